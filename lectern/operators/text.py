"""Text kernels that Spark has no function for, as plain Python and as Arrow UDFs (X*, A21, A22, D34, P37).

The plain functions are importable without a session, so that vectors test them fast.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Letters that look like others are read as these when texts are compared.
HOMOGLYPHS = str.maketrans({
    "\u2019": "'", "\u2018": "'", "\u02bc": "'", "\u02bb": "'", "\ua78c": "'", "\u02c8": "'", "`": "'", "\u00df": "'",
    "\u01e5": "g", "\u2184": "\u0254", "\u1d7e": "\u0289", "\uf21d": "'",
})
#: Signs read as an apostrophe in content strings.
APOSTROPHES = "'\u2019\u02bc\u02bb\ua78c\u00b4`\u2032\uff07"
MODIFIER = "\u02bc"
_ONE_APOSTROPHE = str.maketrans({c: MODIFIER for c in APOSTROPHES})


class _Keep(dict):
    """A table for ``str.translate`` that keeps the characters of some categories, filled as they are met."""

    def __init__(self, kinds: str) -> None:
        self.kinds = kinds

    def __missing__(self, code: int) -> int | None:
        self[code] = code if unicodedata.category(chr(code))[0] in self.kinds else None
        return self[code]


_LETTERS, _LETTERS_AND_MARKS = _Keep("L"), _Keep("LM")


def letters_key(text: str | None) -> str:
    """Lower case, compatibility decomposition, letters only."""
    return unicodedata.normalize("NFKD", (text or "").lower()).translate(_LETTERS)


_BLOCKS = re.compile(r"\\(x|f|rq|fig)\b.*?\\\1\*", re.S)
_TAGS = re.compile(r"\\[A-Za-z0-9]+\*?")


def folded_text(text: str | None) -> str:
    """The first steps of X1 and X2: notes and tags to blanks; lower; look-alikes; NFKD without marks."""
    t = _TAGS.sub(" ", _BLOCKS.sub(" ", text or ""))
    return "".join(c for c in unicodedata.normalize("NFKD", t.lower().translate(HOMOGLYPHS)) if not unicodedata.combining(c))


def normalized_chars(text: str | None) -> str:
    """The folded text's letters and apostrophes only."""
    return "".join(c for c in folded_text(text) if c == "'" or (c.isalnum() and not c.isdecimal()))


def similarity(a: str, b: str) -> float:
    """Twice the matched size over the total, blocks matched recursively, without junk; equal texts are 1."""
    if a == b:
        return 1.0
    return SequenceMatcher(None, a, b, autojunk=False).ratio()


def text_similarity(a: str, b: str) -> float:
    """As X5, but 0 where a side is empty."""
    return similarity(a, b) if a and b else 0.0


def word_similarity(a: str, b: str) -> float:
    """As X5 over words; an empty text has none."""
    x, y = a.split(" ") if a else [], b.split(" ") if b else []
    return 1.0 if x == y else SequenceMatcher(None, x, y, autojunk=False).ratio()


def normal_form(text: str | None) -> str:
    """Which normal form a text is in: none (indifferent), NFC, NFD or mixed."""
    t = text or ""
    c, d = unicodedata.normalize("NFC", t) == t, unicodedata.normalize("NFD", t) == t
    return "none" if c and d else "NFC" if c else "NFD" if d else "mixed"


def strip_marks(text: str) -> str:
    """NFC without combining marks (but asat and virama of Myanmar) and variation selectors."""
    kept = "\u1039\u103a"
    return "".join(c for c in unicodedata.normalize("NFC", text) if (c in kept or not unicodedata.combining(c)) and not 0xFE00 <= ord(c) <= 0xFE0F)


def written_tokens(text: str) -> list[str]:
    """X17 of texts in spaced scripts: maximal runs of letters and marks."""
    out, own = [], []
    for c in unicodedata.normalize("NFC", text or ""):
        if unicodedata.category(c)[0] in "LM":
            own.append(c)
        elif own:
            out.append("".join(own))
            own = []
    return [*out, "".join(own)] if own else out


def content(text: str | None) -> str:
    """NFC, lower case, final sigma as sigma, one apostrophe, letters and marks only."""
    t = unicodedata.normalize("NFC", text or "").lower().replace("ς", "σ")
    return unicodedata.normalize("NFC", t.translate(_ONE_APOSTROPHE)).translate(_LETTERS_AND_MARKS)


def letter_index(n: int) -> str:
    """0 is a, 25 z, 26 aa."""
    out = ""
    n += 1
    while n:
        n, k = divmod(n - 1, 26)
        out = chr(97 + k) + out
    return out


def edits(a: str, b: str) -> list[tuple[int, int, int, int]]:
    """Where two texts differ: (start, end) of the part of a, and of b."""
    return [tuple(places) for tag, *places in SequenceMatcher(None, a, b, autojunk=False).get_opcodes() if tag != "equal"]


def hunks(a: str, b: str) -> list[tuple[str, str, str]]:
    """What differs: (tag, part of a, part of b)."""
    kind = lambda i, j, k, m: "insert" if i == j else "delete" if k == m else "replace"
    return [(kind(i, j, k, m), a[i:j], b[k:m]) for i, j, k, m in edits(a, b)]


def dominant_pair(found: list[tuple[str, str, str]]) -> tuple[tuple[str, str] | None, float, int]:
    """The most frequent edit, its share, and how many kinds make up 80 %; ties by first occurrence."""
    counts = Counter((x, y) for _, x, y in found)
    if not counts:
        return None, 0.0, 0
    ranked = sorted(counts, key=lambda p: -counts[p])
    total, seen = sum(counts.values()), 0
    for k, p in enumerate(ranked, 1):
        seen += counts[p]
        if seen >= 0.8 * total:
            break
    return ranked[0], counts[ranked[0]] / total, k


def _udf(function, kind):
    def run(s: pd.Series) -> pd.Series:
        return s.map(function)

    return F.pandas_udf(run, kind)


def letters_key_col(c: Column | str) -> Column:
    return _udf(letters_key, T.StringType())(c)


def normalized_chars_col(c: Column | str) -> Column:
    return _udf(normalized_chars, T.StringType())(c)


def content_col(c: Column | str) -> Column:
    return _udf(content, T.StringType())(c)


def normal_form_col(c: Column | str) -> Column:
    return _udf(normal_form, T.StringType())(c)


def similarity_col(a: Column | str, b: Column | str) -> Column:
    """X5 rounded to four places as the binary value; equal texts are answered without the UDF."""

    def run(x: pd.Series, y: pd.Series) -> pd.Series:
        return pd.Series([round(similarity(p, q), 4) for p, q in zip(x, y, strict=True)])

    score = F.pandas_udf(run, T.DoubleType())
    a, b = F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b
    return F.when(a == b, F.lit(1.0)).otherwise(score(a, b))


def clean_text(c: Column) -> Column:
    """X9, its white-space part: runs of JavaScript white space to one blank, ends trimmed."""
    space = r"[\t\n\x0b\x0c\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff]+"
    return F.trim(F.regexp_replace(c, space, " "))


def first_number(c: Column) -> Column:
    """What stands before the first hyphen, dash or comma of a verse label."""
    return F.get(F.split(c, "[-,\u2010-\u2015]"), F.lit(0))
