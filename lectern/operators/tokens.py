"""Tokens of verse text in any script, and fingerprints of them.

A text in NFC is cut into runs of letters and marks; a run is a list of letters, each with the marks
that follow it.  Runs of scripts that set no spaces are cut further: Han letter by letter, kana where
the kind changes, Myanmar by syllables.  A token is a piece without its combining marks; a written
token keeps them, so that both lists have the same length by construction.
"""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Myanmar signs that shape syllables.
VIRAMA, ASAT, E_VOWEL = "\u1039", "\u103a", "\u1031"
#: Ranges of Myanmar consonants and independent vowels.
CONSONANTS = [
    (0x1000, 0x102A), (0x103F, 0x103F), (0x1050, 0x1055), (0x105A, 0x105D), (0x1061, 0x1061), (0x1065, 0x1066), (0x106E, 0x1070),
    (0x1075, 0x1081), (0x108E, 0x108E), (0xA9E0, 0xA9E4), (0xA9E7, 0xA9EF), (0xA9FA, 0xA9FE), (0xAA60, 0xAA6F), (0xAA71, 0xAA76),
    (0xAA7A, 0xAA7A), (0xAA7E, 0xAA7F),
]
#: Ranges of Myanmar medials; of unspaced East Asian letters by kind; of signs only S'gaw Karen has, and of Shan ones.
MEDIALS = [(0x103B, 0x103E), (0x105E, 0x1060), (0x1082, 0x1082)]
KINDS = {"han": [(0x4E00, 0x9FFF), (0x3400, 0x4DBF), (0xF900, 0xFAFF)], "hiragana": [(0x3040, 0x309F)], "katakana": [(0x30A0, 0x30FF)]}
KAREN, KAREN_VOWEL, SHAN = "\u1061\u1063\u1064", "\u1062", (0x1075, 0x109F)


def _within(c: str, ranges) -> bool:
    return any(a <= ord(c) <= b for a, b in ranges)


def _kind(c: str) -> str:
    return next((k for k, r in KINDS.items() if _within(c, r)), "")


def _selector(c: str) -> bool:
    """Variation selectors, which choose a form of a letter and are no part of any token."""
    return 0xFE00 <= ord(c) <= 0xFE0F or 0xE0100 <= ord(c) <= 0xE01EF


def _dropped(c: str) -> bool:
    """Marks that a token is without: combining ones but virama and asat, and variation selectors."""
    return _selector(c) or (unicodedata.combining(c) != 0 and c not in (VIRAMA, ASAT))


def strip_marks(text: str) -> str:
    """X16."""
    return "".join(c for c in unicodedata.normalize("NFC", text) if not _dropped(c))


def is_karen(text: str) -> bool:
    """S'gaw Karen by signs of its own, or by its vowel where there is nothing Shan."""
    return any(c in text for c in KAREN) or (KAREN_VOWEL in text and not any(SHAN[0] <= ord(c) <= SHAN[1] for c in text))


def _runs(text: str) -> list[list[str]]:
    """Runs of letters and marks, each letter together with the dropped marks after it."""
    runs: list[list[str]] = []
    open_run = False
    for c in unicodedata.normalize("NFC", text):
        if _dropped(c):
            if open_run and not _selector(c):
                runs[-1][-1] += c
        elif unicodedata.category(c)[0] in "LM":
            if not open_run:
                runs.append([])
            runs[-1].append(c)
            open_run = True
        else:
            open_run = False
    return runs


def _syllable_starts(bare: list[str], karen: bool) -> list[bool]:
    """Where syllables begin in a Myanmar run: at consonants that neither are stacked, nor close a syllable, nor follow a vowel sign written before them."""
    starts, vowel_first = [], False
    for k, c in enumerate(bare):
        before = bare[k - 1] if k else ""
        if _within(c, CONSONANTS):
            after = next((x for x in bare[k + 1 : k + 2]), "")
            closes = after == ASAT and not karen
            starts.append(before != VIRAMA and not closes and not vowel_first)
            vowel_first = False
        elif c == E_VOWEL and not (before and (before == VIRAMA or _within(before, CONSONANTS) or _within(before, MEDIALS))):
            starts.append(True)
            vowel_first = True
        else:
            starts.append(False)
    return starts


def _pieces(run: list[str], karen: bool) -> list[list[str]]:
    """A run cut into tokens."""
    bare = [x[0] for x in run]
    if any(_within(c, CONSONANTS) for c in bare):
        starts = _syllable_starts(bare, karen)
    elif any(_kind(c) for c in bare):
        kinds = [_kind(c) for c in bare]
        starts = [k == "han" or k != p for k, p in zip(kinds, [None, *kinds], strict=False)]
    else:
        return [run]
    out: list[list[str]] = []
    for x, new in zip(run, starts, strict=True):
        if new or not out:
            out.append([])
        out[-1].append(x)
    return out


#: Letters that have no marks of their own and set spaces: here a token is a run of letters, and written so.
_PLAIN = re.compile("[\\x00-\\u02ff]*")
_PLAIN_RUN = re.compile("[" + "".join(re.escape(chr(c)) for c in range(0x300) if unicodedata.category(chr(c))[0] == "L") + "]+")


def token_pairs(text: str | None) -> list[tuple[str, str]]:
    """(token, written token) in order."""
    if _PLAIN.fullmatch(text or ""):
        return [(t, t) for t in _PLAIN_RUN.findall(unicodedata.normalize("NFC", text or ""))]
    karen = is_karen(strip_marks(text or ""))
    return [("".join(x[0] for x in p), "".join(p)) for run in _runs(text or "") for p in _pieces(run, karen)]


def tokenize(text: str | None) -> list[str]:
    """X17."""
    return [a for a, _ in token_pairs(text)]


def tokenize_written(text: str | None) -> list[str]:
    """X21."""
    return [b for _, b in token_pairs(text)]


def tokens_col(c: Column | str, written: bool = False) -> Column:
    run = tokenize_written if written else tokenize

    @F.pandas_udf("array<string>")
    def apply(s: pd.Series) -> pd.Series:
        return s.map(run)

    return apply(c)


def fingerprints(verses: DataFrame, book: list[str], text: str = "text", line: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """(chapters, books) with their SHA-256: ``verses`` has the book's key, chapter and verse (numbers) and text.

    ``line`` is what of a verse is hashed: its tokens joined, or, for the content fingerprint, its
    content string.  Lines are in numeric order of verse and chapter; verses with nothing to hash
    and chapters without verses are left out.
    """
    hashed = line if line is not None else F.array_join(tokens_col(text), " ")
    lines = verses.withColumn("__t", hashed).where("__t != ''")
    line = F.concat(F.col("verse").cast("string"), F.lit(":"), F.col("__t"))
    digest = lambda k, x: F.sha2(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(k, x.alias("l")))), lambda y: y["l"]), "\n"), 256)
    chapters = lines.groupBy(*book, "chapter").agg(digest("verse", line).alias("fp"))
    books = chapters.groupBy(*book).agg(digest("chapter", F.concat(F.col("chapter").cast("string"), F.lit(":"), F.col("fp"))).alias("fp"))
    return chapters, books.withColumn("file_hash", F.substring("fp", 1, 8))


def chapter_digests(verses: DataFrame, book: list[str], text: str = "text") -> DataFrame:
    """(book, chapter, digest): SHA-256 of ``verse TAB text LF`` of a chapter's verses in order; null texts are no verses."""
    line = F.struct("verse", F.concat(F.col("verse").cast("string"), F.lit("\t"), F.col(text), F.lit("\n")).alias("l"))
    told = F.array_join(F.transform(F.array_sort(F.collect_list(line)), lambda x: x["l"]), "")
    return verses.where(F.col(text).isNotNull()).groupBy(*book, "chapter").agg(F.sha2(told, 256).alias("digest"))
