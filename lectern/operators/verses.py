"""Verse text from marked-up chapters (X9-X13): USJ books, Sofria chapters and plain rows.

A tree is first flattened to a stream of events, which one fold turns into verses:

    ("chapter", number)   a chapter begins
    ("verse", number, g)  a verse number; g tells whether it is printed in the text
    ("text", string)      text of the current verse

What is not verse text (notes, headings, introductions, figures, remarks) never becomes an event.
"""

from __future__ import annotations

import json
import re
import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: White space as JavaScript has it.
SPACE = "\t\n\v\f\r \u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"
#: Paragraph markers of headings, of what is no text, character markers of what is no text.
HEADINGS, LEVEL_HEADINGS = frozenset("mr r sr sp cl qa cd d".split()), frozenset("s ms mt mte".split())
NO_TEXT, LEVEL_NO_TEXT = frozenset("rem restore cp ide".split()), frozenset("h toc toca".split())
NO_CHARACTERS = frozenset({"rq", "qac", "fm", "vp", "va", "ca", "fig"})
#: Grafts without verse text, and signs that open a quotation.
NO_GRAFT = frozenset({"heading", "title", "introduction", "end_title", "remark", "fig", "footnote", "xref", "note_caller"})
OPENING = frozenset("«“\"‘'<&¿¡([—-")

_SPACES = re.compile(f"[{SPACE}]+")
_LEVEL = "0123456789"
_PIPE_VALUE = re.compile(r'\| default="?([^"|]*)"?')
_LEGACY = re.compile(r"\|(sc|i|r|d)")
Event = tuple


def _is_heading(marker: str) -> bool:
    return marker in HEADINGS or marker.rstrip(_LEVEL) in LEVEL_HEADINGS


def _is_no_text(marker: str) -> bool:
    """Whether a paragraph holds no verse text: introductions, all of whose markers begin with i, among them."""
    return marker in NO_TEXT or marker.rstrip(_LEVEL) in LEVEL_NO_TEXT or bool(re.fullmatch(r"i\w+", marker, re.A))


def clean(text: str) -> str:
    """Pipe values restored, legacy formatting codes dropped where they stand as such, white space collapsed."""
    text = _PIPE_VALUE.sub(r"|\1", text)

    def code(m: re.Match) -> str:
        after = text[m.end() : m.end() + 1]
        kind = unicodedata.category(after) if after else ""
        blank = bool(_SPACES.match(after))
        if m[1] in ("sc", "i"):
            goes = bool(after) and (blank or kind == "Lu" or after in OPENING)
        else:
            goes = not after or blank or kind[0] == "P"
        return "" if goes else m[0]

    return _SPACES.sub(" ", _LEGACY.sub(code, text)).strip(" ")


def first_number(label: str) -> str:
    """The first number of a verse label."""
    return re.split("[-,\u2010-\u2015]", _SPACES.sub(" ", label).strip(" "))[0].strip(" ")


def _label(value) -> str:
    value = value[0] if isinstance(value, list) and value else value
    return str(int(value)) if isinstance(value, float) and value.is_integer() else str(value)


def _word(content: list | None) -> list:
    """The content of a word up to an attribute that was left in its text."""
    kept: list = []
    for item in content or []:
        if isinstance(item, str) and "|" in item:
            return [*kept, item.split("|", 1)[0]]
        kept.append(item)
    return kept


class _Line:
    """Text of one paragraph; that of a heading counts only after a verse number in it."""

    def __init__(self, heading: bool = False) -> None:
        self.shown = not heading


def _usj_inline(items, line: _Line) -> Iterator[Event]:
    for item in items or []:
        if isinstance(item, str):
            if line.shown:
                yield "text", item
        elif isinstance(item, dict):
            kind, marker = item.get("type"), item.get("marker")
            if kind == "verse":
                line.shown = True
                yield "verse", _label(item.get("number")), True
            elif kind in ("note", "figure", "ms", "optbreak") or (kind == "char" and marker in NO_CHARACTERS):
                continue
            else:
                yield from _usj_inline(_word(item.get("content")) if kind == "char" and marker == "w" else item.get("content"), line)


def usj_events(node: dict) -> Iterator[Event]:
    """Events of a USJ book; what stands before its first chapter is skipped by the fold."""
    for item in node.get("content") or []:
        if not isinstance(item, dict):
            continue
        kind, marker = item.get("type"), item.get("marker") or ""
        if kind == "chapter":
            yield "chapter", _label(item.get("number"))
        elif kind in ("note", "figure") or (kind == "para" and _is_no_text(marker)):
            continue
        elif kind in ("table", "table:row", "row"):
            yield from usj_events(item)
        else:
            yield from _usj_inline(item.get("content"), _Line(kind == "para" and _is_heading(marker)))
            if kind in ("para", "table:cell", "cell"):
                yield "text", " "


def _usfm(subtype: str | None) -> str:
    return (subtype or "").removeprefix("usfm:")


def _sofria_inline(items, line: _Line, state: dict) -> Iterator[Event]:
    for item in items or []:
        if isinstance(item, str):
            if line.shown:
                yield "text", item
            continue
        if not isinstance(item, dict):
            continue
        kind, sub, atts = item.get("type"), item.get("subtype"), item.get("atts") or {}
        if kind == "mark" and sub == "verses_label":
            line.shown = True
            state["begun"] = True
            yield "verse", _label(atts.get("number")), True
        elif kind == "wrapper":
            if sub == "chapter" and state.setdefault("chapter", _label(atts.get("number"))) != _label(atts.get("number")):
                continue  # the label of the next chapter can close a document
            if sub == "verses" and atts.get("number") is not None and not state.get("begun"):
                state["begun"] = True
                yield "verse", _label(atts["number"]), False
            if _usfm(sub) in NO_CHARACTERS:
                continue
            edge = [("text", " ")] if sub == "cell" else []
            yield from edge
            yield from _sofria_inline(_word(item.get("content")) if sub == "usfm:w" else item.get("content"), line, state)
            yield from edge


def sofria_events(document: dict) -> Iterator[Event]:
    """Events of a Sofria chapter."""
    state: dict = {}

    def blocks(items) -> Iterator[Event]:
        for b in items or []:
            inner = b.get("sequence") or {}
            if b.get("type") == "graft":
                if (inner.get("type") or b.get("subtype") or "") not in NO_GRAFT:
                    yield from blocks(inner.get("blocks"))
            elif b.get("type") == "row":
                for cell in b.get("content") or []:
                    yield from _sofria_inline([cell], _Line(), state)
                    yield "text", " "
            elif not _is_no_text(_usfm(b.get("subtype"))):
                yield from _sofria_inline(b.get("content"), _Line(_is_heading(_usfm(b.get("subtype")))), state)
                yield "text", " "

    yield "chapter", ""
    yield from blocks((document.get("sequence") or {}).get("blocks"))


def plain_events(rows: list[dict]) -> Iterator[Event]:
    """Events of plain verse rows (verse_start, verse_text)."""
    yield "chapter", ""
    for row in rows:
        yield "verse", _label(row.get("verse_start")), True
        yield "text", " " + re.sub("~|//", " ", row.get("verse_text") or "")


def fold(events: Iterator[Event]) -> list[tuple[str, str, str]]:
    """(chapter, verse, text) in order: pieces of a verse together, under its first number; empty ones left out."""
    found: dict[tuple[str, str], list[str]] = {}
    chapter = verse = None
    for event in events:
        if event[0] == "chapter":
            chapter, verse = event[1], None
        elif chapter is None:
            continue
        elif event[0] == "verse":
            key = (chapter, first_number(event[1]))
            if event[2] and verse != event[1] and key in found:
                found[key].append(" ")  # seen before: both texts, set off by a blank
            verse = event[1]
        elif verse is not None:
            found.setdefault((chapter, first_number(verse)), []).append(event[1])
    texts = [(c, v, clean("".join(parts))) for (c, v), parts in found.items()]
    return [x for x in texts if x[2]]


_READERS = {"usj": usj_events, "sofria": sofria_events, "plain": plain_events}


def extract(raw: str | None, route: str) -> list[tuple[str, str, str]]:
    """Verses of a JSON text by route; a text that does not parse has none."""
    try:
        return fold(_READERS[route](json.loads(raw or "null") or ({} if route != "plain" else [])))
    except (ValueError, AttributeError):
        return []


def extract_col(raw: Column | str, route: str) -> Column:
    """``extract`` as an array of (chapter, verse, text)."""

    @F.pandas_udf("array<struct<chapter:string,verse:string,text:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"chapter": c, "verse": v, "text": t} for c, v, t in extract(x, route)])

    return run(raw)


def verse_table(books: DataFrame, key: list[str], raw: str, route: str) -> DataFrame:
    """One row per verse: the key, chapter, verse, ord (place in the book) and text."""
    each = books.select(*key, F.posexplode(extract_col(raw, route)).alias("ord", "v"))
    return each.select(*key, "v.chapter", "v.verse", "ord", "v.text")
