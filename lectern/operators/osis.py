"""OSIS verses to USFM (C4): an XML reader emits events by a table of elements, one pass lays them out.

Verses are read apart, since a fragment must be well formed on its own, but laid out as one stream
per chapter, in which a paragraph lasts over verses until the next one or a heading.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterable, Iterator
from xml.parsers import expat

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class Unsupported(ValueError):
    """Markup that has no counterpart."""


#: What stands before and after the text of an element, by name and type (for ``q`` the speaker).
AROUND = {
    ("transChange", "added"): ("\\add ", "\\add*"),
    ("hi", "bold"): ("\\bd ", "\\bd*"),
    ("hi", "italic"): ("\\it ", "\\it*"),
    ("q", "Jesus"): ("\\wj ", "\\wj*"),
    ("note", "crossReference"): ("\\x - \\xt ", "\\x*"),
    ("note", None): ("\\f + \\ft ", "\\f*"),
}
#: Headings, elements whose text is left out, and those of which only the text is taken.
TITLES = {"psalm": "\\d", "acrostic": "\\qa", None: "\\s1"}
LEFT_OUT = {("title", "main"), ("hi", "super")}
TEXT_ONLY = {"foreign", "transChange", "q", "reference"}
#: Paragraph marks, and empty elements that say nothing.
PARAGRAPHS = {"x-p", "paragraph"}
SILENT = {"div", "chapter", "lg", "verse", "milestone"}

_ENTITY = re.compile(r"&(?!(?:amp|lt|gt|quot|apos);|#)\w+;")
_EMPTY = re.compile(r"<(\w+)((?:\s[^<>]*)?)/>")


class _Reader:
    """Events of one verse: text, inline (marks beside text), close, title, end_title, paragraph, mark (of a further verse)."""

    def __init__(self, chapter: int, verse: int) -> None:
        self.where, self.chapter, self.events = f"{chapter}:{verse}", chapter, [("verse", verse)]
        self.ends: list[tuple | None] = []  # what follows each open element
        self.mute = self.note = 0  # depth at which text is left out or lies in a note
        self.colophon = False

    def read(self, markup: str) -> list[tuple]:
        parser = expat.ParserCreate()
        parser.buffer_text = True
        parser.StartElementHandler, parser.EndElementHandler, parser.CharacterDataHandler = self.start, self.end, self.say
        # Empty elements are told from those without text by an attribute.
        told = _EMPTY.sub(r'<\1\2 empty-element="1"/>', _ENTITY.sub(lambda m: html.escape(html.unescape(m[0])), markup))
        try:
            parser.Parse(f"<fragment>{told}</fragment>", True)
        except expat.ExpatError as e:
            raise Unsupported(f"{self.where}: unbalanced or broken markup ({expat.errors.messages[e.code]})") from None
        if self.colophon:
            raise Unsupported(f"{self.where}: not closed: colophon")
        return self.events

    def add(self, *event) -> None:
        if not self.mute and not self.colophon:
            self.events.append(event)

    def say(self, text: str) -> None:
        self.add("text", text)

    def start(self, name: str, atts: dict) -> None:
        kind, end, depth = atts.get("type"), None, len(self.ends) + 1
        if name == "fragment" or self.mute or self.note:
            pass
        elif atts.keys() & {"empty-element", "sID", "eID"}:
            self.point(name, kind, atts)
        elif (name, kind) in LEFT_OUT:
            self.mute = depth
        elif name == "title":
            self.add("title", TITLES.get(kind, TITLES[None]))
            end = ("end_title",)
        else:
            key = (name, atts.get("who") if name == "q" else kind)
            before, after = AROUND.get(key) or (AROUND[name, None] if name == "note" else (None, None))
            if before:
                self.add("inline", before)
                end = ("close", after)
            elif name not in TEXT_ONLY:
                raise Unsupported(f"{self.where}: <{name} {kind or ''}>")
            self.note = depth if name == "note" else self.note
        self.ends.append(end)

    def end(self, name: str) -> None:
        depth, event = len(self.ends), self.ends.pop()
        self.mute = 0 if self.mute == depth else self.mute
        self.note = 0 if self.note == depth else self.note
        if event:
            self.add(*event)

    def point(self, name: str, kind: str | None, atts: dict) -> None:
        over = "eID" in atts
        if (name, kind) == ("div", "colophon"):
            self.colophon = not over
        elif (name, kind) == ("l", "selah"):
            self.add(*(("close", "\\qs*") if over else ("inline", "\\qs ")))
        elif over:
            pass
        elif name == "l":
            self.add("paragraph", f"\\q{atts.get('level', '1')}")
        elif name == "div" and kind in PARAGRAPHS:
            self.add("paragraph", "\\p")
        elif (name, kind) == ("milestone", "x-versemarker"):
            if int(atts.get("cnum", self.chapter)) == self.chapter:
                self.add("mark", atts["vnum"])
        elif name not in SILENT:
            raise Unsupported(f"{self.where}: <{name} {kind or ''}/>")


def _laid_out(events: Iterable[tuple]) -> Iterator[str]:
    """The text of a chapter in pieces.  A verse is numbered at its first text; text after a heading resumes the paragraph."""
    marker, running, number, heading = "\\p", False, None, False
    for kind, *value in events:
        if kind == "verse":
            number = value[0]
            yield "\n"
        elif kind == "paragraph":
            marker, running = value[0], True
            yield f"\n{marker}\n"
        elif kind == "title":
            heading = True
            yield f"\n{value[0]} "
        elif kind == "end_title":
            heading = running = False
            yield "\n"
        elif kind == "close" or (heading and kind == "text"):
            yield value[0]
        elif kind != "text" or value[0].strip() or number is None:
            if not running:
                running = True
                yield f"\n{marker}\n"
            if number is not None:
                yield f"\n\\v {number} "
                number = None
            yield f"\n\\v {value[0]} " if kind == "mark" else value[0]


def osis_to_usfm(verses: list[tuple[int, int, str]]) -> str:
    """OSIS fragments (chapter, verse, markup), in order, as the USFM of a book after its ``\\id``.

    Markup without a counterpart, and elements that are not closed in their verse, raise ``Unsupported``.
    Null markup counts as empty.
    """
    chapters: dict[int, list[tuple]] = {}
    for c, v, markup in verses:
        chapters.setdefault(c, []).extend(_Reader(c, v).read(markup or ""))
    text = "\n".join(f"\\c {c}\n{''.join(_laid_out(events))}" for c, events in chapters.items())
    return "\n".join(line for line in (x.strip(" \t") for x in text.split("\n")) if line).strip() + "\n"


def converted_osis(verses: DataFrame, key: list[str]) -> DataFrame:
    """C4: (key, usfm, error) per book from rows of (key, chapter, verse, osis); a book fails alone.

    A book is bounded by nature, so its verses may meet in one row.
    """

    @F.pandas_udf("struct<usfm:string,error:string>")
    def run(s: pd.Series) -> pd.DataFrame:
        def one(items):
            try:
                return osis_to_usfm([(x["chapter"], x["verse"], x["osis"]) for x in items]), None
            except Unsupported as e:
                return None, str(e)

        return pd.DataFrame([one(x) for x in s], columns=["usfm", "error"])

    books = verses.groupBy(*key).agg(F.sort_array(F.collect_list(F.struct("chapter", "verse", "osis"))).alias("__v"))
    return books.select(*key, run("__v").alias("__u")).select(*key, "__u.*")
