"""Kernels over marked-up source text and its trees.

Every kernel takes one chapter or book, so that a table of them is split over tasks at will.  Texts
that are null count as empty throughout.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterator

import pandas as pd
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators import text as kernels

#: Line markers of headings (some with a level) and introductions (with any level).
HEADINGS, LEVEL_HEADINGS = frozenset("cl r sr mr sp xt".split()), frozenset("s ms".split())
INTRODUCTIONS = frozenset("imt imte imq im imi ip ipi ipq ipr is iq ib ili iot io iex ie".split())
#: Line markers of text, and those that may have a level.
TEXTS, LEVEL_TEXTS = frozenset("v p m mi nb pc qr qc b tr".split()), frozenset("pi ph q qm li lim".split())
#: Fixed value: the sign that stands for pipes of plain text.
PIPE = "\ue000"
#: Notes, whose pipes are all left alone.
NOTES = ("f", "fe", "x")
#: Alignment marks of source texts, with what is left of each.
ALIGNMENT = [(r"\\zaln-s\s*\|[^\\]*\\\*|\\zaln-e\\\*", ""), (r"\\w\s+([^|\\]*?)(?:\|[^\\]*?)?\\w\*", "$1"), (r"\\ts\b(?:\\\*)?", ""), (r"(?m)^\\s5[ \t]*$\n?", "")]
#: Paragraphs that the older walker leaves out.
OLD_HEADINGS = frozenset("s s1 s2 s3 s4 ms ms1 ms2 mr sr d sp cl r mte mte1 mte2".split())

_MARKER = re.compile(r"\\(\w*)")
_TOKEN = re.compile(r"\\(?P<nested>\+?)(?P<name>[a-z]+\d*)(?P<side>-[se])?(?P<close>\*?)|(?P<pipe>\|)|(?P<other>\\)")
_WORD_EDGE = regex.compile(r"(?V1w)\b")
_VERSE = re.compile(r"\\v\s+(\d+)(?:-(\d+))?\s*")


def chapter_lines(usfm: str | None, chapter: int) -> Iterator[str]:
    """Lines of one chapter; a line ``\\c`` of another number ends it."""
    inside = False
    for line in (usfm or "").splitlines():
        if line.startswith("\\c "):
            inside = line.strip() == f"\\c {chapter}"
        elif inside:
            yield line


def _level(marker: str) -> tuple[str, int]:
    stem = marker.rstrip("0123456789")
    return stem, len(marker) - len(stem)


def is_heading_line(marker: str) -> bool:
    stem, digits = _level(marker)
    return marker in HEADINGS or stem in INTRODUCTIONS or (stem in LEVEL_HEADINGS and digits < 2)


def is_text_line(marker: str) -> bool:
    stem, digits = _level(marker)
    return marker in TEXTS or (stem in LEVEL_TEXTS and digits < 2) or bool(re.fullmatch("pm[a-z]*", marker))


def without_headings(lines: Iterator[str], by_words: bool = False) -> Iterator[str]:
    """Lines that are no heading or introduction, nor follow one before text starts again.

    A title line without a verse in it goes too.  ``by_words`` is the rule of the word path (X4): any
    marker starts text again and title lines stay.
    """
    hidden = False
    for line in lines:
        found = _MARKER.match(line)
        if found:
            marker = found[1]
            untold = marker == "d" and "\\v " not in line and not by_words
            if is_heading_line(marker) or untold:
                hidden = True
                continue
            hidden = hidden and not (by_words or is_text_line(marker))
        if not hidden:
            yield line


def chapter_letters(usfm: str | None, chapter: int) -> str:
    """The letters of a chapter, as texts are compared."""
    return kernels.normalized_chars("\n".join(without_headings(chapter_lines(usfm, chapter))))


def normalized_words(source: str | None) -> str:
    """The words of a text set off by one blank; edges by the word rule of Unicode, numbers left out.

    Scripts without blanks, which a dictionary would cut, stay as that rule cuts them.
    """
    folded = kernels.folded_text(source)
    return " ".join(w for w in _WORD_EDGE.split(folded) if any(map(str.isalpha, w)))


def chapter_words(usfm: str | None, chapter: int) -> str:
    """The words of a chapter."""
    return normalized_words("\n".join(without_headings(chapter_lines(usfm, chapter), by_words=True)))


def _attribute_end(usfm: str, at: int, open_: list[str]) -> int | None:
    """Where attributes that begin at the pipe ``at`` end: after the close of one of the markers ``open_``."""
    stop = usfm.find("\\", at)
    ends = [stop + len(name) + 2 for name in open_ if stop >= 0 and usfm.startswith(f"{name}*", stop + 1)]
    return ends[0] if ends else None


def plain_pipes(usfm: str) -> list[int]:
    """Places of the pipes that are plain text: neither attributes of markers and milestones, nor in notes or remarks.

    Attributes run from the first pipe in a marker to its close, with no other marker between; only
    nested markers may stand before that pipe.
    """
    found, open_, at = [], [], 0
    while token := _TOKEN.search(usfm, at):
        at, name, pipe = token.end(), token["name"], token["pipe"]
        end = None
        if pipe:
            end = _attribute_end(usfm, token.start(), open_)
            if end is None:
                found.append(token.start())
            open_ = []
        elif token["close"] or token["other"]:
            open_ = open_ if token["nested"] else []
        elif token["side"]:
            attributes = re.compile(r"\s*\|[^\\]*\\\*").match(usfm, at)
            end, open_ = attributes and attributes.end(), []
        elif name == "rem" and not token["nested"]:
            line = usfm.find("\n", at)
            end, open_ = line if line >= 0 else len(usfm), []
        elif name in NOTES and not token["nested"] and usfm.find(f"\\{name}*", at) >= 0 and usfm[at : at + 1].isspace():
            end, open_ = usfm.find(f"\\{name}*", at) + len(name) + 2, []
        else:
            marker = [token["nested"] + name] if usfm[at : at + 1].isspace() else []
            open_ = [*(open_ if token["nested"] else []), *marker]
        at = end or at
    return found


def protect_pipes(usfm: str | None) -> str:
    """Pipes that are plain text become a private sign; a text that holds it already is an error."""
    usfm = usfm or ""
    if PIPE in usfm:
        raise ValueError("the text holds the sign U+E000, which stands for pipes")
    edges = [-1, *plain_pipes(usfm), len(usfm)]
    return PIPE.join(usfm[a + 1 : b] for a, b in zip(edges, edges[1:], strict=False))


def restore_pipes(node):
    """The tree with its pipes again."""
    return _mapped(node, lambda s: s.replace(PIPE, "|"))


def _mapped(node, f: Callable[[str], str]):
    if isinstance(node, str):
        return f(node)
    if isinstance(node, list):
        return [_mapped(x, f) for x in node]
    return {k: _mapped(v, f) for k, v in node.items()} if isinstance(node, dict) else node


def unaligned(source: Column | str) -> Column:
    """X31, in the JVM: a text without its alignment marks."""
    out = F.col(source) if isinstance(source, str) else source
    for pattern, left in ALIGNMENT:
        out = F.regexp_replace(out, pattern, left)
    return out


def _is_word(node) -> bool:
    return isinstance(node, dict) and node.get("type") == "char" and node.get("marker") == "w"


def space_words(node):
    """The tree with a blank between words that touch."""
    if isinstance(node, list):
        return [space_words(x) for x in node]
    if not isinstance(node, dict):
        return node
    out = {k: space_words(v) for k, v in node.items() if k != "content"}
    if "content" in node:
        items = node["content"]
        if isinstance(items, list):
            spaced: list = []
            for before, item in zip([None, *items], items, strict=False):
                spaced += [" "] if _is_word(before) and _is_word(item) else []
                spaced.append(space_words(item))
            items = spaced
        out["content"] = items
    return out


def drop_strongs(node):
    """The tree without Strong's numbers: words that have no other attribute become plain text."""
    if isinstance(node, list):
        return [drop_strongs(x) for x in node]
    if not isinstance(node, dict) or not isinstance(node.get("content"), list):
        return node
    flat: list = []
    for item in node["content"]:
        item = drop_strongs(item)
        parts = [item]
        if isinstance(item, dict) and item.get("marker") == "w" and "strong" in item:
            item = {k: v for k, v in item.items() if k != "strong"}
            parts = item.get("content") or [] if item.keys() <= {"type", "marker", "content"} else [item]
        for part in parts:
            if isinstance(part, str) and flat and isinstance(flat[-1], str):
                flat[-1] += part
            else:
                flat.append(part)
    return {**node, "content": flat}


def _old_events(node) -> Iterator[tuple]:
    """Events of the older walker: chapter, verse and text; notes and headings yield none."""
    if isinstance(node, str):
        yield "text", node
    if not isinstance(node, dict):
        return
    kind = node.get("type")
    if kind in ("chapter", "verse"):
        yield kind, node.get("number")
    elif kind != "note" and not (kind == "para" and node.get("marker") in OLD_HEADINGS):
        if kind == "para":
            yield "text", " "
        for item in space_words({"content": node.get("content") or []})["content"]:
            yield from _old_events(item)


def _graft_free(node) -> Iterator[tuple]:
    if isinstance(node, str):
        yield "text", node
    elif isinstance(node, dict) and node.get("type") == "mark":
        if node.get("subtype") == "verses_label":
            yield "verse", (node.get("atts") or {}).get("number")
    elif isinstance(node, dict) and node.get("type") != "graft":
        for item in node.get("content") or []:
            yield from _graft_free(item)


def _sofria_events(document: dict) -> Iterator[tuple]:
    chapter = (((document.get("metadata") or {}).get("document") or {}).get("properties") or {}).get("chapters")
    yield "chapter", chapter or 0
    for block in (document.get("sequence") or {}).get("blocks") or []:
        yield "text", " "
        yield from _graft_free(block)


def _last_texts(events: Iterator[tuple]) -> dict[tuple[int, str], str]:
    """Texts by chapter and verse label, white space collapsed; of a label seen again the later text holds."""
    found: dict[tuple[int, str], str] = {}
    chapter = verse = None
    parts: list[str] = []
    for kind, value in [*events, ("end", None)]:
        if kind == "text":
            parts.append(value)
            continue
        joined = " ".join("".join(parts).split())
        if joined and chapter is not None and verse is not None:
            found[chapter, verse] = joined
        parts = []
        chapter, verse = (int(value), None) if kind == "chapter" else (chapter, value)
    return found


def old_verses(tree: dict) -> dict[tuple[int, str], str]:
    """Verse texts of a USJ book by the older rule."""
    return _last_texts(_old_events({"content": tree.get("content")}))


def old_sofria_verses(document: dict) -> dict[tuple[int, str], str]:
    """C14: verse texts of a Sofria chapter by the older rule."""
    return _last_texts(_sofria_events(document))


def reading_strings(node) -> Iterator[str]:
    """Strings of a chapter's content that are read."""
    if isinstance(node, str):
        yield node
    elif isinstance(node, list):
        for item in node:
            yield from reading_strings(item)
    elif isinstance(node, dict) and node.get("type") not in ("footnote", "heading", "hebrew_subtitle"):
        for key in ("text", "content"):
            yield from reading_strings(node.get(key))


def content_letters(chapter: dict) -> str:
    """The letters of a chapter's verses, as texts are compared."""
    items = (i for b in chapter.get("content") or [] if b.get("type") == "verse" for i in b.get("content") or [])
    return kernels.normalized_chars(" ".join(i if isinstance(i, str) else i["text"] for i in items if isinstance(i, str) or (isinstance(i, dict) and "text" in i)))


def chapter_verses(usfm: str | None, chapter: int) -> dict[int, str]:
    """Verse number to raw text; a bridge stands under each of its numbers."""
    body = "\n".join(chapter_lines(usfm, chapter))
    marks = list(_VERSE.finditer(body))
    ends = [*(m.start() for m in marks), len(body)][1:]
    return {n: body[m.end() : end].strip() for m, end in zip(marks, ends, strict=True) for n in range(int(m[1]), int(m[2] or m[1]) + 1)}


def _marked(usfm: str) -> list[tuple[str, str]]:
    """(marker, what follows it up to the next one), in order."""
    return [(part[: len(part) - len(part.lstrip("+*-abcdefghijklmnopqrstuvwxyz0123456789"))], part.lstrip("+*-abcdefghijklmnopqrstuvwxyz0123456789")) for part in usfm.split("\\")[1:]]


def _number(text: str) -> int | None:
    """The number that a text begins with after a blank."""
    digits = re.match(r"\s+(\d+)", text)
    return int(digits[1]) if digits else None


def title_probe(usfm: str | None, chapter: int) -> tuple[int | None, str | None]:
    """The last verse of a chapter, and what stands before its verse 1: a heading, a note or nothing.

    A title marker right before verse 1 has nothing in it and is no heading.
    """
    inside, last, before, begun = False, None, [], False
    for marker, rest in _marked(usfm or ""):
        number = _number(rest) if marker in ("c", "v") else None
        if marker == "c" and number is not None:
            if inside:
                break
            inside = number == chapter
        elif inside:
            begun = begun or (marker == "v" and bool(re.match(r"\s+1\b", rest)))
            last = max(last or 0, number) if number is not None else last
            before += [] if begun else [(marker, rest)]
    titled = any(m == "d" for m, _ in before) and not (before[-1][0] == "d" and not before[-1][1].strip())
    return last, "heading" if titled else "note" if any(m == "f" for m, _ in before) else None


def _parsed(raw: str | None) -> dict:
    try:
        tree = json.loads(raw or "{}")
    except ValueError:
        return {}
    return tree if isinstance(tree, dict) else {}


def text_col(f: Callable[[str | None], str | None], source: Column | str) -> Column:
    """A text kernel as an Arrow UDF."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(f, na_action=None)

    return run(source)


def json_col(f: Callable[[dict], object], source: Column | str) -> Column:
    """A tree kernel as an Arrow UDF from JSON to JSON; what is no tree counts as an empty one."""
    return text_col(lambda raw: json.dumps(f(_parsed(raw)), ensure_ascii=False), source)


def old_verse_table(books: DataFrame, key: list[str], raw: str, sofria: bool = False) -> DataFrame:
    """One row per verse: the key, chapter, verse and text."""
    f = old_sofria_verses if sofria else old_verses

    @F.pandas_udf("array<struct<chapter:int,verse:string,text:string>>")
    def run(s: pd.Series) -> pd.Series:
        return s.map(lambda x: [{"chapter": c, "verse": v, "text": t} for (c, v), t in f(_parsed(x)).items()], na_action=None)

    return books.select(*key, F.explode(run(raw)).alias("__v")).select(*key, "__v.*")


def chapter_verse_table(books: DataFrame, key: list[str], raw: str, chapter: str) -> DataFrame:
    """One row per verse number of the chapter that a row names."""

    @F.pandas_udf("map<int,string>")
    def run(s: pd.Series, c: pd.Series) -> pd.Series:
        return pd.Series([chapter_verses(x, n) for x, n in zip(s, c, strict=True)])

    return books.select(*key, F.explode(run(raw, chapter)).alias("verse", "text"))
