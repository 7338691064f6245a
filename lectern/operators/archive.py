"""The succinct archive of texts: reading, writing, and its verses (S17, C6, C12; parts of C7, C10 and C11).

An archive is gzipped JSON.  Its strings stand once each in five tables of counted strings; blocks of
its sequences are runs of items in bytes.  An item is a byte of kind (two bits) and length (six), a byte
of subtype, and indexes into the tables as numbers of base 128, low digits first, the last byte marked.

In memory an archive is a plain tree: {id, selectors, docs: {id: {headers, mainId, sequences: {id: {type,
blocks: [{bs, bg, c}]}}}}}; bs is a label, bg a list of (type, sequence), c a list of items
("token", kind, text), ("start", label), ("end", label) or ("graft", type, sequence).
"""

from __future__ import annotations

import base64
import gzip
import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Kinds of items, of tokens and of scopes, in the order of their numbers; table names.
ITEMS = ("token", "graft", "start", "end")
TOKENS = ("wordLike", "punctuation", "lineSpace", "eol", "softLineBreak", "noBreakSpace", "bareSlash", "unknown")
SCOPES = (
    "blockTag", "inline", "chapter", "pubChapter", "altChapter", "verses", "verse", "pubVerse", "altVerse", "esbCat", "span", "table", "cell", "milestone",
    "spanWithAtts", "attribute", "hangingGraft", "orphanTokens", "tTableRow", "tTableCol", "tTreeNode", "tTreeParent", "tTreeChild", "tTreeContent",
    "kvPrimary", "kvSecondary", "kvField",
)
#: Fields of a scope's label after its kind, where it is not one.
FIELDS = {"orphanTokens": 0, "hangingGraft": 0, "table": 0, "tTreeChild": 2, "kvSecondary": 2, "cell": 3, "attribute": 5}
TABLES = ("ids", "wordLike", "notWordLike", "scopeBits", "graftTypes")
MOST_ITEM, MOST_STRING = 63, 255


class BadArchive(ValueError):
    """Bytes that are no archive, or a tree that cannot be written as one."""


def number(n: int) -> bytes:
    """A number of base 128."""
    out = bytearray()
    while n > 127:
        out.append(n & 127)
        n >>= 7
    out.append(n | 128)
    return bytes(out)


def read_number(data: bytes, at: int) -> tuple[int, int]:
    """The number that begins at a place, and the place after it."""
    value = shift = 0
    while data[at] < 128:
        value |= data[at] << shift
        at, shift = at + 1, shift + 7
    return value | (data[at] & 127) << shift, at + 1


def strings(data: bytes) -> list[str]:
    """A table of counted strings."""
    out, at = [], 0
    while at < len(data):
        end = at + 1 + data[at]
        out.append(data[at + 1 : end].decode())
        at = end
    return out


def pieces(text: str, most: int = MOST_STRING) -> Iterator[str]:
    """C11: a text in pieces of at most ``most`` bytes of UTF-8, cut between characters."""
    start = size = 0
    for k, char in enumerate(text):
        n = len(char.encode())
        if size + n > most:
            yield text[start:k]
            start, size = k, 0
        size += n
    if start < len(text):
        yield text[start:]


def _table_of(kind: str) -> str:
    return "wordLike" if kind == "wordLike" else "notWordLike"


def _items(data: bytes, tables: dict[str, list[str]]) -> Iterator[tuple]:
    at = 0
    while at < len(data):
        kind, length, subtype = ITEMS[data[at] >> 6], data[at] & MOST_ITEM, data[at + 1]
        if length < 2:
            raise BadArchive(f"an item of {length} bytes")
        if kind == "token":
            yield kind, TOKENS[subtype], tables[_table_of(TOKENS[subtype])][read_number(data, at + 2)[0]]
        elif kind == "graft":
            yield kind, tables["graftTypes"][subtype], tables["ids"][read_number(data, at + 2)[0]]
        else:
            label, place = [SCOPES[subtype]], at + 2
            for _ in range(FIELDS.get(label[0], 1)):
                index, place = read_number(data, place)
                label.append(tables["scopeBits"][index])
            yield kind, "/".join(label)
        at += length


def read_archive(data: bytes) -> dict:
    """An archive's bytes as a tree."""
    try:
        raw = json.loads(gzip.decompress(data))
        tables = {t: strings(base64.b64decode(raw["enums"][t])) for t in TABLES}

        def block(b: dict) -> dict:
            bs, bg, c = (list(_items(base64.b64decode(b[k]), tables)) for k in ("bs", "bg", "c"))
            return {"bs": bs[0][1], "bg": [x[1:] for x in bg], "c": c}

        docs = {
            i: {"headers": d["headers"], "mainId": d["mainId"], "sequences": {s: {"type": q["type"], "blocks": [block(b) for b in q["blocks"]]} for s, q in d["sequences"].items()}}
            for i, d in raw["docs"].items()
        }
        return {"id": raw["id"], "selectors": raw["metadata"]["selectors"], "docs": docs}
    except (OSError, EOFError, ValueError, KeyError, IndexError, TypeError) as e:
        raise BadArchive(str(e)) from e


class _Writer:
    """Tables of strings that grow while items are written; a string's index is its order of first use."""

    def __init__(self) -> None:
        self.tables: dict[str, dict[str, int]] = {t: {} for t in TABLES}

    def index(self, table: str, value: str) -> int:
        if len(value.encode()) > MOST_STRING:
            raise BadArchive(f"a string of more than {MOST_STRING} bytes: {value[:20]}")
        return self.tables[table].setdefault(value, len(self.tables[table]))

    def item(self, item: tuple) -> bytes:
        kind = item[0]
        if kind == "token":
            subtype, body = TOKENS.index(item[1]), number(self.index(_table_of(item[1]), item[2]))
        elif kind == "graft":
            subtype, body = self.index("graftTypes", item[1]), number(self.index("ids", item[2]))
        else:
            scope, *fields = item[1].split("/")
            if len(fields) != FIELDS.get(scope, 1):
                raise BadArchive(f"a label of another form: {item[1]}")
            subtype, body = SCOPES.index(scope), b"".join(number(self.index("scopeBits", f)) for f in fields)
        if len(body) + 2 > MOST_ITEM or subtype > 255:
            raise BadArchive(f"too long an item: {item}")
        return bytes((ITEMS.index(kind) << 6 | len(body) + 2, subtype)) + body

    def run(self, items: Iterable[tuple]) -> str:
        return base64.b64encode(b"".join(map(self.item, items))).decode()

    def enums(self) -> dict[str, str]:
        counted = lambda s: bytes((len(s.encode()),)) + s.encode()
        return {t: base64.b64encode(b"".join(map(counted, held))).decode() for t, held in self.tables.items()}


def write_archive(tree: dict) -> bytes:
    """A tree as an archive's bytes; the same tree gives the same bytes."""
    w = _Writer()

    def block(b: dict) -> dict:
        return {"bs": w.run([("start", b["bs"])]), "bg": w.run(("graft", *g) for g in b["bg"]), "c": w.run(b["c"]), "os": "", "is": "", "nt": base64.b64encode(number(0)).decode()}

    def sequence(s: dict) -> dict:
        main = {"chapters": {}, "chapterVerses": {}, "tokensPresent": "0x0"} if s["type"] == "main" else {}
        return {"type": s["type"], "tags": [], "blocks": [block(b) for b in s["blocks"]], **main}

    docs = {i: {"headers": d["headers"], "mainId": d["mainId"], "sequences": {k: sequence(s) for k, s in d["sequences"].items()}} for i, d in tree["docs"].items()}
    whole = {"id": tree["id"], "metadata": {"selectors": tree["selectors"]}, "enums": w.enums(), "docs": docs, "tags": []}
    return gzip.compress(json.dumps(whole, ensure_ascii=False, separators=(",", ":")).encode(), mtime=0)


_TOKEN = re.compile(r"(?P<wordLike>[^\W_]+(?:['’][^\W_]+)*)|(?P<eol>\r?\n[ \t]*)|(?P<noBreakSpace> )|(?P<lineSpace>[ \t]+)|(?P<softLineBreak>//)|(?P<bareSlash>/)|(?P<punctuation>.)", re.S)


def tokens(text: str) -> Iterator[tuple]:
    """C10, for text without markup: its tokens, which joined give the text again."""
    for m in _TOKEN.finditer(text):
        for piece in pieces(m[0]):
            yield "token", m.lastgroup, piece


def from_verses(rows: list[tuple[int, str, str]], selectors: dict[str, str], headers: dict[str, str]) -> dict:
    """The tree of a document whose (chapter, verse label, text) stand in one paragraph a chapter, in the order given."""
    blocks: list[dict] = []
    opened = None
    for chapter, label, text in rows:
        if chapter != opened:
            if blocks:
                blocks[-1]["c"].append(("end", f"chapter/{opened}"))
            blocks.append({"bs": "blockTag/p", "bg": [], "c": [("start", f"chapter/{chapter}")]})
            opened = chapter
        numbers = [label] if not re.fullmatch(r"\d+-\d+", label) else list(map(str, range(int(label.split("-")[0]), int(label.split("-")[1]) + 1)))
        scopes = [f"verses/{label}", *(f"verse/{n}" for n in numbers)]
        blocks[-1]["c"] += [*(("start", s) for s in scopes), *tokens(text), *(("end", s) for s in reversed(scopes))]
    if blocks:
        blocks[-1]["c"].append(("end", f"chapter/{opened}"))
    return {"id": "_".join(selectors.values()), "selectors": selectors, "docs": {"doc1": {"headers": headers, "mainId": "main", "sequences": {"main": {"type": "main", "blocks": blocks}}}}}


def verses(tree: dict) -> list[tuple[str, int, str, str]]:
    """(document, chapter, verse label, text) of the main sequences; text of grafts is not a verse's.

    A verse that goes on in another block has a blank between; one whose label comes again is one verse.
    """
    out: list[tuple[str, int, str, str]] = []
    for name, doc in tree["docs"].items():
        found: dict[tuple[int, str], str] = {}
        chapter = label = None
        for block in doc["sequences"][doc["mainId"]]["blocks"]:
            if label is not None and found.get((chapter, label)):
                found[chapter, label] += " "
            for item in block["c"]:
                if item[0] in ("start", "end"):
                    scope, _, value = item[1].partition("/")
                    if scope == "chapter":
                        chapter, label = (int(value) if item[0] == "start" else None), None
                    elif scope == "verses":
                        label = value if item[0] == "start" else None
                elif item[0] == "token" and chapter is not None and label is not None:
                    found[chapter, label] = found.get((chapter, label), "") + item[2]
        out += [(name, c, v, " ".join(t.split())) for (c, v), t in found.items() if t.strip()]
    return out


def archive_verses(files: DataFrame, key: list[str], content: str = "content") -> DataFrame:
    """(key, error, document, chapter, verse, text) of archives as bytes; a bad file gives one row with its error.

    ``spark.read.format("binaryFile")`` yields such a table, each file in one row.
    """

    @F.pandas_udf("array<struct<error:string,document:string,chapter:int,verse:string,text:string>>")
    def run(s: pd.Series) -> pd.Series:
        def one(data):
            try:
                return [(None, *v) for v in verses(read_archive(data or b""))]
            except BadArchive as e:
                return [(str(e) or "not an archive", None, None, None, None)]

        return s.map(lambda d: [dict(zip(("error", "document", "chapter", "verse", "text"), r, strict=True)) for r in one(d)], na_action=None)

    return files.select(*key, F.explode(run(content)).alias("__v")).select(*key, "__v.*")


def archives(rows: DataFrame, key: list[str], lang: str, abbr: str) -> DataFrame:
    """(key, content) from verse rows (key, lang, abbr, chapter, ord, verse, text), an archive for each key.

    A text is bounded by nature, so that its verses may meet in one row.
    """

    @F.pandas_udf("binary")
    def run(langs: pd.Series, abbrs: pd.Series, held: pd.Series) -> pd.Series:
        made = [from_verses([(x["chapter"], x["verse"], x["text"] or "") for x in v], {"lang": a, "abbr": b}, {}) for a, b, v in zip(langs, abbrs, held, strict=True)]
        return pd.Series([write_archive(t) for t in made], dtype=object)

    verses_of: Column = F.sort_array(F.collect_list(F.struct(F.col("chapter").cast("int").alias("chapter"), "ord", "verse", "text")))
    return rows.groupBy(*key, F.col(lang).alias("__l"), F.col(abbr).alias("__a")).agg(verses_of.alias("__v")).select(*key, run("__l", "__a", "__v").alias("content"))
