"""USX and USFM to USJ (C3, C5), by the public formats' own rules.

USX is XML, so its tree is taken over node by node.  USFM is read as a row of tokens; what a token
opens or closes is told by the kind of its marker, and open nodes are a stack.
"""

from __future__ import annotations

import json
import re
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from xml.etree import ElementTree

from lectern.operators.usfm import protect_pipes, restore_pipes, space_words

#: Markers of notes, of text within a line, and of text within notes.
NOTES = frozenset("f fe ef x ex efe".split())
CHARACTERS = frozenset(
    "add addpn bd bdit bk cat dc em em fig it jmp k lit litl nd ndx no ord pn png pro qac qs qt rb rt sc sig sls sup tl va vp w wa wg wh wj ior iqt rq ca fm".split()
)
IN_NOTES = frozenset("fr ft fk fq fqa fl fw fp fv fdc xo xk xq xt xta xop xot xnt xdc".split())
#: The attribute that is meant where a value stands alone.
DEFAULT_ATTRIBUTE = {"w": "lemma", "rb": "gloss", "jmp": "href", "xt": "href", "fig": "src"}
VERSION = "3.1"

_TOKEN = re.compile(r"\\(?P<nested>\+?)(?P<marker>[a-zA-Z]+\d*(?:-[se])?)(?P<close>\*?)|\\(?P<end>\*)")
_ATTRIBUTE = re.compile(r'([\w-]+)\s*=\s*"([^"]*)"')


class _Tree:
    """Nodes while a text is read: ``open`` holds them from the document down."""

    def __init__(self) -> None:
        self.document = {"type": "USJ", "version": VERSION, "content": []}
        self.open = [self.document]

    def add(self, node: dict) -> None:
        self.open[-1]["content"].append(node)

    def enter(self, node: dict) -> None:
        self.add(node)
        self.open.append(node)

    def leave(self, wanted: Callable[[dict], bool]) -> bool:
        """Closes the innermost node that is ``wanted``, and all in it."""
        for k in range(len(self.open) - 1, 0, -1):
            if wanted(self.open[k]):
                del self.open[k:]
                return True
        return False

    def text(self, text: str) -> None:
        text = re.sub(r"\s+", " ", text)
        own = self.open[-1]
        if own is self.document:
            if not text.strip():
                return
            self.enter({"type": "para", "marker": "p", "content": []})
            own = self.open[-1]
        if not own["content"] and own["type"] == "para":
            text = text.lstrip(" ")
        if text:
            own["content"].append(text)


def _attributes(marker: str, told: str) -> dict:
    found = dict(_ATTRIBUTE.findall(told))
    alone = told.strip()
    return found if found or not alone else {DEFAULT_ATTRIBUTE.get(marker, "default"): alone}


def _take_attributes(node: dict) -> None:
    """Moves what follows a pipe in a node's last text to its attributes."""
    content = node["content"]
    if content and isinstance(content[-1], str) and "|" in content[-1]:
        text, told = content[-1].split("|", 1)
        node.update(_attributes(node["marker"], told))
        content[-1:] = [text] if text else []


def _trim(node: dict) -> dict:
    """Paragraphs without a blank at their end; the document without empty lists."""
    for child in node["content"]:
        if isinstance(child, dict) and "content" in child:
            _trim(child)
    if node["type"] == "para" and node["content"] and isinstance(node["content"][-1], str):
        node["content"][-1] = node["content"][-1].rstrip(" ")
        if not node["content"][-1]:
            node["content"].pop()
    return node


def usfm_to_usj(usfm: str | None) -> dict:
    """A USFM text as USJ.  Pipes that are plain text stay; words that touch get a blank; null is an empty document.

    A marker that is neither of a note nor of text within a line begins a paragraph where it begins a
    line.  A close without its opening is dropped; what is not closed ends with its paragraph.
    """
    source, tree, at = protect_pipes((usfm or "").lstrip("\ufeff")), _Tree(), 0
    for token in [*_TOKEN.finditer(source), None]:
        between = source[at : token.start() if token else len(source)]
        if token and at and token.start() < at:
            continue
        if between:
            tree.text(between)
        if token is None:
            break
        at, marker = token.end(), token["marker"]
        nested = bool(token["nested"])
        if token["end"]:
            continue
        if token["close"]:
            for node in reversed(tree.open):
                if node.get("marker") == marker:
                    _take_attributes(node)
                    break
            tree.leave(lambda n, m=marker: n.get("marker") == m)
            continue
        if marker[-2:] in ("-s", "-e"):
            told = re.compile(r"\s*(?:\|([^\\]*))?\\\*").match(source, at)
            tree.add({"type": "ms", "marker": marker, **_attributes(marker, (told[1] or "") if told else "")})
            at = told.end() if told else at
            continue
        at += 1 if source[at : at + 1] in (" ", "\t") else 0
        inside = marker in NOTES or marker in CHARACTERS or marker in IN_NOTES
        if marker == "id":
            line = re.compile(r"(\S*)[ \t]*([^\n\\]*)").match(source, at)
            told = line[2].strip()
            tree.open = [tree.document]
            tree.add({"type": "book", "marker": "id", "code": line[1], "content": [told] if told else []})
            at = line.end()
        elif marker in ("c", "v"):
            number = re.compile(r"\s*(\S+)[ \t\n]?").match(source, at)
            if marker == "c":
                tree.open = [tree.document]
            elif tree.open[-1] is tree.document:
                tree.enter({"type": "para", "marker": "p", "content": []})
            tree.leave(lambda n: n["type"] in ("char", "note")) if marker == "v" else None
            tree.add({"type": "chapter" if marker == "c" else "verse", "marker": marker, "number": number[1] if number else ""})
            at = number.end() if number else at
        elif marker in NOTES:
            caller = re.compile(r"\s*(\S)[ \t\n]").match(source, at)
            tree.enter({"type": "note", "marker": marker, "caller": caller[1] if caller else "+", "content": []})
            at = caller.end() if caller else at
        elif inside or nested:
            if not nested:  # a plain marker ends the one before it, in a note or a line
                tree.leave(lambda n: n["type"] == "char")
            if tree.open[-1] is tree.document:
                tree.enter({"type": "para", "marker": "p", "content": []})
            tree.enter({"type": "char", "marker": marker, "content": []})
        else:
            tree.open = [tree.document]
            tree.enter({"type": "para", "marker": marker, "content": []})
    return restore_pipes(space_words(_trim(tree.document)))


def _usx_node(element: ElementTree.Element) -> list:
    """The nodes of an element and of the text after it."""
    own: list = []
    atts = dict(element.attrib)
    if "eid" not in atts:
        node = {"type": {"figure": "char", "row": "table:row", "cell": "table:cell"}.get(element.tag, element.tag)}
        if "style" in atts:
            node["marker"] = atts.pop("style")
        node |= {k: v for k, v in atts.items() if k != "vid"}
        if element.tag in ("chapter", "verse", "ms"):
            own.append(node)
        elif element.tag == "optbreak":
            own.append("//")
        else:
            own.append({**node, "content": _usx_content(element)})
    tail = re.sub(r"\s+", " ", element.tail or "")
    return [*own, tail] if tail else own


def _usx_content(element: ElementTree.Element) -> list:
    text = re.sub(r"\s+", " ", element.text or "")
    return ([text] if text else []) + [node for child in element for node in _usx_node(child)]


def usx_to_usj(usx: str | None) -> dict:
    """A USX text as USJ.  Marks of ends go; white space between paragraphs is none; null is an empty document.

    Text that is no XML raises ``ValueError``.
    """
    document = {"type": "USJ", "version": VERSION, "content": []}
    if usx:
        try:
            root = ElementTree.fromstring(usx.lstrip("\ufeff"))
        except ElementTree.ParseError as e:
            raise ValueError(f"no USX: {e}") from None
        document["content"] = [node for node in _usx_content(root) if not isinstance(node, str) or node.strip()]
    return _trim(document)


def usj_col(source: Column | str, usx: bool = False) -> Column:
    """C3 and C5 as a column: a struct (usj, error); a book that cannot be read fails alone."""

    @F.pandas_udf("struct<usj:string,error:string>")
    def run(s: pd.Series) -> pd.DataFrame:
        def one(text):
            try:
                return json.dumps((usx_to_usj if usx else usfm_to_usj)(text), ensure_ascii=False), None
            except ValueError as e:
                return None, str(e)

        return pd.DataFrame([one(x) for x in s], columns=["usj", "error"])

    return run(source)


#: Paragraphs of a book's head and headings that the rough text leaves out, and those that may have a level.
ROUGH_OUT, ROUGH_LEVELS = frozenset("h ide rem r mr".split()), frozenset("toc mt s ms".split())


def rough_text(usfm: str | None) -> str:
    """A book's text for counting letters: without notes, attributes, titles and headings; white space is as it comes."""

    def told(node) -> list[str]:
        if isinstance(node, str):
            return [node]
        marker = node.get("marker", "")
        headed = marker in ROUGH_OUT or marker.rstrip("0123456789") in ROUGH_LEVELS
        if node["type"] in ("note", "book") or (node["type"] == "para" and headed):
            return []
        return [x for child in node.get("content", ()) for x in told(child)] + [" "]

    return "".join(told(usfm_to_usj(usfm)))


def rough_text_col(source: Column | str) -> Column:
    """X14 as a column."""

    @F.pandas_udf("string")
    def run(s: pd.Series) -> pd.Series:
        return s.map(rough_text, na_action=None)

    return run(source)
