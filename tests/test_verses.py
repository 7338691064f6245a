"""Verse text, tokens and content strings on vectors."""

import json
import unicodedata

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import text, tokens, verses

CLEAN = [
    ('likhati| default="lemma" next', "likhati|lemma next"), ('word| default="abc', "word|abc"), ('a| default="Make His"| default="r k', "a|Make His k"),
    ("|iMoro alfa, moro omega|r enapa", "Moro alfa, moro omega enapa"), ("he said —|iEli, Eli?|r and", "he said —Eli, Eli? and"),
    ("the |scLORD|r said", "the LORD said"), ("it is ended|d", "it is ended"), ("he wrote: |i“Peace”|r", "he wrote: “Peace”"),
    ("cAvarA|isrAyel", "cAvarA|isrAyel"), ("a\u00a0b \u3000c\ufeff", "a b c"),
]


@pytest.mark.parametrize(("raw", "want"), CLEAN)
def test_clean(raw, want):
    assert verses.clean(raw) == want


def test_plain_rows():
    rows = [{"verse_start": 1, "verse_text": "Mr.~Smith//said"}, {"verse_start": 4, "verse_text": "|scYESU|r said|d"}, {"verse_start": 4, "verse_text": "more"}, {"verse_start": 5, "verse_text": "  "}]
    assert verses.extract(json.dumps(rows), "plain") == [("", "1", "Mr. Smith said"), ("", "4", "YESU said more")]


def _book(*paras):
    return {"type": "USJ", "content": [{"type": "book", "content": ["id"]}, {"type": "para", "marker": "ip", "content": ["intro"]}, {"type": "chapter", "number": "1"}, *paras]}


def _v(n):
    return {"type": "verse", "marker": "v", "number": n}


def test_usj():
    p = lambda m, *c: {"type": "para", "marker": m, "content": list(c)}
    char = lambda m, *c: {"type": "char", "marker": m, "content": list(c)}
    book = _book(
        p("s1", "A heading"), p("p", _v("1"), "In the ", char("w", "beginning|lemma"), {"type": "note", "content": ["note"]}, char("rq", "Gen 1")), p("q1", "line two"),
        p("s", "Heading ", _v("2-3"), "in a heading"), p("rem", "remark"), {"type": "table", "content": [{"type": "table:row", "content": [{"type": "table:cell", "content": [_v("4"), "a"]}, {"type": "table:cell", "content": ["b"]}]}]},
        p("p", _v("1"), "again"), p("p", _v("9")),
    )
    assert verses.extract(json.dumps(book), "usj") == [("1", "1", "In the beginning line two again"), ("1", "2", "in a heading"), ("1", "4", "a b")]
    assert verses.extract("not json", "usj") == [] and verses.extract(None, "usj") == []


def test_sofria():
    wrap = lambda sub, n, *c: {"type": "wrapper", "subtype": sub, "atts": {"number": n}, "content": list(c)}
    mark = lambda n: {"type": "mark", "subtype": "verses_label", "atts": {"number": n}}
    doc = {"sequence": {"blocks": [
        {"type": "graft", "subtype": "heading", "sequence": {"type": "heading", "blocks": [{"type": "paragraph", "content": ["no"]}]}},
        {"type": "paragraph", "subtype": "usfm:p", "content": [wrap("chapter", ["3"], wrap("verses", "1", mark("1"), "one ", {"type": "graft", "content": ["x"]}, {"type": "wrapper", "subtype": "usfm:w", "content": ["word|att"]}))]},
        {"type": "paragraph", "subtype": "usfm:q", "content": [wrap("chapter", "3", wrap("verses", "1", "two"))]},
        {"type": "row", "content": [wrap("cell", None, mark("2-3"), "a"), wrap("cell", None, "b")]},
        {"type": "paragraph", "subtype": "usfm:p", "content": [wrap("chapter", "4", "next")]},
    ]}}
    assert verses.extract(json.dumps(doc), "sofria") == [("", "1", "one word two"), ("", "2", "a b")]


WRITTEN = [
    ("qá até", ["qá", "até"], ["qá", "até"]), ("ọkọ̀ ọkọ́", ["ọkọ", "ọkọ"], ["ọkọ̀", "ọkọ́"]), ("فِي البَدْءِ", ["في", "البدء"], ["فِي", "البَدْءِ"]),
    ("神の子イエス", ["神", "の", "子", "イエス"], ["神", "の", "子", "イエス"]), ("अगर दाऊद", ["अगर", "दाऊद"], ["अगर", "दाऊद"]),
    ("အာဗြဟံ ဒါဝိဒ", ["အာ", "ဗြ", "ဟံ", "ဒါ", "ဝိ", "ဒ"], ["အာ", "ဗြ", "ဟံ", "ဒါ", "ဝိ", "ဒ"]), ("ကောင်း သော", ["ကောင်း", "သော"], ["ကောင်း", "သော"]),
    ("က︀ခ", ["က", "ခ"], ["က", "ခ"]), ("a ́b", ["a", "b"], ["a", "b"]), ("40 days—and nights.", ["days", "and", "nights"], ["days", "and", "nights"]),
]


@pytest.mark.parametrize(("raw", "toks", "written"), WRITTEN)
def test_tokens(raw, toks, written):
    nfc = lambda xs: [unicodedata.normalize("NFC", x) for x in xs]
    assert tokens.tokenize(raw) == nfc(toks) and tokens.tokenize_written(raw) == nfc(written)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="aé́神のဂၢ်ဒေကျ ̀1-", max_size=20))
def test_written_token_without_marks_is_the_token(raw):
    pairs = tokens.token_pairs(raw)
    assert all(tokens.strip_marks(b) == a for a, b in pairs)


def test_content():
    assert text.content("In the Beginning, 1 God!") == "inthebeginninggod"
    assert {text.content(x) for x in ("tsa'be", "tsaꞌbe", "TsaꞋbe")} == {"tsaʼbe"}
    assert text.content("ΛΟΓΟΣ λόγος") == "λογοσλόγοσ" and text.content("‘a") == "a"


def test_fingerprints_do_not_depend_on_order(spark):
    rows = [("b", 1, v, f"verse {v}") for v in range(1, 13)] + [("b", 2, 1, "12"), ("b", 10, 1, "x")]
    a = spark.createDataFrame(rows, "book string, chapter int, verse int, text string")
    one, two = (tokens.fingerprints(df, ["book"]) for df in (a, a.orderBy("text").repartition(5)))
    assert one[0].count() == 2 and sorted(one[0].collect()) == sorted(two[0].collect()) and one[1].collect() == two[1].collect()
