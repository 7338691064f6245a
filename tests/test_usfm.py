"""Kernels over marked-up source text."""

import json

import pytest
from pyspark.sql import functions as F

from lectern.operators import osis, usfm

BOOK = """\\id MRK
\\c 1
\\s1 The herald
\\r (Mt 3)
\\ip Intro \\bk words\\bk*
\\bk more\\bk* intro
\\p
\\v 1 In the beginning \\f + \\ft note\\f* of it.
\\d A title
\\q1
\\v 2-3 Bridged \\w word|strong="G1"\\w* 12.
\\c 2
\\p
\\v 1 Other"""


def test_chapters():
    assert usfm.chapter_letters(BOOK, 1) == "inthebeginningofitbridgedwordstrongg"
    assert usfm.chapter_letters(BOOK, 2) == "other"
    assert usfm.chapter_letters(None, 1) == usfm.chapter_letters(BOOK, 9) == ""
    assert usfm.chapter_words(BOOK, 2) == "other"
    assert usfm.chapter_words("\\c 3\n\\s H\nhidden\n\\d Title\n\\v 1 Can't stop 12", 3) == "title can't stop"


def test_chapter_verses():
    got = usfm.chapter_verses(BOOK, 1)
    assert sorted(got) == [1, 2, 3] and got[2] == got[3] and got[2].startswith("Bridged")
    assert usfm.chapter_verses("", 1) == {}


@pytest.mark.parametrize(
    ("body", "want"),
    [("\\d A psalm\n\\p\n\\v 1 a\n\\v 12 b", (12, "heading")), ("\\d \\v 1 a", (1, None)), ("\\p \\f + x\\f*\n\\v 1 a", (1, "note")), ("\\p\n\\v 1 a", (1, None)), ("\\p", (None, None))],
)
def test_title_probe(body, want):
    assert usfm.title_probe(f"\\c 50\n\\v 1 z\n\\c 51\n{body}\n\\c 52\n\\v 99 q", 51) == want
    assert usfm.title_probe("", 51) == (None, None)


def test_pipes():
    source = 'a|b \\w word|lemma="x"\\w* c|d \\f + e|f\\f* \\rem g|h\n\\qt-s |sid="1"\\* i|j'
    held = usfm.protect_pipes(source)
    assert held.count(usfm.PIPE) == 3 and usfm.restore_pipes(["", {"x": held}]) == ["", {"x": source}]
    with pytest.raises(ValueError):
        usfm.protect_pipes("\ue000")


def _w(word, **atts):
    return {"type": "char", "marker": "w", **atts, "content": [word]}


def test_words_of_trees():
    tree = {"type": "para", "content": ["So ", _w("one", strong="G1"), _w("two", strong="G2", lemma="l"), " end"]}
    spaced = usfm.space_words(tree)
    assert spaced["content"][2] == " " and len(tree["content"]) == 4
    assert usfm.drop_strongs(spaced)["content"] == ["So one ", _w("two", lemma="l"), " end"]


def test_old_verses():
    tree = {"content": [{"type": "chapter", "number": "1"}, {"type": "para", "marker": "s1", "content": ["Head"]},
        {"type": "para", "marker": "q1", "content": [{"type": "verse", "number": "1"}, _w("a"), _w("b"), {"type": "note", "content": ["n"]}]},
        {"type": "para", "marker": "q2", "content": ["c ", {"type": "verse", "number": "2-3"}, "d"]}]}
    assert usfm.old_verses(tree) == {(1, "1"): "a b c", (1, "2-3"): "d"}
    label = lambda n: {"type": "mark", "subtype": "verses_label", "atts": {"number": n}}
    doc = {"metadata": {"document": {"properties": {"chapters": "4"}}}, "sequence": {"blocks": [{"type": "graft"}, {"type": "paragraph", "content": [label("1"), {"type": "wrapper", "content": ["x", {"type": "graft", "content": ["no"]}]}]}, {"type": "paragraph", "content": ["y"]}]}}
    assert usfm.old_sofria_verses(doc) == {(4, "1"): "x y"}
    assert usfm.old_verses({}) == {}


def test_strings():
    chapter = {"content": [{"type": "heading", "content": ["H"]}, {"type": "verse", "content": ["A b", {"noteId": 1}, {"text": "C", "poem": 1}]}]}
    assert list(usfm.reading_strings(chapter)) == ["A b", "C"]
    assert usfm.content_letters(chapter) == "abc"


def test_osis():
    verses = [(1, 1, '<title type="psalm">Of <b>D</b></title>'.replace("<b>D</b>", "D") + '<div type="x-p"/>In <transChange type="added">the</transChange> day<note>why</note>'), (1, 2, '<lb/>'.replace("<lb/>", "") + '<l sID="a" level="2"/>line <q who="Jesus">said &amp; done</q><l eID="a"/>'), (2, 1, "next")]
    assert osis.osis_to_usfm(verses) == "\\c 1\n\\d Of D\n\\p\n\\v 1 In \\add the\\add* day\\f + \\ft why\\f*\n\\q2\n\\v 2 line \\wj said & done\\wj*\n\\c 2\n\\p\n\\v 1 next\n"
    for bad in ("<odd>x</odd>", "<q>x", "</q>"):
        with pytest.raises(osis.Unsupported):
            osis.osis_to_usfm([(1, 1, bad)])


def test_columns(spark):
    rows = spark.createDataFrame([(1, BOOK, 1), (2, None, 1)], "id int, raw string, chapter int")
    assert {(r.id, r.verse) for r in usfm.chapter_verse_table(rows, ["id"], "raw", "chapter").collect()} == {(1, 1), (1, 2), (1, 3)}
    source = spark.createDataFrame([('\\zaln-s |x="1"\\*\\w In|occ="1"\\w*\\zaln-e\\* a\n\\ts\\*\n\\s5 \nend',)], "x string")
    assert source.select(usfm.unaligned("x")).first()[0] == "In a\n\nend"
    trees = spark.createDataFrame([(1, json.dumps({"content": [{"type": "chapter", "number": 1}, {"type": "verse", "number": "1"}, "t"]})), (2, "{"), (3, None)], "id int, raw string")
    assert [tuple(r) for r in usfm.old_verse_table(trees, ["id"], "raw").collect()] == [(1, 1, "1", "t")]
    assert trees.select(usfm.json_col(usfm.drop_strongs, "raw")).count() == 3
    books = spark.createDataFrame([("A", 1, 2, "b"), ("A", 1, 1, "a"), ("B", 1, 1, "<odd>")], "book string, chapter int, verse int, osis string")
    got = {r.book: (r.usfm, r.error) for r in osis.converted_osis(books, ["book"]).collect()}
    assert got["A"] == ("\\c 1\n\\p\n\\v 1 a\n\\v 2 b\n", None) and got["B"][0] is None and "odd" in got["B"][1]
    assert books.limit(0).transform(lambda d: osis.converted_osis(d, ["book"])).count() == 0
    assert rows.select(F.count("*")).first()[0] == 2
