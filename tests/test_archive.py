"""The succinct archive."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lectern.operators import archive

TREE = {
    "id": "eng_X", "selectors": {"lang": "eng", "abbr": "X"},
    "docs": {"d": {"headers": {"id": "MRK"}, "mainId": "m", "sequences": {
        "m": {"type": "main", "blocks": [
            {"bs": "blockTag/p", "bg": [("heading", "h")], "c": [("start", "chapter/1"), ("start", "verses/1"), ("start", "attribute/spanWithAtts/w/strong/0/G1"), ("token", "wordLike", "In"), ("end", "attribute/spanWithAtts/w/strong/0/G1"), ("graft", "footnote", "f")]},
            {"bs": "blockTag/q", "bg": [], "c": [("token", "wordLike", "été"), ("token", "punctuation", "."), ("end", "verses/1"), ("start", "table"), ("end", "chapter/1")]},
        ]},
        "h": {"type": "heading", "blocks": [{"bs": "orphanTokens", "bg": [], "c": [("token", "lineSpace", " ")]}]},
        "f": {"type": "footnote", "blocks": []},
    }}},
}


def test_round_trip():
    data = archive.write_archive(TREE)
    assert archive.read_archive(data) == TREE and data == archive.write_archive(TREE)
    assert archive.verses(TREE) == [("d", 1, "1", "In été.")]


@settings(max_examples=200, deadline=None)
@given(st.integers(0, 2**40))
def test_numbers(n):
    assert archive.read_number(b"x" + archive.number(n) + b"y", 1) == (n, len(archive.number(n)) + 1)


def test_numbers_of_bytes():
    assert archive.number(0) == b"\x80" and archive.number(127) == b"\xff" and archive.number(300) == bytes((300 % 128, 128 + 300 // 128))


@settings(max_examples=100, deadline=None)
@given(st.text(max_size=400))
def test_tokens(text):
    made = list(archive.tokens(text))
    assert "".join(t[2] for t in made) == text and all(len(t[2].encode()) <= 255 for t in made)


def test_verses():
    many = [(c, str(v), f"w{c * 500 + v} d'accord, é/b") for c in (1, 2) for v in range(1, 400)]
    rows = [*many, (3, "1-2", "x" * 700), (3, "3", "")]
    tree = archive.read_archive(archive.write_archive(archive.from_verses(rows, {"lang": "a", "abbr": "B"}, {})))
    assert archive.verses(tree) == [("doc1", *r) for r in rows if r[2]]
    assert ("start", "verse/2") in tree["docs"]["doc1"]["sequences"]["main"]["blocks"][-1]["c"]
    empty = archive.from_verses([], {"lang": "a"}, {})
    assert archive.read_archive(archive.write_archive(empty)) == empty


@pytest.mark.parametrize("block", [{"bs": "chapter", "bg": [], "c": []}, {"bs": "blockTag/p", "bg": [], "c": [("token", "wordLike", "x" * 256)]}])
def test_not_written(block):
    with pytest.raises(archive.BadArchive):
        archive.write_archive({"id": "", "selectors": {}, "docs": {"d": {"headers": {}, "mainId": "m", "sequences": {"m": {"type": "main", "blocks": [block]}}}}})


def test_tables(spark, tmp_path):
    rows = spark.createDataFrame([(1, "eng", "X", 2, 1, "1", "b c"), (1, "eng", "X", 1, 2, "2-3", "a"), (1, "eng", "X", 1, 1, "1", None), (2, "fra", "Y", 1, 1, "1", "z")], "id int, lang string, abbr string, chapter int, ord int, verse string, text string")
    made = archive.archives(rows, ["id"], "lang", "abbr")
    got = sorted((r.id, r.chapter, r.verse, r.text) for r in archive.archive_verses(made, ["id"]).collect())
    assert got == [(1, 1, "2-3", "a"), (1, 2, "1", "b c"), (2, 1, "1", "z")]
    (tmp_path / "good.pkf").write_bytes(made.where("id = 2").first().content)
    (tmp_path / "bad.pkf").write_bytes(b"no")
    files = spark.read.format("binaryFile").load(str(tmp_path / "*.pkf")).select("path", "content")
    assert sorted((r.error is None, r.text) for r in archive.archive_verses(files, ["path"]).collect()) == [(False, None), (True, "z")]
    assert archive.archive_verses(files.limit(0), ["path"]).isEmpty()
