"""Maps between numbering schemes and connected components."""

import random
from collections import defaultdict

from pyspark.sql import functions as F

from lectern.operators import maps, refs
from lectern.operators.graphs import components

BOOKS = ["GEN", "PSA", "JER"]


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def _brute(edges):
    near = defaultdict(set)
    for a, b in edges:
        near[a].add(b)
        near[b].add(a)
    found = {}
    for start in sorted(near):
        todo = [start]
        while todo:
            n = todo.pop()
            if n not in found:
                found[n] = start
                todo += near[n]
    return found


def test_components(spark):
    rng = random.Random(5)
    edges = [(i, i + 1) for i in range(100, 300)] + [(rng.randrange(400, 500), rng.randrange(400, 500)) for _ in range(60)]
    rng.shuffle(edges)
    got = components(spark.createDataFrame([*edges, edges[0], (None, 1)], "a long, b long"))
    assert dict(_rows(got)) == _brute(edges)
    assert components(spark.createDataFrame([], "a long, b long")).isEmpty()


def _lines(spark, text):
    return spark.createDataFrame([("f", k, line) for k, line in enumerate(text.split("\n"))], "path string, pos int, value string")


def test_scan_and_pairs(spark):
    text = "note\nAction\tEnglish KJV\tLatin\tHebrew\nRenumber\tGen.1:2-3\tx\tGen.1:3-4\n#c\tGen.1:1\tx\tGen.1:1\nTEST\tGen.1:1\tx\tGen.1:1\nTitle\tPsa.3:Title\tx\tPsa.3:1-2\nMerge\tGen.2:1\tx\tNoVerse\nShort\tGen.2:1\nAnd\tGen.2:1 & 2\tx\tGen.2:1\nOdd\tGen.2:1-2\tx\tGen.2:1\nNo\tXyz.1:1\tx\tGen.1:1\n$ end\nRenumber\tGen.9:1\tx\tGen.9:2"
    rows = maps.scan_columns(_lines(spark, text))
    assert [r[2] for r in _rows(rows)] == ["Renumber", "Title", "Merge", "Odd", "No"]
    assert _rows(maps.single_pairs(rows, BOOKS)) == [("GEN 1:3", "GEN 1:2"), ("GEN 1:4", "GEN 1:3"), ("PSA 3:1", "PSA 3:title"), ("PSA 3:2", "PSA 3:title")]
    assert maps.scan_columns(_lines(spark, "").limit(0)).isEmpty()


def test_sections_and_blocks(spark):
    text = "Greek+Latin\tGen.1:1-2\tGen.1:2-3\tRenumber\nLatin2\tGen.1:1\tGen.1:2\tx\nLatin\tGen.5:1\tGen.5:2\tKeep verse\nLatin\tGen.5:1a\tGen.5:2b\t\nLatin\tGen.5:1"
    assert _rows(maps.section_pairs(_lines(spark, text), "Latin", BOOKS)) == [("GEN 1:1", "GEN 1:2"), ("GEN 1:2", "GEN 1:3"), ("GEN 5:1a", "GEN 5:2b")]
    blocks = maps.test_blocks(_lines(spark, "x\n$A\tone\ttwo\t\nTEST\ta\tb\tc\nTEST\td\nr1\te\tf\tg\n\nlost\n$B\n$C\tq\nTEST\tz\nr2\ty"))
    got = [(r.block, r.kind, r.label, r.cells) for r in blocks.orderBy("pos").collect()]
    assert got == [(1, "test", "TEST", ["a", "b"]), (1, "test", "TEST", ["d"]), (1, "row", "r1", ["e", "f"]), (2, "test", "TEST", ["z"]), (2, "row", "r2", ["y"])]


def _shape(spark, **books):
    return spark.createDataFrame([(b, c + 1, n) for b, chapters in books.items() for c, n in enumerate(chapters)], "book string, chapter int, last int")


def _map(spark, *pairs):
    return spark.createDataFrame(list(pairs), "s string, t string")


def test_shapes_and_exceptions(spark):
    src, tgt = _shape(spark, GEN=[3, 4], JER=[2]), _shape(spark, GEN=[3, 5], JER=[9])
    rows = _map(spark, ("GEN 1:4", "GEN 1:3"), ("JER 1:3", "JER 1:3"), ("GEN 1:1", "GEN 2:6"), ("GEN 1:title", "GEN 1:1"), ("GEN 1:2", "GEN 2:5"))
    assert _rows(maps.map_exceptions(rows, src, tgt)) == [("GEN 1:1", "GEN 2:6", "target", "recension"), ("GEN 1:4", "GEN 1:3", "source", "boundary-extend"), ("JER 1:3", "JER 1:3", "source", "reorder")]
    assert _rows(maps.restricted(rows, src, tgt)) == [("GEN 1:2", "GEN 2:5"), ("GEN 1:title", "GEN 1:1")]
    assert _rows(maps.restricted(rows, src, tgt, src.where("chapter = 1").select("book", "chapter"))) == []
    assert _rows(maps.reconstruction_problems(rows, "GEN", tgt)) == [(2, 6, 5)]
    assert _rows(maps.numbered_alike(src, tgt, _shape(spark, GEN=[9]))) == [("GEN", 1)]
    assert _rows(maps.collisions(_map(spark, ("GEN 1:1", "GEN 1:9"), ("GEN 1:2", "GEN 1:9"), ("GEN 1:9", "GEN 1:9")))) == [("GEN 1:9", 2)]
    assert _rows(maps.overridden(_map(spark, ("a", "b"), ("c", "d")), _map(spark, ("a", "x")), _map(spark, ("e", "f")))) == [("a", "x"), ("c", "d"), ("e", "f")]
    seen = spark.createDataFrame([("GEN", 1, 3), ("GEN", 2, 2)], "book string, chapter int, verse int")
    assert [tuple(r) for r in maps.witness_mismatches(src, seen).orderBy("book").collect()] == [("GEN", 2, 4, 2), ("JER", 1, 2, None)]


def test_crosswalk_and_identity(spark):
    rules = spark.createDataFrame([("DAG", "DAN", 0, None, None), ("EZR", "NEH", None, 11, 1), ("OFF", "ON", 10, None, None)], "book string, to string, chapter_offset int, only_chapter int, to_chapter int")
    rows = _map(spark, ("DAG 1:2", "t"), ("EZR 11:3", "t"), ("EZR 2:1", "t"), ("OFF 1:title", "t"), ("XXX 1:1", "t"), ("YYY 1:1", "t"))
    got = maps.apply_crosswalk(rows, rules, drop=["XXX"], pending=["YYY"])
    assert _rows(got.select("s", "status")) == [("DAN 1:2", "ok"), ("EZR 2:1", "ok"), ("NEH 1:3", "ok"), ("ON 11:title", "ok"), ("XXX 1:1", "dropped"), ("YYY 1:1", "pending")]
    back = maps.identity(_map(spark, ("NEH 1:3", ""), ("NEH 2:3", ""), ("ON 11:1", ""), ("ON 9:1", ""), ("GEN 1:1", "")), "s", rules)
    assert _rows(back.select("s", "identity")) == [("GEN 1:1", "GEN 1:1"), ("NEH 1:3", "EZR 11:3"), ("NEH 2:3", "NEH 2:3"), ("ON 11:1", "OFF 1:1"), ("ON 9:1", "ON 9:1")]


def test_relations_and_layouts(spark):
    shape, base = _shape(spark, GEN=[3, 4, 5]), _shape(spark, GEN=[3, 9, 5])
    rel = _map(spark, ("GEN 1:1-2", "GEN 1:1"), ("GEN 1:3-2:1", "GEN 1:3"), ("GEN 3:1", "GEN 3:1-2"))
    mine, theirs = _map(spark, ("GEN 1:1", "GEN 1:2"), ("GEN 3:4", "GEN 3:5")), _map(spark, ("GEN 1:1", "GEN 1:2"))
    assert _rows(maps.holding_relations(rel, mine, theirs, shape, base)) == [("GEN 1:1-2", "GEN 1:1")]
    layouts = spark.createDataFrame([("l", "JOB", 1, 2), ("l", "JOB", 2, 2)], "id string, book string, chapter int, last int")
    ranges = spark.createDataFrame([("l", 2, 1, 2, 1, 3)], "id string, chapter int, v1 int, v2 int, to_chapter int, to_verse int")
    got = maps.layout_rows(layouts, ranges, _map(spark, ("JOB 1:1", "JOB 9:9"), ("JOB 1:4", "JOB 2:2")))
    assert _rows(got) == [("l", "JOB 1:1", "JOB 1:1", "JOB 9:9"), ("l", "JOB 2:1", "JOB 1:3", "JOB 1:3"), ("l", "JOB 2:2", "JOB 1:4", "JOB 2:2")]


def test_compose(spark):
    links = lambda **d: spark.createDataFrame([(v.replace("_", " ", 1).replace("_", ":"), e) for v, es in d.items() for e in es], "v string, e string")
    x = links(GEN_1_1=["a"], GEN_1_2=["b"], GEN_1_3=["c", "d"], GEN_2_1=["e"], GEN_2_2=["e"], GEN_2_3=["f"], GEN_3_1=["g", "h"], GEN_3_2=["h"], GEN_4_1=["k"], GEN_4_2=["k"], GEN_5_1=["m", "n"])
    o = links(GEN_1_1=["a"], GEN_1_9=["b"], GEN_1_3=["c"], GEN_2_1=["d"], GEN_2_2=["e"], GEN_3_1=["g"], GEN_3_2=["h"], GEN_4_1=["k"], GEN_4_3=["k"], GEN_5_1=["m"], GEN_5_3=["n"])
    xs, os_ = _shape(spark, GEN=[3, 3, 2, 2, 1]), _shape(spark, GEN=[3, 2, 2, 3, 3])
    got = sorted((r.kind, r.s, r.t or "") for r in maps.compose(x, o, xs, os_).collect())
    assert got == [
        ("flagged", "GEN 3:1-2", "GEN 3:1-2"), ("flagged", "GEN 5:1", "GEN 5:1-3"),
        ("multi", "GEN 1:3", "GEN 1:3-2:1"), ("multi", "GEN 2:1-2", "GEN 2:2"),
        ("no_base", "GEN 2:3", ""), ("single", "GEN 1:2", "GEN 1:9"), ("single", "GEN 4:2", "GEN 4:3"),
    ]


def test_links(spark):
    rules = spark.createDataFrame([], "book string, to string, chapter_offset int, only_chapter int, to_chapter int")
    verses = spark.createDataFrame([("GEN 1:1",), ("GEN 1:2",), ("GEN 1:3",)], "v string")
    got = maps.scheme_links(verses, _map(spark, ("GEN 1:1", "A"), ("GEN 1:2", "B")), _map(spark, ("GEN 1:1", "C"), ("GEN 1:1", "D")), rules)
    assert _rows(got) == [("GEN 1:1", "C"), ("GEN 1:1", "D"), ("GEN 1:2", "B"), ("GEN 1:3", "GEN 1:3")]
    assert refs.join_ref(F.lit("A"), F.lit(1), F.lit(2)) is not None
