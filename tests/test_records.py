"""Fields of metadata records."""

from urllib.parse import quote

import pytest
from pyspark.sql import functions as F

from lectern.operators import records


def _one(spark, *values, kinds, f):
    df = spark.createDataFrame([tuple(values)], ", ".join(f"c{k} {t}" for k, t in enumerate(kinds)))
    return df.select(f(*[F.col(c) for c in df.columns]).alias("x")).first().x


@pytest.mark.parametrize(
    ("name", "dam", "want"),
    [("x_AAAAAAN1DA.mp3", "AAAAAAN1DA", "AAAAAAN1DA"), ("B01_N1IZZTBL.mp3", "QQ", "IZZTBLN1DA"), ("B01___AAAAAAN2DA.mp3", "ZZ", "AAAAAAN2DA"), ("x.mp3", "ZZ", "ZZ"), ("AAAAAAN1DA_B01_Matthew.mp3", None, "AAAAAAN1DA"), (None, None, None), ("x", "", None)],
)
def test_audio_fileset(spark, name, dam, want):
    assert _one(spark, name, dam, kinds=["string", "string"], f=records.audio_fileset) == want


@pytest.mark.parametrize(
    ("values", "want"),
    [((False, "C-rut-3-timing.txt", "RTH", 4), ("RUT", 3)), ((True, "C-rut-3-timing.txt", "gen", 4), ("GEN", 4)), ((True, "C-rut-3-timing.txt", None, 4), ("RUT", 3)), ((None, None, "gen", 4), ("GEN", 4)), ((True, "x", "gen", None), None)],
)
def test_book_and_chapter(spark, values, want):
    got = _one(spark, *values, kinds=["boolean", "string", "string", "int"], f=records.book_and_chapter)
    assert (tuple(got) if got else None) == want


def test_urls(spark):
    for url in ("https://a.b/c d(1)*~é%20+&.mp3", "x", "%2F"):
        assert _one(spark, url, kinds=["string"], f=records.quoted) == quote(url, safe=":/%")
    f = lambda *v: _one(spark, *v, kinds=["boolean"] + ["string"] * 4, f=records.audio_url)
    assert f(True, "u v", None, "f", "d/") == "u v" and f(True, None, "b", "f", "d/") is None
    assert [f(None, "u v", "b", "f", "d/"), f(False, None, "b//", "f f", "d/"), f(False, "", None, "f", "d/")] == ["u%20v", "b/f%20f", "d/f"]


def test_crosswalk(spark):
    ids = spark.createDataFrame([("eng_kjv",), ("fra",), ("fra",), (None,)], "id string")
    assert sorted(map(tuple, records.catalog_crosswalk(ids).collect())) == [("ENGKJV", "eng_kjv"), ("FRA", "fra")]
    with pytest.raises(Exception, match="meet in one key"):
        records.catalog_crosswalk(ids.union(spark.createDataFrame([("fr_a",)], "id string"))).collect()


def test_stories(spark):
    assets = spark.createDataFrame([("r", 1, "en_obs_v6_01_64kbps.mp3", "a"), ("r", 2, "en_obs_v6_01_32kbps.mp3", "b"), ("r", 3, "x.zip", "c"), ("r", 4, None, "d")], "repo string, pos int, name string, url string")
    assert [tuple(r) for r in records.story_audio(assets, ["repo"], "pos").collect()] == [("r", "01", "b")]
    f = lambda *v: _one(spark, *v, kinds=["string"] * 3, f=records.story_template)
    got = f("http://c/{quality}/en_obs_{chapter}_{quality}.mp3", None, "o/en_obs")
    assert len(got) == 50 and tuple(got[8]) == ("09", "http://c/64kbps/en_obs_09_64kbps.mp3")
    assert f("http://c/{quality}/en_obs_{chapter}.mp3", "32kbps", "o/id_obs") is None and f("http://c/en_obs_{chapter}.mp3", "", "o/en_obs") is None and f(None, None, None) is None
    assert _one(spark, "see creativecommons.org/licenses/by-sa/4.0/", kinds=["string"], f=records.cc_license) == "CC BY-SA 4.0"
    assert _one(spark, "free", kinds=["string"], f=records.cc_license) is None
    listing = "array<struct<name:string,type:string>>"
    f = lambda *v: tuple(_one(spark, *v, kinds=[listing, "string", "string"], f=records.repository_stories))
    text = "creativecommons.org/licenses/by/3.0"
    assert f([("02.md", "file"), ("01.md", "file"), ("03", "dir")], None, text) == ("md", ["01", "02"], None)
    assert f([("00", "dir"), ("07", "dir"), ("08", "file")], None, text) == ("ts-desktop", ["07"], "CC BY 3.0")
    assert f([], "own", text) == ("ts-desktop", [], "own")


def test_editions(spark):
    kind = "array<struct<current:boolean,licenses:array<string>,artifacts:array<struct<format:string,id:string>>>>"
    versions = [(False, ["old"], [("USFM", "a0")]), (True, ["new"], [("PDF", "b1"), ("USFM", "a1"), ("USFM", "a2")]), (True, ["next"], None)]
    assert _one(spark, versions, kinds=[kind], f=lambda v: records.current(v, "licenses")) == ["new"]
    projects = spark.createDataFrame([("p", versions), ("q", []), ("r", None)], f"id string, versions {kind}")
    rows = spark.createDataFrame([(1, "/artifactContent/a1", "old", "OLD"), (2, "/artifactContent/a1", "eng", "NEW"), (3, None, "x", "X")], "pos int, link string, iso string, abbr string")
    assert [tuple(r) for r in records.matched_editions(projects, rows).collect()] == [("p", "eng", "NEW")]
    f = lambda *v: tuple(_one(spark, *v, kinds=["string"] * 2, f=records.descriptions))
    assert f("a" * 299 + "  b", "v") == ("a" * 299, "v") and f("", "v") == ("v", None) and f("x", "x") == ("x", None) and f(None, None) == (None, None)


def test_story_index(spark):
    t = lambda rows, schema="iso string": spark.createDataFrame(rows, schema)
    codes = t([("en", "eng")], "code string, to string")
    got = records.story_index(t([("en", 2), ("fra", 1), ("deu", 1)], "iso string, n int"), t([("en",), ("en",)]), t([("eng",), ("deu",), (None,)]), codes)
    assert sorted(map(tuple, got.collect())) == [("deu", "tv", None), ("eng", "atv", 2), ("fra", "t", None)]
