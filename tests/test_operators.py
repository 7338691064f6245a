"""Kernels on vectors, and operators whose branches the proxy tables do not reach."""

import json
from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lectern.operators import compare, refs, rollups, scripts, text
from lectern.sources import tables
from lectern.streaming import ingest, windows


@pytest.mark.parametrize(
    ("raw", "want"),
    [("Él Niño’s 12", "elnino's"), ("a\\f + note\\f* b", "ab"), ("\\v 1 Text", "text"), ("Straße", "stra'e"), ("<b>x</b>", "bxb"), ("a\\+w b\\+w*፩", "a+wb+w*፩".replace("+", "").replace("*", "")), (None, ""), ("Ꞌa ǥ", "'ag")],
)
def test_normalized_chars(raw, want):
    assert text.normalized_chars(raw) == want


def test_letters_and_content():
    assert text.letters_key("É'a 1ﬁ") == "eafi"
    assert text.content("ΣΑΣ ’ü") == "σασʼü"
    assert text.strip_marks("é̀ a️") == "é a"
    assert text.written_tokens("L'été, déjà 3x") == ["L", "été", "déjà", "x"]


@settings(max_examples=100, deadline=None)
@given(st.text("abc", max_size=12), st.text("abc", max_size=12))
def test_similarity(a, b):
    assert text.similarity(a, b) == SequenceMatcher(None, a, b, autojunk=False).ratio()
    assert 0 <= text.similarity(a, b) <= 2 * min(len(a), len(b)) / (len(a) + len(b)) if a or b else True
    assert text.text_similarity("", b) == 0.0


def test_forms_and_scripts():
    assert [text.normal_form(x) for x in ("abc", "é", "é", "éé")] == ["none", "NFC", "NFD", "mixed"]
    assert scripts.merged_form(["none", "NFC"]) == "NFC" and scripts.merged_form(["NFD", "NFC"]) == "mixed" and scripts.merged_form([]) == scripts.merged_form(["none"]) == "NFC"
    assert scripts.detect_script({"Hira": 5, "Hani": 5})[0] == "Jpan"
    assert scripts.detect_script({"Hang": 5, "Hani": 1})[0] == "Kore"
    assert scripts.detect_script({"Latn": 97, "Grek": 3, "Zyyy": 500}) == ("Latn", ["Latn", "Grek"])
    assert scripts.detect_script({"Latn": 999, "Grek": 1}) == ("Latn", []) and scripts.detect_script({}) == (None, [])
    assert [text.letter_index(n) for n in (0, 25, 26, 701, 702)] == ["a", "z", "aa", "zz", "aaa"]


def test_diagnosis():
    a = "".join(f"ma{c}o" for c in "bcdfghjklnpqrstvwz") * 2
    assert compare.category(a, a.replace("o", "u"), 0.75) == "single_pair_dominant_ambiguous"
    assert compare.category("abc", "xyz", 0.0) == "likely_distinct_translation"
    assert compare.category("abc", "abc", 1.0) == "likely_dialect_variant"
    block = "the quick brown fox jumps over it"
    assert compare.category(block + "one" + block, "one" + block, 0.6) == "likely_source_duplication"
    # Vectors worked out by hand from the rule: floors, known pairs, a hunk that stands once, an insertion.
    assert compare.category("abcdefghij" * 6, "abcdefghiz" + "abcdefghij" * 5, 0.6) == "likely_orthography_convention"
    assert compare.category("abcdefghij" * 6, "abcdefghiz" + "abcdefghij" * 5, 0.4) == "likely_distinct_translation"
    sounds = "".join(f"k{c}ʉt" for c in "bcdfghjk")
    assert compare.category(sounds, sounds.replace("ʉ", "u"), 0.75) == "likely_phonemic_distinction"
    assert not compare.repeats_itself(block + "one", "one", text.edits(block + "one", "one"))
    assert compare.replaced_score("abab", "axbaxb", ("", "x")) == text.similarity("abab", "axbaxb")
    wide = [chr(0x400 + k) for k in range(60)]
    assert compare.category("".join(wide), "".join(w + chr(0x500 + k) for k, w in enumerate(wide)), 0.84) == "likely_distinct_translation"
    assert compare.category("".join(wide), "".join(w + chr(0x500 + k) for k, w in enumerate(wide)), 0.85) == "likely_dialect_variant"


def test_tiers_and_bitrate(spark):
    df = spark.createDataFrame([(1.0, "128kbps"), (0.99, "x"), (0.6, " 64kbps"), (0.6, "64 KBPS"), (0.1, None), (None, "kbps")], "s double, b string")
    out = df.select(rollups.score_tier(F.col("s")).alias("t"), rollups.bitrate(F.col("b")).alias("n")).collect()
    assert [(r.t, r.n) for r in out] == [("identical", 128), ("near_identical", None), ("uncertain", 64), ("uncertain", None), ("distinct", None), (None, None)]


def test_refs(spark):
    df = spark.createDataFrame([("PSA 3:4",), ("PSA 3:4a",), ("PSA 3:title",), ("nonsense",)], "r string")
    got = [r.x for r in df.select(refs.split_ref(F.col("r")).alias("x")).collect()]
    assert [tuple(x) if x else None for x in got] == [("PSA", 3, 4, "", False), ("PSA", 3, 4, "a", False), ("PSA", 3, None, "", True), None]
    lines = spark.createDataFrame([("BBB 1:2",), ("AAA 2:3 1:4",), ("ZZZ 1:1",)], "value string")
    out = refs.render_shape(refs.parse_shapes(lines, strict=True), ["AAA", "BBB"]).orderBy("position").collect()
    assert [r.line for r in out] == ["AAA 1:4 2:3", "BBB 1:2", "ZZZ 1:1"]
    with pytest.raises(Exception, match="not a chapter"):
        refs.parse_shapes(spark.createDataFrame([("AAA x",)], "value string"), strict=True).collect()


def test_checksum_weighs_each_book_alone(spark):
    counts = [("a", "GEN", 107, 3), ("a", "EXO", 107, 3), ("a", "PSA", 90, 150), ("b", "GEN", 121, 3), ("b", "PSA", 100, 152), ("c", "PSA", 121, 152), ("d", "TOB", 900, 9), ("e", "GEN", None, 3), ("f", "GEN", 100, 9)]
    ref = [("GEN", 100, 3), ("EXO", 100, 3), ("PSA", 100, 150)]
    out = refs.checksum(spark.createDataFrame(counts, "id string, book string, verses bigint, chapters bigint"), spark.createDataFrame(ref, "book string, ref_verses bigint, ref_chapters bigint"))
    assert {r.id: (r.worst, r.flagged, r.ok) for r in out.collect()} == {
        "a": (0, [], True), "b": (200, ["GEN v+21", "PSA ch+2"], False), "c": (21, ["PSA v+21"], False), "d": (0, [], True), "e": (0, [], True), "f": (0, [], True),
    }


def test_crosswalk_and_offsets(spark):
    r = spark.createDataFrame([("DAG", 1, "a"), ("DAG", 13, "b"), ("ESG", 2, "c"), ("GEN", 1, "d"), ("XXX", 1, "e")], "book string, chapter int, id string")
    rules = spark.createDataFrame([("DAG", "DAN", 0, None, None), ("ESG", "EST", 0, 2, 10), ("XXX", None, 0, None, None)], "book string, to string, chapter_offset int, only_chapter int, to_chapter int")
    assert sorted((x.id, x.book, x.chapter) for x in refs.crosswalk(r, rules).collect()) == [("a", "DAN", 1), ("b", "DAN", 13), ("c", "EST", 10), ("d", "GEN", 1)]
    o = spark.createDataFrame([("g", k, v) for k, v in enumerate([1, None, 1, None, 2, None])], "g string, k int, off int")
    assert [x.resolved for x in refs.neighbour_offset(o, ["g"], "k", "off").orderBy("k").collect()] == [1, 1, 1, 1, 2, 2]


def test_clusters(spark):
    s = spark.createDataFrame([("x", 1, 2, 1.0), ("x", 2, 3, 0.97), ("x", 5, 6, 0.96), ("x", 3, 5, 0.5)], "lang string, a bigint, b bigint, score double")
    assert sorted((r.doc_id, r.cluster) for r in compare.clusters(s, 0.95).collect()) == [(1, 1), (2, 1), (3, 1), (5, 5), (6, 5)]


def test_sources(spark, tmp_path):
    page = {"data": [{"iso": "eng", "abbr": "ENGX", "filesets": {"b": [{"id": "ENGXN1DA", "type": "audio", "size": "NT"}, {"id": "ENGXO_ET", "type": "text", "size": "OT"}]}}]}
    (tmp_path / "list_page_1.json").write_text(json.dumps(page))
    found = tables.filesets(tables.catalog_pages(spark, str(tmp_path / "list_page_1.json")))
    assert sorted((r.iso, r.id, r.size) for r in found.collect()) == [("eng", "ENGXN1DA", "NT"), ("eng", "ENGXO_ET", "OT")]
    (tmp_path / "d").mkdir()
    (tmp_path / "d/good.json").write_text('{"iso": "eng"}')
    (tmp_path / "d/bad.json").write_text('{"iso": ')
    assert [r.iso for r in tables.json_directory(spark, str(tmp_path / "d"), tables.T.StructType([tables.T.StructField("iso", tables.T.StringType())])).collect()] == ["eng"]
    rows = tables.toml_table(spark, '[eng.X]\nreason = "old"\nscope = "all"\n').collect()
    assert sorted((r.key, r.id, r.field, r.value) for r in rows) == [("eng", "X", "reason", "old"), ("eng", "X", "scope", "all")]
    (tmp_path / "pin.txt").write_text("a\n")
    with pytest.raises(ValueError, match="pinned"):
        tables.pinned(spark, str(tmp_path / "pin.txt"), "0")


def test_stream_ingests_each_file_once(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    src, state, check = (str(tmp_path / x) for x in ("src", "state", "check"))
    for part in range(2):
        events.where(f"event_id % 2 = {part}").write.mode("append").parquet(src)
        ingest.ingest(spark, src, events.schema, state, check, ["event_id"])
    ingest.ingest(spark, src, events.schema, state, check, ["event_id"])
    assert spark.read.parquet(state).count() == events.count() == ingest.digest(spark, state, ["event_id"]).count()


def test_stream_windows_match_batch(spark, sf, tmp_path):
    events = spark.read.parquet(f"{sf}/events.parquet")
    events.write.parquet(str(tmp_path / "src"))
    stream = windows.tumbling(spark.readStream.schema(events.schema).parquet(str(tmp_path / "src")))
    q = stream.writeStream.format("memory").queryName("tumbling").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination()
    key = lambda r: (r.start, r.event_type, r.n)
    assert sorted(map(key, spark.table("tumbling").collect())) == sorted(map(key, windows.tumbling(events).collect()))
