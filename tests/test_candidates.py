"""Recordings that could be aligned."""

from lectern.operators import candidates


def _rows(df, *columns):
    return sorted(tuple(r[c] for c in columns) for r in df.collect())


def test_untimed_best(spark):
    rows = [
        ("a", "AAAN1DA", False), ("a", "AAAN2DA", False), ("a", "AAAN1SA", False),  # the best tier
        ("b", "BBBN2DA", True), ("b", "BBBN2SA", False),  # a timed one is as good
        ("c", "CCCN2DA", True), ("c", "CCCN1DA", False),  # better than the timed one
        ("d", "DDDNXYZ", False), ("d", "DDDNXYQ", False), ("e", "EEENXYZ", False), ("e", "EEENQQQ", True), ("f", "x", False),
    ]
    got = candidates.untimed_best(spark.createDataFrame(rows, "iso string, id string, timed boolean"), ["iso"])
    more = candidates.untimed_best(spark.createDataFrame([*rows, ("a", "AAANXYZ", False), ("b", "BBBNXYZ", False)], "iso string, id string, timed boolean"), ["iso"], unranked=True)
    assert [r for r in _rows(more, "iso", "id") if r not in _rows(got, "iso", "id")] == [("a", "AAANXYZ"), ("b", "BBBNXYZ")]
    assert _rows(got, "iso", "id", "better") == [("a", "AAAN1DA", False), ("c", "CCCN1DA", True), ("d", "DDDNXYQ", False), ("d", "DDDNXYZ", False), ("f", "x", False)]


def test_sync_candidates(spark):
    f = lambda *r: r
    rows = [
        f("eng", "ENGX", "NT", "NT", "ENGXN2DA-opus16", "audio"), f("eng", "ENGX", "NT", "NT", "ENGXN2DA", "audio_drama"), f("eng", "ENGX", "FULL", "C", "ENGX_ET", "text_usx"), f("eng", "ENGX", "FULL", "C", "ENGX_PL", "text_plain"),
        f("eng", "ENGX", "NT", "NT", "ENGXN2SA", "audio_stream"), f("eng", "ENGX", "PARTIAL", "OTP", "ENGXP1DA", "audio"), f("eng", "ENGX", "PARTIAL", "?", "ENGXQ1DA", "audio"),
        f("fra", "", "NT", "NT", "FRAXN1DA", "audio"), f("fra", "FRAY", "NT", "NT", "FRAYN1DA", "audio"), f("deu", "DEUX", "NT", "NT", "DEUXN1SA", "audio_stream"), f("deu", "DEUX", "NT", "NT", "DEUXT", "text_other"), f("deu", "DEUX", "NT", None, None, "audio"),
    ]
    files = spark.createDataFrame(rows, "iso string, abbr string, canon string, size string, id string, type string")
    timed = spark.createDataFrame([("eng", "ENGXN2SA"), ("eng", "ENGXN2SA")], "iso string, id string")
    got = candidates.sync_candidates(files, timed)
    assert _rows(got, "iso", "canon", "audio", "text", "better") == [("deu", "nt", "DEUXN1SA", "DEUXT", False), ("eng", "nt", "ENGXN2DA", "ENGX_PL", True), ("eng", "ot", "ENGXP1DA", "ENGX_PL", False)]
    assert candidates.sync_candidates(files.limit(0), timed).isEmpty()


def test_syncable_pairs(spark):
    audio = spark.createDataFrame([("eng", "ENGXYZN1DA", False), ("eng", "ENGXYZN2DA", False), ("fra", "ENGXYZN1DA", False), ("eng", "OTHERSN1DA", False)], "iso string, id string, timed boolean")
    texts = spark.createDataFrame([("eng", "ENGXYZN_ET", 2), ("eng", "ENGXYZ", 1), ("eng", "ENGXYQ", 0)], "iso string, id string, pos int")
    assert _rows(candidates.syncable_pairs(audio, texts), "iso", "audio", "text") == [("eng", "ENGXYZN1DA", "ENGXYZ")]
