"""The pipeline's stages on plain cases, and queries against SQL on the small tables."""

import duckdb
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from lectern.llm import queries

TABLES = "documents labels conversations".split()


def _norm(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(str, row)) for row in frame.itertuples(index=False))


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_against_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    assert _norm(queries.QUERIES[name](spark, sf).toPandas()) == _norm(con.sql(queries.ORACLE_SQL[name]).df())


def test_pipeline_stages(spark, make):
    word = lambda k: f"w{k:03d}"
    base = [" ".join(word(100 * d + k) for k in range(60)) for d in range(6)]
    passage = "It was told here once. It was told here twice. It was told here again. And so it ended."
    rows = [
        (1, base[0] + ". " + passage), (2, base[0].replace(" ", "  ") + ". " + passage), (3, base[1]), (4, base[1] + " extra"),
        (5, base[2] + ".\n" + passage), (6, "12345 !!"), (7, None), (8, base[3]), (9, base[4]), (10, base[5]),
    ]
    docs = make(rows)
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, "")
        assert docs.columns == make(rows).columns
        kept.append({r.doc_id: r.text for r in docs.collect()})
    assert set(kept[0]) == {1, 2, 3, 4, 5, 8, 9, 10}
    assert set(kept[1]) == {2, 3, 4, 5, 8, 9, 10}  # the longer of 1 and 2
    assert set(kept[2]) == {2, 3, 5, 8, 9, 10}
    assert passage in kept[3][2] and "told" not in kept[3][5] and base[2] in kept[3][5]
    last = corpus_pipeline.STAGES[-1][1](spark, docs, "").collect()
    assert {r.doc_id for r in last} == set(kept[3])


def _through(spark, docs):
    for _, stage in corpus_pipeline.STAGES[:-1]:
        columns = docs.columns
        docs = stage(spark, docs, "")
        assert docs.columns == columns
    return docs, corpus_pipeline.STAGES[-1][1](spark, docs, "")


def test_pipeline_of_an_empty_table(spark, make):
    kept, packed = _through(spark, make([]))
    assert kept.count() == packed.count() == 0


def test_pipeline_of_odd_rows(spark, make):
    # Repeated and null ids, nulls in every column, columns whose names the operators use themselves.
    say = lambda a, n=30: " ".join(f"{a}word{k}x" for k in range(n))
    rows = [(1, say("a")), (1, say("a")), (1, say("b")), (2, say("b") + " more"), (None, say("c")), (None, None), (None, say("a")), (3, ""), (4, "  \n"), (5, "???"), (6, say("d", 40_000))]
    docs = make(rows)
    clash = {c: F.lit(c) for c in ("n", "count", "run", "row", "sha", "best", "spans", "starts", "text_hash", "__sha", "salt", "removed_by", "sid", "component", "places", "__row", "__best", "__salt", "__hot___sha", "__hash", "__own", "__id", "__starts", "__n")}
    kept, packed = _through(spark, docs.withColumns(clash))
    found = sorted((r.doc_id or 0, r.text) for r in kept.collect())
    assert [(k, t[:6]) for k, t in found] == [(0, "cword0"), (1, "aword0"), (1, "bword0"), (6, "dword0")]
    assert all(r[c] == c for r in kept.collect() for c in clash)
    by = {}
    for r in packed.collect():
        by.setdefault((r.doc_id, r.piece), []).append(r.length)
    assert max(k for d, k in by if d == 6) > 10 and all(0 < x <= 2048 for own in by.values() for x in own)


def test_pipeline_is_reproducible(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, two = (sorted((r.doc_id, r.text) for r in _through(spark, d)[0].collect()) for d in (docs, docs.orderBy("source", "doc_id").repartition(7)))
    assert one == two


def test_pipeline_runs(spark, sf):
    assert corpus_pipeline.run(spark, sf).count() > 100
