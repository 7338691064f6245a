"""Queries of verdicts and sinks over the proxy tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import verdicts
from lectern.plans.catalog import query
from lectern.session import table
from lectern.sinks import documents


@query("textual_basis", r"""WITH v AS (SELECT user_id * 6 + event_id % 6 AS id, CASE WHEN event_id % 17 = 0 THEN NULL WHEN event_id % 5 = 0 THEN chr(10) || ' ' WHEN event_id % 5 = 1 THEN ['[x]', ' (y', '【z】 t'][event_id % 3 + 1] WHEN user_id % 3 = 0 THEN '' WHEN user_id % 7 = 1 AND event_id % 5 < 4 THEN '' ELSE event_type END AS text, event_id % 4 = 0 AS tr_only FROM events),
c AS (SELECT id, count(*) AS checked, count(*) FILTER (b = 0) AS present, count(*) FILTER (b = 1) AS bracketed, count(*) FILTER (tr_only) AS tr_checked, count(*) FILTER (tr_only AND b = 0) AS tr_present FROM (SELECT *, CASE WHEN regexp_matches(text, '^\s*[\[(【]') THEN 1 WHEN regexp_matches(text, '^\s*$') THEN 2 ELSE 0 END AS b FROM v WHERE text IS NOT NULL) GROUP BY 1)
SELECT *, CASE WHEN checked < 8 THEN 'indeterminate' WHEN bracketed >= 3 AND present / checked < 0.5 THEN 'mixed' WHEN present / checked < 0.2 THEN 'critical' WHEN tr_checked > 0 AND tr_present * 2 >= tr_checked THEN 'tr' WHEN present / checked >= 0.6 THEN 'byzantine' ELSE 'mixed' END AS verdict FROM c""")
def textual_basis(spark, sf_dir):
    """The textual basis by diagnostic verses."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id") % 5
    doubtful = F.get(F.array(F.lit("[x]"), F.lit(" (y"), F.lit("【z】 t")), (F.col("event_id") % 3).cast("int"))
    text = F.when(F.col("event_id") % 17 == 0, None).when(k == 0, "\n ").when(k == 1, doubtful).when(F.col("user_id") % 3 == 0, "").when((F.col("user_id") % 7 == 1) & (k < 4), "").otherwise(F.col("event_type"))
    return verdicts.textual_basis(e.select((F.col("user_id") * 6 + F.col("event_id") % 6).alias("id"), text.alias("text"), (F.col("event_id") % 4 == 0).alias("tr_only")))


@query("psalm_titles", """WITH p AS (SELECT o_custkey AS id, CASE WHEN o_orderstatus = 'P' THEN NULL WHEN o_custkey % 5 < 3 THEN o_custkey % 5 = 0 ELSE o_orderstatus = 'F' END AS numbered, CASE WHEN o_custkey % 5 = 2 THEN NULL WHEN o_orderkey % 3 = 0 AND o_custkey % 2 = 0 THEN 'heading' WHEN o_orderkey % 3 = 1 THEN 'note' END AS marked FROM orders)
SELECT id, CASE WHEN bool_or(numbered) AND bool_or(NOT numbered) THEN 'mixed' WHEN bool_or(numbered) THEN 'numbered' WHEN coalesce(bool_or(marked = 'heading'), false) THEN 'heading' WHEN coalesce(bool_or(marked = 'note'), false) THEN 'note' ELSE 'unmarked' END AS titles
FROM p WHERE numbered IS NOT NULL GROUP BY 1""")
def psalm_titles(spark, sf_dir):
    """How titles are set."""
    o, k = table(spark, sf_dir, "orders"), F.col("o_orderkey") % 3
    c = F.col("o_custkey")
    p = o.select(F.col("o_custkey").alias("id"), F.when(F.col("o_orderstatus") == "P", None).when(c % 5 < 3, c % 5 == 0).otherwise(F.col("o_orderstatus") == "F").alias("numbered"), F.when(c % 5 == 2, None).when((k == 0) & (c % 2 == 0), "heading").when(k == 1, "note").alias("marked"))
    return verdicts.title_class(p)


@query("text_route", """WITH f AS (SELECT p_type || p_brand || p_partkey % 40 AS id, list(DISTINCT CASE p_size % 23 WHEN 0 THEN 'j' WHEN 1 THEN 'u' WHEN 2 THEN 'pl' ELSE 'x' END) AS f, max(CASE WHEN p_size % 46 = 1 THEN 'usx' END) AS o FROM part GROUP BY 1)
SELECT id, CASE WHEN o = 'usx' AND list_contains(f, 'u') THEN 'usx' WHEN list_contains(f, 'j') THEN 'sofria' WHEN list_contains(f, 'u') THEN 'usx' WHEN list_contains(f, 'pl') THEN 'plain' END AS route FROM f""")
def text_route(spark, sf_dir):
    """The reading route."""
    p, k = table(spark, sf_dir, "part"), F.col("p_size") % 23
    kind = F.when(k == 0, "j").when(k == 1, "u").when(k == 2, "pl").otherwise("x")
    f = p.groupBy(F.concat("p_type", "p_brand", (F.col("p_partkey") % 40).cast("string")).alias("id")).agg(F.collect_set(kind).alias("f"), F.max(F.when(F.col("p_size") % 46 == 1, "usx")).alias("o"))
    return f.select("id", verdicts.text_route(F.col("f"), F.col("o")).alias("route"))


@query("default_edition", """SELECT lang, arg_min(doc_id, (CASE source WHEN 'src3' THEN 1 WHEN 'src1' THEN 2 ELSE 3 END, doc_id)) AS doc_id FROM documents GROUP BY 1""")
def default_edition(spark, sf_dir):
    """The default edition by source priority."""
    return verdicts.default_edition(table(spark, sf_dir, "documents"), ["lang"], "source", ["src3", "src1"], "doc_id")


@query("has_timing", """WITH b AS (SELECT l_orderkey AS id, list(DISTINCT l_linenumber) AS b FROM lineitem GROUP BY 1)
SELECT id, CASE id % 3 WHEN 0 THEN list_contains(b, 2) WHEN 1 THEN NOT list_contains(b, 2) ELSE true END AS timed FROM b""")
def has_timing(spark, sf_dir):
    """Whether a book has timing."""
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set("l_linenumber").alias("b"))
    k = F.col("id") % 3
    return b.select("id", verdicts.has_timing(F.when(k == 0, F.col("b")), F.when(k == 1, F.col("b")), F.lit(2)).alias("timed"))


@query("split_documents", """SELECT lang, '{"schema_version":1,"entries":{' || string_agg('"' || doc_id || '":{"source":"' || source || '","n_chars":' || n_chars || '}', ',' ORDER BY CAST(doc_id AS VARCHAR)) || '}}' AS document FROM documents GROUP BY 1""")
def split_documents(spark, sf_dir):
    """K1, K2: a document per language."""
    d = table(spark, sf_dir, "documents").select("lang", "doc_id", "source", "n_chars")
    return documents.documents_by(d, ["lang"], ["doc_id"])
