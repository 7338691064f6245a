"""Queries of roll-ups, joins, references and incremental operators over the proxy tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.operators import joins, refs, rollups
from lectern.plans.catalog import query
from lectern.session import table

#: Books of the proxy canon: the seven order lines.
FULL = tuple(range(1, 8))


def _flags(spark, sf_dir):
    """Per document: text, audio and timing flags from its labels."""
    d, lab = table(spark, sf_dir, "documents").select("doc_id", "lang", "source"), table(spark, sf_dir, "labels")
    return d.join(lab, "doc_id", "left").select("doc_id", "lang", "source", F.col("quality").isNotNull().alias("text"), F.coalesce(F.col("quality") == 1, F.lit(False)).alias("audio"), F.coalesce(F.col("toxic") == 1, F.lit(False)).alias("timing"))


FLAGS_SQL = """flags AS (SELECT d.doc_id, lang, source, quality IS NOT NULL AS text, coalesce(quality = 1, false) AS audio, coalesce(toxic = 1, false) AS timing
  FROM documents d LEFT JOIN labels USING (doc_id))"""
CATEGORY_SQL = """CASE WHEN text AND audio AND timing THEN 'with-timecode' WHEN audio AND timing THEN 'audio-with-timecode' WHEN text AND audio THEN 'syncable'
  WHEN text THEN 'text-only' WHEN audio THEN 'audio-only' END"""


@query("coverage_index", "SELECT lang, source, count(*) AS n, CASE WHEN count(*) > 1 THEN count(*) END AS shown FROM documents GROUP BY ALL")
def coverage_index(spark, sf_dir):
    """A1: editions by language and source; the count is shown only above 1."""
    n = F.count("*")
    return table(spark, sf_dir, "documents").groupBy("lang", "source").agg(n.alias("n"), F.when(n > 1, n).alias("shown"))


@query(
    "coverage_class",
    """SELECT l_orderkey AS key, CASE WHEN count(DISTINCT l_linenumber) FILTER (l_linenumber <= 3) = 3 THEN 'full' WHEN count(*) FILTER (l_linenumber <= 3) > 0 THEN 'partial' ELSE 'none' END AS coverage
FROM lineitem GROUP BY 1""",
)
def coverage_class(spark, sf_dir):
    """A3: coverage of a set of books."""
    books = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.collect_set("l_linenumber").alias("b"))
    return books.select("key", rollups.coverage_class(F.col("b"), F.array(*map(F.lit, (1, 2, 3)))).alias("coverage"))


@query("capability_category", f"WITH {FLAGS_SQL} SELECT doc_id, {CATEGORY_SQL} AS category FROM flags")
def capability_category(spark, sf_dir):
    """What an edition can be used for."""
    return _flags(spark, sf_dir).select("doc_id", rollups.capability_category(F.col("text"), F.col("audio"), F.col("timing")).alias("category"))


@query("langs_by_category", f"""WITH {FLAGS_SQL}, c AS (SELECT lang, {CATEGORY_SQL} AS category FROM flags)
SELECT category, string_agg(DISTINCT lang, ',' ORDER BY lang) AS langs, count(DISTINCT lang) AS n FROM c WHERE category IS NOT NULL GROUP BY 1""")
def langs_by_category(spark, sf_dir):
    """Languages of each category."""
    c = _flags(spark, sf_dir).select("lang", rollups.capability_category(F.col("text"), F.col("audio"), F.col("timing")).alias("category")).where("category IS NOT NULL")
    return c.groupBy("category").agg(F.array_join(F.array_sort(F.collect_set("lang")), ",").alias("langs"), F.count_distinct("lang").alias("n"))


@query("richest_media", f"""WITH {FLAGS_SQL} SELECT lang, source, CASE max(CASE WHEN audio AND timing THEN 2 WHEN audio THEN 1 ELSE 0 END) WHEN 2 THEN 'at' WHEN 1 THEN 'a' ELSE '' END AS media FROM flags GROUP BY ALL""")
def richest_media(spark, sf_dir):
    """A10: at above a above nothing."""
    rank = F.max(F.when(F.col("audio") & F.col("timing"), 2).when(F.col("audio"), 1).otherwise(0))
    return _flags(spark, sf_dir).groupBy("lang", "source").agg(F.when(rank == 2, "at").when(rank == 1, "a").otherwise("").alias("media"))


@query("capability_letters", f"""WITH {FLAGS_SQL} SELECT lang, concat(CASE WHEN bool_or(audio) THEN 'a' ELSE '' END, CASE WHEN bool_or(text) THEN 't' ELSE '' END, CASE WHEN bool_or(timing) THEN 'w' ELSE '' END) AS code FROM flags GROUP BY 1""")
def capability_letters(spark, sf_dir):
    """Capability letters merged over rows, in order."""
    letter = lambda c, x: F.when(F.bool_or(c), x).otherwise("")
    return _flags(spark, sf_dir).groupBy("lang").agg(F.concat(letter("audio", "a"), letter("text", "t"), letter("timing", "w")).alias("code"))


@query(
    "timing_exceptions",
    """WITH b AS (SELECT l_orderkey AS key, list_sort(list_distinct(list(l_linenumber))) AS b FROM lineitem GROUP BY 1),
e AS (SELECT key, b, list_filter(range(1, 8), lambda x: NOT list_contains(b, x)) AS lack FROM b)
SELECT key, CASE WHEN len(lack) = 0 THEN NULL WHEN len(b) <= len(lack) THEN 'only:' || array_to_string(b, ',') ELSE 'except:' || array_to_string(lack, ',') END AS exceptions FROM e""",
)
def timing_exceptions(spark, sf_dir):
    """The shorter of two lists."""
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("key")).agg(F.collect_set("l_linenumber").alias("b"))
    return b.select("key", rollups.exceptions(F.col("b"), F.array(*map(F.lit, FULL))).alias("exceptions"))


@query("audio_only_anti", "SELECT DISTINCT c_nationkey AS nation FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)")
def audio_only_anti(spark, sf_dir):
    """Keys of one set that another lacks."""
    s = table(spark, sf_dir, "supplier").where("s_acctbal > 5000").select(F.col("s_nationkey").alias("nation"))
    return table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("nation")).distinct().join(s, "nation", "left_anti")


@query("two_way_mismatch", """WITH a AS (SELECT DISTINCT l_partkey AS key FROM lineitem WHERE l_quantity > 48), b AS (SELECT p_partkey AS key FROM part WHERE p_size > 25)
SELECT key, 'parts' AS missing_in FROM a WHERE key NOT IN (SELECT key FROM b) UNION ALL SELECT key, 'lines' FROM b WHERE key NOT IN (SELECT key FROM a)""")
def two_way_mismatch(spark, sf_dir):
    """What either listing lacks."""
    a = table(spark, sf_dir, "lineitem").where("l_quantity > 48").select(F.col("l_partkey").alias("key"))
    b = table(spark, sf_dir, "part").where("p_size > 25").select(F.col("p_partkey").alias("key"))
    return joins.two_way_missing(a, b, ["key"], ("lines", "parts"))


@query("full_outer_flags", """SELECT k AS nation, max(c) AS customer, max(s) AS supplier FROM (SELECT c_nationkey AS k, true AS c, false AS s FROM customer WHERE c_acctbal > 9000 UNION ALL SELECT s_nationkey, false, true FROM supplier) GROUP BY 1""")
def full_outer_flags(spark, sf_dir):
    """Union of keys with a flag per source."""
    c = table(spark, sf_dir, "customer").where("c_acctbal > 9000").select(F.col("c_nationkey").alias("nation"))
    s = table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"))
    return joins.full_flags({"customer": c, "supplier": s}, ["nation"])


@query("first_source_wins", """WITH u AS (SELECT o_custkey AS key, 0 AS source_rank, max(o_orderpriority) AS name FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 UNION ALL SELECT c_custkey, 1, c_mktsegment FROM customer)
SELECT key, source_rank, name FROM u QUALIFY row_number() OVER (PARTITION BY key ORDER BY source_rank) = 1""")
def first_source_wins(spark, sf_dir):
    """The first source that has a name gives it."""
    a = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").groupBy(F.col("o_custkey").alias("key")).agg(F.max("o_orderpriority").alias("name"))
    b = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_mktsegment").alias("name"))
    return joins.first_source_wins([a, b], ["key"])


@query("best_variant_tier", """WITH p AS (SELECT p_partkey, p_brand, CASE WHEN p_type = 'ECONOMY' THEN NULL ELSE p_size END AS tier, p_retailprice > 1500 AS timed FROM part),
g AS (SELECT *, min(tier) FILTER (NOT timed) OVER (PARTITION BY p_brand) AS best, min(tier) FILTER (timed) OVER (PARTITION BY p_brand) AS done FROM p)
SELECT p_partkey, p_brand, tier, timed FROM g WHERE NOT timed AND NOT coalesce(done <= best, false) AND (best IS NULL OR tier = best)""")
def best_variant_tier(spark, sf_dir):
    """The best untimed variants of a base."""
    p = table(spark, sf_dir, "part").select("p_partkey", "p_brand", F.when(F.col("p_type") != "ECONOMY", F.col("p_size")).alias("tier"), (F.col("p_retailprice") > 1500).alias("timed"))
    return rollups.best_tier(p, ["p_brand"], "tier", "timed")


@query("shortest_id", "SELECT p_brand, arg_min(p_name, (length(p_name), p_partkey)) AS name FROM part GROUP BY 1")
def shortest_id(spark, sf_dir):
    """The shortest id of a base, ties by order."""
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.min_by("p_name", F.struct(F.length("p_name"), "p_partkey")).alias("name"))


@query("variants_merged", "SELECT p_brand, string_agg(DISTINCT p_type, ',' ORDER BY p_type) AS types, count(DISTINCT p_size) AS sizes FROM part GROUP BY 1")
def variants_merged(spark, sf_dir):
    """Formats merged per id."""
    return table(spark, sf_dir, "part").groupBy("p_brand").agg(F.array_join(F.array_sort(F.collect_set("p_type")), ",").alias("types"), F.count_distinct("p_size").alias("sizes"))


@query("variant_conflicts", "SELECT p_name, count(DISTINCT p_size) AS n_values FROM part GROUP BY 1 HAVING count(DISTINCT p_size) > 1")
def variant_conflicts(spark, sf_dir):
    """Ids with attributes that disagree."""
    return rollups.conflicts(table(spark, sf_dir, "part"), ["p_name"], "p_size")


@query("last_wins", "SELECT p_name, arg_max(p_size, p_partkey) AS size FROM part GROUP BY 1")
def last_wins(spark, sf_dir):
    """The last row of a key."""
    return table(spark, sf_dir, "part").groupBy("p_name").agg(F.max_by("p_size", "p_partkey").alias("size"))


@query("mode_order", """WITH c AS (SELECT lang, source, count(*) AS n, min(doc_id) AS pos FROM documents GROUP BY ALL)
SELECT lang, string_agg(source, ',' ORDER BY n DESC, pos) AS ordered, count(*) > 1 AS multi FROM c GROUP BY 1""")
def mode_order(spark, sf_dir):
    """Values by frequency, ties by first occurrence."""
    return rollups.mode_order(table(spark, sf_dir, "documents"), "lang", "source", "doc_id")


@query("wildcard_join", """WITH r AS (SELECT c_mktsegment AS iso, c_nationkey AS f FROM customer WHERE c_acctbal > 9800 UNION SELECT '*', s_nationkey FROM supplier WHERE s_acctbal > 9500)
SELECT DISTINCT c.iso, c.f FROM (SELECT c_mktsegment AS iso, c_nationkey AS f FROM customer) c JOIN r ON c.f = r.f AND (r.iso = c.iso OR r.iso = '*')""")
def wildcard_join(spark, sf_dir):
    """A key or the wildcard."""
    c = table(spark, sf_dir, "customer")
    rules = c.where("c_acctbal > 9800").select(F.col("c_mktsegment").alias("iso"), F.col("c_nationkey").alias("f")).union(table(spark, sf_dir, "supplier").where("s_acctbal > 9500").select(F.lit("*"), "s_nationkey"))
    return joins.wildcard_join(c.select(F.col("c_mktsegment").alias("iso"), F.col("c_nationkey").alias("f")), rules, "iso", ["f"])


@query("prefix_match", """WITH a AS (SELECT DISTINCT p_name AS t FROM part), b AS (SELECT DISTINCT p_name || ' x' AS u FROM part)
SELECT t, u FROM a JOIN b ON left(t, 6) = left(u, 6) AND left(u, least(7, length(t))) = left(t, least(7, length(t))) WHERE length(t) >= 6 AND length(u) >= 6""")
def prefix_match(spark, sf_dir):
    """Ids that agree on a prefix."""
    p = table(spark, sf_dir, "part").select(F.col("p_name").alias("t")).distinct()
    return joins.prefix_join(p, p.select(F.concat("t", F.lit(" x")).alias("u")), "t", "u")


@query("match_cascade", """WITH m AS (SELECT a.n_nationkey, 0 AS rule, s_suppkey FROM nation a JOIN supplier ON s_suppkey = n_nationkey * 7
UNION ALL SELECT n_nationkey, 1, s_suppkey FROM nation JOIN supplier ON s_nationkey = n_nationkey)
SELECT n_nationkey, s_suppkey, rule FROM m QUALIFY row_number() OVER (PARTITION BY n_nationkey ORDER BY rule, s_suppkey) = 1""")
def match_cascade(spark, sf_dir):
    """The first rule that matches."""
    n, s = table(spark, sf_dir, "nation"), table(spark, sf_dir, "supplier")
    key = lambda c: c.cast("bigint")
    return joins.match_cascade(n, s, "n_nationkey", "s_suppkey", [(key(F.col("n_nationkey") * 7), key(F.col("s_suppkey"))), (key(F.col("n_nationkey")), key(F.col("s_nationkey")))])


@query("asof_verse", """WITH a AS (SELECT event_id, user_id, ts FROM events WHERE event_type = 'click'), b AS (SELECT user_id, ts AS start, max(value) AS value FROM events WHERE event_type = 'view' GROUP BY ALL)
SELECT event_id, a.user_id, a.ts, b.value FROM a ASOF LEFT JOIN b ON a.user_id = b.user_id AND a.ts >= b.start""")
def asof_verse(spark, sf_dir):
    """The verse that plays at a time."""
    e = table(spark, sf_dir, "events")
    a = e.where("event_type = 'click'").select("event_id", "user_id", "ts")
    b = e.where("event_type = 'view'").groupBy("user_id", F.col("ts").alias("start")).agg(F.max("value").alias("value"))
    return joins.as_of(a, b, ["user_id"], "ts", "start", "value")


@query("first_start", "SELECT user_id, event_type, min(ts) AS start, arg_min(event_id, (ts, event_id)) AS event_id FROM events GROUP BY ALL")
def first_start(spark, sf_dir):
    """The first part of a verse."""
    return table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.min("ts").alias("start"), F.min_by("event_id", F.struct("ts", "event_id")).alias("event_id"))


@query("islands", """WITH c AS (SELECT *, CASE WHEN lag(event_type) OVER w = event_type THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY event_id)),
i AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM c)
SELECT user_id, CAST(island AS BIGINT) AS island, event_type, count(*) AS n, min(event_id) AS start FROM i GROUP BY user_id, island, event_type""")
def islands(spark, sf_dir):
    """Consecutive pieces of one verse."""
    return rollups.islands(table(spark, sf_dir, "events"), ["user_id"], "event_id", "event_type")


@query("back_fill", """SELECT event_id, arg_min(n.value, n.event_id) AS next_value FROM (SELECT event_id, user_id FROM events) e LEFT JOIN (SELECT event_id AS event_id, user_id, value FROM events WHERE event_type = 'purchase') n ON n.user_id = e.user_id AND n.event_id > e.event_id GROUP BY e.event_id""".replace("SELECT event_id, arg_min", "SELECT e.event_id, arg_min", 1))
def back_fill(spark, sf_dir):
    """A heading belongs to the next verse."""
    e = table(spark, sf_dir, "events").withColumn("v", F.when(F.col("event_type") == "purchase", F.col("value")))
    return rollups.back_fill(e, ["user_id"], "event_id", "v", "next_value").select("event_id", "next_value")


@query("snapshot_delta", """WITH o AS (SELECT o_orderkey AS path, o_totalprice AS size, o_orderstatus AS mtime FROM orders WHERE o_orderkey % 7 <> 0),
n AS (SELECT o_orderkey AS path, CASE WHEN o_orderkey % 5 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS size, o_orderstatus AS mtime FROM orders WHERE o_orderkey % 11 <> 0)
SELECT coalesce(o.path, n.path) AS path, CASE WHEN o.path IS NULL THEN 'added' WHEN n.path IS NULL THEN 'deleted' ELSE 'changed' END AS change
FROM o FULL JOIN n ON o.path = n.path WHERE o.path IS NULL OR n.path IS NULL OR o.size <> n.size OR o.mtime <> n.mtime""")
def snapshot_delta(spark, sf_dir):
    """What changed between two listings."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("path"), F.col("o_totalprice").alias("size"), F.col("o_orderstatus").alias("mtime"))
    n = o.where("path % 11 != 0").withColumn("size", F.when(F.col("path") % 5 == 0, F.col("size") + 1).otherwise(F.col("size")))
    return joins.snapshot_delta(o.where("path % 7 != 0"), n, "path", ["size", "mtime"])


@query("resume_filter", """SELECT c_custkey FROM customer LEFT JOIN (SELECT o_custkey, count(*) AS n, count(*) FILTER (o_orderstatus = 'P') AS failed FROM orders GROUP BY 1) ON o_custkey = c_custkey WHERE n IS NULL OR failed > 3 OR n < 5""")
def resume_filter(spark, sf_dir):
    """Never tried, failed in part, or grown."""
    done = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("n"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"))
    return table(spark, sf_dir, "customer").join(done, "c_custkey", "left").where("n IS NULL OR failed > 3 OR n < 5").select("c_custkey")


@query("override_pairs", "SELECT c_custkey AS s, c_nationkey AS t FROM customer WHERE c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_nationkey FROM supplier")
def override_pairs(spark, sf_dir):
    """Pairs with overrides."""
    base = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("s"), F.col("c_nationkey").alias("t"))
    return joins.override_pairs(base, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), F.col("s_nationkey").alias("t")), "s")


@query("pending_gap", """SELECT o_orderpriority, count(*) AS n, count(*) FILTER (l.l_orderkey IS NULL) AS pending FROM orders LEFT JOIN (SELECT DISTINCT l_orderkey FROM lineitem WHERE l_quantity > 40) l ON l.l_orderkey = o_orderkey GROUP BY 1""")
def pending_gap(spark, sf_dir):
    """How much is still missing."""
    seen = table(spark, sf_dir, "lineitem").where("l_quantity > 40").select("l_orderkey").distinct()
    j = table(spark, sf_dir, "orders").join(seen, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return j.groupBy("o_orderpriority").agg(F.count("*").alias("n"), F.count_if(F.col("l_orderkey").isNull()).alias("pending"))


@query("encode_ids", """SELECT p_partkey, CASE WHEN starts_with(upper(p_name), upper(left(p_name, p_size % 6))) THEN 't:' || substr(p_name, p_size % 6 + 1) END AS spec, p_name AS decoded FROM part""")
def encode_ids(spark, sf_dir):
    """Suffix compression and back."""
    p = table(spark, sf_dir, "part").withColumn("base", F.col("p_name").substr(F.lit(1), F.col("p_size") % 6))
    spec = rollups.encode_id(F.col("base"), F.col("p_name"))
    return p.select("p_partkey", spec.alias("spec"), rollups.decode_id(F.col("base"), spec).alias("decoded"))


@query("strip_suffixes", "SELECT p_partkey, CASE WHEN p_name LIKE '%ing' THEN left(p_name, length(p_name) - 3) WHEN p_name LIKE '%g' THEN left(p_name, length(p_name) - 1) WHEN p_name LIKE '%et' THEN left(p_name, length(p_name) - 2) ELSE p_name END AS stem FROM part")
def strip_suffixes(spark, sf_dir):
    """One suffix, in list order."""
    return table(spark, sf_dir, "part").select("p_partkey", rollups.strip_suffix(F.col("p_name"), ["ing", "g", "et"]).alias("stem"))


#: A made-up shape, verses of three chapters per book.
SHAPE_LINES = ["# shape", "AAA 1:5 2:7 3:4", "BBB 1:3 2:9", "=skip", "CCC 1:2 x 2:6"]
_SHAPE_SQL = "shape(book, chapter, last) AS (VALUES ('AAA', 1, 5), ('AAA', 2, 7), ('AAA', 3, 4), ('BBB', 1, 3), ('BBB', 2, 9), ('CCC', 1, 2), ('CCC', 2, 6))"


def _shape(spark):
    return refs.parse_shapes(spark.createDataFrame([(x,) for x in SHAPE_LINES], "value string"))


@query("parse_vrs", f"WITH {_SHAPE_SQL} SELECT * FROM shape")
def parse_vrs(spark, sf_dir):
    """Shape lines to rows."""
    return _shape(spark)


def _ranges(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    book = F.element_at(F.array(*map(F.lit, ("AAA", "BBB", "CCC"))), (F.col("p_partkey") % 3 + 1).cast("int"))
    c1, size = (F.col("p_size") % 2 + 1), F.col("p_size")
    return p.select(F.col("p_partkey").alias("id"), book.alias("book"), c1.alias("c1"), (size % 3 + 1).alias("v1"), (c1 + size % 2).alias("c2"), (size % 5 + 1).alias("v2"))


_RANGES_SQL = f"""{_SHAPE_SQL}, r AS (SELECT p_partkey AS id, ['AAA', 'BBB', 'CCC'][p_partkey % 3 + 1] AS book, p_size % 2 + 1 AS c1, p_size % 3 + 1 AS v1, p_size % 2 + 1 + p_size % 2 AS c2, p_size % 5 + 1 AS v2 FROM part),
e AS (SELECT id, r.book, chapter, unnest(range(CASE WHEN chapter = c1 THEN v1 ELSE 1 END, CASE WHEN chapter = c2 THEN least(v2, last) ELSE last END + 1)) AS verse
  FROM r JOIN shape s ON s.book = r.book AND chapter BETWEEN c1 AND c2)"""


@query("range_expand", f"WITH {_RANGES_SQL} SELECT id, book, chapter, CAST(verse AS INTEGER) AS verse FROM e")
def range_expand(spark, sf_dir):
    """Ranges to verses by the shape."""
    return refs.expand_ranges(_ranges(spark, sf_dir), _shape(spark))


@query("range_compose", f"""WITH {_RANGES_SQL}, m AS (SELECT id, book, min((chapter, verse)) AS a, max((chapter, verse)) AS b FROM e GROUP BY ALL)
SELECT id, book || ' ' || a[1] || ':' || a[2] || CASE WHEN a = b THEN '' WHEN a[1] = b[1] THEN '-' || b[2] ELSE '-' || b[1] || ':' || b[2] END AS ref FROM m""")
def range_compose(spark, sf_dir):
    """Verses back to a range."""
    return refs.compose_ranges(refs.expand_ranges(_ranges(spark, sf_dir), _shape(spark)))


@query("range_contiguous", f"""WITH {_RANGES_SQL}, k AS (SELECT e.*, last, lag(chapter) OVER w AS pc, lag(verse) OVER w AS pv, lag(last) OVER w AS pl FROM (SELECT * FROM e WHERE verse <> 3) e JOIN shape USING (book, chapter) WINDOW w AS (PARTITION BY id ORDER BY chapter, verse))
SELECT id, bool_and(pv IS NULL OR (chapter = pc AND verse = pv + 1) OR (chapter = pc + 1 AND verse = 1 AND pv = pl)) AS contiguous FROM k GROUP BY 1""")
def range_contiguous(spark, sf_dir):
    """Whether verses follow one another."""
    e = refs.expand_ranges(_ranges(spark, sf_dir), _shape(spark)).where("verse != 3")
    return refs.contiguous(e.join(_shape(spark), ["book", "chapter"]))


@query("vmap_lookup", """SELECT c_custkey AS ref, coalesce(s_nationkey, c_custkey) AS target FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey""")
def vmap_lookup(spark, sf_dir):
    """A map with identity elsewhere."""
    r = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("ref"))
    return refs.map_refs(r, table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("s"), F.col("s_nationkey").cast("bigint").alias("t")))


@query("classify_scheme", """WITH p AS (SELECT p_partkey AS id, CASE WHEN p_size % 7 = 0 THEN NULL ELSE p_size % 30 END AS ps117, p_size % 13 = 0 AS ps151, CASE WHEN p_partkey % 11 = 0 THEN NULL ELSE 18 + p_partkey % 5 END AS ps51, 3 + p_partkey % 2 AS mal,
  CASE p_partkey % 3 WHEN 0 THEN NULL WHEN 1 THEN true ELSE false END AS mal4, CASE WHEN p_partkey % 5 = 0 THEN NULL ELSE 30 + p_partkey % 30 END AS sa17, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 20 + p_partkey % 9 END AS ki4,
  CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE 14 + p_partkey % 2 END AS hag1, p_partkey % 8 = 0 AS byz FROM part)
SELECT id, CASE WHEN ps117 IS NULL THEN '?' WHEN ps117 >= 15 OR ps151 THEN CASE WHEN byz THEN 'rso' WHEN sa17 IS NULL THEN '?' WHEN sa17 <= 40 AND coalesce(ki4 <= 25, true) THEN 'lxx' WHEN hag1 IS NULL THEN '?' WHEN hag1 = 14 THEN 'vul' ELSE 'rso' END
  WHEN ps51 IS NULL THEN '?' WHEN ps51 <= 20 THEN 'eng' WHEN mal = 4 THEN CASE WHEN mal4 IS NULL THEN '?' WHEN mal4 THEN 'orgw' ELSE 'org' END ELSE 'org' END AS scheme FROM p""")
def classify_scheme(spark, sf_dir):
    """The scheme by its probes, three-valued."""
    k, s = F.col("p_partkey"), F.col("p_size")
    no = lambda cond, v: F.when(~cond, v)
    mal4 = F.when(k % 3 == 1, True).when(k % 3 == 2, False)
    scheme = refs.classify_scheme(no(s % 7 == 0, s % 30), s % 13 == 0, no(k % 11 == 0, 18 + k % 5), 3 + k % 2, mal4, no(k % 5 == 0, 30 + k % 30), no(k % 4 == 0, 20 + k % 9), no(k % 6 == 0, 14 + k % 2), k % 8 == 0)
    return table(spark, sf_dir, "part").select(k.alias("id"), scheme.alias("scheme"))


@query("checksum_flags", """WITH c AS (SELECT l_orderkey AS id, l_returnflag AS book, count(*) AS verses, count(DISTINCT l_linenumber) AS chapters FROM lineitem GROUP BY ALL), r(book, rv, rc) AS (VALUES ('A', 1, 2), ('N', 2, 1)),
f AS (SELECT id, book, CASE WHEN verses - rv > 2 THEN verses - rv WHEN book = 'A' AND chapters > rc THEN (chapters - rc) * 100 END AS w, CASE WHEN verses - rv > 2 THEN book || ' v+' || (verses - rv) WHEN book = 'A' AND chapters > rc THEN book || ' ch+' || (chapters - rc) END AS told FROM c LEFT JOIN r USING (book))
SELECT id, coalesce(max(w), 0) AS worst, array_to_string(list_sort(coalesce(list(told) FILTER (told IS NOT NULL), [])), ',') AS flagged, count(told) = 0 AS ok FROM f GROUP BY 1""")
def checksum_flags(spark, sf_dir):
    """D3: whole-text checksum against a scheme, each book alone."""
    c = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("book")).agg(F.count("*").alias("verses"), F.count_distinct("l_linenumber").alias("chapters"))
    r = spark.createDataFrame([("A", 1, 2), ("N", 2, 1)], "book string, ref_verses bigint, ref_chapters bigint")
    return refs.checksum(c, r, slack=2, chapter_books=("A",)).withColumn("flagged", F.array_join("flagged", ","))


@query("shape_gaps", f"WITH {_SHAPE_SQL} SELECT book, chapter, last, last + chapter % 2 AS other FROM shape WHERE chapter % 2 = 1 AND book <> 'BBB'")
def shape_gaps(spark, sf_dir):
    """Chapters that differ and that no row touches."""
    a = _shape(spark)
    b = a.withColumn("last", F.col("last") + F.col("chapter") % 2)
    return refs.shape_gaps(a, b, a.where("book = 'BBB'"))


@query("nearest_shape", """WITH s(scheme, book, chapter, own) AS (VALUES ('eng', 'AFRICA', 1, 3), ('eng', 'ASIA', 1, 4), ('org', 'AFRICA', 1, 5), ('org', 'ASIA', 1, 4)),
l AS (SELECT s_suppkey AS id, r_name AS book, 1 AS chapter, 3 + s_suppkey % 3 AS last FROM supplier, region WHERE r_name IN ('AFRICA', 'ASIA')),
c AS (SELECT id, scheme, count(*) FILTER (last <> own AND last IN (SELECT own FROM s x WHERE x.book = l.book)) AS conflicts FROM l JOIN s USING (book, chapter) GROUP BY ALL)
SELECT id, scheme, conflicts, CASE WHEN conflicts = 0 THEN 'exact' WHEN conflicts <= 5 THEN 'near' ELSE 'custom' END AS grade FROM c QUALIFY row_number() OVER (PARTITION BY id ORDER BY conflicts, scheme) = 1""")
def nearest_shape(spark, sf_dir):
    """The scheme with the fewest conflicts."""
    shapes = spark.createDataFrame([("eng", "AFRICA", 1, 3), ("eng", "ASIA", 1, 4), ("org", "AFRICA", 1, 5), ("org", "ASIA", 1, 4)], "scheme string, book string, chapter int, last bigint")
    each = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.explode(F.array(F.lit("AFRICA"), F.lit("ASIA"))).alias("book"), F.lit(1).alias("chapter"), (3 + F.col("s_suppkey") % 3).alias("last"))
    return refs.nearest_shape(each, shapes, ["eng", "org"])
