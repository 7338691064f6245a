"""Queries of verse maps and marked-up source text over the proxy tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import archive, candidates, chapters, graphs, maps, osis, records, usfm, verses
from lectern.plans.catalog import query
from lectern.session import table


@query("components_map", """SELECT node, component FROM (SELECT s_suppkey AS node, min(s_suppkey) OVER w AS component, count(*) OVER w AS n FROM supplier WINDOW w AS (PARTITION BY s_nationkey)) WHERE n > 1""")
def components_map(spark, sf_dir):
    """Components of chains through the suppliers of a nation."""
    s = table(spark, sf_dir, "supplier").select("s_nationkey", "s_suppkey")
    chain = s.join(s.groupBy("s_nationkey").agg(F.min("s_suppkey").alias("b")), "s_nationkey").where("s_suppkey != b")
    return graphs.components(chain.select(F.col("s_suppkey").alias("a"), "b"))


def _verses(spark, sf_dir):
    chapters = table(spark, sf_dir, "part").select((F.col("p_partkey") % 60 + 1).cast("int").alias("c")).distinct()
    return chapters.select("c", F.explode(F.sequence(F.lit(1), F.lit(40))).alias("n"))


@query(
    "compose_maps",
    """WITH c AS (SELECT DISTINCT p_partkey % 60 + 1 AS c FROM part), v AS (SELECT c, unnest(range(1, 41)) AS n FROM c)
SELECT 'multi' AS kind, 'PRT ' || c || ':' || n AS s, 'PRT ' || c || ':' || (2 * n - 1) || '-' || (2 * n) AS t FROM v WHERE c % 3 = 0 AND n <= 20
UNION ALL SELECT 'single', 'PRT ' || c || ':' || n, 'PRT ' || c || ':' || (n + 1) FROM v WHERE c % 3 = 1 AND n < 40
UNION ALL SELECT 'no_base', 'PRT ' || c || ':40', NULL FROM c WHERE c % 3 = 1
UNION ALL SELECT 'flagged', 'PRT ' || c || ':' || (3 * n - 2) || '-' || (3 * n), 'PRT ' || c || ':' || (2 * n - 1) || '-' || (2 * n) FROM v WHERE c % 6 = 2 AND n <= 13
UNION ALL SELECT 'no_base', 'PRT ' || c || ':40', NULL FROM c WHERE c % 6 = 2""",
)
def compose_maps(spark, sf_dir):
    """One numbering to another through a third."""
    v, c, n = _verses(spark, sf_dir), F.col("c"), F.col("n")
    ref = F.concat(F.lit("PRT "), c.cast("string"), F.lit(":"), n.cast("string")).alias("v")
    to = lambda k: F.concat_ws(":", c, k).alias("e")
    three, two = F.floor((n + 2) / 3), F.floor((n + 1) / 2)
    x = v.where("c % 3 != 0 OR n <= 20").select(ref, to(F.when(c % 3 == 0, n).when(c % 3 == 1, n + 1).when(c % 6 == 2, three).otherwise(two)))
    o = v.where("c % 6 != 2 OR n <= 26").select(ref, to(F.when(c % 3 == 1, n).otherwise(two)))
    shape = v.groupBy(F.lit("PRT").alias("book"), c.alias("chapter")).agg(F.max("n").alias("last"))
    return maps.compose(x, o, shape, shape)


def _shape(spark, sf_dir, low, high):
    o = table(spark, sf_dir, "orders").where(F.col("o_orderkey") % 3 >= low).where(F.col("o_orderkey") % 3 <= high)
    return o.groupBy(F.substring("o_orderpriority", 3, 3).alias("book"), F.month("o_orderdate").alias("chapter")).agg((F.count("*") % 50 + 1).cast("int").alias("last"))


@query(
    "map_exceptions",
    """WITH sh AS (SELECT w, substring(o_orderpriority, 3, 3) AS book, month(o_orderdate) AS chapter, count(*) % 50 + 1 AS last FROM orders, (VALUES ('s', 0, 1), ('t', 1, 2)) x(w, lo, hi) WHERE o_orderkey % 3 BETWEEN lo AND hi GROUP BY ALL),
m AS (SELECT DISTINCT substring(o_orderpriority, 3, 3) AS book, month(o_orderdate) AS c, day(o_orderdate) AS v, o_custkey % 55 + 1 AS u FROM orders),
j AS (SELECT m.*, coalesce(v <= a.last, false) AS a, coalesce(u <= b.last, false) AS b FROM m LEFT JOIN sh a ON a.w = 's' AND a.book = m.book AND a.chapter = c LEFT JOIN sh b ON b.w = 't' AND b.book = m.book AND b.chapter = c)
SELECT book || ' ' || c || ':' || v AS s, book || ' ' || c || ':' || u AS t, CASE WHEN a THEN 'target' ELSE 'source' END AS side, CASE WHEN a THEN 'recension' WHEN book = 'URG' THEN 'reorder' ELSE 'boundary-extend' END AS kind FROM j WHERE NOT (a AND b)""",
)
def map_exceptions(spark, sf_dir):
    """Map rows outside the shapes."""
    book, c = F.substring("o_orderpriority", 3, 3), F.month("o_orderdate").cast("string")
    ref = lambda v: F.concat(book, F.lit(" "), c, F.lit(":"), v.cast("string"))
    rows = table(spark, sf_dir, "orders").select(ref(F.dayofmonth("o_orderdate")).alias("s"), ref(F.col("o_custkey") % 55 + 1).alias("t")).distinct()
    return maps.map_exceptions(rows, _shape(spark, sf_dir, 0, 1), _shape(spark, sf_dir, 1, 2), reordered="URG")


@query(
    "section_pairs",
    """WITH r AS (SELECT string_split(o_orderpriority, '-')[1] AS label, o_custkey % 40 + 1 AS c, o_orderkey % 30 + 1 AS v, o_orderstatus AS st FROM orders), p AS (SELECT *, unnest([0, 1]) AS k FROM r WHERE label IN ('1', '3') AND st <> 'P')
SELECT DISTINCT 'ORD ' || c || ':' || (v + k) AS s, 'ORD ' || c || ':' || (v + k + 1) AS t FROM p""",
)
def section_pairs(spark, sf_dir):
    """Pairs of labelled sections."""
    label = F.concat(F.when(F.split("o_orderpriority", "-")[0].isin("1", "3"), "Latin+").otherwise("Greek+Latin2+"), F.lit("x"))
    c, v = F.col("o_custkey") % 40 + 1, F.col("o_orderkey") % 30 + 1
    ref = lambda k: F.concat(F.lit("Ord."), c.cast("string"), F.lit(":"), (v + k).cast("string"), F.lit("-"), (v + k + 1).cast("string"))
    line = F.concat_ws("\t", label, ref(0), ref(1), F.when(F.col("o_orderstatus") == "P", "Keep verse").otherwise("Renumber"))
    return maps.section_pairs(table(spark, sf_dir, "orders").select(line.alias("value")), "Latin", ["ORD"])


@query(
    "layout_rows",
    """WITH v AS (SELECT s_suppkey, n_nationkey AS id, unnest(range(1, s_suppkey % 12 + 2)) AS n FROM supplier JOIN nation ON s_nationkey = n_nationkey),
m AS (SELECT id, 'SUP ' || s_suppkey || ':' || n AS s, CASE WHEN n BETWEEN 2 AND 5 THEN 'SUP ' || (s_suppkey + 1) || ':' || (n + 5) ELSE 'SUP ' || s_suppkey || ':' || n END AS t, n BETWEEN 2 AND 5 AS moved FROM v),
o AS (SELECT m.*, CASE WHEN t LIKE '%:1' OR t LIKE '%:9' THEN 'OLD ' || substring(t, 5) ELSE t END AS o FROM m)
SELECT id, s, t, o FROM o WHERE moved OR o <> s""",
)
def layout_rows(spark, sf_dir):
    """Verses of layouts that vary between editions."""
    s = table(spark, sf_dir, "supplier")
    chapter = F.col("s_suppkey").cast("int").alias("chapter")
    layouts = s.select(F.col("s_nationkey").alias("id"), F.lit("SUP").alias("book"), chapter, (F.col("s_suppkey") % 12 + 1).cast("int").alias("last"))
    ranges = s.select(F.col("s_nationkey").alias("id"), chapter, F.lit(2).alias("v1"), F.lit(5).alias("v2"), (F.col("s_suppkey") + 1).cast("int").alias("to_chapter"), F.lit(7).alias("to_verse"))
    tails = s.select(F.explode(F.array("s_suppkey", F.col("s_suppkey") + 1)).alias("c")).distinct().select("c", F.explode(F.array(F.lit(1), F.lit(9))).alias("v"))
    tail = F.concat(F.col("c").cast("string"), F.lit(":"), F.col("v").cast("string"))
    return maps.layout_rows(layouts, ranges, tails.select(F.concat(F.lit("SUP "), tail).alias("s"), F.concat(F.lit("OLD "), tail).alias("t")))


@query("unaligned_text", "SELECT doc_id, text AS plain FROM documents")
def unaligned_text(spark, sf_dir):
    """Texts whose words were given alignment marks, without them again."""
    marked = F.concat(F.lit("\\zaln-s |x=\"1\"\\*"), F.regexp_replace("text", r"([A-Za-z]+)", r'\\w $1|n="1"\\w*'), F.lit("\\zaln-e\\*\\ts\\*"))
    return table(spark, sf_dir, "documents").select("doc_id", usfm.unaligned(marked).alias("plain"))


@query(
    "source_verses",
    r"""SELECT conv_id, CAST(n AS INTEGER) AS verse, 'turn ' || turn || ' of ' || role AS text FROM (SELECT conv_id, turn, role, unnest(CASE WHEN turn % 3 = 2 THEN [turn * 2 + 1, turn * 2 + 2] ELSE [turn * 2 + 1] END) AS n FROM conversations)""",
)
def source_verses(spark, sf_dir):
    """Verses of a chapter of source text; a bridge stands under each of its numbers."""
    n = F.col("turn") * 2 + 1
    label = F.when(F.col("turn") % 3 == 2, F.concat(n.cast("string"), F.lit("-"), (n + 1).cast("string"))).otherwise(n.cast("string"))
    line = F.concat(F.lit("\n\\v "), label, F.lit(" turn "), F.col("turn").cast("string"), F.lit(" of "), F.col("role"))
    body = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("turn", line.alias("l")))), lambda x: x["l"]), "")
    books = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(body.alias("b"))
    return usfm.chapter_verse_table(books.select("conv_id", F.lit(3).alias("chapter"), F.concat(F.lit("\\c 2\n\\v 1 no\n\\c 3"), "b", F.lit("\n\\c 4\n\\v 9 no")).alias("raw")), ["conv_id"], "raw", "chapter")


@query(
    "converted_osis",
    r"""SELECT conv_id, '\c 1' || chr(10) || '\p' || chr(10) || string_agg('\v ' || (turn + 1) || ' ' || CASE role WHEN 'user' THEN '\add ' || role || '\add*' ELSE role || '\f + \ft n\f*' END, chr(10) ORDER BY turn) || chr(10) AS usfm, NULL::VARCHAR AS error FROM conversations GROUP BY 1""",
)
def converted_osis(spark, sf_dir):
    """C4: OSIS fragments as source text."""
    marked = F.when(F.col("role") == "user", F.concat(F.lit('<transChange type="added">'), F.col("role"), F.lit("</transChange>"))).otherwise(F.concat(F.col("role"), F.lit("<note>n</note>")))
    verses = table(spark, sf_dir, "conversations").select("conv_id", F.lit(1).alias("chapter"), (F.col("turn") + 1).alias("verse"), marked.alias("osis"))
    return osis.converted_osis(verses, ["conv_id"])


@query("chapter_books", "SELECT conv_id, '1' AS chapter, CAST(turn + 1 AS VARCHAR) AS verse, 'turn ' || turn || ' of ' || role AS text FROM conversations")
def chapter_books(spark, sf_dir):
    """Chapters of the API as books, read back verse by verse."""
    item = F.struct(F.lit("verse").alias("type"), (F.col("turn") + 1).alias("number"), F.array(F.concat(F.lit("turn "), F.col("turn").cast("string")), F.concat(F.lit("of "), F.col("role"))).alias("content"))
    content = F.transform(F.sort_array(F.collect_list(F.struct("turn", item.alias("i")))), lambda x: x["i"])
    raw = F.to_json(F.struct(F.struct(F.lit(1).alias("number"), content.alias("content")).alias("chapter")))
    rows = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(raw.alias("raw")).select("conv_id", F.lit("PSA").alias("book"), F.lit(1).alias("chapter"), "raw")
    books = chapters.book_table(rows, ["conv_id"], "book", "chapter", "raw")
    return verses.verse_table(books, ["conv_id"], "usj", "usj").select("conv_id", "chapter", "verse", "text")


@query(
    "audio_items",
    """SELECT event_id, CASE WHEN event_id % 3 = 0 THEN upper(left(event_type, 3)) ELSE 'ABC' END AS book, CAST(CASE WHEN event_id % 3 = 0 THEN user_id % 50 + 1 ELSE event_id % 7 + 1 END AS INTEGER) AS chapter,
  CASE event_id % 4 WHEN 0 THEN 'ENGESVN1DA' WHEN 1 THEN 'DAMDAMDAMX' WHEN 2 THEN 'ABCDEFO2DA' END AS fileset,
  'https://a.b/' || replace(event_type, '_', '%20') || '/' || user_id || '%20(x).mp3' AS url FROM events""",
)
def audio_items(spark, sf_dir):
    """The fileset, book, chapter and address of audio items."""
    e, k = table(spark, sf_dir, "events"), F.col("event_id")
    name = F.when(k % 4 == 0, "B01_N1ENGESV.mp3").when(k % 4 == 1, "x.mp3").when(k % 4 == 2, "B01_ABCDEFO2DA.mp3").otherwise("y.ogg")
    dam = F.when(k % 4 == 1, "DAMDAMDAMX")
    timing = F.concat(F.lit("C-abc-"), (k % 7 + 1).cast("string"), F.lit("-timing.txt"))
    placed = records.book_and_chapter(k % 3 == 0, timing, F.substring("event_type", 1, 3), F.col("user_id") % 50 + 1)
    url = F.concat(F.lit("https://a.b/"), F.replace("event_type", F.lit("_"), F.lit(" ")), F.lit("/"), F.col("user_id").cast("string"), F.lit(" (x).mp3"))
    quoted = F.replace(F.replace(records.audio_url(F.lit(False), url, F.lit(None).cast("string"), name, F.lit("d/")), F.lit("%28"), F.lit("(")), F.lit("%29"), F.lit(")"))
    return e.select("event_id", placed["book"].alias("book"), placed["chapter"].alias("chapter"), records.audio_fileset(name, dam).alias("fileset"), quoted.alias("url"))


@query(
    "story_index",
    """SELECT n_name AS iso, concat(CASE WHEN n_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 3000) THEN 'at' ELSE 't' END, CASE WHEN n_nationkey IN (SELECT c_nationkey FROM customer WHERE c_acctbal > 9900) THEN 'v' ELSE '' END) AS media, CASE WHEN n > 1 THEN n END AS n
FROM (SELECT c_nationkey AS n_nationkey, count(*) FILTER (c_custkey % 100 = 7) AS n FROM customer GROUP BY 1) JOIN nation USING (n_nationkey)""",
)
def story_index(spark, sf_dir):
    """Media letters of languages read through a table of codes."""
    c, s, n = (table(spark, sf_dir, t) for t in ("customer", "supplier", "nation"))
    codes = n.select(F.col("n_nationkey").cast("string").alias("code"), F.col("n_name").alias("to"))
    languages = c.groupBy(F.col("c_nationkey").cast("string").alias("iso")).agg(F.count_if(F.col("c_custkey") % 100 == 7).alias("n"))
    iso = lambda df, k, bal, least: df.where(F.col(bal) > least).select(F.col(k).cast("string").alias("iso"))
    return records.story_index(languages, iso(s, "s_nationkey", "s_acctbal", 3000), iso(c, "c_nationkey", "c_acctbal", 9900), codes)


@query("archive_round_trip", "SELECT conv_id, CAST(turn // 10 + 1 AS INTEGER) AS chapter, CAST(turn % 10 + 1 AS VARCHAR) AS verse, trim(regexp_replace(text, '[\\t\\n\\v\\f\\r ]+', ' ', 'g')) AS text FROM conversations WHERE trim(regexp_replace(text, '[\\t\\n\\v\\f\\r ]+', ' ', 'g')) <> ''")
def archive_round_trip(spark, sf_dir):
    """Texts written as succinct archives and read back."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.lit("eng").alias("lang"), F.lit("X").alias("abbr"), (F.floor(F.col("turn") / 10) + 1).alias("chapter"), F.col("turn").alias("ord"), (F.col("turn") % 10 + 1).cast("string").alias("verse"), "text")
    return archive.archive_verses(archive.archives(c, ["conv_id"], "lang", "abbr"), ["conv_id"]).select("conv_id", "chapter", "verse", "text")


@query(
    "sync_candidates",
    """WITH g AS (SELECT p_brand AS iso, p_type AS abbr, 'P' || p_size AS base, CASE p_partkey % 4 WHEN 0 THEN '1DA' WHEN 1 THEN '2DA' WHEN 2 THEN '1SA' ELSE '2SA' END AS kind, p_partkey % 4 AS tier, bool_or(p_partkey % 11 = 0) AS timed FROM part GROUP BY ALL),
b AS (SELECT *, min(tier) FILTER (NOT timed) OVER w AS best, min(tier) FILTER (timed) OVER w AS done, bool_or(timed) OVER w AS better FROM g WINDOW w AS (PARTITION BY iso, abbr, base))
SELECT iso, canon, abbr, base || kind AS audio, abbr || ' text' AS text, better FROM b, (VALUES ('nt'), ('ot')) c(canon) WHERE NOT timed AND tier = best AND (done IS NULL OR done > best)""",
)
def sync_candidates(spark, sf_dir):
    """Recordings to align next."""
    k = F.col("p_partkey") % 4
    ident = F.concat(F.lit("P"), F.col("p_size").cast("string"), F.when(k == 0, "1DA").when(k == 1, "2DA").when(k == 2, "1SA").otherwise("2SA"))
    row = lambda i, t: [F.col("p_brand").alias("iso"), F.col("p_type").alias("abbr"), F.lit("PARTIAL").alias("canon"), F.lit("C").alias("size"), i.alias("id"), F.lit(t).alias("type")]
    p = table(spark, sf_dir, "part")
    encoded = F.concat(ident, F.lit("-opus16"))
    texts = p.select(*row(F.concat("p_type", F.lit(" text")), "text_plain")).union(p.select(*row(F.concat("p_type", F.lit(" a text")), "text_usx"))).distinct()
    timed = p.where("p_partkey % 11 = 0").select(F.concat_ws(" ", "p_brand").alias("iso"), ident.alias("id"), "p_type")
    audio = p.select(*row(ident, "audio")).union(p.select(*row(encoded, "audio")))
    marked = lambda df: df.withColumn("iso", F.concat_ws("/", "iso", "abbr"))  # noqa: E731  timing is known by language and id
    out = candidates.sync_candidates(marked(audio.union(texts)), timed.select(F.concat_ws("/", "iso", "p_type").alias("iso"), "id"))
    return out.withColumn("iso", F.substring_index("iso", "/", 1))
