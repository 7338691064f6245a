"""Queries of roll-ups and filters of filesets over the proxy tables: documents as filesets, labels as their flags."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import filesets, usj, verses
from lectern.plans.catalog import query
from lectern.session import table
from lectern.sinks import documents
from lectern.sources import usfm_files

#: The proxy testaments: order lines 1 to 3 and 4 to 7.
NEW, OLD = ["1", "2", "3"], ["4", "5", "6", "7"]


def _filesets(spark, sf_dir):
    """Documents as filesets: iso, id, kind, canon, timed, ord."""
    k = F.col("doc_id")
    canon = F.when(k % 7 == 0, "PARTIAL").when(k % 5 == 0, "FULL").when(k % 2 == 0, "NT").otherwise("OT")
    return table(spark, sf_dir, "documents").select(F.col("lang").alias("iso"), F.concat("source", F.when(k % 11 == 0, "SA").otherwise("")).alias("id"), F.when(k % 3 == 0, "audio").otherwise("text").alias("kind"), canon.alias("canon"), (k % 4 == 0).alias("timed"), k.alias("ord"))


_FILESETS = """fs AS (SELECT lang AS iso, source || CASE WHEN doc_id % 11 = 0 THEN 'SA' ELSE '' END AS id, CASE WHEN doc_id % 3 = 0 THEN 'audio' ELSE 'text' END AS kind,
  CASE WHEN doc_id % 7 = 0 THEN 'PARTIAL' WHEN doc_id % 5 = 0 THEN 'FULL' WHEN doc_id % 2 = 0 THEN 'NT' ELSE 'OT' END AS canon, doc_id % 4 = 0 AS timed, doc_id AS ord FROM documents)"""


@query("without_excluded", f"""WITH {_FILESETS}, x AS (SELECT DISTINCT iso, id, ['align', 'all', NULL, 'other'][ord % 4 + 1] AS scope FROM fs WHERE ord % 13 = 0)
SELECT iso, id, ord FROM fs WHERE (iso, id) NOT IN (SELECT (iso, id) FROM x WHERE coalesce(scope, 'align') IN ('align', 'all'))""")
def without_excluded(spark, sf_dir):
    """filesets that are not excluded from alignment."""
    rows, k = _filesets(spark, sf_dir), F.col("ord") % 4
    scope = F.when(k == 0, "align").when(k == 1, "all").when(k == 3, "other")
    return filesets.without_excluded(rows, rows.where("ord % 13 = 0").select("iso", "id", scope.alias("scope")), ["iso", "id"]).select("iso", "id", "ord")


@query("exclusion_reasons", f"""WITH {_FILESETS} SELECT ord, unnest(list_filter([CASE WHEN id LIKE '%SA' THEN 'sa_versions' END, CASE WHEN canon = 'PARTIAL' THEN 'partial_content' END, CASE WHEN kind = 'audio' AND timed THEN 'story_adaptations' END], lambda x: x IS NOT NULL)) AS reason FROM fs""")
def exclusion_reasons(spark, sf_dir):
    """every reason why a fileset is left out."""
    typed = _filesets(spark, sf_dir).withColumn("type", F.when((F.col("kind") == "audio") & F.col("timed"), "Video_stream").otherwise(F.col("kind")))
    return filesets.exclusion_reasons(typed).select("ord", "reason")


@query("held_back_files", """SELECT p_partkey AS id, '_app/' || p_brand || '/' || p_name AS path FROM part WHERE p_name <> 'red ring' AND '_app/' || p_brand || '/' || p_name NOT IN ('_app/Brand#1/blue bolt')""")
def held_back_files(spark, sf_dir):
    """files that may be published."""
    files = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.concat(F.lit("_app/"), "p_brand", F.lit("/"), "p_name").alias("path"))
    return filesets.without_held_back(files, "path", ["_app/Brand#1/blue bolt"], ["red ring"])


@query("compared_groups", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus IN ('F', 'O')")
def compared_groups(spark, sf_dir):
    """groups with more than one source."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", F.when(F.col("o_orderstatus") == "F", "compared").when(F.col("o_orderstatus") == "O", "no_text").otherwise("single_source").alias("status"))
    return filesets.compared_groups(o).drop("status")


@query("summed_counts", "SELECT nation, CAST(sum(n) AS BIGINT) AS n FROM (SELECT c_nationkey AS nation, count(*) AS n FROM customer GROUP BY 1 UNION ALL SELECT s_nationkey, count(*) FROM supplier GROUP BY 1) GROUP BY 1")
def summed_counts(spark, sf_dir):
    """A2: the sum of two tables of counts."""
    count = lambda t, c: table(spark, sf_dir, t).groupBy(F.col(c).alias("nation")).agg(F.count("*").alias("n"))
    return filesets.summed_counts([count("customer", "c_nationkey"), count("supplier", "s_nationkey")], ["nation"])


@query("collection_canons", """WITH b AS (SELECT l_orderkey AS id, list_sort(list_distinct(list(CAST(l_linenumber AS VARCHAR)) FILTER (l_linenumber > 3))) AS o FROM lineitem GROUP BY 1),
c AS (SELECT id, o, id % 3 = 0 AS none, [27, 66, 5, 0, NULL][id % 5 + 1] AS books, CASE id % 4 WHEN 0 THEN 'full' WHEN 1 THEN 'partial' END AS n FROM b)
SELECT id, CASE WHEN none THEN CASE WHEN books = 27 THEN 'nt' WHEN books >= 66 THEN 'nt,ot' WHEN books > 0 THEN 'ntp' ELSE '' END
  ELSE array_to_string(list_filter([CASE n WHEN 'full' THEN 'nt' WHEN 'partial' THEN 'ntp' END, CASE WHEN len(o) = 4 THEN 'ot' WHEN len(o) > 0 THEN 'otp' END], lambda x: x IS NOT NULL), ',') END AS canons FROM c""")
def collection_canons(spark, sf_dir):
    """A4: canons of a collection, by its coverage or its number of books."""
    own = F.collect_set(F.when(F.col("l_linenumber") > 3, F.col("l_linenumber").cast("string")))
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.when(F.size(own) > 0, own).alias("o"))
    k = F.col("id")
    coverage = F.when(k % 3 != 0, F.struct(F.when(k % 4 == 0, "full").when(k % 4 == 1, "partial").alias("n"), F.col("o")))
    books = F.when(k % 5 == 0, 27).when(k % 5 == 1, 66).when(k % 5 == 2, 5).when(k % 5 == 3, 0)
    return b.select("id", coverage.alias("c"), books.alias("n")).select("id", F.array_join(filesets.collection_canons(F.col("n"), F.col("c"), OLD), ",").alias("canons"))


@query("completeness", """WITH b AS (SELECT l_orderkey AS id, list_distinct(list(l_linenumber)) AS b FROM lineitem GROUP BY 1)
SELECT id, CASE WHEN id % 4 = 0 THEN true ELSE len(list_intersect(b, [1, 2, 3])) = 3 END AS has_full_nt, CASE WHEN id % 4 = 0 THEN false ELSE len(list_intersect(b, [4, 5, 6, 7])) = 4 END AS has_full_ot,
 CASE WHEN id % 4 = 0 THEN false ELSE len(b) = 7 END AS has_full_bible, CASE WHEN id % 4 = 0 THEN true ELSE len(list_intersect(b, [1, 2, 3])) > 0 END AS has_any_nt, CASE WHEN id % 4 = 0 THEN false ELSE len(list_intersect(b, [4, 5, 6, 7])) > 0 END AS has_any_ot
FROM b WHERE id % 4 <> 0 OR id % 8 = 0""")
def completeness(spark, sf_dir):
    """A5: completeness by testament; where books could not be read, what was known before."""
    k = F.col("id")
    b = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id")).agg(F.collect_set(F.col("l_linenumber").cast("string")).alias("b"))
    old = b.where("id % 8 = 0").select("id", *[F.lit(v).alias(n) for n, v in (("has_full_nt", True), ("has_full_ot", False), ("has_full_bible", False), ("has_any_nt", True), ("has_any_ot", False))])
    return filesets.completeness(b.select("id", F.when(k % 4 != 0, F.col("b")).alias("books")), old, NEW, OLD)


@query("folded_flags", f"""WITH {_FILESETS} SELECT iso, canon, bool_or(kind = 'text') AS has_text, bool_or(timed) AS has_audio, coalesce(string_agg(DISTINCT id, ',' ORDER BY id) FILTER (kind = 'audio'), '') AS audio_ids FROM fs GROUP BY 1, 2""")
def folded_flags(spark, sf_dir):
    """Flags and audio ids of a canon."""
    rows = _filesets(spark, sf_dir).select("iso", "canon", "id", F.when(F.col("kind") == "text", True).alias("has_text"), F.col("timed").alias("has_audio"), (F.col("kind") == "audio").alias("is_audio"))
    return filesets.folded_flags(rows, ["iso", "canon"]).withColumn("audio_ids", F.array_join("audio_ids", ","))


@query("edition_category", f"""WITH {_FILESETS}, f AS (SELECT iso, id, canon, bool_or(kind = 'text') AS t, bool_or(kind = 'audio') AS a, bool_or(kind = 'audio' AND timed) AS w FROM fs GROUP BY ALL)
SELECT iso, id, canon, CASE WHEN canon = 'PARTIAL' THEN 'partial' WHEN t AND a AND w THEN 'with-timecode' WHEN a AND w THEN 'audio-with-timecode' WHEN t AND a THEN 'syncable' WHEN t THEN 'text-only' ELSE 'audio-only' END AS category FROM f""")
def edition_category(spark, sf_dir):
    """The category of an edition's canon, partial before all."""
    return filesets.edition_category(_filesets(spark, sf_dir), ["iso", "id"])


_TESTAMENTS = [(b, "nt") for b in NEW] + [(b, "ot") for b in OLD]


@query("audio_books", """WITH m AS (SELECT o_orderkey AS k, o_orderpriority AS iso, CASE WHEN o_orderkey % 3 = 0 THEN 'text' ELSE 'audio_drama' END AS type, CASE WHEN o_orderkey % 5 = 0 THEN 'STORY' WHEN o_orderkey % 7 > 0 THEN 'PARTIAL' END AS canon FROM orders)
SELECT CASE WHEN l_linenumber <= 3 THEN 'nt' ELSE 'ot' END AS canon, iso, string_agg(DISTINCT CAST(l_linenumber AS VARCHAR), ',' ORDER BY CAST(l_linenumber AS VARCHAR)) AS books FROM m JOIN lineitem ON l_orderkey = k WHERE type LIKE 'audio%' AND coalesce(canon, '') <> 'STORY' GROUP BY ALL""")
def audio_books(spark, sf_dir):
    """Books with audio, each under its own testament."""
    k = F.col("o_orderkey")
    books = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_set(F.col("l_linenumber").cast("string")).alias("books"))
    m = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_orderpriority").alias("iso"), F.when(k % 3 == 0, "text").otherwise("audio_drama").alias("type"), F.when(k % 5 == 0, "STORY").when(k % 7 > 0, "PARTIAL").alias("canon"))
    out = filesets.audio_books(m.join(books, "o_orderkey"), spark.createDataFrame(_TESTAMENTS, "book string, testament string"))
    return out.withColumn("books", F.array_join("books", ","))


@query("resolved_timing", """WITH a AS (SELECT CAST(c_nationkey AS VARCHAR) AS iso, c_mktsegment AS fileset, CAST(c_custkey % 9 AS VARCHAR) AS book FROM customer), b AS (SELECT '7', 'BUILDING', CAST(s_suppkey % 4 AS VARCHAR) FROM supplier),
d AS (SELECT '*', p_brand, CAST(unnest(CASE p_size % 2 WHEN 0 THEN [1, 2, 3] ELSE [4, 5, 6, 7] END) AS VARCHAR) FROM part WHERE p_size % 3 = 0)
SELECT * FROM a UNION SELECT * FROM b UNION SELECT * FROM d""")
def resolved_timing(spark, sf_dir):
    """Timing of several sources by book."""
    a = table(spark, sf_dir, "customer").select(F.col("c_nationkey").cast("string").alias("iso"), F.col("c_mktsegment").alias("fileset"), (F.col("c_custkey") % 9).cast("string").alias("book"))
    b = table(spark, sf_dir, "supplier").select(F.lit("7").alias("iso"), F.lit("BUILDING").alias("fileset"), (F.col("s_suppkey") % 4).cast("string").alias("book"))
    d = table(spark, sf_dir, "part").select(F.col("p_brand").alias("fileset"), F.when(F.col("p_size") % 2 == 0, "nt").otherwise("ot").alias("canon"), (F.col("p_size") % 3 == 0).alias("whole"))
    return filesets.resolved_timing([a, b], d, spark.createDataFrame(_TESTAMENTS, "book string, testament string"))


@query("merged_coverage", """WITH l AS (SELECT l_partkey AS id, l_linenumber AS book, arg_max(CAST(l_quantity AS INTEGER), (l_orderkey, l_quantity)) AS value FROM lineitem GROUP BY ALL)
SELECT id, string_agg(book || '=' || value, ',' ORDER BY book) AS books FROM l GROUP BY 1""")
def merged_coverage(spark, sf_dir):
    """Coverage of one fileset in several directories, merged by book."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("id"), F.col("l_linenumber").alias("book"), F.col("l_quantity").cast("int").alias("value"), F.struct("l_orderkey", "l_quantity").alias("at"))
    out = filesets.merged_coverage(rows, ["id"], "at")
    return out.select("id", F.array_join(F.transform("books", lambda x: F.concat(x["book"].cast("string"), F.lit("="), x["value"].cast("string"))), ",").alias("books"))


@query("tallies", "SELECT o_orderstatus AS status, count(*) AS n, coalesce(CAST(sum(CASE WHEN o_orderkey % 2 = 0 THEN o_custkey END) AS BIGINT), 0) AS total FROM orders GROUP BY 1")
def tallies(spark, sf_dir):
    """Tallies for a report."""
    o = table(spark, sf_dir, "orders").select(F.col("o_orderstatus").alias("status"), F.when(F.col("o_orderkey") % 2 == 0, F.col("o_custkey")).alias("size"))
    return filesets.tallies(o, "status", "size")


@query("processed_once", f"""WITH {_FILESETS} SELECT iso, id, canon, ord FROM fs QUALIFY row_number() OVER (PARTITION BY iso, id, CASE WHEN canon = 'FULL' THEN canon ELSE '' END ORDER BY ord) = 1""")
def processed_once(spark, sf_dir):
    """Every fileset once, and once more as a full one."""
    return filesets.once(_filesets(spark, sf_dir), ["iso", "id"]).select("iso", "id", "canon", "ord")


@query("run_summary", f"""WITH {_FILESETS}, p AS (SELECT DISTINCT iso, id FROM fs WHERE kind = 'text' INTERSECT SELECT DISTINCT iso, id FROM fs WHERE kind = 'audio')
SELECT count(DISTINCT iso) AS languages, count(*) AS filesets, count(*) FILTER (kind = 'audio') AS audio, count(*) FILTER (kind = 'text') AS text, count(*) FILTER (kind = 'audio' AND timed) AS timed, (SELECT count(*) FROM p) AS pairs FROM fs""")
def run_summary(spark, sf_dir):
    """The counters of a run."""
    fs = _filesets(spark, sf_dir)
    pairs = fs.where("kind = 'text'").select("iso", "id").intersect(fs.where("kind = 'audio'").select("iso", "id"))
    return filesets.summary(fs, pairs)


@query("first_testament", f"""WITH {_FILESETS} SELECT iso, id, arg_min(canon, CASE canon WHEN 'NT' THEN 1 WHEN 'OT' THEN 2 WHEN 'FULL' THEN 3 ELSE 4 END) AS canon FROM fs GROUP BY 1, 2""")
def first_testament(spark, sf_dir):
    """One entry of a version, the first testament's."""
    return filesets.first_testament(_filesets(spark, sf_dir), ["iso", "id"], "canon", ["NT", "OT", "FULL"]).select("iso", "id", "canon")


@query("versification_field", "SELECT c_custkey, CAST(s_nationkey AS VARCHAR) AS scheme FROM customer LEFT JOIN supplier ON s_suppkey = c_custkey")
def versification_field(spark, sf_dir):
    """A field by key, or none."""
    index = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").cast("string").alias("scheme"))
    return filesets.with_field(table(spark, sf_dir, "customer").select("c_custkey"), index, ["c_custkey"])


@query("known_filesets", "SELECT c_custkey, c_nationkey FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 0)")
def known_filesets(spark, sf_dir):
    """Rows whose key is resolved."""
    index = table(spark, sf_dir, "supplier").where("s_acctbal > 0").select(F.col("s_nationkey").alias("c_nationkey"))
    return filesets.known_only(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), index, ["c_nationkey"])


@query("tried_status", "SELECT c_custkey AS id, CASE WHEN c_custkey % 2 = 0 THEN 'present' ELSE 'absent' END AS status FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0")
def tried_status(spark, sf_dir):
    """Present, known to be absent, or never tried."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"))
    return filesets.tried_status(c.where("id % 2 = 0"), c.where("id % 3 = 0"), ["id"])


@query("chosen_sample", "SELECT p_brand, p_name, p_partkey FROM part QUALIFY row_number() OVER (PARTITION BY p_brand ORDER BY p_size = 7 DESC, p_name, p_partkey) = 1")
def chosen_sample(spark, sf_dir):
    """The own sample, else the first by name."""
    p = table(spark, sf_dir, "part").select("p_brand", "p_name", "p_partkey", F.when(F.col("p_size") == 7, True).alias("own"), F.struct("p_name", "p_partkey").alias("name"))
    return filesets.chosen_sample(p, ["p_brand"], "own", "name").select("p_brand", "p_name", "p_partkey")


@query("first_files", "SELECT lang, source, doc_id FROM documents QUALIFY row_number() OVER (PARTITION BY lang, source ORDER BY doc_id) <= 3")
def first_files(spark, sf_dir):
    """T4: the first three files of an edition."""
    return filesets.first_files(table(spark, sf_dir, "documents").select("lang", "source", "doc_id"), ["lang", "source"], "doc_id")


@query("preferred_first", """WITH s AS (SELECT lang, list(DISTINCT source) AS s FROM documents GROUP BY 1) SELECT lang, array_to_string(list_concat(list_sort(list_filter(s, lambda x: x IN ('src9', 'src11'))), list_sort(list_filter(s, lambda x: x NOT IN ('src9', 'src11')))), ',') AS ids FROM s""")
def preferred_first(spark, sf_dir):
    """Preferred ids before the others."""
    s = table(spark, sf_dir, "documents").groupBy("lang").agg(F.collect_set("source").alias("s"))
    return s.select("lang", F.array_join(filesets.preferred_first(F.col("s"), F.array(F.lit("src9"), F.lit("src11"))), ",").alias("ids"))


@query("outdated", "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderkey % 3 = 2)")
def outdated(spark, sf_dir):
    """I4: what the present version has not computed."""
    done = table(spark, sf_dir, "orders").select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderkey") % 3).alias("input_version"))
    return filesets.outdated(table(spark, sf_dir, "customer").select("c_custkey"), done, ["c_custkey"], 2)


@query("meta_documents", """WITH b AS (SELECT lang, source, list_sort(list(DISTINCT doc_id % 5)) AS b FROM documents GROUP BY ALL) SELECT lang, source, '{"iso":"' || lang || '","books":[' || array_to_string(b, ',') || '],"formats":{"usj":"json"}}' AS meta FROM b""")
def meta_documents(spark, sf_dir):
    """K6: what an edition's own file tells."""
    b = table(spark, sf_dir, "documents").groupBy("lang", "source").agg(F.array_sort(F.collect_set(F.col("doc_id") % 5)).alias("b"))
    return b.select("lang", "source", documents.meta_document({"iso": F.col("lang")}, F.col("b"), F.struct(F.lit("json").alias("usj"))).alias("meta"))


@query("placed_keys", """WITH k AS (SELECT p_partkey AS n, ['helloao:', 'ebible:', 'pkf:', 'odd:'][p_size % 4 + 1] || p_partkey % 40 || '_x' AS key FROM part), i AS (SELECT ['h:', 'e:'][s_suppkey % 2 + 1] || s_suppkey || '_x' AS id, 'i' || s_nationkey AS iso FROM supplier)
SELECT n, key, CASE WHEN key LIKE 'pkf:%' THEN string_split(substr(key, 5), '_')[1] ELSE i.iso END AS iso FROM k LEFT JOIN i ON i.id = CASE WHEN key LIKE 'helloao:%' THEN 'h:' || substr(key, 9) WHEN key LIKE 'ebible:%' THEN 'e:' || substr(key, 8) ELSE '?' END""")
def placed_keys(spark, sf_dir):
    """K3: the language of an index key, through several id spaces."""
    source = F.get(F.array(*map(F.lit, ("helloao:", "ebible:", "pkf:", "odd:"))), F.col("p_size") % 4)
    keys = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("n"), F.concat(source, (F.col("p_partkey") % 40).cast("string"), F.lit("_x")).alias("key"))
    letter = F.when(F.col("s_suppkey") % 2 == 0, "h:").otherwise("e:")
    languages = table(spark, sf_dir, "supplier").select(F.concat(letter, F.col("s_suppkey").cast("string"), F.lit("_x")).alias("id"), F.concat(F.lit("i"), F.col("s_nationkey").cast("string")).alias("iso"))
    return documents.placed(keys, languages)


@query("verified_files", "SELECT doc_id AS path, CASE WHEN doc_id % 5 = 0 THEN 'missing' WHEN doc_id % 3 = 0 THEN 'differs' ELSE 'same' END AS state FROM documents WHERE text IS NOT NULL")
def verified_files(spark, sf_dir):
    """Local files against what is published."""
    local = table(spark, sf_dir, "documents").where("text IS NOT NULL").select(F.col("doc_id").alias("path"), F.sha2("text", 256).alias("sha256"))
    other = F.when(F.col("path") % 3 == 0, F.lit("0")).otherwise(F.col("sha256"))
    return documents.verified(local.where("path % 5 != 0").withColumn("sha256", other), local)


@query("usfm_headers", """SELECT conv_id, turn, 'T' || turn AS h, 'long ' || turn AS toc1, CASE WHEN turn % 2 = 0 THEN 'two' END AS toc2 FROM conversations""")
def usfm_headers(spark, sf_dir):
    """Markers before the first chapter, the first of each."""
    t = F.col("turn").cast("string")
    raw = F.concat(F.lit("\\id GEN x\n\\h  T"), t, F.lit(" \n\\toc1 long "), t, F.lit("\n\\h again\n\\ide\n"), F.when(F.col("turn") % 2 == 0, "\\toc2 two\n").otherwise(""), F.lit("\\c 1\n\\toc2 late\n\\toc3 later"))
    m = usfm_files.headers(raw)
    return table(spark, sf_dir, "conversations").select("conv_id", "turn", *[m[k].alias(k) for k in ("h", "toc1", "toc2")])


_VERSES_SQL = """SELECT conv_id, '1' AS chapter, CAST(turn + 1 AS VARCHAR) AS verse, trim(regexp_replace(text, '[\\t\\n\\v\\f\\r ]+', ' ', 'g')) AS text FROM conversations WHERE regexp_matches(text, '[^\\s]')"""


@query("usfm_to_usj", _VERSES_SQL)
def usfm_to_usj(spark, sf_dir):
    """Verses of books in USFM by way of USJ; notes, headings and attributes are no text."""
    turn = (F.col("turn") + 1).cast("string")
    plain = F.regexp_replace("text", r"\\", "/")
    verse = F.concat(F.when(F.col("turn") % 3 == 0, "\\s1 A head\n\\q1\n").otherwise(""), F.lit("\\v "), turn, F.lit(" \\nd "), plain, F.lit("\\nd*\\f + \\fr 1.1 \\ft note | x\\f*"))
    return _through_usj(spark, sf_dir, verse, F.concat(F.lit("\\id GEN test\n\\h T\n\\c 1\n\\p\n"), F.array_join(F.transform("vs", lambda x: x["t"]), "\n")), False)


@query("usx_to_usj", _VERSES_SQL)
def usx_to_usj(spark, sf_dir):
    """Verses of books in USX by way of USJ."""
    turn = (F.col("turn") + 1).cast("string")
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", "&", "&amp;"), "<", "&lt;"), "[\x00-\x08]", "")
    verse = F.concat(F.lit('<para style="s1">A head</para><para style="q1"><verse number="'), turn, F.lit('" style="v" sid="a"/>'), plain, F.lit('<note style="f" caller="+"><char style="ft">note</char></note><verse eid="a"/></para>\n'))
    return _through_usj(spark, sf_dir, verse, F.concat(F.lit('<usx version="3.0"><book code="GEN" style="id">x</book><chapter number="1" style="c" sid="c"/>\n'), F.array_join(F.transform("vs", lambda x: x["t"]), ""), F.lit('<chapter eid="c"/></usx>')), True)


def _through_usj(spark, sf_dir, verse, book, usx):
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    books = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", verse.alias("t")))).alias("vs")).select("conv_id", usj.usj_col(book, usx).alias("u"))
    return verses.verse_table(books.select("conv_id", "u.usj"), ["conv_id"], "usj", "usj").select("conv_id", "chapter", "verse", "text")


@query("rough_letters", "SELECT conv_id, turn, CAST(length(regexp_replace(text, '[^\\p{L}]', '', 'g')) AS INTEGER) AS letters FROM conversations WHERE text IS NOT NULL")
def rough_letters(spark, sf_dir):
    """Letters of a book's rough text."""
    raw = F.concat(F.lit("\\id GEN x\n\\h Title\n\\toc1 Long\n\\mt1 Main\n\\c 1\n\\s1 Head\n\\p\n\\v 1 \\w "), F.regexp_replace(F.regexp_replace("text", r"\\", "/"), r"\|", "/"), F.lit('|lemma="x"\\w*\\f + \\ft note\\f*\n\\ms2 More\n\\b'))
    rows = table(spark, sf_dir, "conversations").where("text IS NOT NULL").select("conv_id", "turn", usj.rough_text_col(raw).alias("t"))
    return rows.select("conv_id", "turn", F.length(F.regexp_replace("t", r"[^\p{L}]", "")).alias("letters"))


@query("last_verse", """SELECT l_orderkey AS id, CAST(coalesce(max(CASE WHEN l_orderkey % 5 > 0 THEN l_linenumber + CAST(l_quantity AS INTEGER) % 3 END), CASE WHEN l_orderkey % 2 = 0 THEN count(*) END, -1) AS BIGINT) AS last FROM lineitem GROUP BY l_orderkey""")
def last_verse(spark, sf_dir):
    """The last verse of a chapter by its numbers, else as it is told."""
    k = F.col("l_orderkey")
    numbers = F.collect_list(F.when(k % 5 > 0, F.col("l_linenumber") + F.col("l_quantity").cast("int") % 3).cast("bigint"))
    c = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(numbers.alias("numbers"), F.count("*").alias("n"))
    return c.select(k.alias("id"), F.coalesce(filesets.last_verse(F.col("numbers"), F.when(k % 2 == 0, F.col("n"))), F.lit(-1).cast("bigint")).alias("last"))


@query("to_recheck", "SELECT p_partkey || '' AS iso, p_name AS file FROM part WHERE p_size % 4 <> 0 AND p_size < 40 AND p_size % 3 <> 1")
def to_recheck(spark, sf_dir):
    """Comparisons that are done again by words."""
    s = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("string").alias("iso"), F.when(s % 4 != 0, s / 40).alias("score"), F.when(s % 3 != 1, F.col("p_name")).alias("file"))
    return filesets.to_recheck(rows)


@query("staged_files", """WITH b AS (SELECT o_orderkey AS e, o_orderkey % 3 <> 0 AS w FROM orders), c AS (SELECT l_orderkey AS e, l_linenumber AS n FROM lineitem WHERE l_linenumber > 4 GROUP BY ALL),
k AS (SELECT e, w FROM b WHERE NOT w OR e IN (SELECT e FROM c))
SELECT e || '/GEN.json' AS source, e || '/GEN.usj.json' AS target FROM k UNION ALL SELECT e || '/GEN/' || n || '.json', e || '/GEN/' || n || '.sofria.json' FROM c JOIN k USING (e) WHERE w""")
def staged_files(spark, sf_dir):
    """K7: files under their published names."""
    books = table(spark, sf_dir, "orders").select(F.col("o_orderkey").cast("string").alias("edition"), F.lit("GEN").alias("book"), (F.col("o_orderkey") % 3 != 0).alias("with_chapters"))
    chapters = table(spark, sf_dir, "lineitem").where("l_linenumber > 4").select(F.col("l_orderkey").cast("string").alias("edition"), F.lit("GEN").alias("book"), F.col("l_linenumber").alias("chapter")).distinct()
    return filesets.staged(books, chapters)
