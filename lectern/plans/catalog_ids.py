"""Queries of id and field functions, scripts and scheme labels over derived columns of the proxy tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.functions import ids
from lectern.operators import schemes, scripts
from lectern.plans.catalog import query
from lectern.session import table


def _of(values, k):
    """The ``k``-th of literal values."""
    return F.get(F.array(*[F.lit(v) for v in values]), k.cast("int"))


def _sql_of(values, k):
    return f"[{', '.join('NULL' if v is None else chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39) for v in values)}][({k}) + 1]"


SPECS = [["a:N1DA", "t:N_ET"], ["T:XYZ:a", "t:b"], ["t:helloao:abc", "t:b"], ["A:foo", "t:ebible:x"], ["junk", "v:zz"], []]


@query("fileset_specs", f"""WITH s AS (SELECT p_partkey AS id, p_brand AS base, {[list(x) for x in SPECS]}[p_size % 6 + 1] AS specs FROM part),
f AS (SELECT *, list_filter(specs, lambda x: string_split(x, ':')[1] IN ('t', 'T'))[1] AS spec FROM s)
SELECT id, spec, CASE WHEN starts_with(spec, 't:helloao:') OR starts_with(spec, 't:ebible:') THEN NULL WHEN starts_with(spec, 't:') THEN base || substr(spec, 3) ELSE substr(spec, 3) END AS fileset FROM f""")
def fileset_specs(spark, sf_dir):
    """The first text spec of a row and the id that it names."""
    specs = F.get(F.array(*[F.array(*map(F.lit, x)) if x else F.array().cast("array<string>") for x in SPECS]), F.col("p_size") % 6)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("base"), ids.first_spec(specs, ("t", "T")).alias("spec"))
    return rows.select("id", "spec", ids.resolved_id(F.col("base"), F.col("spec")).alias("fileset"))


LETTERS, ENDS, SIZES = ["O", "N", "C", "P", "S", "X", ""], ["", "_ET", "DA", "_ET-json", "DA-usx", "-json"], ["C", "NTOTP", "NT", "NTP", "OT", "OTP", "P", "S", "?", None]
_FILESET = f"substr('ENGABCDEF', 1, 3 + p_size % 4) || {_sql_of(LETTERS, 'p_partkey % 7')} || CASE WHEN p_size % 2 = 0 THEN '1' ELSE '' END || {_sql_of(ENDS, 'p_size % 6')}"


@query("id_parts", f"""WITH r AS (SELECT p_partkey AS id, {_FILESET} AS fileset, {_sql_of(SIZES, 'p_partkey % 10')} AS size, ['eng', 'deu'][p_size % 2 + 1] AS iso FROM part),
n AS (SELECT *, CASE substr(fileset, 7, 1) WHEN 'O' THEN 'OT' WHEN 'N' THEN 'NT' WHEN 'C' THEN 'FULL' WHEN 'P' THEN 'PARTIAL' WHEN 'S' THEN 'STORY' END AS told, CASE WHEN upper(left(fileset, 3)) = upper(iso) THEN substr(fileset, 4) ELSE fileset END AS version FROM r)
SELECT id, left(fileset, 6) AS abbr, regexp_replace(fileset, '(?:[NOP]\\d?(?:_ET|DA))?(?:-json|-usx)?$', '') AS stem, version, iso || '-' || lower(version) AS ebible, iso || '_' || lower(version) AS helloao, upper(iso) || upper(version) AS dbt,
  CASE WHEN told = 'PARTIAL' THEN told WHEN size IN ('C', 'NTOTP') THEN 'FULL' WHEN size IN ('NT', 'NTP') AND (told IS NULL OR told NOT IN ('OT', 'FULL')) THEN 'NT' WHEN size IN ('OT', 'OTP') AND (told IS NULL OR told NOT IN ('NT', 'FULL')) THEN 'OT' ELSE coalesce(told, 'VARIOUS') END AS books FROM n""")
def id_parts(spark, sf_dir):
    """What an id tells: abbreviation, stem, version, standard ids and books."""
    size = F.col("p_size")
    fileset = F.concat(F.substring(F.lit("ENGABCDEF"), F.lit(1), 3 + size % 4), _of(LETTERS, F.col("p_partkey") % 7), F.when(size % 2 == 0, "1").otherwise(""), _of(ENDS, size % 6))
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), fileset.alias("fileset"), _of(SIZES, F.col("p_partkey") % 10).alias("size"), _of(["eng", "deu"], size % 2).alias("iso"))
    rows = rows.withColumn("version", ids.version_id(F.col("iso"), F.col("fileset")))
    standard = [ids.standard_id(F.col("iso"), F.col("version"), s).alias(s) for s in ("ebible", "helloao", "dbt")]
    return rows.select("id", ids.short_abbreviation(F.col("fileset")).alias("abbr"), ids.fileset_stem(F.col("fileset")).alias("stem"), "version", *standard, ids.book_set(F.col("fileset"), F.col("size")).alias("books"))


@query("canon_certainty", f"""WITH r AS (SELECT p_partkey AS id, {_sql_of(['C', 'NT', 'OT', 'NTP', 'OTP', 'NTOTP', 'OTNTP', 'NTPOTP', 'S', 'P', 'odd'], 'p_partkey % 11')} AS size FROM part)
SELECT id, size, CASE WHEN size IN ('C', 'NT', 'NTOTP') THEN 'true' WHEN size IN ('OT', 'OTP', 'S') THEN NULL ELSE 'false' END AS nt, CASE WHEN size IN ('C', 'OT', 'OTNTP') THEN 'true' WHEN size IN ('NT', 'NTP', 'S') THEN NULL ELSE 'false' END AS ot,
  CASE size WHEN 'C' THEN 'nt,ot' WHEN 'NT' THEN 'nt' WHEN 'OT' THEN 'ot' WHEN 'NTP' THEN 'ntp' WHEN 'OTP' THEN 'otp' WHEN 'NTOTP' THEN 'nt,otp' WHEN 'OTNTP' THEN 'ntp,ot' WHEN 'S' THEN '' ELSE 'ntp,otp' END AS keys FROM r""")
def canon_certainty(spark, sf_dir):
    """what a size code says of each testament."""
    size = _of(["C", "NT", "OT", "NTP", "OTP", "NTOTP", "OTNTP", "NTPOTP", "S", "P", "odd"], F.col("p_partkey") % 11)
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), size.alias("size"))
    return rows.select("id", "size", ids.canon_certainty(F.col("size")).alias("c"), F.array_join(ids.canon_keys(F.col("size")), ",").alias("keys")).select("id", "size", F.col("c.nt").cast("string").alias("nt"), F.col("c.ot").cast("string").alias("ot"), "keys")


TITLES = ["# 1. ", "## ", "12- ", "٣: ", "", "\n \n7 ", "#", "100 "]


@query("text_fields", f"""WITH r AS (SELECT conv_id, turn, {_sql_of(TITLES, 'turn % 8')} || left(text, 12) || chr(10) || 'second' AS raw, text FROM conversations WHERE text IS NOT NULL),
l AS (SELECT *, list_filter(list_transform(string_split(raw, chr(10)), lambda x: regexp_replace(x, '^\\s+|\\s+$', '', 'g')), lambda x: x <> '')[1] AS line FROM r)
SELECT conv_id, turn, nullif(regexp_replace(regexp_replace(line, '^#*\\s*(?:\\p{{Nd}}+[.\\-:]?\\s*)?', ''), '^\\s+|\\s+$', '', 'g'), '') AS title, CASE WHEN turn % 3 = 0 THEN NULL ELSE left(text, 5) END AS name,
  CASE turn % 3 WHEN 0 THEN NULL WHEN 1 THEN 'v' || turn WHEN 2 THEN '' END AS field, CASE turn % 2 WHEN 0 THEN '١' || translate(CAST(turn AS VARCHAR), '01234567', '٠١٢٣٤٥٦٧') || '–٩' ELSE '' END AS number, turn % 4 IN (1, 3) AS derivable FROM l""")
def text_fields(spark, sf_dir):
    """Titles, names, manifest fields, verse labels and licenses."""
    turn = F.col("turn")
    rows = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    name = F.when(turn % 3 == 0, F.concat(F.lit("ENG "), F.lit(ids.PLACEHOLDER))).otherwise(F.substring("text", 1, 5))
    manifest = F.concat(F.lit("dublin_core:\n  other: x\n"), F.when(turn % 3 == 0, "version: 'no'").when(turn % 3 == 1, F.concat(F.lit("  version: 'v"), turn.cast("string"), F.lit("'  \n"))).otherwise('  version: ""\n'))
    licenses = F.when(turn % 4 == 0, F.array(F.lit("[CC BY-ND]"))).when(turn % 4 == 1, F.array(F.lit("CC BY-ND"), F.lit("[CC BY]"))).when(turn % 4 == 2, F.array().cast("array<string>")).otherwise(F.array(F.lit(None).cast("string")))
    number = F.when(turn % 2 == 0, F.concat(F.lit("1"), turn.cast("string"), F.lit("-9")))
    return rows.select(
        "conv_id", "turn", ids.story_title(F.concat(_of(TITLES, turn % 8), F.substring("text", 1, 12), F.lit("\nsecond"))).alias("title"), ids.without_placeholder(name).alias("name"),
        ids.manifest_field(manifest, "version").alias("field"), ids.numeral(number, "–", "٠١٢٣٤٥٦٧٨٩").alias("number"), ids.may_derive(licenses).alias("derivable"),
    )


ORDERS = {"byzantine": ["MAT", "ACT", "JAS", "ROM", "HEB", "REV"], "antilegomena": ["ACT", "ROM", "HEB", "JAS", "JUD", "REV"], "standard": ["ACT", "HEB", "JAS", "1PE", "JUD", "REV"], "other": ["ACT", "REV", "JAS"], "unknown": ["MAT", "ACT"]}
SOURCES = {"dbt": "d", "pkf": "p", "own": "o"}


@query("order_and_sources", """SELECT p_partkey AS id, ['byzantine', 'antilegomena', 'standard', 'other', 'unknown', 'unknown'][p_partkey % 6 + 1] AS book_order, ['dp', 'd', NULL, 'dpo', 'o'][p_size % 5 + 1] AS sources FROM part""")
def order_and_sources(spark, sf_dir):
    """The order of books and the letters of sources."""
    books = F.get(F.array(*[F.array(*map(F.lit, b)) for b in ORDERS.values()]), (F.col("p_partkey") % 6).cast("int"))
    held = F.get(F.array(*[F.array(*map(F.lit, s)) for s in (["pkf", "dbt"], ["dbt", "x"], ["x"], ["own", "pkf", "dbt"], ["own"])]), F.col("p_size") % 5)
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), ids.book_order(books).alias("book_order"), ids.source_letters(held, SOURCES).alias("sources"))


#: Letters that were counted, stated scripts and directions, with the verdict worked out by hand.
VERDICTS = [
    (1, {"Latn": 90, "Grek": 10}, ["NFC", "none"], "Latn", "ltr", ("Latn", "metadata", None, "Latn,Grek", "ltr", None, None, "NFC")),
    (2, {"Hani": 50}, ["none"], "Hant", None, ("Hant", "metadata", None, None, "ltr", None, False, "NFC")),
    (3, {"Arab": 99, "Zyyy": 900}, ["NFD", "NFC"], "Latn", "ltr", ("Arab", "detected", "Latn", None, "rtl", "ltr", None, "mixed")),
    (4, {"Hira": 3, "Hani": 90, "Latn": 7}, ["NFC"], None, None, ("Jpan", "detected", None, "Jpan,Latn", "ltr", None, False, "NFC")),
    (5, {"Zyyy": 5}, ["none"], "Deva", "rtl", ("Deva", "metadata", None, None, "ltr", "rtl", None, "NFC")),
    (6, None, None, None, "rtl", (None, "metadata", None, None, "rtl", None, None, None)),
    (7, None, None, None, None, (None, None, None, None, None, None, None, None)),
    (8, {"Arab": 10}, ["NFD"], "Aran", "rtl", ("Aran", "metadata", None, None, "rtl", None, None, "NFD")),
    (9, {"Hang": 80, "Hani": 19, "Latn": 1}, ["NFC"], "Hang", None, ("Kore", "detected", "Hang", "Kore,Latn", "ltr", None, None, "NFC")),
]
_FIELDS = ("script", "basis", "stated_script", "scripts", "direction", "stated_direction", "spaces", "normalization")


def _literal(v):
    return "NULL" if v is None else str(v) if isinstance(v, bool) else f"'{v}'"


@query("script_verdicts", f"""SELECT id, script, basis, stated_script, scripts, direction, stated_direction, lower(CAST(spaces AS VARCHAR)) AS spaces, normalization FROM (VALUES {", ".join(f"({r[0]}, {', '.join(map(_literal, r[-1]))})" for r in VERDICTS)}) AS v(id, {', '.join(_FIELDS)})""")
def script_verdicts(spark, sf_dir):
    """Verdicts on scripts."""
    rows = spark.createDataFrame([r[:-1] for r in VERDICTS], "id int, letters map<string,int>, forms array<string>, stated string, direction string")
    verdict = scripts.verdict_col(F.col("letters"), F.col("forms"), F.col("stated"), F.col("direction"))
    return rows.select("id", verdict.alias("v")).select("id", "v.*").withColumns({"scripts": F.array_join("scripts", ","), "spaces": F.col("spaces").cast("string")})


NAMES = ["Latn", "Latin", "Arabic (Nastaliq variant)", "Myanmar (Burmese)", "Han (Simplified variant)", "CJK", "Hindi", "Code for uncoded script", "No such script", "", None, "Canadian Aboriginal"]


@query("script_codes", f"""SELECT p_partkey AS id, ['Latn', 'Latn', 'Aran', 'Mymr', 'Hans', 'Hani', 'Deva', NULL, NULL, NULL, NULL, 'Cans'][p_partkey % {len(NAMES)} + 1] AS code FROM part""")
def script_codes(spark, sf_dir):
    """Codes of scripts named in metadata."""
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), scripts.script_code_col(_of(NAMES, F.col("p_partkey") % len(NAMES))).alias("code"))


@query("scheme_labels", """WITH t AS (SELECT p_partkey AS id, ['?', 'eng', 'org', 'lxx', '?'][p_size % 5 + 1] AS scheme, CASE WHEN p_partkey % 4 = 0 THEN NULL ELSE 8 + p_partkey % 12 END AS ps117, CASE WHEN p_partkey % 7 = 0 THEN NULL ELSE 18 + p_size % 5 END AS ps51, CASE WHEN p_partkey % 5 < 2 THEN NULL ELSE 40 END AS sa17,
  CASE WHEN p_partkey % 3 = 0 THEN 350 + p_size * 3 END AS dan, CASE WHEN p_partkey % 13 = 0 THEN 'byzantine' ELSE 'standard' END AS book_order, p_partkey % 9 <> 0 AS has_books, CASE WHEN p_partkey % 11 = 0 THEN 27 ELSE 66 END AS books, CASE WHEN p_partkey % 6 = 0 THEN NULL ELSE p_partkey % 10 <> 1 END AS ok FROM part)
SELECT id, CASE WHEN books <= 27 THEN 'eng' WHEN scheme <> '?' THEN CASE WHEN ok IS FALSE THEN 'irregular' WHEN scheme IN ('eng', 'org', 'orgw') AND dan > 400 THEN 'catm' ELSE scheme END
  WHEN book_order = 'byzantine' THEN 'rso' WHEN dan > 400 THEN 'catm' WHEN ps117 < 15 AND ps51 > 20 THEN 'org' WHEN ps117 >= 15 AND sa17 IS NOT NULL THEN 'vul' WHEN has_books AND ps117 IS NULL THEN 'eng' ELSE 'undetermined' END AS label,
 CASE WHEN books <= 27 THEN 'nt_only' WHEN scheme <> '?' THEN NULL WHEN book_order = 'byzantine' THEN CASE WHEN ps117 IS NULL THEN 'book_order_only' END WHEN dan > 400 THEN NULL WHEN ps117 < 15 AND ps51 > 20 THEN 'tiebreaker_unconfirmed' WHEN ps117 >= 15 AND sa17 IS NOT NULL THEN 'tiebreaker_unconfirmed' WHEN has_books AND ps117 IS NULL THEN 'no_psalm_evidence' END AS assumed FROM t""")
def scheme_labels(spark, sf_dir):
    """Labels of schemes with their fallbacks and the reasons of what is assumed."""
    k, s = F.col("p_partkey"), F.col("p_size")
    texts = table(spark, sf_dir, "part").select(
        k.alias("id"), _of(["?", "eng", "org", "lxx", "?"], s % 5).alias("scheme"), F.when(k % 4 != 0, 8 + k % 12).alias("ps117"), F.when(k % 7 != 0, 18 + s % 5).alias("ps51"), F.when(k % 5 >= 2, 40).alias("sa17"),
        F.when(k % 3 == 0, 350 + s * 3).alias("dan"), F.when(k % 13 == 0, "byzantine").otherwise("standard").alias("book_order"), (k % 9 != 0).alias("has_books"), F.when(k % 11 == 0, 27).otherwise(66).alias("books"), F.when(k % 6 != 0, k % 10 != 1).alias("ok"),
    )
    return schemes.labelled(texts)


#: A made-up shape, what differs from it, and named sets of that.
BASE = [("R", 1, 8), ("R", 2, 9), ("A", 1, 5), ("N", 1, 7)]
VARIANTS = [("R", 1, 9, "R1long"), ("A", 1, 6, "A1long"), ("R", 2, 8, "R2short")]


@query("nt_variants", """WITH l AS (SELECT l_orderkey AS id, l_returnflag AS book, l_linenumber % 2 + 1 AS chapter, CAST(max(l_quantity) AS INTEGER) % 4 + 5 AS last FROM lineitem GROUP BY ALL),
b(book, chapter, usual) AS (VALUES ('R', 1, 8), ('R', 2, 9), ('A', 1, 5), ('N', 1, 7)), v(book, chapter, last, variant) AS (VALUES ('R', 1, 9, 'R1long'), ('A', 1, 6, 'A1long'), ('R', 2, 8, 'R2short')),
d AS (SELECT id, l.book, l.chapter, variant FROM l JOIN b USING (book, chapter) LEFT JOIN v ON v.book = l.book AND v.chapter = l.chapter AND v.last = l.last WHERE l.last <> usual),
t AS (SELECT id, coalesce(string_agg(variant, ',' ORDER BY variant), '') AS variants, coalesce(string_agg(book || ' ' || chapter, ',' ORDER BY book || ' ' || chapter) FILTER (variant IS NULL), '') AS unexplained FROM d GROUP BY 1)
SELECT id, variants, unexplained, CASE variants WHEN 'A1long' THEN 'long' WHEN 'A1long,R2short' THEN 'both' END AS profile FROM t""")
def nt_variants(spark, sf_dir):
    """Variants of chapters by their lengths."""
    lengths = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.col("l_returnflag").alias("book"), (F.col("l_linenumber") % 2 + 1).cast("int").alias("chapter")).agg((F.max("l_quantity").cast("int") % 4 + 5).alias("last"))
    base = spark.createDataFrame(BASE, "book string, chapter int, last int")
    variants = spark.createDataFrame(VARIANTS, "book string, chapter int, last int, variant string")
    profiles = spark.createDataFrame([(["A1long"], "long"), (["A1long", "R2short"], "both")], "variants array<string>, profile string")
    out = schemes.new_testament_variants(lengths, base, variants, profiles)
    return out.select("id", F.array_join("variants", ",").alias("variants"), F.array_join("unexplained", ",").alias("unexplained"), "profile")


@query("ot_variants", """WITH l AS (SELECT l_orderkey AS id, 'JOB' AS book, l_linenumber AS chapter, CAST(max(l_quantity) AS INTEGER) % 2 + 5 AS last FROM lineitem GROUP BY ALL),
own AS (SELECT id, count(*) FILTER (chapter IN (1, 2)) AS n, string_agg(last, '/' ORDER BY chapter) FILTER (chapter IN (1, 2)) AS lasts FROM l GROUP BY 1),
lab AS (SELECT o_orderkey AS id, ['eng', 'org', 'none'][o_orderkey % 3 + 1] AS scheme FROM orders),
d AS (SELECT id, lasts, scheme FROM own JOIN lab USING (id) WHERE n = 2 AND scheme <> 'none' AND lasts <> CASE scheme WHEN 'eng' THEN '5/6' ELSE '6/5' END)
SELECT id, CASE lasts WHEN '6/5' THEN 'swap' WHEN '5/6' THEN 'plain' ELSE '' END AS variants, CASE WHEN lasts IN ('6/5', '5/6') THEN '' ELSE 'JOB 1-2: ' || lasts END AS unexplained FROM d""")
def ot_variants(spark, sf_dir):
    """Blocks of chapters that are divided otherwise than in the text's scheme."""
    lengths = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("id"), F.lit("JOB").alias("book"), F.col("l_linenumber").cast("int").alias("chapter")).agg((F.max("l_quantity").cast("int") % 2 + 5).alias("last"))
    labels = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"), _of(["eng", "org", "none"], F.col("o_orderkey") % 3).alias("scheme"))
    shapes = spark.createDataFrame([("eng", "JOB", 1, 5), ("eng", "JOB", 2, 6), ("org", "JOB", 1, 6), ("org", "JOB", 2, 5)], "scheme string, book string, chapter int, last int")
    blocks = spark.createDataFrame([("JOB", [1, 2], [6, 5], "swap"), ("JOB", [1, 2], [5, 6], "plain")], "book string, chapters array<int>, lasts array<int>, variant string")
    out = schemes.old_testament_variants(lengths, labels, shapes, blocks)
    return out.select("id", F.array_join("variants", ",").alias("variants"), F.array_join("unexplained", ",").alias("unexplained"))
