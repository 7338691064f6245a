"""Queries of text kernels, comparison and clustering over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import compare, rollups, scripts, text, tokens, verses
from lectern.plans.catalog import LINES_SQL, query, verse_lines
from lectern.session import table


def _docs(spark, sf_dir):
    return table(spark, sf_dir, "documents")


@query("verse_lines", f"WITH {LINES_SQL} SELECT doc_id, v, v || ':' || array_to_string(toks, ' ') AS line FROM lines WHERE len(toks) > 0")
def verse_lines_query(spark, sf_dir):
    """Numbered token lines."""
    return verse_lines(_docs(spark, sf_dir))


@query("token_counts", f"WITH {LINES_SQL} SELECT doc_id, CAST(sum(len(toks)) AS BIGINT) AS n_tokens FROM lines GROUP BY 1")
def token_counts(spark, sf_dir):
    """X17, fast path: tokens of a text."""
    toks = F.size(F.regexp_extract_all("text", F.lit(r"[\p{L}\p{M}]+"), F.lit(0))).cast("bigint")
    return _docs(spark, sf_dir).select("doc_id", toks.alias("n_tokens"))


@query("content_fingerprint", r"""SELECT doc_id, sha256(regexp_replace(lower(nfc_normalize(regexp_replace(text, '[''’ʼʻꞌ´`′＇]', 'ʼ', 'g'))), '[^\p{L}\p{M}]', '', 'g')) AS fp FROM documents""")
def content_fingerprint(spark, sf_dir):
    """Digest of the content string."""
    return _docs(spark, sf_dir).select("doc_id", F.sha2(text.content_col("text"), 256).alias("fp"))


@query("file_hash", "SELECT doc_id, left(sha256(text), 8) AS hash FROM documents")
def file_hash(spark, sf_dir):
    """The short digest of a whole text, as K10 publishes it; the fingerprint of a book (X24) is in ``book_fingerprints``."""
    return _docs(spark, sf_dir).select("doc_id", F.substring(F.sha2("text", 256), 1, 8).alias("hash"))


def _book_verses(spark, sf_dir):
    """Conversations as books: two turns a chapter."""
    turn = F.col("turn")
    return table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("book"), (F.floor(turn / 2) + 1).cast("int").alias("chapter"), (turn % 2 + 1).cast("int").alias("verse"), "text")


def _book_sql(line: str) -> str:
    return f"""WITH v AS (SELECT conv_id AS book, turn // 2 + 1 AS chapter, turn % 2 + 1 AS verse, {line} AS l FROM conversations),
c AS (SELECT book, chapter, sha256(string_agg(verse || ':' || l, chr(10) ORDER BY verse)) AS fp FROM v WHERE l <> '' GROUP BY ALL),
b AS (SELECT book, sha256(string_agg(chapter || ':' || fp, chr(10) ORDER BY chapter)) AS book_fp FROM c GROUP BY 1)
SELECT book, CAST(chapter AS INTEGER) AS chapter, fp, book_fp, left(book_fp, 8) AS file_hash FROM c JOIN b USING (book)"""


def _both_levels(pair):
    chapters, books = pair
    return chapters.join(books.select("book", F.col("fp").alias("book_fp"), "file_hash"), "book")


@query("book_fingerprints", _book_sql(r"array_to_string(regexp_extract_all(nfc_normalize(text), '[\p{L}\p{M}]+'), ' ')"))
def book_fingerprints(spark, sf_dir):
    """Fingerprints of chapters and books, and the hash in a file's name."""
    return _both_levels(tokens.fingerprints(_book_verses(spark, sf_dir), ["book"]))


@query("book_content_fingerprints", _book_sql(r"regexp_replace(lower(nfc_normalize(regexp_replace(text, '[''’ʼʻꞌ´`′＇]', 'ʼ', 'g'))), '[^\p{L}\p{M}]', '', 'g')"))
def book_content_fingerprints(spark, sf_dir):
    """Content fingerprints of chapters and books."""
    return _both_levels(tokens.fingerprints(_book_verses(spark, sf_dir), ["book"], line=text.content_col("text")))


@query("chapter_digests", """SELECT conv_id AS book, CAST(turn // 2 + 1 AS INTEGER) AS chapter, sha256(string_agg((turn % 2 + 1) || chr(9) || text || chr(10), '' ORDER BY turn)) AS digest FROM conversations WHERE text IS NOT NULL GROUP BY ALL""")
def chapter_digests(spark, sf_dir):
    """Digest of a chapter's verses with their numbers."""
    return tokens.chapter_digests(_book_verses(spark, sf_dir), ["book"])


@query("letters_key", r"SELECT doc_id, regexp_replace(strip_accents(lower(text)), '[^\p{L}]', '', 'g') AS letters FROM documents")
def letters_key(spark, sf_dir):
    """Letters only."""
    return _docs(spark, sf_dir).select("doc_id", text.letters_key_col("text").alias("letters"))


@query("clean_text", r"SELECT doc_id, trim(regexp_replace(text, '[\t\n\v\f\r ]+', ' ', 'g')) AS cleaned FROM documents")
def clean_text(spark, sf_dir):
    """White space."""
    return _docs(spark, sf_dir).select("doc_id", text.clean_text(F.col("text")).alias("cleaned"))


@query("first_number", "SELECT o_orderkey, string_split(o_orderpriority, '-')[1] AS num FROM orders")
def first_number(spark, sf_dir):
    """The first number of a label."""
    return table(spark, sf_dir, "orders").select("o_orderkey", text.first_number(F.col("o_orderpriority")).alias("num"))


@query("plain_verses", """SELECT conv_id, turn // 2 AS verse, trim(regexp_replace(string_agg(coalesce(text, ''), ' ' ORDER BY turn), '[\\t\\n\\v\\f\\r ]+', ' ', 'g')) AS text FROM conversations GROUP BY ALL""")
def plain_verses(spark, sf_dir):
    """Fragments of one verse joined in order."""
    c = table(spark, sf_dir, "conversations").select("conv_id", F.floor(F.col("turn") / 2).cast("bigint").alias("verse"), F.struct("turn", F.coalesce("text", F.lit("")).alias("t")).alias("p"))
    joined = F.array_join(F.transform(F.sort_array(F.collect_list("p")), lambda x: x["t"]), " ")
    return c.groupBy("conv_id", "verse").agg(text.clean_text(joined).alias("text"))


@query("normal_form", "SELECT doc_id, CASE WHEN nfc_normalize(text) = text AND strip_accents(text) = text THEN 'none' WHEN nfc_normalize(text) = text THEN 'NFC' ELSE 'mixed' END AS form FROM documents")
def normal_form(spark, sf_dir):
    """Normal form of a text."""
    return _docs(spark, sf_dir).select("doc_id", text.normal_form_col("text").alias("form"))


@query("script_letters", r"SELECT lang, 'Latn' AS script, CAST(sum(len(regexp_extract_all(text, '\p{L}'))) AS BIGINT) AS n FROM documents GROUP BY 1")
def script_letters(spark, sf_dir):
    """Letters by script and language."""
    each = _docs(spark, sf_dir).select("lang", F.explode(scripts.script_letters_col("text")).alias("script", "n"))
    return each.groupBy("lang", "script").agg(F.sum("n").alias("n"))


@query("html_strip", r"SELECT page_id, regexp_replace(html, '<[^<>]*>', ' ', 'g') AS text FROM pages")
def html_strip(spark, sf_dir):
    """Tags to blanks, the first step of P17."""
    return table(spark, sf_dir, "pages").select("page_id", F.regexp_replace("html", "<[^<>]*>", " ").alias("text"))


#: Short copyright pages of every kind.
PAGES = [
    (-1, '<p><a href="https://creativecommons.org/licenses/by-sa/4.0/">x</a></p>'), (-2, "<a href='http://CreativeCommons.org/licenses/BY-ND/4.0/'>x</a>"), (-3, "creativecommons.org/licenses/by creativecommons.org/licenses/by-nc/3.0"),
    (-4, "creativecommons.org/publicdomain/zero/1.0 all rights reserved"), (-5, "In the <b>Public</b> Domain"), (-6, "public domain. License Agreement"), (-7, "All Rights Reserved"), (-8, "you may share, no derivatives, creativecommons.org/licenses/by/4.0"),
    (-9, "creativecommons.org/licenses/by creativecommons.org/licenses/by"), (-10, "creativecommons.org/publicdomain/mark/1.0"), (-11, "republic domain"), (-12, None),
]
_PAGES_SQL = ", ".join(f"({k}, {'NULL' if v is None else chr(39) + v.replace(chr(39), chr(39) * 2) + chr(39)})" for k, v in PAGES)


@query("page_license", f"""WITH p AS (SELECT page_id, coalesce(html, '') AS raw FROM (SELECT page_id, html FROM pages UNION ALL VALUES {_PAGES_SQL})),
x AS (SELECT page_id, raw, regexp_replace(regexp_replace(regexp_replace(raw, '<[^>]+>', ' ', 'g'), '&(?:nbsp|#160|#[xX][aA]0);', ' ', 'g'), '\\s+', ' ', 'g') AS t, list_distinct(list_transform(regexp_extract_all(raw, 'creativecommons\\.org/(licenses|publicdomain)/([a-z-]+)(?:/([0-9.]+))?', 0, 'i'), lambda l: lower(substr(l, 21)))) AS links FROM p),
y AS (SELECT *, list_filter(links, lambda l: starts_with(l, 'licenses/')) AS own FROM x),
z AS (SELECT *, string_split(own[1], '/') AS o, len(list_filter(links, lambda l: starts_with(l, 'publicdomain/'))) > 0 OR regexp_matches(t, '\\bpublic domain\\b', 'i') AS free FROM y),
r AS (SELECT page_id, o, CASE WHEN len(list_filter(links, lambda l: list_contains(string_split(string_split(l, '/')[2], '-'), 'nd'))) > 0 OR regexp_matches(t, 'no[ -]?deriv', 'i') THEN 'No Derivatives' WHEN len(own) = 1 THEN '!cc' WHEN len(own) > 1 THEN 'several licences on the page'
  WHEN len(list_filter(links, lambda l: starts_with(l, 'publicdomain/zero'))) > 0 THEN '!zero' WHEN free AND regexp_matches(t, 'all rights reserved|license agreement', 'i') THEN 'public domain mentioned, but rights reserved' WHEN free THEN '!free' WHEN regexp_matches(t, 'all rights reserved', 'i') THEN 'All rights reserved' ELSE 'no licence stated' END AS k FROM z)
SELECT page_id, CASE k WHEN '!cc' THEN 'CC ' || upper(o[2]) || CASE WHEN len(o) > 2 THEN ' ' || o[3] ELSE '' END WHEN '!zero' THEN 'CC0 1.0' WHEN '!free' THEN 'Public Domain' END AS type,
  CASE k WHEN '!cc' THEN 'https://creativecommons.org/licenses/' || o[2] || '/' || CASE WHEN len(o) > 2 THEN o[3] ELSE '4.0' END || '/' WHEN '!zero' THEN 'https://creativecommons.org/publicdomain/zero/1.0/' WHEN '!free' THEN 'page ' || page_id END AS url, CASE WHEN k NOT LIKE '!%' THEN k END AS reason FROM r""")
def page_license(spark, sf_dir):
    """What a copyright page permits."""
    pages = table(spark, sf_dir, "pages").select(F.col("page_id").cast("bigint").alias("page_id"), "html").union(spark.createDataFrame(PAGES, "page_id bigint, html string"))
    return pages.select("page_id", rollups.page_license(F.col("html"), F.concat(F.lit("page "), F.col("page_id").cast("string"))).alias("l")).select("page_id", "l.*")


@query("exact_copies", "SELECT lang, a, doc_id AS b FROM (SELECT lang, doc_id, min(doc_id) OVER (PARTITION BY lang, text) AS a FROM documents WHERE text IS NOT NULL) WHERE doc_id <> a")
def exact_copies(spark, sf_dir):
    """J3 with equality: every copy with the least of its equals."""
    return compare.copies(_docs(spark, sf_dir), ["lang"], "doc_id", "text")


@query("identical_clusters", "SELECT doc_id, min(doc_id) OVER (PARTITION BY lang, text) AS cluster, count(*) OVER (PARTITION BY lang, text) AS n FROM documents")
def identical_clusters(spark, sf_dir):
    """G1 over identical texts, singletons kept."""
    return compare.identical_clusters(_docs(spark, sf_dir), ["lang"], "doc_id", "text")


@query("written_tokens", f"WITH {LINES_SQL} SELECT doc_id, v, toks AS tokens, toks AS written FROM lines")
def written_tokens(spark, sf_dir):
    """Tokens and written tokens by the general tokenizer; these texts have no marks."""
    lines = _docs(spark, sf_dir).select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return lines.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("v"), tokens.tokens_col("line").alias("tokens"), tokens.tokens_col("line", written=True).alias("written"))


@query("usj_verses", """SELECT conv_id, '1' AS chapter, CAST(turn + 1 AS VARCHAR) AS verse, trim(regexp_replace(text, '[\\t\\n\\v\\f\\r ]+', ' ', 'g')) AS text
FROM conversations WHERE regexp_matches(text, '[^\\s]')""")
def usj_verses(spark, sf_dir):
    """X11: verses of a marked-up book, here a conversation as a chapter with a note in every verse."""
    turns = table(spark, sf_dir, "conversations").where("text IS NOT NULL")
    kind = lambda k, **x: F.struct(F.lit(k).alias("type"), *[F.lit(v).alias(n) for n, v in x.items()])
    para = F.to_json(F.struct(F.lit("para").alias("type"), F.lit("p").alias("marker"), F.array(F.to_json(F.struct(F.lit("verse").alias("type"), (F.col("turn") + 1).cast("string").alias("number"))), F.to_json(kind("note", marker="f")), F.to_json(F.struct(F.lit("char").alias("type"), F.lit("nd").alias("marker"), F.array("text").alias("content")))).alias("content")))
    book = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", para.alias("p")))).alias("ps"))
    chapter = F.lit('{"type": "chapter", "number": "1"}')
    # Items are JSON texts inside JSON: opened again by the concatenation.
    items = F.transform("ps", lambda x: F.regexp_replace(F.replace(F.replace(F.replace(F.replace(x["p"], F.lit('"{'), F.lit("{")), F.lit('}"'), F.lit("}")), F.lit('\\"'), F.lit('"')), F.lit("\\\\"), F.lit("\\")), "$^", ""))
    raw = F.concat(F.lit('{"content": ['), chapter, F.lit(", "), F.array_join(items, ", "), F.lit("]}"))
    return verses.verse_table(book.select("conv_id", raw.alias("raw")), ["conv_id"], "raw", "usj").select("conv_id", "chapter", "verse", "text")
