"""Registered queries of the reference's operators, with their SQL oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.session import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Registers a query under ``name`` together with its oracle."""

    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


LINES_SQL = """lines AS (
  SELECT doc_id, v, regexp_extract_all(l, '[\\p{L}\\p{M}]+') AS toks
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS l,
               unnest(range(1, len(string_split(text, chr(10))) + 1)) AS v
        FROM documents WHERE text IS NOT NULL)
)"""


def verse_lines(docs: DataFrame) -> DataFrame:
    """X17 + X22: the n-th line of a document is verse n; token-less verses are left out."""
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    toks = F.regexp_extract_all("line", F.lit(r"[\p{L}\p{M}]+"), F.lit(0))
    return (
        lines.select("doc_id", (F.col("pos") + 1).cast("bigint").alias("v"), toks.alias("toks"))
        .where(F.size("toks") > 0)
        .select("doc_id", "v", F.concat(F.col("v").cast("string"), F.lit(":"), F.array_join("toks", " ")).alias("line"))
    )


@query(
    "text_fingerprint",
    f"""WITH {LINES_SQL}
SELECT doc_id, sha256(string_agg(v || ':' || array_to_string(toks, ' '), chr(10) ORDER BY v)) AS fp,
       count(*) AS n_lines
FROM lines WHERE len(toks) > 0 GROUP BY doc_id""",
)
def text_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """X23 of documents as chapters: SHA-256 of the verse lines in order.

    A document is one row, so its lines are numbered, cut and joined within it; nothing is shuffled.
    """
    toks = F.transform(F.split("text", "\n"), lambda line, k: F.struct((k + 1).alias("v"), F.regexp_extract_all(line, F.lit(r"[\p{L}\p{M}]+"), F.lit(0)).alias("t")))
    docs = table(spark, sf_dir, "documents").select("doc_id", F.filter(toks, lambda x: F.size(x["t"]) > 0).alias("lines")).where(F.size("lines") > 0)
    text = F.array_join(F.transform("lines", lambda x: F.concat(x["v"].cast("string"), F.lit(":"), F.array_join(x["t"], " "))), "\n")
    return docs.select("doc_id", F.sha2(text, 256).alias("fp"), F.size("lines").cast("bigint").alias("n_lines"))


from lectern.plans import catalog_rollups, catalog_texts  # noqa: E402,F401  they register their queries
from lectern.plans import catalog_streams  # noqa: E402,F401
from lectern.plans import catalog_verdicts  # noqa: E402,F401
from lectern.plans import catalog_maps  # noqa: E402,F401
from lectern.plans import catalog_editions, catalog_filesets, catalog_ids  # noqa: E402,F401
