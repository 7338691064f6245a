"""The registered queries of the training-data operators, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import bpe, chat, exact_dedup, langid, licenses, ngram_join, packing, quality, sentence_spans, token_files
from lectern.llm.tokens import default_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def add(function):
        QUERIES[name] = function
        if sql:
            ORACLE_SQL[name] = sql
        return function

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: The conversation that the contract adds: its texts hold the template's own control strings.
EXTRA = [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]


@query(
    "op1_chat_formatting",
    r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'
), f AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\b'), '</turn>', '\e'), '### ', '\h'), ':', '\c'))
            + length(replace(replace(replace(text, '\', '\b'), '</turn>', '\e'), '### ', '\h')) + 14 AS chars,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
         count(*) OVER (PARTITION BY conv_id) AS n
  FROM t
), p AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY k) AS prefix FROM f
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       coalesce(length(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant')), 0) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (role = 'assistant' OR k = n) AS BIGINT) AS formatted_chars
FROM p GROUP BY conv_id""",
)
def op1_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.digests(chat.examples(turns.union(spark.createDataFrame(EXTRA, turns.schema))))


@query("op3_bpe_coding")
def op3_bpe_coding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), default_path())


@query(
    "op10_exact_dedup",
    r"""
WITH d AS (
  SELECT doc_id, sha256(translate(coalesce(text, ''), ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS sha,
         length(coalesce(text, '')) AS chars
  FROM documents
), w AS (
  SELECT *, row_number() OVER (PARTITION BY sha ORDER BY chars DESC, doc_id NULLS LAST) AS k,
         first_value(doc_id) OVER (PARTITION BY sha ORDER BY chars DESC, doc_id NULLS LAST) AS keep_id,
         count(*) OVER (PARTITION BY sha) AS group_size
  FROM d
)
SELECT doc_id, keep_id, group_size, k = 1 AS kept, sha AS text_sha256 FROM w""",
)
def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("op4_ngram_jaccard_join")
def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.near_classes(table(spark, sf_dir, "documents"), n=4, percent=85)


@query("op6_best_fit_packing")
def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), default_path(), capacity=2048, end_id=0)


@query("op7_token_files")
def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.read_shards(token_files.write_shards(table(spark, sf_dir, "documents"), default_path(), end_id=1))


@query("op8_language_id")
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


@query("op9_sentence_spans", sentence_spans.ORACLE_SQL)
def op9_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = sentence_spans.cut_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), "n_sentences", "n_removed")


@query("op2_license_scan")
def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.best_license(licenses.scan(table(spark, sf_dir, "documents")))


@query("op5_quality_rules", quality.ORACLE_SQL)
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
