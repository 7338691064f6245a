"""A corpus pipeline in five stages, each written as Parquet and read again as the next one's input.

1. language ID: documents in which no language is recognised go;
2. exact dedup: of equal texts one row stays;
3. n-gram Jaccard join (five words, similarity 0.8 or more): one document of each group stays;
4. substring dedup: sentences in runs (of three sentences and 15 words at least) that stand elsewhere
   before are cut out; documents of which nothing is left go;
5. best-fit packing of what is left into sequences of 2048 tokens.

All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm import exact_dedup, langid, ngram_join, packing, sentence_spans
from lectern.llm.common import written
from lectern.llm.tokens import default_path


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return langid.keep_identified(docs)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.drop_copies(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.keep_one(docs, n=5, percent=80)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = sentence_spans.cut_repeats(docs)
    left = F.translate(F.coalesce("text", F.lit("")), sentence_spans.BLANK, "") != ""
    kept = cut.where((F.col("n_removed") == 0) | left)
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("bigint")).otherwise(F.col("n_chars")))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, default_path(), capacity=2048, end_id=0)


STAGES = [
    ("language ID", language_id),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", near_copies),
    ("substring dedup", repeated_passages),
    ("best-fit packing", packed),
]

#: Language ID and the tokenizer cannot be expressed in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; every result but the last is written to the shared folder."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = written(docs, f"stage-{k + 1}")
    return docs
