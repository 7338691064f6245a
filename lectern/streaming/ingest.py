"""Incremental ingestion of batches (I1, I3-I6): an idempotent union that takes every batch once."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def ingest(spark: SparkSession, source: str, schema, state: str, checkpoint: str, key: list[str]) -> None:
    """Folds new files under ``source`` into the table ``state``, each file once.

    A file stream with a checkpoint remembers what was taken.  A micro-batch is written as its own
    partition, named by its number, so that a batch that is run again replaces itself.
    """

    def fold(batch: DataFrame, number: int) -> None:
        batch.dropDuplicates(key).write.mode("overwrite").parquet(f"{state}/batch={number}")

    stream = spark.readStream.schema(schema).parquet(source)
    stream.writeStream.foreachBatch(fold).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def digest(spark: SparkSession, state: str, key: list[str]) -> DataFrame:
    """The set union of all batches: late and repeated rows fall together, so no watermark is needed."""
    return spark.read.parquet(state).select(*key).distinct()


def unseen(rows: DataFrame, ingested: DataFrame, batch: str) -> DataFrame:
    """I1 on a batch: rows of batches that are not yet ingested."""
    return rows.join(ingested.select(batch).distinct(), batch, "left_anti")


def successes(rows: DataFrame, status: str = "status") -> DataFrame:
    """What may be cached: a failure is tried again and never remembered as absent."""
    return rows.where(F.col(status) == "ok")
