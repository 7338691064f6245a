"""Connected components of an edge table."""

from __future__ import annotations

import re
import tempfile

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def cut(df: DataFrame) -> DataFrame:
    """``df`` with its lineage cut in the shared checkpoint folder of the session.

    Where that setting is absent a session of one machine takes a temporary folder; on a cluster,
    whose executors could not read that, this raises.
    """
    spark = df.sparkSession
    if not spark.sparkContext.getCheckpointDir():
        folder = spark.conf.get("spark.checkpoint.dir", None)
        if not folder:
            if not re.match(r"local(\[|$)", spark.sparkContext.master):
                raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
            folder = tempfile.mkdtemp(prefix="lectern-")
        spark.sparkContext.setCheckpointDir(folder)
    return df.checkpoint()


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the least node reachable over edges ``a``-``b``; nodes without an edge are not named.

    Each round takes the least label among the neighbours and then that label's own label, so that
    long chains shorten by half; it ends when no label changes, with no bound on rounds.  A null on
    either side is no edge.  Every edge moves once per round, keyed by its node.
    """
    pairs = edges.select(F.col(a).alias("a"), F.col(b).alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
    both = cut(pairs.union(pairs.select("b", "a")).distinct())
    labels = cut(both.groupBy(F.col("a").alias("node")).agg(F.least("node", F.min("b")).alias("component")))
    while True:
        near = both.join(labels, F.col("b") == F.col("node")).groupBy("a").agg(F.min("component").alias("__m"))
        low = labels.join(near, F.col("node") == F.col("a")).select("node", F.col("component").alias("__old"), F.least("component", "__m").alias("__l"))
        own = low.select(F.col("node").alias("__n"), F.col("__l").alias("__ll"))
        moved = low.join(own, F.col("__l") == F.col("__n")).select("node", F.least("__l", "__ll").alias("component"), "__old")
        moved = cut(moved)
        labels = moved.select("node", "component")
        if moved.where("component != __old").isEmpty():
            return labels
