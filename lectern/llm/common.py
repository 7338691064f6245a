"""Shared folder, written tables, Arrow batches and connected components."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows of an Arrow batch that are Python objects at once.
SLICE_ROWS = 256
#: Rows of an Arrow batch that the JVM sends to a worker.
BATCH_ROWS = 1024
#: Keys that hold more than this share of a join's rows are spread over tasks; there are at most 1 / HOT of them.
HOT, SPREAD = 1 / 2000, 64


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a session of one machine (tests) takes and sets a temporary folder; on a
    cluster, whose executors could not read that, this raises.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
        found = "file://" + tempfile.mkdtemp(prefix="lectern-")
        spark.conf.set("spark.checkpoint.dir", found)
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/lectern-{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts lineage, survives lost executors.

    What was shuffled for the table goes when it is written, not when the driver next collects garbage.
    """
    spark, cleanup = df.sparkSession, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    path, before = new_path(spark, name), spark.conf.get(cleanup, None)
    spark.conf.set(cleanup, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(cleanup) if before is None else spark.conf.set(cleanup, before)
    table = spark.read.schema(df.schema).parquet(path)
    table.written_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Deletes tables that ``written`` returned, when all that is read from them has itself been written."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def filesystem(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    """The file system of a path in the shared folder, and the path in it."""
    return pyarrow.fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (pyarrow.fs.LocalFileSystem(), uri)


def free_names(df: DataFrame, *names: str) -> list[str]:
    """Names like ``names`` that no column of ``df`` has, for columns that are added on the way."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def join_spread(rows: DataFrame, small: DataFrame, on: list[str], total: int, spread: list[str], how: str = "inner") -> DataFrame:
    """``rows`` joined with ``small``, which has one row for each key and, as ``n``, the number of its rows among ``rows``.

    The rows of a key that holds more than HOT of all ``total`` rows are dealt to SPREAD parts by the
    columns ``spread``, and that key's row of ``small`` goes to each of them.  Only hot keys are
    broadcast, 1 / HOT at most.  ``n`` is left out of the result.
    """
    part = F.sequence(F.lit(0).cast("bigint"), F.lit(SPREAD - 1).cast("bigint"))
    cutoff = total * HOT
    salt, *keys = free_names(rows, "__salt", *[f"__hot_{c}" for c in on])
    hot = F.broadcast(small.where(F.col("n") > cutoff).select(*[F.col(c).alias(k) for c, k in zip(on, keys, strict=True)]))
    dealt = rows.join(hot, [F.col(c) == F.col(k) for c, k in zip(on, keys, strict=True)], "left")
    dealt = dealt.withColumn(salt, F.when(F.col(keys[0]).isNotNull(), F.pmod(F.xxhash64(*spread), F.lit(SPREAD))).otherwise(0)).drop(*keys)
    copies = small.withColumn(salt, F.explode(F.when(F.col("n") > cutoff, part).otherwise(F.array(F.lit(0).cast("bigint"))))).drop("n")
    return dealt.join(copies, [*on, salt], how).drop(salt)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that few of them are Python objects at once."""
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)


def in_arrow(df: DataFrame, run: Callable, schema) -> DataFrame:
    """``df.mapInArrow`` with batches of BATCH_ROWS rows at most: documents can be long, and workers small."""
    conf = df.sparkSession.conf
    if int(conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) not in range(1, BATCH_ROWS + 1):
        conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return df.mapInArrow(run, schema)


def map_rows(df: DataFrame, rows: Callable[..., tuple], schema: str, setup: Callable[[], object] | None = None) -> DataFrame:
    """Applies ``rows(state, *columns) -> columns`` to small batches of ``df`` by Arrow.

    ``columns`` are lists, in and out; ``state`` is what ``setup`` returns, once a task.
    """
    types = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(types)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state = setup() if setup else None
        for part in slices(batches):
            out = rows(state, *[c.to_pylist() for c in part.columns])
            arrays = [pa.array(x, type=f.type) for x, f in zip(out, arrow, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return in_arrow(df, run, types)


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges`` (u, v, both long): rows (node, label), label the least node.

    Alternates large-star and small-star steps.  A node's neighbours are never brought
    together: each step takes a minimum per node (pre-aggregated before the shuffle) and joins
    it back, the rows of a hot node spread over tasks.  Every round is written to the shared
    folder, and the one before is deleted; rounds go on until nothing changes.
    """
    now = written(_canonical(edges.select("u", "v")), "edges")
    mark = _state(now)
    while mark[0]:
        both = now.union(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("u", "m").alias("m"), "n")
        large = join_spread(both, least, ["u"], 2 * mark[0], ["v"]).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = _canonical(large)
        down = large.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n"))
        small = join_spread(large, down, ["u"], mark[0], ["v"])
        small = small.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
        old, now = now, written(_canonical(small), "edges")
        discard(old)
        before, mark = mark, _state(now)
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("label")).union(now.select(F.col("v"), F.col("v")).distinct())


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct edges from the greater to the lesser node."""
    return edges.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
    return row[0], row[1]
