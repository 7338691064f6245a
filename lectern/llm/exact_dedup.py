"""Exact dedup by a tree merge of sorted digest runs.

Every input partition writes a run: its rows' digests in order, one entry for each distinct text
with the best row so far and a count.  In binomial rounds the runs are merged, FAN to one: a task
takes a range of digests of FAN runs, reads them block by block, in order, and writes one run in
order, in which entries of the same text have become one with the better row.  The more runs have
become one, the narrower the ranges, so that every round has about as many tasks; the last leaves
one run, range by range.  A text that fills a third of the table is one entry a run from the first
level on.  Entries are the same only where the whole SHA-256 agrees.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.common import discard, filesystem, free_names, in_arrow, join_spread, new_path, written

#: Characters that are deleted before texts are compared: space and tab to carriage return.
BLANK = " \t\n\x0b\x0c\r"
#: Runs that one merge takes, entries of a run that are read at once, rows that a run of the first level holds at most.
FAN, BLOCK, RUN = 8, 1 << 15, 1 << 20
#: An entry: the digest in four numbers, then, in the order of preference, the best row, and the number of rows.
ENTRY = np.dtype([(f"h{k}", "<u8") for k in range(4)] + [("minus_chars", "<i8"), ("no_id", "<i8"), ("doc_id", "<i8"), ("row", "<i8"), ("n", "<i8")])
_DIGEST = ["h0", "h1", "h2", "h3"]


def normalised(text: Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANK, "")


def digest_rows(docs: DataFrame) -> DataFrame:
    """A row for each row of ``docs``: doc_id, a row number, digest and size; the texts stay behind."""
    text = normalised(F.col("text"))
    return docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.monotonically_increasing_id().alias("row"),
        F.sha2(text, 256).alias("sha"),
        F.length(F.coalesce("text", F.lit(""))).cast("bigint").alias("chars"),
    )


def folded(entries: np.ndarray) -> np.ndarray:
    """Entries in order of digest, those of one text as one: the best row and the sum of the counts."""
    order = np.lexsort([entries[c] for c in ("row", "doc_id", "no_id", "minus_chars", *_DIGEST[::-1])])
    entries = entries[order]
    new = np.ones(len(entries), bool)
    new[1:] = np.any([entries[c][1:] != entries[c][:-1] for c in _DIGEST], axis=0)
    first = np.flatnonzero(new)
    out = entries[first]
    out["n"] = np.add.reduceat(entries["n"], first) if len(first) else 0
    return out


class RunReader:
    """A slice of a run, from digest ``low`` up to ``high`` (by its first number), read in blocks."""

    def __init__(self, uri: str, low: int, high: int) -> None:
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        self.at = self._place(low)
        self.end = self._place(high) if high < 1 << 64 else self.file.size() // ENTRY.itemsize
        self.held = np.empty(0, ENTRY)

    def _place(self, value: int) -> int:
        """The first entry whose digest is not below ``value``."""
        lo, hi = 0, self.file.size() // ENTRY.itemsize
        while lo < hi and value > 0:
            mid = (lo + hi) // 2
            self.file.seek(mid * ENTRY.itemsize)
            if int(np.frombuffer(self.file.read(8), "<u8")[0]) < value:
                lo = mid + 1
            else:
                hi = mid
        return lo

    def more(self) -> None:
        """Holds another block."""
        n = min(BLOCK, self.end - self.at)
        self.file.seek(self.at * ENTRY.itemsize)
        self.at += n
        self.held = np.concatenate([self.held, np.frombuffer(self.file.read(n * ENTRY.itemsize), ENTRY)])

    def below(self, bound: int | None) -> np.ndarray:
        """Takes what is held below ``bound``; all of it for None."""
        k = len(self.held) if bound is None else int(np.searchsorted(self.held["h0"], np.uint64(bound)))
        out, self.held = self.held[:k], self.held[k:]
        return out


def merged(readers: list[RunReader]) -> Iterator[np.ndarray]:
    """The slices as one, in order, block by block: below the least of the last digests that are held, all is known."""
    while True:
        for r in readers:
            if not len(r.held) and r.at < r.end:
                r.more()
        open_ = [r for r in readers if r.at < r.end]
        bound = min((int(r.held["h0"][-1]) for r in open_), default=None)
        block = np.concatenate([r.below(bound) for r in readers]) if readers else np.empty(0, ENTRY)
        if len(block):
            yield folded(block)
        elif open_:  # a block that begins and ends with the bound: read on
            for r in open_:
                r.more()
        else:
            return


def _write(folder: str, blocks: Iterator[np.ndarray]) -> tuple[str, int]:
    """Writes a run under a name of its own, so that a task that is run again leaves other files alone."""
    name, n = f"{folder}/{uuid.uuid4().hex}.run", 0
    fs, path = filesystem(name)
    fs.create_dir(path.rsplit("/", 1)[0], recursive=True)
    with fs.open_output_stream(path) as out:
        for block in blocks:
            out.write(block.tobytes())
            n += len(block)
    return name, n


def _leaves(rows: DataFrame, folder: str) -> list[tuple[str, int]]:
    """(file, entries) of the runs of the first level: one a partition, or more where it has over RUN rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def leaf() -> pa.RecordBatch:
            name, n = _write(folder, iter([folded(np.concatenate(held))]))
            held.clear()
            return pa.RecordBatch.from_pylist([{"file": name, "entries": n}])

        for batch in batches:
            sha, chars, doc_id, row = batch.columns
            own = np.zeros(batch.num_rows, ENTRY)
            digits = np.frombuffer(b"".join(sha.to_pylist()), ">u8").reshape(-1, 4)
            for k, c in enumerate(_DIGEST):
                own[c] = digits[:, k]
            own["minus_chars"], own["no_id"], own["n"] = -chars.to_numpy(), doc_id.is_null().to_numpy(zero_copy_only=False), 1
            own["doc_id"], own["row"] = doc_id.fill_null(0).to_numpy(), row.to_numpy()
            held.append(own)
            if sum(map(len, held)) >= RUN:
                yield leaf()
        if held:
            yield leaf()

    found = rows.select(F.unhex("sha").alias("sha"), "chars", "doc_id", "row").transform(in_arrow, run, "file string, entries bigint")
    return sorted(tuple(r) for r in found.collect())  # a row a run


def _merge_round(spark: SparkSession, tasks: list[tuple], folder: str) -> dict[tuple[int, int], str]:
    """Runs ``tasks`` (run, part, low, high, files) and returns the file of each (run, part)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for t in batch.to_pylist():
                name, _ = _write(folder, merged([RunReader(f, int(t["low"]), int(t["high"])) for f in t["files"]]))
                yield pa.RecordBatch.from_pylist([{"run": t["run"], "part": t["part"], "file": name}])

    kinds = "run bigint, part bigint, low string, high string, files array<string>"
    # One task in each partition: dealt in turn from a single one.
    dealt = spark.createDataFrame(tasks, kinds).coalesce(1).repartition(len(tasks))
    return {(r["run"], r["part"]): r["file"] for r in dealt.transform(in_arrow, run, "run bigint, part bigint, file string").collect()}


def tree_merge(rows: DataFrame) -> DataFrame:
    """(sha, best, n) for each text of ``rows`` (``digest_rows``, written) that more than one row holds: its best row and their number."""
    spark, folder = rows.sparkSession, new_path(rows.sparkSession, "runs")
    # The tasks of a round: a power of two, so that the ranges of every round lie in those before.
    tasks = 1 << (max(1, int(spark.conf.get("spark.sql.shuffle.partitions"))) - 1).bit_length()
    runs = [[file] for file, _ in _leaves(rows, folder)]  # the files of each run, range by range
    while len(runs) > 1:
        left = -(-len(runs) // FAN)
        parts = 1 << max(0, (tasks // left).bit_length() - 1)
        todo = []
        for k in range(left * parts):
            run, part = divmod(k, parts)
            group = runs[run * FAN : (run + 1) * FAN]
            files = [files[part * len(files) // parts] for files in group]
            todo.append((run, part, str((part << 64) // parts), str((part + 1 << 64) // parts), files))
        done = _merge_round(spark, todo, folder)
        runs = [[done[run, part] for part in range(parts)] for run in range(left)]
    return _copies(spark, runs[0] if runs else [])


def _copies(spark: SparkSession, files: list[str]) -> DataFrame:
    """The entries of ``files`` with more than one row, as a written table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in (f for batch in batches for f in batch.column(0).to_pylist()):
            reader = RunReader(name, 0, 1 << 64)
            while reader.at < reader.end:
                reader.more()
                block = reader.below(None)
                block = block[block["n"] > 1]
                digits = np.stack([block[c] for c in _DIGEST], axis=1).astype(">u8").tobytes() if len(block) else b""
                sha = [digits[k : k + 32].hex() for k in range(0, len(digits), 32)]
                doc_id = pa.array(block["doc_id"], mask=block["no_id"].astype(bool))
                best = pa.StructArray.from_arrays([pa.array(block["minus_chars"]), doc_id, pa.array(block["row"])], names=["minus_chars", "doc_id", "row"])
                yield pa.RecordBatch.from_arrays([pa.array(sha, pa.string()), best, pa.array(block["n"])], names=["sha", "best", "n"])

    kinds = "sha string, best struct<minus_chars:bigint,doc_id:bigint,row:bigint>, n bigint"
    names = spark.createDataFrame([(f,) for f in files], "file string").coalesce(1).repartition(max(1, len(files)))
    table = written(names.transform(in_arrow, run, kinds), "copies")
    if files:
        fs, path = filesystem(files[0].rsplit("/", 1)[0])
        fs.delete_dir(path)
    return table


def _checked(docs: DataFrame) -> None:
    kind = docs.schema["doc_id"].dataType.typeName()
    if kind not in ("byte", "short", "integer", "long"):
        raise TypeError(f"doc_id must be an integer, not {kind}")


def exact_groups(docs: DataFrame) -> DataFrame:
    """Which rows of ``docs`` (doc_id, an integer, and text; other columns are not read) are copies.

    One row per row: doc_id, keep_id, group_size, kept, text_sha256.  Texts are equal when they are
    identical without the characters of BLANK; a null text counts as empty.  The row with the most
    code points in its own text stays, then the smallest doc_id (nulls last), then the first row
    read, so that of repeated rows exactly one is kept.  An empty table gives no rows.
    """
    _checked(docs)
    kind = docs.schema["doc_id"].dataType
    rows = written(digest_rows(docs), "digests")
    copies = tree_merge(rows)
    met = F.col("__n").isNotNull()
    named = copies.select("sha", "best", "n", F.col("n").alias("__n"))
    return join_spread(rows, named, ["sha"], rows.count(), ["row"], "left").select(
        F.col("doc_id").cast(kind).alias("doc_id"),
        F.when(met, F.col("best.doc_id")).otherwise(F.col("doc_id")).cast(kind).alias("keep_id"),
        F.coalesce("__n", F.lit(1).cast("bigint")).alias("group_size"),
        (~met | (F.col("row") == F.col("best.row"))).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )


def drop_copies(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns and without the copies: of equal texts the row of ``exact_groups`` stays.

    Only texts met more than once are looked up.  Repeated rows that agree in doc_id, text digest
    and length stand for one another; one of them stays.
    """
    _checked(docs)
    sha, number, chosen = free_names(docs, "__sha", "__row", "__best")
    rows = written(digest_rows(docs), "digests")
    total = rows.count()
    copies = tree_merge(rows).select(F.col("sha").alias(sha), F.struct("best.*").alias(chosen), "n")

    def is_best(chars):
        return F.col("doc_id").eqNullSafe(F.col(f"{chosen}.doc_id")) & (chars == -F.col(f"{chosen}.minus_chars"))

    again = join_spread(rows.withColumnRenamed("sha", sha), copies, [sha], total, ["row"]).where(is_best(F.col("chars"))).groupBy(sha).count().where("count > 1")
    twice = not again.isEmpty()
    discard(rows)
    joined = docs.withColumn(sha, F.sha2(normalised(F.col("text")), 256)).withColumn(number, F.monotonically_increasing_id())
    joined = join_spread(joined, copies, [sha], total, [number], "left")
    own = [F.col(f"`{c}`") for c in docs.columns]
    best = is_best(F.length(F.coalesce("text", F.lit(""))))
    if not twice:
        return joined.where(F.col(chosen).isNull() | best).select(*own)
    return joined.where(F.col(chosen).isNull()).select(*own).unionByName(joined.where(best).dropDuplicates([sha]).select(*own))
