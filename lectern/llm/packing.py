"""Vector best-fit packing of whole corpora.

Documents become pieces of at most ``capacity`` tokens.  A bin (sequence) has three capacities:
tokens, documents and attention cost (the sum of the squares of its pieces' lengths).  Pieces are
placed longest first; of the bins with room under every constraint the one is taken whose residual
vector suits the piece best, by the least weighted residual norm or the greatest weighted dot
product.

Which bin a piece of a given length gets depends on its length alone.  So the plan is made once for
the whole corpus from the histogram of lengths, with at most ``capacity`` entries whatever the size
of the input: bins in the same state form a class, and as many pieces of a length as the class has
bins are placed in one step.  A step is a run of consecutive ranks among the pieces of one length,
sent to a run of consecutive sequences.  The pieces themselves are ranked where they lie, by counts
per partition and length, and find their step by binary search.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import in_arrow, written
from lectern.llm.tokens import encoder


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, part, slot): the pieces of every document.

    ``slot`` counts the pieces of one length within the partition ``part``.  Null texts are empty
    and so consist of ``end_id`` alone.
    """
    end = np.array([end_id], "<u4").tobytes()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, seen, part_id = encoder(path), [0] * (capacity + 1), TaskContext.get().partitionId()
        for part in batches:
            row, number, start, length, crc, slot = [], [], [], [], [], []
            for k, ids in enumerate(encode.encode_all(x.as_py() for x in part.column(1))):
                ids += end
                for p, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    n = len(own) // 4
                    row.append(k)
                    number.append(p)
                    start.append(at // 4)
                    length.append(n)
                    crc.append(zlib.crc32(own))
                    slot.append(seen[n])
                    seen[n] += 1
            long = lambda x: pa.array(x, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(pa.array(row, pa.int64())), pa.array(number, pa.int32()), long(start), pa.array(length, pa.int32()), long(crc), pa.array([part_id] * len(row), pa.int32()), long(slot)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "slot"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").transform(in_arrow, run, f"doc_id {kind}, piece int, start bigint, length int, ids_crc32 bigint, part int, slot bigint")


def plan(histogram: dict[int, int], capacity: int, documents: int | None = None, attention: int | None = None, weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm") -> np.ndarray:
    """The steps that place all pieces: rows (length, first rank, count, first sequence, offset).

    ``documents`` and ``attention`` are a bin's capacities besides tokens; where None they never
    bind.  ``rule`` is "norm" (least weighted norm of what is left) or "dot" (greatest weighted dot
    product of the piece and what is left).
    """
    documents = documents or capacity
    attention = attention or capacity * capacity
    full = np.array([capacity, documents, attention], float)
    w = np.array(weights) / full**2
    # Classes of bins: what is left of each capacity, number of bins, first sequence.
    left = np.empty((0, 3), np.int64)
    bins = np.empty(0, np.int64)
    first = np.empty(0, np.int64)
    steps: list[tuple[int, int, int, int, int]] = []
    opened = 0
    for length in sorted(histogram, reverse=True):
        count, rank = int(histogram[length]), 0
        need = np.array([length, 1, length * length], np.int64)
        if length > capacity or (need > [capacity, documents, attention]).any():
            raise ValueError(f"a piece of {length} tokens fits no bin")
        while count:
            fits = np.flatnonzero((left >= need).all(axis=1)) if len(left) else []
            if len(fits):
                rest = left[fits] - need if rule == "norm" else left[fits]
                score = (rest * rest * w).sum(axis=1) if rule == "norm" else -(rest * need * w).sum(axis=1)
                k = fits[int(score.argmin())]
                n = min(count, int(bins[k]))
                steps.append((length, rank, n, int(first[k]), capacity - int(left[k, 0])))
                if n < bins[k]:  # the first n bins leave the class
                    left = np.vstack([left, left[k] - need])
                    bins, first = np.append(bins, n), np.append(first, first[k])
                    bins[k] -= n
                    first[k] += n
                else:
                    left[k] -= need
            else:
                each = max(1, min(capacity // length, documents, attention // (length * length)))
                whole, more = divmod(count, each)
                if whole:
                    n, placed = whole, each
                else:
                    n, placed = 1, more
                for j in range(placed):
                    steps.append((length, rank + j * n, n, opened, j * length))
                left = np.vstack([left, full.astype(np.int64) - placed * need])
                bins, first = np.append(bins, n), np.append(first, opened)
                opened += n
                n *= placed
            count -= n
            rank += n
        useful = (left > 0).all(axis=1)
        left, bins, first = left[useful], bins[useful], first[useful]
    return np.array(sorted(steps), np.int64).reshape(-1, 5)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, **constraints) -> DataFrame:
    """Packs every document of ``docs`` (doc_id, text; other columns are not read) into sequences.

    A document is its ids by the tokenizers file at ``path`` and then ``end_id``; one of more than
    ``capacity`` tokens is cut into pieces.  ``constraints`` go to ``plan``.  Returns a row per
    piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.  Repeated rows and null ids
    are packed as they stand; an empty table gives no rows.
    """
    held = written(pieces(docs, path, capacity, end_id), "pieces")
    counts = held.groupBy("part", "length").agg(F.count("*").alias("n"))
    counts = written(counts, "counts")
    before = F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("part", "length", F.coalesce(before, F.lit(0)).alias("before"))
    histogram = {r[0]: r[1] for r in counts.groupBy("length").agg(F.sum("n")).collect()}  # at most capacity rows
    steps = plan(histogram, capacity, **constraints)
    shared = docs.sparkSession.sparkContext.broadcast(steps)  # bounded by the number of lengths and bin states

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = shared.value
        keys = s[:, 0] * (1 << 44) + s[:, 1]
        for batch in batches:
            length, rank = batch.column(3).to_numpy().astype(np.int64), batch.column(5).to_numpy()
            at = np.searchsorted(keys, length * (1 << 44) + rank, side="right") - 1
            step = s[at]
            yield pa.RecordBatch.from_arrays([*batch.columns[:5], pa.array(step[:, 3] + rank - step[:, 1]), pa.array(step[:, 4])], names=[*batch.schema.names[:5], "sequence_id", "offset"])

    ranked = held.join(starts, ["part", "length"]).select("doc_id", "piece", "start", "length", "ids_crc32", (F.col("slot") + F.col("before")).alias("rank"))
    kind = docs.schema["doc_id"].dataType.simpleString()
    found = ranked.transform(in_arrow, run, f"doc_id {kind}, piece int, start bigint, length int, ids_crc32 bigint, sequence_id bigint, offset bigint")
    return found.withColumn("length", F.col("length").cast("bigint"))
