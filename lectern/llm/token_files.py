"""Token-id files with Elias-Fano encoded document boundaries.

A shard file holds the ids of a range of documents, one after another, as 16- or 32-bit numbers,
and the boundaries between them as an Elias-Fano sequence: the low bits of each boundary in a packed
array, the high bits in unary, with samples of the positions of set bits.  A boundary is selected by
going to the nearest sample and counting set bits from there; two bits and the low bits are all that
a document costs, and there is no table of 64-bit offsets.  Offsets over the whole corpus are a
shard's base, from the manifest, plus a boundary within the shard.

    magic "EFT1", id width; ids; doc_ids (ascending, Elias-Fano above their least; nulls first);
    low bits; high bits; samples; footer of fixed size with the counts and places of all these
"""

from __future__ import annotations

import os
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lectern.llm.common import filesystem, in_arrow, new_path, slices, written
from lectern.llm.tokens import encoder

MAGIC = b"EFT1"
#: A sample for so many set bits.
SAMPLE = 256
_FOOTER = struct.Struct("<4sBQQQqQ" + "QQBQQQ" * 2)
_ONES = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).sum(axis=1).astype(np.uint8)


class EliasFano:
    """A non-decreasing sequence of numbers from 0 on: ``low`` bits packed, the rest in unary."""

    def __init__(self, n: int, width: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray) -> None:
        self.n, self.width, self.low, self.high, self.samples = n, width, low, high, samples

    @classmethod
    def build(cls, values: np.ndarray) -> EliasFano:
        values = np.asarray(values, np.uint64)
        n = len(values)
        top = int(values[-1]) if n else 0
        width = max(0, (top // n).bit_length() - 1) if n else 0
        bits = ((values[:, None] >> np.arange(width, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        low = np.packbits(bits.ravel(), bitorder="little")
        places = (values >> np.uint64(width)).astype(np.int64) + np.arange(n)
        unary = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        unary[places] = 1
        return cls(n, width, low, np.packbits(unary, bitorder="little"), places[::SAMPLE].astype("<u4" if n == 0 or places[-1] < 2**32 else "<u8"))

    def _place(self, k: int) -> int:
        """Where the k-th set bit of the high bits is: from its sample on, a byte at a time."""
        at = int(self.samples[k // SAMPLE])
        more = k % SAMPLE
        byte = at // 8
        first = int(self.high[byte]) >> (at % 8) << (at % 8)
        while (have := int(_ONES[first])) <= more:
            more -= have
            byte += 1
            first = int(self.high[byte])
        for _ in range(more):
            first &= first - 1
        return 8 * byte + (first & -first).bit_length() - 1

    def select(self, k: int) -> int:
        """The k-th number."""
        low = 0
        for j in range(self.width):
            at = k * self.width + j
            low |= (int(self.low[at // 8]) >> (at % 8) & 1) << j
        return (self._place(k) - k) << self.width | low

    def range(self, start: int, end: int) -> np.ndarray:
        """The numbers from ``start`` to before ``end``, decoded together between two selects."""
        if start >= end:
            return np.empty(0, np.int64)
        a, b = self._place(start), self._place(end - 1)
        bits = np.unpackbits(self.high[a // 8 : b // 8 + 1], bitorder="little")
        places = np.flatnonzero(bits[a % 8 :])[: end - start] + a
        low = np.zeros(end - start, np.int64)
        if self.width:
            p, q = start * self.width, end * self.width
            own = np.unpackbits(self.low[p // 8 : -(-q // 8)], bitorder="little")[p % 8 :][: q - p].reshape(-1, self.width)
            low = own.astype(np.int64) @ (1 << np.arange(self.width, dtype=np.int64))
        return (places - np.arange(start, end)) << self.width | low

    def parts(self) -> list[bytes]:
        return [self.low.tobytes(), self.high.tobytes(), self.samples.tobytes()]


class ShardWriter:
    """Writes a shard: ids as they come, boundaries and document ids at the end."""

    def __init__(self, uri: str, width: int) -> None:
        self.width, self.bounds, self.keys, self.nulls = width, [0], [], 0
        fs, path = filesystem(uri)
        fs.create_dir(os.path.dirname(path), recursive=True)
        self.file = fs.open_output_stream(path)
        self.file.write(MAGIC + struct.pack("<I", width))

    def add(self, key: int | None, ids: bytes) -> None:
        x = np.frombuffer(ids, "<u4")
        self.file.write(x.astype(f"<u{self.width}").tobytes() if self.width != 4 else ids)
        self.bounds.append(self.bounds[-1] + len(x))
        if key is None:
            self.nulls += 1
        else:
            self.keys.append(key)

    def close(self) -> tuple[int, int]:
        """(documents, ids) of the shard."""
        base = self.keys[0] if self.keys else 0
        made = [EliasFano.build(np.array(self.keys, np.int64) - base if self.keys else []), EliasFano.build(np.array(self.bounds))]
        at = 8 + self.width * self.bounds[-1]
        footer = [MAGIC, self.width, len(self.bounds) - 1, self.bounds[-1], self.nulls, base, at]
        for ef in made:
            parts = ef.parts()
            for x in parts:
                self.file.write(x)
            footer += [ef.n, at, ef.width, *map(len, parts)]
            at += sum(map(len, parts))
        self.file.write(_FOOTER.pack(*footer))
        self.file.close()
        return len(self.bounds) - 1, self.bounds[-1]


class ShardReader:
    """Reads a shard: any document by select, or all in blocks."""

    def __init__(self, uri: str) -> None:
        fs, path = filesystem(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, self.documents, self.ids, self.nulls, self.base, _, *rest = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is no shard")
        self.keys, self.bounds = self._sequence(rest[:6]), self._sequence(rest[6:])

    def _sequence(self, f: list[int]) -> EliasFano:
        n, at, width, low, high, samples = f
        raw = self.file.read_at(low + high + samples, at)
        count = -(-n // SAMPLE)
        kind = "<u8" if count and samples == 8 * count else "<u4"
        return EliasFano(n, width, np.frombuffer(raw[:low], np.uint8), np.frombuffer(raw[low : low + high], np.uint8), np.frombuffer(raw[low + high :], kind))

    def document(self, k: int) -> tuple[int, bytes]:
        """Where the k-th document begins in the shard, and its ids."""
        start, end = self.bounds.select(k), self.bounds.select(k + 1)
        return start, self._ids(start, end)

    def _ids(self, start: int, end: int) -> bytes:
        raw = self.file.read_at(self.width * (end - start), 8 + self.width * start)
        return np.frombuffer(raw, f"<u{self.width}").astype("<u4").tobytes()

    def blocks(self, documents: int = 512) -> Iterator[tuple[list[int | None], np.ndarray, np.ndarray]]:
        """(keys, boundaries, ids) of so many documents at a time."""
        for a in range(0, self.documents, documents):
            b = min(self.documents, a + documents)
            bounds = self.bounds.range(a, b + 1)
            empty = max(0, min(b, self.nulls) - a)
            keys = [None] * empty + (self.keys.range(max(a, self.nulls) - self.nulls, max(b, self.nulls) - self.nulls) + self.base).tolist()
            raw = self.file.read_at(self.width * int(bounds[-1] - bounds[0]), 8 + self.width * int(bounds[0]))
            yield keys, bounds, np.frombuffer(raw, f"<u{self.width}")


def write_shards(docs: DataFrame, path: str, end_id: int, folder: str | None = None, shards: int | None = None) -> DataFrame:
    """Writes the ids of every text of ``docs`` (doc_id, text) in ascending doc_id order (nulls first).

    Texts are dealt to shards by range of doc_id before they are encoded.  A task writes its own
    file, named by its attempt, so that a task that is run again leaves the files of others alone;
    the manifest names the files that count.  Returns it: shard, file, documents, ids, base (ids in
    all shards before).  Null texts are empty: their documents hold ``end_id`` alone.  Rows that
    repeat a doc_id are documents of their own, in the order of a hash of their texts.  ``doc_id`` must
    be an integer, as the files hold it in 64 bits.
    """
    if docs.schema["doc_id"].dataType.typeName() not in ("byte", "short", "integer", "long"):
        raise TypeError("doc_id must be an integer")
    folder = folder or new_path(docs.sparkSession, "shards")
    end = np.array([end_id], "<u4").tobytes()
    parts = shards or int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, context, writer = encoder(path), TaskContext.get(), None
        width = 2 if max(len(encode.strings), end_id + 1) <= 1 << 16 else 4
        name = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.eft"
        for part in slices(batches):
            for key, text in zip(*[c.to_pylist() for c in part.columns], strict=True):
                writer = writer or ShardWriter(name, width)
                writer.add(key, encode(text) + end)
        if writer:
            n, ids = writer.close()
            yield pa.RecordBatch.from_pylist([{"shard": context.partitionId(), "file": name, "documents": n, "ids": ids}])

    dealt = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").repartitionByRange(parts, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    manifest = written(dealt.transform(in_arrow, run, "shard bigint, file string, documents bigint, ids bigint"), "manifest")
    before = F.sum("ids").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))  # a row per file
    return manifest.withColumn("base", F.coalesce(before, F.lit(0)))


def read_shards(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document in the files of ``manifest``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                for keys, bounds, ids in ShardReader(row["file"]).blocks():
                    raw = ids.astype("<u4").tobytes()
                    ends = (4 * (bounds - bounds[0])).tolist()
                    crc = [zlib.crc32(raw[a:b]) for a, b in zip(ends[:-1], ends[1:], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(keys, pa.int64()), pa.array(bounds[:-1] + row["base"]), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                        names=["doc_id", "start", "n_tokens", "ids_crc32"],
                    )

    parts = int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    files = manifest.select("file", "base").repartition(parts, "file")
    return files.transform(in_arrow, run, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")
