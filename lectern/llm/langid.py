"""Language ID by bit-sliced n-gram Bloom filters.

One Bloom filter per language, over the character n-grams that are usual in it, laid side by side:
cell k of the table holds bit l when cell k of language l's filter is set.  Looking an n-gram up
takes the bitwise "and" of a few cells, whose set bits are all languages that contain it.  For each
language the n-grams of a text that it contains are counted, corrected for what its filter lets
through by chance, and the greatest share decides.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import in_arrow, map_rows, slices

#: Lengths of the n-grams, in letters; words are set off by a blank on either side.
LENGTHS = (2, 3, 4)
#: Cells of the table (a power of two) and cells looked up for an n-gram.
CELLS, PROBES = 1 << 17, 3
#: Documents that a language is learned from, about: a bounded sample of the labelled rows, by hash of the doc_id.
SAMPLE_DOCUMENTS = 4000
#: N-grams of a language: those in the most documents.
NGRAMS = 6000
#: An n-gram belongs to a language if at least this share of the language's documents hold it.
LEAST_SHARE = 0.02
#: N-grams of a language, counted once a document, that a task holds before it hands their counts on.
FLUSH = 1 << 21
#: Characters of one lookup; longer texts are counted in parts.
PART = 1 << 16

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], dtype=np.uint64)
_LETTER = re.compile(r"[^\W\d_]+")


def ngrams(text: str) -> np.ndarray:
    """Hashes of all n-grams of ``text``, one for each place, by length."""
    letters = " " + " ".join(_LETTER.findall(text.lower())) + " "
    x = np.frombuffer(letters.encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    out, h = [], x * _ODD[0]
    for n in range(2, max(LENGTHS) + 1):
        if len(x) < n:
            break
        h = (h[: len(x) - n + 1] ^ (x[n - 1 :] * _ODD[1])) * _ODD[2]
        h ^= h >> np.uint64(31)
        if n in LENGTHS:
            # An n-gram with a blank inside spans two words.
            inner = np.ones(len(h), bool)
            for k in range(1, n - 1):
                inner &= x[k : k + len(h)] != 32
            out.append(h[inner])
    return np.concatenate(out) if out else np.empty(0, np.uint64)


def _cells(h: np.ndarray, k: int, cells: int) -> np.ndarray:
    # A factor of its own for each probe, and a shift between: sums and shifts alone would give the same cell, moved.
    x = h * _ODD[k % len(_ODD)] + np.uint64(k // len(_ODD))
    x = (x ^ (x >> np.uint64(32))) * _ODD[(k + 1) % len(_ODD)]
    return (x >> np.uint64(64 - (cells.bit_length() - 1))).astype(np.int64)


@dataclass
class LanguageFilters:
    """The table, the languages by bit, and each filter's rate of false positives."""

    languages: list[str]
    table: np.ndarray
    false: np.ndarray

    @classmethod
    def build(cls, grams: dict[str, np.ndarray], cells: int = CELLS) -> LanguageFilters:
        """``grams``: the n-gram hashes of each language."""
        languages = sorted(grams)
        slices_ = -(-max(1, len(languages)) // 64)
        table = np.zeros((slices_, cells), np.uint64)
        false = []
        for bit, language in enumerate(languages):
            own = np.zeros(cells, bool)
            for k in range(PROBES):
                own[_cells(grams[language], k, cells)] = True
            table[bit // 64] |= own.astype(np.uint64) << np.uint64(bit % 64)
            false.append(own.mean() ** PROBES)
        return cls(languages, table, np.array(false))

    def counts(self, text: str) -> tuple[np.ndarray, int]:
        """The n-grams of ``text`` that each language contains, and the number of all."""
        found, total = np.zeros(len(self.languages)), 0
        for at in range(0, len(text), PART):
            h = ngrams(text[at : at + PART])
            total += len(h)
            for s in range(len(self.table)):
                mask = self.table[s][_cells(h, 0, self.table.shape[1])]
                for k in range(1, PROBES):
                    mask &= self.table[s][_cells(h, k, self.table.shape[1])]
                for bit in range(min(64, len(self.languages) - 64 * s)):
                    found[64 * s + bit] += np.count_nonzero(mask & np.uint64(1 << bit))
        return found, total

    def predict(self, text: str | None) -> tuple[str, float]:
        """(language, share of n-grams): "und" and 0 where there is no letter to go by."""
        if not text or not _LETTER.search(text) or not self.languages:
            return "und", 0.0
        found, total = self.counts(text)
        share = np.clip((found / max(1, total) - self.false) / (1 - self.false), 0, 1)
        best = int(share.argmax())
        return self.languages[best], float(share[best])


def fit(labelled: DataFrame) -> LanguageFilters:
    """Learns from ``labelled`` (doc_id, text, lang): texts without letters and null languages are left out.

    At most about SAMPLE_DOCUMENTS documents of a language count, chosen by a hash of their doc_id
    that has nothing to do with the text; of a language with fewer, all do.
    """
    kept = labelled.where("lang IS NOT NULL AND text IS NOT NULL").select("doc_id", "text", "lang")
    sizes = kept.groupBy("lang").agg(F.count("*").alias("n"))
    languages = {r[0]: r[1] for r in sizes.collect()}  # a row per language
    share = F.create_map(*[F.lit(y) for lang, n in languages.items() for y in (lang, min(1.0, SAMPLE_DOCUMENTS / n))]) if languages else F.create_map()
    draw = F.pmod(F.xxhash64("doc_id", F.lit(17)), F.lit(1 << 20)) / (1 << 20)
    sample = kept.where(draw < share[F.col("lang")]) if languages else kept

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, list] = {}
        number: dict[str, int] = {}
        held: dict[str, int] = {}

        def flush(lang: str) -> pa.RecordBatch:
            h, n = np.unique(np.concatenate(seen.pop(lang)), return_counts=True)
            held.pop(lang)
            return pa.RecordBatch.from_arrays([pa.array([lang] * (len(h) + 1)), pa.array([None, *h.view(np.int64).tolist()], pa.int64()), pa.array([number.pop(lang), *n.tolist()], pa.int64())], names=["lang", "gram", "n"])

        for part in slices(batches):
            for text, lang in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                if not _LETTER.search(text):
                    continue
                seen.setdefault(lang, []).append(np.unique(np.concatenate([ngrams(text[at : at + PART]) for at in range(0, len(text), PART)])))
                number[lang] = number.get(lang, 0) + 1
                held[lang] = held.get(lang, 0) + len(seen[lang][-1])
                if held[lang] >= FLUSH:
                    yield flush(lang)
        for lang in list(seen):
            yield flush(lang)

    counted = sample.select("text", "lang").transform(in_arrow, count, "lang string, gram bigint, n bigint")
    totals = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    whole = totals.where("gram IS NULL").select("lang", F.col("n").alias("documents"))
    usual = totals.where("gram IS NOT NULL").join(whole, "lang").where(F.col("n") >= F.greatest(F.lit(1), LEAST_SHARE * F.col("documents")))
    # Per language the NGRAMS in most documents; as an aggregate, so that no language's n-grams meet unreduced.
    best = usual.groupBy("lang").agg(F.slice(F.sort_array(F.collect_list(F.struct("n", "gram")), asc=False), 1, NGRAMS).alias("g"))
    grams = {r[0]: np.array([x[1] for x in r[1]], np.int64).view(np.uint64) for r in best.collect()}  # at most NGRAMS a language
    return LanguageFilters.build(grams)


def predict(docs: DataFrame, model: LanguageFilters, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, lang_pred, score) of every whole text.

    The prediction is "und" with score 0 for null texts and those without a letter.  Ties go to the
    language that comes first in order.  Other columns are not read; an empty table gives no rows.
    """
    held = docs.sparkSession.sparkContext.broadcast(model)  # of fixed size
    kind = docs.schema[id_col].dataType.simpleString()

    def rows(m, keys, texts):
        found = [m.predict(t) for t in texts]
        return keys, [a for a, _ in found], [b for _, b in found]

    return map_rows(docs.select(id_col, text_col), rows, f"`{id_col}` {kind}, lang_pred string, score double", lambda: held.value)


def fold(doc_id) -> F.Column:
    """The remainder by 4 of the crc32 of a doc_id as text."""
    return F.crc32(F.col(doc_id).cast("string").cast("binary")) % 4


def identify(docs: DataFrame) -> DataFrame:
    """Learns from the rows of ``docs`` whose fold is not 2 and predicts all: doc_id, held_out, lang_pred, score.

    A null doc_id belongs to no fold: such rows are not learned from, and held_out is null.
    """
    model = fit(docs.where(fold("doc_id") != 2))
    return predict(docs, model).select("doc_id", (fold("doc_id") == 2).alias("held_out"), "lang_pred", "score")


def recognised(model: LanguageFilters, text: str | None) -> bool:
    """Whether a text has a letter and, if ``model`` has any language, an n-gram of one (a score above 0)."""
    if not model.languages:
        return bool(text and _LETTER.search(text))
    return model.predict(text)[1] > 0


def keep_identified(docs: DataFrame) -> DataFrame:
    """``docs`` with all its columns, without the rows in which no language is ``recognised``.

    Where no language can be learned, all texts with a letter stay.
    """
    model = fit(docs.where(fold("doc_id") != 2))
    held = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches):
            keep = [recognised(held.value, t) for t in part.column(at).to_pylist()]
            yield part.filter(pa.array(keep, pa.bool_()))

    return docs.transform(in_arrow, run, docs.schema)
