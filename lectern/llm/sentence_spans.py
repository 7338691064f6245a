"""Substring dedup by sliding sentence spans.

A text is cut into sentences: they end with their stops, commas, colons, semicolons or line ends,
and a longer stretch without any ends at words chosen by their content, so that a passage falls
into the same sentences wherever it is pasted.  From every sentence the shortest run of several
consecutive sentences that holds enough words is hashed, all runs of the corpus are joined on their
hashes, and a sentence goes where a run that covers it stands elsewhere before: in a document of
smaller doc_id, or earlier in the same one.  Runs are compared without regard to the white space
around and within sentences; sentences without any other character belong to the text but to no run.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import discard, free_names, in_arrow, join_spread, slices, written

#: What ends a sentence, beside the line end: ASCII, full-width, Arabic and Indic signs.
STOPS = ".!?,;:。！？，；：、؟،؛।"
#: A sentence up to and with its stops or line ends; a text is the sum of these.
SENTENCE = re.compile(rf"[^{STOPS}\n]*[{STOPS}\n]+|[^{STOPS}\n]+")
#: White space within a sentence.
BLANK = " \t\n\x0b\x0c\r"
#: Words after which a stretch is long enough to be ended by a word; such are one word in LONG.
LONG = 8
#: Sentences and words that a run holds at least.
SENTENCES, WORDS = 3, 15

_WORD = re.compile(rf"[{BLANK}]*[^{BLANK}]+|[{BLANK}]+")
_ODD = np.array([0x9E3779B97F4A7C17, 0xD6E8FEB86659FD93], np.uint64)


def _is_end(word: bytes) -> bool:
    """Whether a word ends a long stretch: the first hex digit of its MD5 is 0 or 1."""
    return hashlib.md5(word, usedforsecurity=False).digest()[0] < 0x20


class Ends(dict):
    """Remembers for words whether they end a long stretch."""

    def __missing__(self, word: bytes) -> bool:
        if len(self) > 200_000:
            self.clear()
        found = self[word] = _is_end(word)
        return found


def sentences(text: str | None, ends: Ends | None = None) -> list[tuple[str, list[bytes]]]:
    """(sentence, its words in UTF-8), in order; the sentences add up to the text."""
    ends, out = Ends() if ends is None else ends, []
    for part in SENTENCE.findall(text or ""):
        words = part.encode("utf-8", "surrogatepass").split()
        if len(words) <= LONG:
            out.append((part, words))
            continue
        held, own = [], []
        for piece, word in zip(_WORD.findall(part), [*words, b""], strict=False):
            held.append(piece)
            own += [word] if word else []
            if word and ends[word]:
                out.append(("".join(held), own))
                held, own = [], []
        if held:
            out.append(("".join(held), own))
    return out


def words_of(text: str | None, ends: Ends) -> list[list[bytes]]:
    """The words of those ``sentences`` that have any."""
    out = []
    for part in SENTENCE.findall(text or ""):
        words = part.encode("utf-8", "surrogatepass").split()
        begin = 0
        if len(words) > LONG:
            for k in [k for k, w in enumerate(words, 1) if ends[w]]:
                out.append(words[begin:k])
                begin = k
            words = words[begin:]
        if words:
            out.append(words)
    return out


def _run_ends(counts: np.ndarray, least: int, words: int) -> np.ndarray:
    """For each sentence the end of its run, past the last sentence where there is none."""
    n = len(counts)
    before = np.concatenate([[0], np.cumsum(counts)])
    return np.maximum(np.searchsorted(before, before[:n] + words), np.arange(n) + least)


def spans_of(text: str | None, least: int = SENTENCES, words: int = WORDS, ends: Ends | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(places, first halves, second halves): the runs' first sentences, counted among those with a word, and 128-bit hashes.

    The sentences' hashes are the digits of a number whose part, shifted to its place, is the run's hash.
    """
    own = words_of(text, Ends() if ends is None else ends)
    n, last = len(own), _run_ends(np.array([len(w) for w in own], np.int64), least, words) if own else np.empty(0, np.int64)
    at = np.flatnonzero(last <= n)
    if not len(at):
        return np.empty(0, np.int32), np.empty(0, np.int64), np.empty(0, np.int64)
    digits = np.frombuffer(b"".join([xxhash.xxh3_128_digest(b" ".join(w)) for w in own]), np.uint64).reshape(n, 2)
    halves = []
    for digit, odd in zip(digits.T, _ODD, strict=True):
        power = np.cumprod(np.full(n, odd, np.uint64))
        back = np.cumprod(np.full(n, pow(int(odd), -1, 1 << 64), np.uint64))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(digit * power)])
        x = (sums[last[at]] - sums[at]) * back[at] * odd
        x = (x ^ (last[at] - at).astype(np.uint64)) * _ODD[0]
        halves.append((x ^ (x >> np.uint64(31))).view(np.int64))
    return at.astype(np.int32), *halves


def covered(counts: list[int], places, least: int, words: int) -> set[int]:
    """The sentences, counted among those with a word, that runs from ``places`` hold."""
    ends = _run_ends(np.array(counts, np.int64), least, words)
    return {k for p in places for k in range(p, ends[p])}


def repeated_spans(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """(doc_id, text_hash, starts): the places (see ``spans_of``) of runs that stand elsewhere before.

    A document is a doc_id and a text; rows that repeat both are one document.  The first place of
    a run is that of the least (doc_id, text hash, place), null ids last.  One half of the hashes is
    counted first, by partial sums; only runs met more than once go on with both halves and their
    places, and the rows of a run that makes up a large share of all are spread over tasks.
    """

    def hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = Ends()
        for part in slices(batches):
            found = [spans_of(t, least, words, ends) for t in part.column(2).to_pylist()]
            offsets = pa.array(np.cumsum([0, *(len(x[0]) for x in found)]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([x[k] for x in found]))) for k in range(3)]
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *lists], names=["doc_id", "text_hash", "pos", "a", "b"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    named = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    spans = written(named.transform(in_arrow, hashes, f"doc_id {kind}, text_hash bigint, pos array<int>, a array<bigint>, b array<bigint>"), "spans")
    met = written(spans.select(F.explode("a").alias("a")).groupBy("a").agg(F.count("*").alias("n")).where("n > 1"), "met")
    runs = spans.agg(F.sum(F.size("a"))).first()[0] or 0
    each = spans.select("doc_id", "text_hash", F.inline(F.arrays_zip("pos", "a", "b")))
    again = written(join_spread(each, met, ["a"], runs, ["doc_id", "text_hash", "pos"], "left_semi"), "again")
    discard(spans, met)

    place = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash", "pos")
    first = again.groupBy("a", "b").agg(F.min(place).alias("first"), F.max(place).alias("last"), F.count("*").alias("n"))
    first = written(first.where("first != last").select("a", "b", "first", "n"), "first")
    later = join_spread(again, first, ["a", "b"], runs, ["doc_id", "text_hash", "pos"]).where(place != F.col("first"))
    starts = written(later.groupBy("doc_id", "text_hash").agg(F.collect_set("pos").alias("starts")), "starts")
    discard(again, first)
    return starts


def cut_repeats(docs: DataFrame, least: int = SENTENCES, words: int = WORDS) -> DataFrame:
    """``docs`` (doc_id, text and any other columns) without sentences that repeat in runs.

    From every sentence a run goes on until it has ``least`` sentences and ``words`` words (parts
    between white space); where the text ends before, there is none.

    Adds n_sentences (those with a word), n_removed and removed (their spans, as an array of start
    and end in code points of the former text, neighbours joined) and replaces text by what is left
    of it, character for character.  Null and empty texts, and those without a run, stay as they
    are.  Rows with a null doc_id come after all others.  Rows that repeat doc_id and text are one
    document and get the same result.  An empty table gives no rows.
    """
    key, hashed, begun_at, of_text = free_names(docs, "__id", "__hash", "__starts", "__own")
    starts = repeated_spans(docs, least, words).select(F.col("doc_id").alias(key), F.col("text_hash").alias(hashed), F.col("starts").alias(begun_at))
    named = docs.withColumn(of_text, F.xxhash64("text"))
    joined = named.join(starts, F.col("doc_id").eqNullSafe(F.col(key)) & (F.col(of_text) == F.col(hashed)), "left").drop(key, hashed, of_text)
    extra = "n_sentences bigint, n_removed bigint, removed array<struct<start:bigint,end:bigint>>"
    keep = [c for c in docs.columns if c not in ("n_sentences", "n_removed", "removed")]
    joined = joined.select(*[F.col(f"`{c}`") for c in keep], begun_at)
    at = keep.index("text")
    span = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ends = Ends()
        for part in slices(batches):
            texts, counts, removed, spans = [], [], [], []
            for text, begun in zip(part.column(at).to_pylist(), part.column(len(keep)).to_pylist(), strict=True):
                if not begun:
                    counts.append(len(words_of(text, ends)))
                    removed.append(0)
                    spans.append([])
                    texts.append(text)
                    continue
                found = sentences(text, ends)
                own = [k for k, (_, w) in enumerate(found) if w]
                gone = {own[k] for k in covered([len(found[k][1]) for k in own], begun, least, words)}
                counts.append(len(own))
                removed.append(len(gone))
                spans.append(_joined(found, gone))
                texts.append("".join([s for k, (s, _) in enumerate(found) if k not in gone]))
            columns = list(part.columns[: len(keep)])
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(counts, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans, span)], names=[*keep, "n_sentences", "n_removed", "removed"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in keep)
    return joined.transform(in_arrow, cut, f"{schema}, {extra}")


def _joined(found: list[tuple[str, list[bytes]]], gone: set[int]) -> list[dict]:
    """The spans of the sentences ``gone``."""
    spans, at = [], 0
    for k, (s, _) in enumerate(found):
        if k in gone:
            if spans and spans[-1]["end"] == at:
                spans[-1]["end"] = at + len(s)
            else:
                spans.append({"start": at, "end": at + len(s)})
        at += len(s)
    return spans


#: The same in DuckDB's SQL, with the constants above.
ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
p AS (
  SELECT doc_id, unnest(x) AS part, unnest(range(1, len(x) + 1)) AS k
  FROM (SELECT doc_id, regexp_extract_all(text, '[^STOPS\n]*[STOPS\n]+|[^STOPS\n]+') AS x FROM d)
), t AS (
  SELECT doc_id, k, len(list_filter(x, lambda w: trim(w, BLANK) <> '')) AS n, unnest(x) AS tok, unnest(range(1, len(x) + 1)) AS j
  FROM (SELECT doc_id, k, regexp_extract_all(part, '[ \t\n\x0b\x0c\r]*[^ \t\n\x0b\x0c\r]+|[ \t\n\x0b\x0c\r]+') AS x FROM p)
), c AS (
  SELECT *, trim(tok, BLANK) AS w, n > 8 AND trim(tok, BLANK) <> '' AND substr(md5(trim(tok, BLANK)), 1, 1) IN ('0', '1') AS ends FROM t
), g AS (
  SELECT *, coalesce(sum(ends::INT) OVER (PARTITION BY doc_id, k ORDER BY j ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS piece FROM c
), s AS (
  SELECT doc_id, k, piece, string_agg(tok, '' ORDER BY j) AS raw, string_agg(w, ' ' ORDER BY j) FILTER (w <> '') AS txt, count(*) FILTER (w <> '') AS words
  FROM g GROUP BY doc_id, k, piece
), w AS (
  SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY k, piece) AS pos,
         coalesce(sum(words) OVER (PARTITION BY doc_id ORDER BY k, piece ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM s WHERE words > 0
), r AS (
  SELECT doc_id, pos, before, count(*) OVER near AS n_near, sum(words) OVER near AS w_near, list(txt) OVER near AS t_near, count(*) OVER three AS n_three, list(txt) OVER three AS t_three, sum(words) OVER three AS w_three
  FROM w WINDOW near AS (PARTITION BY doc_id ORDER BY before RANGE BETWEEN CURRENT ROW AND 14 FOLLOWING), three AS (PARTITION BY doc_id ORDER BY before ROWS BETWEEN CURRENT ROW AND 2 FOLLOWING)
), f AS (
  SELECT doc_id, pos, n, row_number() OVER (PARTITION BY array_to_string(span, chr(31)) ORDER BY doc_id, pos) AS nth
  FROM (SELECT doc_id, pos, greatest(n_near, 3) AS n, CASE WHEN n_near > 2 THEN t_near ELSE t_three END AS span FROM r
        WHERE CASE WHEN n_near > 2 THEN w_near ELSE w_three END >= 15 AND n_three = 3)
), gone AS (
  SELECT DISTINCT doc_id, pos + unnest(range(0, n)) AS pos FROM f WHERE nth > 1
), cut AS (
  SELECT w.doc_id, w.k, w.piece FROM w JOIN gone USING (doc_id, pos)
), kept AS (
  SELECT s.doc_id, string_agg(s.raw, '' ORDER BY s.k, s.piece) AS text FROM s LEFT JOIN cut USING (doc_id, k, piece) WHERE cut.k IS NULL GROUP BY s.doc_id
)
SELECT d.doc_id, coalesce(kept.text, '') AS text, coalesce(a.n, 0) AS n_sentences, coalesce(b.n, 0) AS n_removed
FROM d LEFT JOIN kept USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM w GROUP BY doc_id) a USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n FROM cut GROUP BY doc_id) b USING (doc_id)""".replace("STOPS", STOPS).replace("BLANK", "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)")
