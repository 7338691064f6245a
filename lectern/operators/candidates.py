"""Recordings of an edition that lack timing and could be aligned with its text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators import joins, rollups

#: Kinds of recordings; tiers by generation and format; texts in order of preference; endings of encodings.
AUDIO = ("audio", "audio_drama", "audio_stream", "audio_drama_stream")
TIERS = {"1DA": 0, "2DA": 1, "1SA": 2, "2SA": 3}
TEXTS = {"text_plain": 0, "text_format": 1, "text_json": 2, "text_usx": 3}
ENCODINGS = ["-opus16", "-opus32", "-mp3", "-64", "-128", "16"]
#: The testaments that a size names, for parts of a canon.
SIZES = {"C": ("nt", "ot"), "NTOTP": ("nt", "ot"), "NT": ("nt",), "NTP": ("nt",), "OT": ("ot",), "OTP": ("ot",)}


def _chosen(c: Column, values: dict) -> Column:
    """The value of a key, null for another key; a chain of comparisons, all in the JVM."""
    out = F.when(F.lit(False), F.lit(None))
    for key, value in values.items():
        out = out.when(c == key, value if isinstance(value, Column) else F.lit(value))
    return out


def testaments(canon: Column, size: Column) -> Column:
    """The testaments of a fileset; of a part of the canon those that its size names, and none for an unknown size."""
    both = F.array(F.lit("nt"), F.lit("ot"))
    named = {k: F.array(*map(F.lit, v)) for k, v in SIZES.items()}
    return _chosen(canon, {"NT": F.array(F.lit("nt")), "OT": F.array(F.lit("ot")), "FULL": both, "PARTIAL": _chosen(size, named)})


def _base(c: Column) -> Column:
    return F.when(F.length(c) >= 3, c.substr(F.lit(1), F.length(c) - 3)).otherwise(c)


def untimed_best(recordings: DataFrame, by: list[str], unranked: bool = False) -> DataFrame:
    """W2, of rows (by, id, timed): the untimed recordings to align next, with ``better``: a worse one is timed already.

    Of a base the best tier counts, unless a timed one is as good; where no untimed one has a tier, all
    stay if nothing of the base is timed.  With ``unranked`` (W1) ids without a tier also stay beside ranked ones.
    """
    tier = F.when(F.length("id") >= 3, _chosen(F.substring("id", -3, 3), TIERS))
    w = Window.partitionBy(*by, "__base")
    least = lambda kept: F.min(F.when(kept, F.col("tier"))).over(w)
    rows = recordings.select(*by, "id", "timed", tier.alias("tier"), _base(F.col("id")).alias("__base"))
    rows = rows.withColumns({"__best": least(~F.col("timed")), "__done": least(F.col("timed")), "better": F.bool_or("timed").over(w)})
    ranked = (F.col("tier") == F.col("__best")) & F.coalesce(F.col("__done") > F.col("__best"), F.lit(True))
    other = F.col("tier").isNull() & F.when(F.col("__best").isNull(), ~F.col("better")).otherwise(F.lit(unranked))
    return rows.where(~F.col("timed") & (F.coalesce(ranked, F.lit(False)) | other)).select(*by, "id", "better")


def sync_candidates(filesets: DataFrame, timed: DataFrame) -> DataFrame:
    """(iso, canon, abbr, audio, text, better) of filesets (iso, abbr, canon, size, id, type).

    ``timed``: (iso, id) of recordings that have timing.  Of the encodings of a recording the shortest id
    stands for all (W3), and of an edition's texts the preferred kind, ties by id (W4).  Rows without an
    abbreviation or an id count as absent.
    """
    key = ["iso", "abbr", "canon"]
    rows = filesets.where("abbr != '' AND id != ''").select("iso", "abbr", F.explode(testaments(F.col("canon"), F.col("size"))).alias("canon"), "id", "type")
    plain = rollups.strip_suffix(F.col("id"), ENCODINGS)
    shortest = rows.where(F.col("type").isin(*AUDIO)).groupBy(*key, plain.alias("__plain")).agg(F.min(F.struct(F.length("id"), "id")).alias("m"))
    known = timed.select("iso", F.col("id").alias("__plain")).distinct().withColumn("__t", F.lit(True))
    audio = shortest.join(known, ["iso", "__plain"], "left").select(*key, "m.id", F.coalesce("__t", F.lit(False)).alias("timed"))
    texts = rows.where(F.col("type").startswith("text")).groupBy(*key).agg(F.min(F.struct(F.coalesce(_chosen(F.col("type"), TEXTS), F.lit(99)).alias("k"), "id")).alias("m"))
    return untimed_best(audio, key).join(texts, key).select("iso", "canon", "abbr", F.col("id").alias("audio"), F.col("m.id").alias("text"), "better")


def syncable_pairs(audio: DataFrame, texts: DataFrame) -> DataFrame:
    """(iso, audio, text) of audio (iso, id, timed) and texts (iso, id, pos); of the texts an audio matches the first counts."""
    best = untimed_best(audio, ["iso"], unranked=True).select("iso", F.col("id").alias("audio"))
    found = joins.prefix_join(texts.select(F.col("iso").alias("__iso"), F.col("id").alias("text"), "pos"), best, "text", "audio")
    return found.where("iso = __iso").groupBy("iso", "audio").agg(F.min_by("text", F.struct("pos", "text")).alias("text"))
