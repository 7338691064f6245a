"""Queries of the comparison of editions: conversations as editions, their turns as chapters, ten to a group."""

from __future__ import annotations

from pyspark.sql import functions as F

from lectern.operators import compare
from lectern.plans.catalog import query
from lectern.session import table

BY = ["iso", "canon"]


def _chapters(spark, sf_dir):
    """(iso, canon, id, chapter, text): whole texts of turns; every fourth edition begins as the one before it."""
    c, k = table(spark, sf_dir, "conversations").where("text IS NOT NULL"), F.col("conv_id")
    own = c.select(F.floor(k / 10).cast("bigint").alias("iso"), F.lit("nt").alias("canon"), k.alias("id"), F.col("turn").cast("int").alias("chapter"), "text")
    again = own.where("id % 4 = 1").withColumn("id", F.col("id") + F.lit(1_000_000)).withColumn("text", F.when(F.col("chapter") == 2, F.concat("text", F.lit(" more"))).otherwise(F.col("text")))
    return own.union(again)


def _compared(spark, sf_dir):
    chapters = _chapters(spark, sf_dir)
    probe = compare.probe_chapters(chapters, BY, [0, 1, 2])
    own = compare.members(chapters.join(probe, [*BY, "chapter"]).select(*BY, "id", "text"), BY)
    return chapters, probe, own, compare.pair_scores(own, BY)


@query("pair_scores")
def pair_scores(spark, sf_dir):
    """Scores of the different texts of a group."""
    return _compared(spark, sf_dir)[3]


@query("closest_partner")
def closest_partner(spark, sf_dir):
    """The best partner of an edition, with its tier."""
    _, _, own, scores = _compared(spark, sf_dir)
    return compare.closest(own, scores, BY)


@query("diagnose_pairs")
def diagnose_pairs(spark, sf_dir):
    """Why closest editions below 1 differ."""
    _, _, own, scores = _compared(spark, sf_dir)
    return compare.diagnose(own, compare.closest(own, scores, BY), BY)


@query("confirmed_pairs")
def confirmed_pairs(spark, sf_dir):
    """Editions that are the same on the probe, on further chapters."""
    chapters, probe, own, _ = _compared(spark, sf_dir)
    return compare.confirmed(own, chapters, probe, BY)


#: Small editions with texts whose scores are worked out by hand.
SMALL = [
    ("eng", "nt", 1, 0, "abcd"), ("eng", "nt", 2, 0, "ABCD!"), ("eng", "nt", 3, 0, "abxd"), ("eng", "nt", 4, 0, "qrst"), ("deu", "nt", 5, 0, "abcd"), ("deu", "nt", 6, 0, " 12 "), ("fra", "ot", 7, 0, None), ("fra", "ot", 7, 1, "abcdefgh"), ("fra", "ot", 8, 1, "abcdefg"),
    ("eng", "nt", 1, 1, "one two"), ("eng", "nt", 2, 1, "one too"), ("eng", "nt", 3, 1, "x"), ("spa", "nt", 10, 0, "same"), ("spa", "nt", 11, 0, "same"), ("spa", "nt", 12, 0, "same"), ("spa", "nt", 10, 2, "further"), ("spa", "nt", 11, 2, "further"),
]
_KIND = "iso string, canon string, id int, chapter int, text string"


def _small(spark):
    chapters = spark.createDataFrame(SMALL, _KIND)
    probe = compare.probe_chapters(chapters, BY, [0, 1])
    own = compare.members(chapters.join(probe, [*BY, "chapter"]).select(*BY, "id", "text"), BY)
    return chapters, probe, own, compare.pair_scores(own, BY)


@query("small_scores", "SELECT iso, canon, a, b, score, score AS back FROM (VALUES ('eng', 'nt', 1, 3, 0.75::DOUBLE), ('eng', 'nt', 1, 4, 0.0), ('eng', 'nt', 3, 4, 0.0), ('fra', 'ot', 7, 8, 0.9333)) AS v(iso, canon, a, b, score)")
def small_scores(spark, sf_dir):
    """Scores worked out by hand, a fallback probe among them."""
    return _small(spark)[3]


@query("small_overlap", """SELECT iso, canon, ids, closest, score, likely FROM (VALUES ('eng', 'nt', '1,2', NULL, NULL, NULL), ('eng', 'nt', '3', '1', '0.75', 'dialect_variant'), ('eng', 'nt', '4', '1', '0.0', 'distinct'), ('deu', 'nt', '5', NULL, NULL, NULL),
 ('fra', 'ot', '7', '8', '0.5', 'uncertain'), ('fra', 'ot', '8', '7', '0.5', 'uncertain'), ('spa', 'nt', '10,11,12', NULL, NULL, NULL)) AS v(iso, canon, ids, closest, score, likely)""")
def small_overlap(spark, sf_dir):
    """Clusters with their closest editions, an overridden score and a diagnosis."""
    _, _, own, scores = _small(spark)
    scores = compare.overridden(scores, spark.createDataFrame([("fra", "ot", 8, 7, 0.50001)], "iso string, canon string, a int, b int, score double"), BY)
    diagnosis = spark.createDataFrame([("eng", "nt", 1, 3, "likely_dialect_variant"), ("eng", "nt", 1, 2, "x")], "iso string, canon string, a int, b int, category string")
    out = compare.overlap(own, compare.closest(own, scores, BY), diagnosis, BY)
    return out.select(*BY, F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"), F.col("closest").cast("string").alias("closest"), F.col("score").cast("string").alias("score"), "likely")


@query("small_confirmations", """SELECT iso, canon, a, b, confirmed, checked, differs_on, score, score AS back FROM (VALUES ('eng', 'nt', 1, 2, false, '1', '1', 0.8333::DOUBLE), ('spa', 'nt', 10, 11, true, '2', NULL, 1.0), ('spa', 'nt', 10, 12, false, '', NULL, 1.0)) AS v(iso, canon, a, b, confirmed, checked, differs_on, score)""")
def small_confirmations(spark, sf_dir):
    """Pairs of 1 confirmed, lowered, or without a further chapter."""
    chapters, probe, own, _ = _small(spark)
    out = compare.confirmed(own, chapters, probe, BY)
    return out.withColumns({"checked": F.array_join(F.transform("checked", lambda x: x.cast("string")), ","), "differs_on": F.col("differs_on").cast("string")})


@query("duplicate_editions", """SELECT id, candidate, worst, duplicate FROM (VALUES (1, 'a', 1.0::DOUBLE, true), (1, 'b', 0.0, false), (1, 'c', 1.0, false), (2, 'a', 0.0, false), (2, 'b', 0.857, false), (2, 'c', 0.0, false)) AS v(id, candidate, worst, duplicate)""")
def duplicate_editions(spark, sf_dir):
    """Candidates against samples, the first that matches on all shared chapters."""
    kind = "iso string, id string, chapter int, text string, ord int"
    samples = spark.createDataFrame([("eng", 1, 0, "abcd"), ("eng", 1, 1, "wxyz"), ("eng", 2, 0, "lmn"), ("deu", 3, 0, "abcd")], "iso string, id int, chapter int, text string")
    candidates = spark.createDataFrame([("eng", "c", 1, "w x y z", 3), ("eng", "a", 0, "Abcd", 1), ("eng", "a", 1, "WXYZ.", 1), ("eng", "b", 1, "wyqq", 2), ("eng", "b", 0, "lmno", 2), ("eng", "c", 0, "abcd", 3)], kind)
    return compare.duplicate_of(samples, candidates, ["iso"]).drop("iso")
