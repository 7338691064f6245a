"""Comparison, clusters and diagnosis of editions.

Editions are compared by the whole letters of a chapter, within a group: one language and canon.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.operators import rollups, text
from lectern.operators.graphs import components


def copies(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """J3 with equality: (by, a, b) of every row that repeats the ``value`` of another of its group, with the least key of these.

    Equality is transitive, so the pairs among the copies need not be listed.  Null values equal nothing.
    """
    named = df.where(F.col(value).isNotNull()).select(*by, key, F.sha2(value, 256).alias("__h"))
    least = named.groupBy(*by, "__h").agg(F.min(key).alias("a"))
    return named.join(least, [*by, "__h"]).where(F.col(key) != F.col("a")).select(*by, "a", F.col(key).alias("b"))


def identical_clusters(df: DataFrame, by: list[str], key: str, value: str) -> DataFrame:
    """(key, cluster, n): equality is transitive, so a cluster is a group, named by its least key; a null value is not an empty one."""
    named = df.select(*by, key, F.sha2(value, 256).alias("__h"))
    groups = named.groupBy(*by, "__h").agg(F.min(key).alias("cluster"), F.count("*").alias("n"))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in [*by, "__h"]]
    return named.alias("a").join(groups.alias("b"), same).select(f"a.{key}", "cluster", "n")


def probe_chapters(chapters: DataFrame, by: list[str], order: list[str]) -> DataFrame:
    """(by, chapter) that a group is compared on: the first of ``order`` that at least two editions have, else the first that one has.

    ``chapters`` is (by, id, chapter, text); a text that is null or empty is not there.
    """
    place = F.array_position(F.array(*map(F.lit, order)), F.col("chapter"))
    held = chapters.where((F.coalesce("text", F.lit("")) != "") & (place > 0)).groupBy(*by, "chapter", place.alias("__p")).agg(F.count_distinct("id").alias("n"))
    return held.groupBy(*by).agg(F.min_by("chapter", F.struct((F.col("n") < 2).alias("lone"), "__p")).alias("chapter"))


def members(texts: DataFrame, by: list[str]) -> DataFrame:
    """(by, id, letters, rep, n): the editions of each group by their whole letters; ``rep`` is the least id with the same ones.

    Editions without letters are left out; rows that repeat an id count once, the first by text.
    """
    each = texts.groupBy(*by, "id").agg(F.min("text").alias("text")).select(*by, "id", text.normalized_chars_col("text").alias("letters")).where("letters != ''")
    named = each.withColumn("__h", F.sha2("letters", 256))
    classes = named.groupBy(*by, "__h").agg(F.min("id").alias("rep"), F.count("*").alias("n"))
    return named.join(classes, [*by, "__h"]).drop("__h")


def pair_scores(own: DataFrame, by: list[str]) -> DataFrame:
    """(by, a, b, score, back) of every two different texts of a group, a < b, by the editions that stand for them.

    ``own`` is of ``members``.  The similarity depends on which text comes first: of two editions that
    is the one of lesser id, so ``score`` has the text of a first and ``back`` that of b, and both are
    told, as copies of either may come first.  Copies score 1 by being members of one class and are
    not listed.  A group is the editions of one language and canon, a few dozen.  Pairs are dealt out
    by their hash before the kernel runs, so that a large group does not end in one task.
    """
    reps = own.where("id = rep").select(*by, "rep", "letters")
    x, y = reps.select(*by, F.col("rep").alias("a"), F.col("letters").alias("x")), reps.select(*by, F.col("rep").alias("b"), F.col("letters").alias("y"))
    pairs = x.join(y, by).where("a < b").repartition(F.xxhash64(*by, "a", "b"))
    return pairs.select(*by, "a", "b", text.similarity_col("x", "y").alias("score"), text.similarity_col("y", "x").alias("back"))


def closest(own: DataFrame, scores: DataFrame, by: list[str]) -> DataFrame:
    """(by, id, partner, score, tier) of each edition with a partner: that of the greatest score, the least id on ties."""
    classes = own.groupBy(*by, "rep").agg(F.array_sort(F.collect_list("id")).alias("ids"))  # copies of one text in a group
    sides = scores.select(*by, F.col("a").alias("rep"), F.col("b").alias("other"), F.col("score").alias("first"), F.col("back").alias("second"))
    sides = sides.union(scores.select(*by, "b", "a", "back", "score"))
    twins = classes.select(*by, "rep", F.col("rep").alias("other"), F.lit(1.0).alias("first"), F.lit(1.0).alias("second"))
    met = own.select(*by, "id", "rep").join(sides.union(twins), [*by, "rep"]).join(classes.withColumnRenamed("rep", "other"), [*by, "other"])
    before, after = F.get("ids", F.lit(0)), F.get(F.filter("ids", lambda x: x > F.col("id")), F.lit(0))
    each = F.array(F.when(before < F.col("id"), F.struct((-F.col("second")).alias("k"), before.alias("partner"))), F.when(after.isNotNull(), F.struct((-F.col("first")).alias("k"), after.alias("partner"))))
    best = met.select(*by, "id", F.explode(F.array_compact(each)).alias("e")).groupBy(*by, "id").agg(F.min("e").alias("e"))
    return best.select(*by, "id", "e.partner", (-F.col("e.k")).alias("score")).withColumn("tier", rollups.score_tier(F.col("score")))


def clusters(scores: DataFrame, least: float) -> DataFrame:
    """G1: connected components of pairs at or above ``least``: (doc_id, cluster), the cluster its least id."""
    return components(scores.where(F.col("score") >= least)).select(F.col("node").alias("doc_id"), F.col("component").alias("cluster"))


def confirmed(own: DataFrame, chapters: DataFrame, probe: DataFrame, by: list[str]) -> DataFrame:
    """(by, a, b, confirmed, checked, differs_on, score, back) of editions that score 1 on the probe, compared on further chapters.

    ``chapters`` is (by, id, chapter, text), ``probe`` (by, chapter).  Of a class the editions that are the
    same in all further chapters stand behind one of them; these are compared two by two on the
    chapters that both have.  The lowest score below 1 replaces the pair's; the chapters are told in
    order, the first of the worst as ``differs_on``.  Copies within such a part are rows with their
    least edition: confirmed where there is a chapter to check.  ``back`` is the lowest score with
    the text of b first, which holds for copies of b that come before those of a.
    """
    further = chapters.join(probe.select(*by, F.col("chapter").alias("__probe")), by).where(~F.col("chapter").eqNullSafe(F.col("__probe")))
    read = further.select(*by, "id", "chapter", text.normalized_chars_col("text").alias("t")).where("t != ''").dropDuplicates([*by, "id", "chapter"])
    told = read.groupBy(*by, "id").agg(F.array_sort(F.collect_list(F.struct("chapter", F.sha2("t", 256).alias("h")))).alias("own"))
    named = own.where("n > 1").select(*by, "id", "rep").join(told, [*by, "id"], "left").withColumn("part", F.sha2(F.coalesce(F.to_json("own"), F.lit("")), 256))
    heads = named.groupBy(*by, "rep", "part").agg(F.min("id").alias("head"))
    placed = named.join(heads, [*by, "rep", "part"])
    names = F.transform("own", lambda x: x["chapter"])
    none = F.array().cast(read.schema["chapter"].dataType.simpleString().join(["array<", ">"]))
    same = placed.where("id != head").select(*by, F.col("head").alias("a"), F.col("id").alias("b"), F.col("own").isNotNull().alias("confirmed"), F.coalesce(names, none).alias("checked"))
    same = same.select("*", F.lit(None).cast(read.schema["chapter"].dataType).alias("differs_on"), F.lit(1.0).alias("score"), F.lit(1.0).alias("back"))
    x, y = heads.select(*by, "rep", F.col("head").alias("a")), heads.select(*by, "rep", F.col("head").alias("b"))
    pairs = x.join(y, [*by, "rep"]).where("a < b").drop("rep")
    texts = lambda i, t: read.select(*by, F.col("id").alias(i), "chapter", F.col("t").alias(t))
    both = pairs.join(texts("a", "x"), [*by, "a"]).join(texts("b", "y"), [*by, "b", "chapter"])
    scored = both.select(*by, "a", "b", "chapter", text.similarity_col("x", "y").alias("s"), text.similarity_col("y", "x").alias("t"))
    worst = scored.groupBy(*by, "a", "b").agg(F.array_sort(F.collect_list("chapter")).alias("checked"), F.min(F.struct("s", "chapter")).alias("w"), F.min("t").alias("back"))
    found = pairs.join(worst, [*by, "a", "b"], "left")
    lower = F.col("w.s") < 1
    differ = found.select(*by, "a", "b", (F.col("w").isNotNull() & ~F.coalesce(lower, F.lit(False))).alias("confirmed"), F.coalesce("checked", none).alias("checked"), F.when(lower, F.col("w.chapter")).alias("differs_on"), F.when(lower, F.col("w.s")).otherwise(1.0).alias("score"), F.coalesce("back", F.lit(1.0)).alias("back"))
    return same.union(differ)


def overridden(scores: DataFrame, better: DataFrame, by: list[str]) -> DataFrame:
    """Scores in which those of ``better`` (by, a, b, score), measured on a longer probe, take the place of others."""
    new = better.select(*by, F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), F.round("score", 4).alias("__new"))
    return scores.join(new, [*by, "a", "b"], "left").select(*by, "a", "b", F.coalesce("__new", "score").alias("score"), F.coalesce("__new", "back").alias("back"))


def likely(score: Column, category: Column) -> Column:
    """How an edition relates to its closest one: identical, else the category of the diagnosis, else the tier of the score."""
    return F.when(score == 1.0, "identical").otherwise(F.coalesce(F.regexp_replace(category, "likely_", ""), rollups.score_tier(score)))


def overlap(own: DataFrame, near: DataFrame, diagnosis: DataFrame, by: list[str]) -> DataFrame:
    """The clusters of a group: (by, ids, closest, score, likely); a lone edition names its closest, where it has one.

    ``near`` is of ``closest``, ``diagnosis`` (by, a, b, category), a < b.
    """
    ids = own.groupBy(*by, "rep", "n").agg(F.array_sort(F.collect_list("id")).alias("ids"))
    lone = near.select(*by, F.col("id").alias("rep"), "partner", "score", F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b"))
    told = lone.join(diagnosis.select(*by, "a", "b", "category"), [*by, "a", "b"], "left").drop("a", "b")
    j = ids.join(told, [*by, "rep"], "left")
    alone = F.col("n") == 1
    return j.select(*by, "ids", F.when(alone, F.col("partner")).alias("closest"), F.when(alone, F.col("score")).alias("score"), F.when(alone & F.col("partner").isNotNull(), likely(F.col("score"), F.col("category"))).alias("likely"))


def duplicate_of(samples: DataFrame, candidates: DataFrame, by: list[str], least: float = 0.95) -> DataFrame:
    """(by, id, candidate, worst, duplicate): every comparison of an edition's samples with a candidate of its group.

    ``samples`` and ``candidates`` are (by, id, chapter, text), candidates with their order ``ord``.  The
    worst score over the chapters that both have decides; of the candidates that reach ``least`` on all
    of them the first is the duplicate.
    """
    letters = lambda df, t: df.withColumn(t, text.letters_key_col("text")).where(F.col(t) != "").drop("text")
    x = letters(samples, "x")
    y = letters(candidates, "y").select(*by, F.col("id").alias("candidate"), "ord", "chapter", "y")
    both = x.join(y, [*by, "chapter"]).repartition(F.xxhash64(*by, "id", "candidate", "chapter"))
    worst = both.select(*by, "id", "candidate", "ord", F.round(text.similarity_col("x", "y"), 3).alias("s")).groupBy(*by, "id", "candidate", "ord").agg(F.min("s").alias("worst"))
    first = worst.where(F.col("worst") >= least).groupBy(*by, "id").agg(F.min_by("candidate", "ord").alias("__first"))
    return worst.join(first, [*by, "id"], "left").select(*by, "id", "candidate", "worst", F.coalesce(F.col("candidate") == F.col("__first"), F.lit(False)).alias("duplicate"))


#: Bounds of the diagnosis, and edits known to be distinctions of sound.
DUPLICATE_LETTERS, DUPLICATE_HUNKS = 30, 5
ORTHOGRAPHY_PAIRS, ORTHOGRAPHY_SCORE, DIALECT_SCORE = 5, 0.5, 0.85
KNOWN_PHONEMIC_PAIRS = frozenset({frozenset({"ʉ", "u"})})


def repeats_itself(a: str, b: str, places: list[tuple[int, int, int, int]]) -> bool:
    """Whether a long hunk of a text, of few, stands in the rest of that text as well."""
    if len(places) > DUPLICATE_HUNKS:
        return False
    sides = [(own, i, j) for i1, i2, j1, j2 in places for own, i, j in ((a, i1, i2), (b, j1, j2))]
    return any(j - i >= DUPLICATE_LETTERS and own[i:j] in own[:i] + own[j:] for own, i, j in sides)


def replaced_score(a: str, b: str, pair: tuple[str, str]) -> float:
    """The similarity when the first side's part of an edit is rewritten everywhere; an insertion rewrites nothing."""
    x, y = pair
    return text.text_similarity(a.replace(x, y) if x else a, b)


def category(a: str, b: str, score: float) -> str:
    """Why two texts differ; the tests come in this order."""
    places = text.edits(a, b)
    pair, share, kinds = text.dominant_pair(text.hunks(a, b))
    if repeats_itself(a, b, places):
        return "likely_source_duplication"
    if pair and share >= 0.8 and len(places) >= 3:
        known = frozenset(pair) in KNOWN_PHONEMIC_PAIRS
        return "single_pair_dominant_ambiguous" if not known and replaced_score(a, b, pair) >= 0.999 else "likely_phonemic_distinction"
    if 0 < kinds <= ORTHOGRAPHY_PAIRS and score >= ORTHOGRAPHY_SCORE:
        return "likely_orthography_convention"
    if score >= DIALECT_SCORE:
        return "likely_dialect_variant"
    return "likely_distinct_translation" if places else "unclassified"


def diagnose(own: DataFrame, near: DataFrame, by: list[str]) -> DataFrame:
    """(by, a, b, score, category) of the editions whose closest partner is below 1, mutual pairs once."""
    pairs = near.where("score < 1").select(*by, F.least("id", "partner").alias("a"), F.greatest("id", "partner").alias("b"), "score").distinct()
    texts = lambda i, t: own.select(*by, F.col("id").alias(i), F.col("letters").alias(t))
    both = pairs.join(texts("a", "x"), [*by, "a"]).join(texts("b", "y"), [*by, "b"]).repartition(F.xxhash64(*by, "a", "b"))

    @F.pandas_udf("string")
    def label(xs: pd.Series, ys: pd.Series, ss: pd.Series) -> pd.Series:
        return pd.Series([category(u, v, s) for u, v, s in zip(xs, ys, ss, strict=True)])

    return both.select(*by, "a", "b", "score", label("x", "y", "score").alias("category"))


def largest_hunks(a: str, b: str, n: int = 3, width: int = 40) -> list[tuple[str, str, str]]:
    """The hunks with the longest sides, the first on ties, cut for display: a report's feature."""
    found = sorted(text.hunks(a, b), key=lambda h: -max(len(h[1]), len(h[2])))
    return [(kind, x[:width], y[:width]) for kind, x, y in found[:n]]
