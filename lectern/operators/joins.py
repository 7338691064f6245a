"""Join shapes of the catalog that are not a plain equi-join."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def wildcard_join(left: DataFrame, rules: DataFrame, key: str, other: list[str], wildcard: str = "*") -> DataFrame:
    """Rows of ``left`` with a rule for their key or for the wildcard, and the same ``other`` columns.

    A union of two equi-joins: an OR in the condition would be a nested loop.
    """
    own = left.join(rules, [key, *other], "left_semi")
    rest = left.join(rules.where(F.col(key) == wildcard).select(*other).distinct(), other, "left_semi")
    return own.unionByName(rest).distinct()


def prefix_join(texts: DataFrame, audios: DataFrame, text_id: str, audio_id: str, least: int = 6, most: int = 7) -> DataFrame:
    """An audio id matches a text id on its first min(``most``, length) characters, ``least`` of them at any rate.

    Equal first ``least`` characters are the join key; the rest is a residual filter.
    """
    a = texts.where(F.length(text_id) >= least).withColumn("__key", F.substring(text_id, 1, least))
    b = audios.where(F.length(audio_id) >= least).withColumn("__key", F.substring(audio_id, 1, least))
    n = F.least(F.lit(most), F.length(text_id))
    return a.join(b, "__key").where(F.col(audio_id).substr(F.lit(1), n) == F.col(text_id).substr(F.lit(1), n)).drop("__key")


def full_flags(sources: dict[str, DataFrame], key: list[str]) -> DataFrame:
    """The union of all sources' keys with a flag for each source."""
    flagged = [df.select(*key).distinct().withColumns({n: F.lit(n == name) for n in sources}) for name, df in sources.items()]
    union = reduce(DataFrame.unionByName, flagged)
    return union.groupBy(*key).agg(*[F.bool_or(n).alias(n) for n in sources])


def two_way_missing(a: DataFrame, b: DataFrame, key: list[str], names: tuple[str, str]) -> DataFrame:
    """Keys that only one side has, with the side that lacks them."""
    x = a.select(*key).distinct().join(b.select(*key), key, "left_anti").withColumn("missing_in", F.lit(names[1]))
    y = b.select(*key).distinct().join(a.select(*key), key, "left_anti").withColumn("missing_in", F.lit(names[0]))
    return x.unionByName(y)


def first_source_wins(sources: list[DataFrame], key: list[str]) -> DataFrame:
    """Per key the row of the first source that has one, as a minimum by source number."""
    ranked = reduce(DataFrame.unionByName, [df.withColumn("source_rank", F.lit(k)) for k, df in enumerate(sources)])
    rest = [c for c in ranked.columns if c not in key]
    best = ranked.groupBy(*key).agg(F.min(F.struct("source_rank", *[c for c in rest if c != "source_rank"])).alias("__best"))
    return best.select(*key, "__best.*")


def match_cascade(left: DataFrame, right: DataFrame, left_id: str, right_id: str, rules: list[tuple[Column, Column]]) -> DataFrame:
    """Each left id gets the right id of the first rule under which any matches (least id on ties)."""
    found = []
    for k, (a, b) in enumerate(rules):
        x = left.select(left_id, a.alias("__key"))
        y = right.select(right_id, b.alias("__key"))
        found.append(x.join(y, "__key").select(left_id, F.struct(F.lit(k).alias("rule"), right_id).alias("m")))
    return reduce(DataFrame.union, found).groupBy(left_id).agg(F.min("m").alias("m")).select(left_id, f"m.{right_id}", "m.rule")


def as_of(left: DataFrame, right: DataFrame, by: list[str], at: str, start: str, value: str) -> DataFrame:
    """For each left row the ``value`` of the last right row of the same key with ``start`` at or before ``at``.

    Union and a running last value: one shuffle on the key, no pairs.
    """
    a = left.select(*left.columns, F.col(at).alias("__t"), F.lit(1).alias("__side"), F.lit(None).cast(right.schema[value].dataType).alias("__v"))
    nulls = [F.lit(None).cast(left.schema[c].dataType).alias(c) if c not in by else F.col(c) for c in left.columns]
    b = right.select(*nulls, F.col(start).alias("__t"), F.lit(0).alias("__side"), F.col(value).alias("__v"))
    w = Window.partitionBy(*by).orderBy("__t", "__side").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = a.unionByName(b).withColumn(value, F.last("__v", ignorenulls=True).over(w))
    return both.where("__side = 1").drop("__t", "__side", "__v")


def snapshot_delta(old: DataFrame, new: DataFrame, key: str, facts: list[str]) -> DataFrame:
    """Added, changed and deleted keys between two listings."""
    a = old.select(key, F.struct(*facts).alias("o"))
    b = new.select(key, F.struct(*facts).alias("n"))
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "deleted").when(F.col("o") != F.col("n"), "changed")
    return a.join(b, key, "full").select(key, change.alias("change")).where("change IS NOT NULL")


def override_pairs(base: DataFrame, over: DataFrame, key: str) -> DataFrame:
    """The base without overridden keys, and the overrides."""
    return base.join(over, key, "left_anti").unionByName(over)
