"""Verdicts per edition."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def textual_basis(verses: DataFrame, key: str = "id") -> DataFrame:
    """The textual basis from diagnostic verses.

    ``verses``: (key, text, tr_only), one row per diagnostic verse that could be looked up.  A verse
    that is empty is absent, one that begins with a bracket doubtful; a null text was not looked
    up.  Fewer than eight verses tell nothing.
    """
    verses = verses.where(F.col("text").isNotNull())
    blank = F.col("text").rlike(r"(?U)^\s*$")
    bracketed = F.col("text").rlike(r"(?U)^\s*[\[(【]")
    present = ~blank & ~bracketed
    counts = verses.groupBy(key).agg(
        F.count("*").alias("checked"), F.count_if(present).alias("present"), F.count_if(bracketed).alias("bracketed"),
        F.count_if(F.col("tr_only")).alias("tr_checked"), F.count_if(present & F.col("tr_only")).alias("tr_present"),
    )
    rate = F.col("present") / F.col("checked")
    verdict = (
        F.when(F.col("checked") < 8, "indeterminate")
        .when((F.col("bracketed") >= 3) & (rate < 0.5), "mixed")
        .when(rate < 0.2, "critical")
        .when((F.col("tr_checked") > 0) & (F.col("tr_present") * 2 >= F.col("tr_checked")), "tr")
        .when(rate >= 0.6, "byzantine")
        .otherwise("mixed")
    )
    return counts.withColumn("verdict", verdict)


def title_class(probes: DataFrame, key: str = "id") -> DataFrame:
    """How psalm titles are set: (key, numbered, marked) per usable probe; null numbered is not usable."""
    usable = probes.where("numbered IS NOT NULL")
    both = F.bool_or("numbered") & F.bool_or(~F.col("numbered"))
    kind = F.when(both, "mixed").when(F.bool_or("numbered"), "numbered")
    for k in ("heading", "note"):
        kind = kind.when(F.coalesce(F.bool_or(F.col("marked") == k), F.lit(False)), k)
    return usable.groupBy(key).agg(kind.otherwise("unmarked").alias("titles"))


def text_route(formats: Column, override: Column) -> Column:
    """The reading route of an edition's formats; null where there is only a generic one."""
    has = lambda f: F.array_contains(formats, f)
    return (
        F.when(F.coalesce(override == "usx", F.lit(False)) & has("u"), "usx")
        .when(has("j"), "sofria")
        .when(has("u"), "usx")
        .when(has("pl"), "plain")
    )


def has_timing(only: Column, excepted: Column, book: Column) -> Column:
    """Listed under "only", or not under "except"; all books where neither list is there."""
    return F.when(only.isNotNull(), F.array_contains(only, book)).when(excepted.isNotNull(), ~F.array_contains(excepted, book)).otherwise(True)


def default_edition(editions: DataFrame, by: list[str], source: str, order: list[str], key: str) -> DataFrame:
    """The edition of the source that comes first; sources not listed last, then the least id."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(source))
    return editions.groupBy(*by).agg(F.min_by(key, F.struct(F.when(place == 0, len(order) + 1).otherwise(place), F.col(key))).alias(key))
