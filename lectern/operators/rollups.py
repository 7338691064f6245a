"""Roll-ups and classifications of the catalog as column expressions and aggregates (A*, F*, P*, W*, D31-D36)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def capability_category(text: Column, audio: Column, timing: Column) -> Column:
    """With-timecode, audio-with-timecode, syncable, text-only, audio-only, or null."""
    return (
        F.when(text & audio & timing, "with-timecode")
        .when(audio & timing, "audio-with-timecode")
        .when(text & audio, "syncable")
        .when(text, "text-only")
        .when(audio, "audio-only")
    )


def coverage_class(books: Column, full: Column) -> Column:
    """A3: full, partial or none, from a set of books and the full set."""
    return F.when(F.size(F.array_except(full, books)) == 0, "full").when(F.arrays_overlap(full, books), "partial").otherwise("none")


def exceptions(books: Column, full: Column) -> Column:
    """Null where full; else the shorter of "only" and "except" lists, "only" on ties."""
    only = F.array_sort(F.array_intersect(books, full))
    lack = F.array_sort(F.array_except(full, books))
    kind = lambda name, c: F.concat(F.lit(name + ":"), F.array_join(c, ","))
    return F.when(F.size(lack) == 0, F.lit(None)).when(F.size(only) <= F.size(lack), kind("only", only)).otherwise(kind("except", lack))


def best_tier(df: DataFrame, base: list[str], tier: str, timed: str) -> DataFrame:
    """Untimed rows at the best tier of their base group, unless a timed sibling is as good or better.

    Rows without a tier pass where no untimed row of the group has one.
    """
    w = Window.partitionBy(*base)
    ranked = df.withColumns({"__best": F.min(F.when(~F.col(timed), F.col(tier))).over(w), "__timed": F.min(F.when(F.col(timed), F.col(tier))).over(w)})
    at_best = F.col(tier) == F.col("__best")
    none = F.col("__best").isNull()
    beaten = F.coalesce(F.col("__timed") <= F.col("__best"), F.lit(False))
    return ranked.where(~F.col(timed) & ~beaten & (at_best | none)).drop("__best", "__timed")


def strip_suffix(c: Column, suffixes: list[str]) -> Column:
    """P5: the first of ``suffixes`` that ends ``c`` is taken off; one only, in list order."""
    out = None
    for s in suffixes:
        cut = c.substr(F.lit(1), F.length(c) - len(s))
        out = F.when(F.endswith(c, F.lit(s)), cut) if out is None else out.when(F.endswith(c, F.lit(s)), cut)
    return out.otherwise(c)


def encode_id(base: Column, item: Column) -> Column:
    """The item as the suffix of its base where that is its prefix, without regard to case; a kind letter tells which."""
    own = F.startswith(F.upper(item), F.upper(base))
    return F.when(own, F.concat(F.lit("t:"), item.substr(F.length(base) + 1, F.length(item)))).otherwise(F.concat(F.lit("T:"), item))


def decode_id(base: Column, spec: Column) -> Column:
    """The inverse of ``encode_id``."""
    rest = F.substring(spec, 3, 1 << 20)
    return F.when(F.startswith(spec, F.lit("t:")), F.concat(base, rest)).when(F.startswith(spec, F.lit("T:")), rest)


def bitrate(c: Column) -> Column:
    """P4: "128kbps" is 128, anything else null; the unit is in small letters and last, a sign and blanks may be beside the number."""
    number = F.regexp_extract(c, r"^\s*([+-]?\d+(?:_\d+)*)\s*kbps$", 1)
    return F.regexp_replace(number, "[+_]", "").try_cast("int")


#: Links to licenses, and the words that rule one out or reserve rights.
LICENSE_LINK = r"(?i)creativecommons\.org/(licenses|publicdomain)/([a-z-]+)(?:/([0-9.]+))?"
NO_DERIVATIVES, RESERVED = r"(?i)no[ -]?deriv", r"(?i)all rights reserved"


def page_license(page: Column, url: Column) -> Column:
    """What a copyright page (HTML) permits, as a struct (type, url, reason); a null type with the reason.

    First no-derivatives licenses are refused, by link or by words; then the one license that is
    linked holds, and several tell nothing; then CC0; then public domain, unless rights are reserved.
    Null pages state no license.
    """
    raw = F.coalesce(page, F.lit(""))
    blank = F.regexp_replace(F.regexp_replace(raw, "<[^>]+>", " "), "&(?:nbsp|#160|#[xX][aA]0);", " ")
    told = F.regexp_replace(blank, r"(?U)\s+", " ")
    part = lambda k: F.regexp_extract_all(raw, F.lit(LICENSE_LINK), F.lit(k))
    links = F.transform(F.arrays_zip(part(1).alias("area"), part(2).alias("kind"), part(3).alias("version")), lambda x: F.struct(F.lower(x["area"]).alias("area"), F.lower(x["kind"]).alias("kind"), x["version"].alias("version")))
    own = F.array_distinct(F.filter(links, lambda x: x["area"] == "licenses"))
    one = F.get(own, F.lit(0))
    name = F.concat(F.lit("CC "), F.upper(one["kind"]), F.when(one["version"] != "", F.concat(F.lit(" "), one["version"])).otherwise(""))
    link = F.concat(F.lit("https://creativecommons.org/licenses/"), one["kind"], F.lit("/"), F.when(one["version"] != "", one["version"]).otherwise("4.0"), F.lit("/"))
    open_ = F.exists(links, lambda x: x["area"] == "publicdomain") | told.rlike(r"(?i)\bpublic domain\b")
    yes = lambda kind, at: F.struct(kind.alias("type"), at.alias("url"), F.lit(None).cast("string").alias("reason"))
    no = lambda why: F.struct(F.lit(None).cast("string").alias("type"), F.lit(None).cast("string").alias("url"), F.lit(why).alias("reason"))
    return (
        F.when(F.exists(links, lambda x: F.array_contains(F.split(x["kind"], "-"), "nd")) | told.rlike(NO_DERIVATIVES), no("No Derivatives"))
        .when(F.size(own) == 1, yes(name, link))
        .when(F.size(own) > 1, no("several licences on the page"))
        .when(F.exists(links, lambda x: (x["area"] == "publicdomain") & (x["kind"] == "zero")), yes(F.lit("CC0 1.0"), F.lit("https://creativecommons.org/publicdomain/zero/1.0/")))
        .when(open_ & told.rlike(r"(?i)all rights reserved|license agreement"), no("public domain mentioned, but rights reserved"))
        .when(open_, yes(F.lit("Public Domain"), url))
        .when(told.rlike(RESERVED), no("All rights reserved"))
        .otherwise(no("no licence stated"))
    )


def score_tier(score: Column) -> Column:
    """A similarity score in words."""
    return F.when(score.isNull(), None).when(score == 1.0, "identical").when(score >= 0.98, "near_identical").when(score >= 0.5, "uncertain").otherwise("distinct")


def conflicts(df: DataFrame, key: list[str], attribute: str) -> DataFrame:
    """Keys with more than one value of an attribute."""
    return df.groupBy(*key).agg(F.count_distinct(attribute).alias("n_values")).where("n_values > 1")


def mode_order(df: DataFrame, key: str, value: str, order: str) -> DataFrame:
    """The values of a key, most frequent first, ties by first occurrence; and whether there are several."""
    counted = df.groupBy(key, value).agg(F.count("*").alias("n"), F.min(order).alias("at"))
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("n")).alias("k"), "at", F.col(value).alias("v"))))
    return counted.groupBy(key).agg(F.transform(ranked, lambda x: x["v"]).alias("ordered")).select(key, F.array_join("ordered", ",").alias("ordered"), (F.size("ordered") > 1).alias("multi"))


def islands(df: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Runs of consecutive rows with one value: (by, island, value, n, start)."""
    w = Window.partitionBy(*by).orderBy(order)
    change = F.when(F.lag(value).over(w).eqNullSafe(F.col(value)) & (F.row_number().over(w) > 1), 0).otherwise(1)
    numbered = df.withColumn("__new", change).withColumn("island", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return numbered.groupBy(*by, "island", value).agg(F.count("*").alias("n"), F.min(order).alias("start"))


def back_fill(df: DataFrame, by: list[str], order: str, value: str, out: str) -> DataFrame:
    """The next value that is not null after a row; read backwards, so that the frame only grows."""
    w = Window.partitionBy(*by).orderBy(F.desc(order)).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumn(out, F.last(value, ignorenulls=True).over(w))
