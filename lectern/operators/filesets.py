"""Roll-ups and filters of filesets and editions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators.rollups import capability_category


def without_excluded(rows: DataFrame, excluded: DataFrame, keys: list[str], scope: str = "align") -> DataFrame:
    """``rows`` without those excluded in ``scope``: "align" takes entries of scope align and all, "all" only the latter.

    ``excluded`` has the keys and a scope; a null scope is "align".
    """
    scopes = ("align", "all") if scope == "align" else ("all",)
    gone = excluded.where(F.coalesce("scope", F.lit("align")).isin(*scopes))
    return rows.join(gone.select(*keys).distinct(), keys, "left_anti")


def compared_groups(groups: DataFrame, status: str = "status") -> DataFrame:
    """groups with more than one source: those that were compared, or had no text to compare."""
    return groups.where(F.col(status).isin("compared", "no_text"))


def exclusion_reasons(filesets: DataFrame) -> DataFrame:
    """a row for each reason why a fileset (id, type, canon) is left out; one may have several, most have none."""
    reasons = {
        "sa_versions": F.endswith(F.col("id"), F.lit("SA")),
        "partial_content": F.col("canon") == "PARTIAL",
        "story_adaptations": F.lower("type").contains("story") | F.lower("type").contains("video"),
    }
    told = F.array_compact(F.array(*[F.when(c, name) for name, c in reasons.items()]))
    return filesets.select("*", F.explode(told).alias("reason"))


def without_held_back(files: DataFrame, path: str, stale: list[str], held_back: list[str]) -> DataFrame:
    """files that are neither stale paths nor, wherever they lie, of a name that is held back."""
    name = F.element_at(F.split(F.col(path), "/"), -1)
    return files.where(~F.col(path).isin(*stale) & ~name.isin(*held_back))


def summed_counts(counts: list[DataFrame], keys: list[str], n: str = "n") -> DataFrame:
    """A2: the sum of several tables of counts."""
    return reduce(DataFrame.unionByName, [c.select(*keys, n) for c in counts]).groupBy(*keys).agg(F.sum(n).alias(n))


def collection_canons(books: Column, coverage: Column, old_testament: list[str]) -> Column:
    """A4: the canons that a collection covers: by its coverage (struct n: string, o: array of books), else by its number of books.

    ``n`` is "full", "partial" or null, ``o`` the Old Testament books or null.  Without coverage 27
    books are the New Testament, 66 and more both, fewer a part of the New.
    """
    number = F.coalesce(books, F.lit(0))
    told = F.array_compact(
        F.array(
            F.when(coverage["n"] == "full", "nt").when(coverage["n"].isNotNull(), "ntp"),
            F.when(coverage["o"].isNotNull(), F.when(F.size(F.array_except(F.array(*map(F.lit, old_testament)), coverage["o"])) == 0, "ot").otherwise("otp")),
        )
    )
    none = F.array().cast("array<string>")
    counted = F.when(number == 27, F.array(F.lit("nt"))).when(number >= 66, F.array(F.lit("nt"), F.lit("ot"))).when(number > 0, F.array(F.lit("ntp"))).otherwise(none)
    return F.when(coverage.isNull(), counted).otherwise(told)


def completeness(editions: DataFrame, existing: DataFrame, new_testament: list[str], old_testament: list[str]) -> DataFrame:
    """A5: (id, flags) of editions (id, books); where the books could not be read (null) the flags that ``existing`` has, if any."""
    full = lambda own: F.size(F.array_except(F.array(*map(F.lit, own)), F.col("books"))) == 0
    some = lambda own: F.arrays_overlap(F.array(*map(F.lit, own)), F.col("books"))
    flags = {
        "has_full_nt": full(new_testament),
        "has_full_ot": full(old_testament),
        "has_full_bible": full(new_testament) & full(old_testament),
        "has_any_nt": some(new_testament),
        "has_any_ot": some(old_testament),
    }
    fresh = editions.select("id", F.col("books").isNotNull().alias("__read"), *[c.alias(k) for k, c in flags.items()])
    old = existing.select("id", F.lit(True).alias("__old"), *[F.col(k).alias(f"__{k}") for k in flags])
    both = fresh.join(old, "id", "left").where("__read OR __old")
    return both.select("id", *[F.when(F.col("__read"), F.col(k)).otherwise(F.col(f"__{k}")).alias(k) for k in flags])


def folded_flags(rows: DataFrame, keys: list[str]) -> DataFrame:
    """Text and audio flags of a key, and the ids of its audio filesets in order; null flags are false."""
    flag = lambda c: F.coalesce(F.bool_or(c), F.lit(False)).alias(c)
    return rows.groupBy(*keys).agg(flag("has_text"), flag("has_audio"), F.array_sort(F.collect_set(F.when(F.col("is_audio"), F.col("id")))).alias("audio_ids"))


def edition_category(filesets: DataFrame, keys: list[str], canon: str = "canon") -> DataFrame:
    """The category of an edition's canon from its filesets (kind "audio" or "text", timed); a partial canon is partial before all.

    Timing counts on audio filesets; text that is timed without audio is text only.
    """
    has = lambda c: F.coalesce(F.bool_or(c), F.lit(False))
    flags = filesets.groupBy(*keys, canon).agg(
        has(F.col("kind") == "text").alias("t"), has(F.col("kind") == "audio").alias("a"), has((F.col("kind") == "audio") & F.col("timed")).alias("w")
    )
    return flags.select(*keys, canon, F.when(F.col(canon) == "PARTIAL", "partial").otherwise(capability_category(F.col("t"), F.col("a"), F.col("w"))).alias("category"))


def audio_books(metadata: DataFrame, testaments: DataFrame) -> DataFrame:
    """(canon, iso, books) with audio: each book of an audio fileset (iso, type, canon, books) under its own testament.

    ``testaments`` is (book, testament); story collections, other books and missing codes do not count.
    """
    own = metadata.where(F.startswith(F.col("type"), F.lit("audio")) & ~(F.coalesce("canon", F.lit("")) == "STORY") & (F.coalesce("iso", F.lit("")) != ""))
    each = own.select("iso", F.explode("books").alias("book")).join(F.broadcast(testaments), "book")  # one row a book
    return each.groupBy(F.col("testament").alias("canon"), "iso").agg(F.array_sort(F.collect_set("book")).alias("books"))


def resolved_timing(by_book: list[DataFrame], by_canon: DataFrame, testaments: DataFrame) -> DataFrame:
    """Distinct (iso, fileset, book) with timing: of sources that name books, and of one that vouches for a canon, under iso "*"."""
    whole = by_canon.where("whole").select(F.lit("*").alias("iso"), "fileset", F.col("canon").alias("testament")).join(F.broadcast(testaments), "testament")
    return reduce(DataFrame.unionByName, [x.select("iso", "fileset", "book") for x in by_book], whole.select("iso", "fileset", "book")).distinct()


def merged_coverage(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The books of a fileset from several directories: of a book named in more than one the last by ``order`` holds."""
    last = rows.groupBy(*keys, "book").agg(F.max_by("value", order).alias("value"))
    return last.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("book", "value"))).alias("books"))


def tallies(rows: DataFrame, by: str, size: str) -> DataFrame:
    """How many rows of each kind there are, and the sum of their sizes, nulls as nothing."""
    return rows.groupBy(by).agg(F.count("*").alias("n"), F.coalesce(F.sum(size), F.lit(0)).cast("bigint").alias("total"))


def once(rows: DataFrame, keys: list[str], canon: str = "canon", full: str = "FULL") -> DataFrame:
    """The key under which a fileset is processed once: with its canon where that is full, else without; first by order of ``ord``."""
    part = F.when(F.col(canon) == full, F.col(canon)).otherwise("")
    w = Window.partitionBy(*keys, part).orderBy("ord")
    return rows.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def summary(filesets: DataFrame, pairs: DataFrame) -> DataFrame:
    """The counters of a run, one row: languages, filesets by kind, timed ones, pairs."""
    told = filesets.agg(
        F.count_distinct("iso").alias("languages"), F.count("*").alias("filesets"), F.count_if(F.col("kind") == "audio").alias("audio"),
        F.count_if(F.col("kind") == "text").alias("text"), F.count_if((F.col("kind") == "audio") & F.col("timed")).alias("timed"),
    )
    number = pairs.agg(F.count("*").alias("pairs"))
    names = [*told.columns, "pairs"]
    zero = lambda own, n: F.col(n) if n in own.columns else F.lit(0).cast("bigint").alias(n)
    both = told.select(*[zero(told, n) for n in names]).union(number.select(*[zero(number, n) for n in names]))
    return both.agg(*[F.sum(n).alias(n) for n in names])


def first_testament(entries: DataFrame, keys: list[str], testament: str, order: list[str]) -> DataFrame:
    """One entry a key: of the testament that comes first in ``order``."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col(testament))
    w = Window.partitionBy(*keys).orderBy(F.when(place == 0, len(order) + 1).otherwise(place), testament)
    return entries.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def with_field(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """A field looked up by key; a key that the index lacks leaves it null."""
    return rows.join(index, keys, "left")


def known_only(rows: DataFrame, index: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key the index has."""
    return rows.join(index.select(*keys).distinct(), keys, "left_semi")


def tried_status(samples: DataFrame, absent: DataFrame, keys: list[str]) -> DataFrame:
    """Whether a key's sample is there, is known to be absent (a marker file), or neither: (keys, status).

    A sample outweighs a marker.
    """
    a, b = samples.select(*keys, F.lit(1).alias("rank")), absent.select(*keys, F.lit(0).alias("rank"))
    return a.union(b).groupBy(*keys).agg(F.when(F.max("rank") == 1, "present").otherwise("absent").alias("status"))


def chosen_sample(samples: DataFrame, keys: list[str], own: str, name: str) -> DataFrame:
    """One sample a key: that of its own fileset where there is one, else the first by name."""
    w = Window.partitionBy(*keys).orderBy(F.desc(F.coalesce(F.col(own), F.lit(False))), name)
    return samples.withColumn("__k", F.row_number().over(w)).where("__k = 1").drop("__k")


def first_files(files: DataFrame, keys: list[str], order: str, n: int = 3) -> DataFrame:
    """T4: the first ``n`` files of an edition, a report's feature."""
    w = Window.partitionBy(*keys).orderBy(order)
    return files.withColumn("__k", F.row_number().over(w)).where(F.col("__k") <= n).drop("__k")


def preferred_first(ids: Column, preferred: Column) -> Column:
    """Ids in order, those that are preferred before the others."""
    own = F.array_sort(F.array_intersect(ids, preferred))
    return F.concat(own, F.array_sort(F.array_except(ids, preferred)))


def outdated(rows: DataFrame, done: DataFrame, keys: list[str], version: int) -> DataFrame:
    """I4: rows without a result of the present input version."""
    return rows.join(done.where(F.col("input_version") == version).select(*keys).distinct(), keys, "left_anti")


def last_verse(numbers: Column, counted: Column) -> Column:
    """A chapter's last verse: the greatest number in it, else the number of verses that its metadata tell."""
    return F.coalesce(F.array_max(numbers), counted)


def to_recheck(results: DataFrame) -> DataFrame:
    """(iso, file) of comparisons below 1 that name the file they read; a null score was not compared and is none."""
    return results.where((F.col("score") < 1) & (F.coalesce("file", F.lit("")) != "")).select("iso", "file")


def staged(books: DataFrame, chapters: DataFrame) -> DataFrame:
    """K7: (source, target) of files to publish: books (edition, book, with_chapters) and chapters (edition, book, chapter).

    A book is staged beside its chapters; where chapters should be there and are not, it is left out.
    """
    name = F.concat(F.col("edition"), F.lit("/"), F.col("book"))
    have = chapters.select("edition", "book").distinct().withColumn("__have", F.lit(True))
    kept = books.join(have, ["edition", "book"], "left").where("NOT with_chapters OR __have")
    whole = kept.select(F.concat(name, F.lit(".json")).alias("source"), F.concat(name, F.lit(".usj.json")).alias("target"))
    own = chapters.join(kept.where("with_chapters").select("edition", "book"), ["edition", "book"])
    at = F.concat(name, F.lit("/"), F.col("chapter").cast("string"))
    return whole.union(own.select(F.concat(at, F.lit(".json")), F.concat(at, F.lit(".sofria.json"))))
