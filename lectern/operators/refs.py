"""Verse references and numbering schemes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def parse_shapes(lines: DataFrame, line: str = "value", strict: bool = False) -> DataFrame:
    """Lines ``BOOK c:last c:last ...`` to (book, chapter, last); comments, ``=`` lines and other items are skipped.

    ``strict`` raises on an item of another form instead.
    """
    rows = lines.select(F.trim(F.regexp_replace(line, "#.*$", "")).alias("l")).where("l != '' AND l NOT LIKE '%=%'")
    parts = rows.select(F.split("l", r"\s+").alias("p"))
    items = parts.select(F.get("p", F.lit(0)).alias("book"), F.explode(F.slice("p", F.lit(2), F.size("p") - 1)).alias("item"))
    good = F.col("item").rlike(r"^\d+:\d+$")
    if strict:
        items = items.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.concat(F.lit("not a chapter and verse: "), F.col("item"))).cast("boolean")))
    at = lambda k: F.get(F.split("item", ":"), F.lit(k)).cast("int")
    return items.where(good).select("book", at(0).alias("chapter"), at(1).alias("last"))


def split_ref(ref: Column) -> Column:
    """``BOOK C:V``, V with a letter or "title", to a struct; null where it has another form."""
    p = r"^(\S+) (\d+):(?:(\d+)([a-z]?)|title)$"
    get = lambda k: F.regexp_extract(ref, p, k)
    return F.when(
        ref.rlike(p),
        F.struct(get(1).alias("book"), get(2).cast("int").alias("chapter"), F.nullif(get(3), F.lit("")).cast("int").alias("verse"), get(4).alias("sub"), (get(3) == "").alias("is_title")),
    )


def join_ref(book: Column, chapter: Column, verse: Column) -> Column:
    return F.concat(book, F.lit(" "), chapter.cast("string"), F.lit(":"), verse.cast("string"))


def expand_ranges(ranges: DataFrame, shape: DataFrame) -> DataFrame:
    """(id, book, c1, v1, c2, v2) to its verses, within and across chapters; absent chapters have none.

    The range is exploded by chapter and joined with the shape, so no range join is needed.
    """
    each = ranges.select("*", F.explode(F.sequence("c1", "c2")).alias("chapter")).where("c1 <= c2")
    held = each.join(shape, ["book", "chapter"])
    lo = F.when(F.col("chapter") == F.col("c1"), F.col("v1")).otherwise(1)
    hi = F.when(F.col("chapter") == F.col("c2"), F.least("v2", "last")).otherwise(F.col("last"))
    return held.select("id", "book", "chapter", lo.alias("lo"), hi.alias("hi")).where("lo <= hi").select("id", "book", "chapter", F.explode(F.sequence("lo", "hi")).alias("verse"))


def compose_ranges(verses: DataFrame) -> DataFrame:
    """The verses of an id as ``BOOK C:V-V`` or ``BOOK C:V-C:V``, or a single reference."""
    at = F.struct("chapter", "verse")
    ends = verses.groupBy("id", "book").agg(F.min(at).alias("a"), F.max(at).alias("b"))
    head = join_ref(F.col("book"), F.col("a.chapter"), F.col("a.verse"))
    tail = F.when(F.col("a") == F.col("b"), "").when(F.col("a.chapter") == F.col("b.chapter"), F.concat(F.lit("-"), F.col("b.verse").cast("string"))).otherwise(F.concat(F.lit("-"), F.col("b.chapter").cast("string"), F.lit(":"), F.col("b.verse").cast("string")))
    return ends.select("id", F.concat(head, tail).alias("ref"))


def map_refs(refs: DataFrame, mapping: DataFrame) -> DataFrame:
    """References by a map of (s, t); a reference without a row stands for itself."""
    return refs.join(mapping, refs["ref"] == mapping["s"], "left").select(*refs.columns, F.coalesce("t", "ref").alias("target"))


def crosswalk(refs: DataFrame, rules: DataFrame) -> DataFrame:
    """Book rules (book, to, chapter_offset, only_chapter, to_chapter; ``to`` null drops the book); a rule for one chapter leaves the others."""
    r = refs.join(rules.select(F.col("book").alias("__b"), "to", "chapter_offset", "only_chapter", "to_chapter"), F.col("book") == F.col("__b"), "left")
    out = r.where(F.col("__b").isNull() | F.col("to").isNotNull())
    ruled = F.col("to").isNotNull() & (F.col("only_chapter").isNull() | (F.col("only_chapter") == F.col("chapter")))
    chapter = F.when(ruled, F.coalesce(F.col("to_chapter"), F.col("chapter") + F.coalesce("chapter_offset", F.lit(0)))).otherwise(F.col("chapter"))
    return out.select(*[c for c in refs.columns if c not in ("book", "chapter")], F.when(ruled, F.col("to")).otherwise(F.col("book")).alias("book"), chapter.alias("chapter"))


def classify_scheme(ps117: Column, ps151: Column, ps51: Column, mal: Column, mal4: Column, sa17: Column, ki4: Column, hag1: Column, byzantine: Column) -> Column:
    """The numbering scheme by probe counts; "?" where the probe that decides next is unknown.

    Psalm 117 of 15 verses and more, or a Psalm 151, means Septuagint numbering; a Byzantine order
    of books then confirms rso, short 1 Samuel 17 and 1 Kings 4 lxx, and Haggai 1 splits vul and
    rso.  Else Psalm 51 tells eng, and a confirmed fourth chapter of Malachi orgw from org.
    """
    unknown = F.lit("?")
    short = (sa17 <= 40) & F.coalesce(ki4 <= 25, F.lit(True))
    septuagint = F.when(byzantine, "rso").when(sa17.isNull(), unknown).when(short, "lxx").when(hag1.isNull(), unknown).when(hag1 == 14, "vul").otherwise("rso")
    four = F.when(mal4.isNull(), unknown).when(mal4, "orgw").otherwise("org")
    masoretic = F.when(ps51.isNull(), unknown).when(ps51 <= 20, "eng").when(F.coalesce(mal == 4, F.lit(False)), four).otherwise("org")
    return F.when(ps117.isNull(), unknown).when((ps117 >= 15) | ps151, septuagint).otherwise(masoretic)


def checksum(counts: DataFrame, reference: DataFrame, slack: int = 20, extra_weight: int = 100, chapter_books: tuple[str, ...] = ("PSA",)) -> DataFrame:
    """D3: whether a text's verse counts agree with a scheme's: (id, worst, flagged, ok).

    ``counts``: (id, book, verses, chapters); ``reference``: (book, ref_verses, ref_chapters).  A book is
    flagged that alone has more than ``slack`` verses too many, or else, among ``chapter_books``, too
    many chapters, each of which weighs ``extra_weight``.  Too few verses, books without a reference
    and null counts tell nothing; a text without any book to check is ok.
    """
    j = counts.join(reference, "book", "left")
    over, extra = F.col("verses") - F.col("ref_verses"), F.col("chapters") - F.col("ref_chapters")
    sign = F.when(over > slack, F.struct(over.alias("weight"), F.concat("book", F.lit(" v+"), over.cast("string")).alias("told")))
    sign = sign.when(F.col("book").isin(*chapter_books) & (extra > 0), F.struct((extra * extra_weight).alias("weight"), F.concat("book", F.lit(" ch+"), extra.cast("string")).alias("told")))
    told = j.withColumn("__s", sign).groupBy("id").agg(F.coalesce(F.max("__s.weight"), F.lit(0).cast("bigint")).alias("worst"), F.array_sort(F.collect_list("__s.told")).alias("flagged"))
    return told.withColumn("ok", F.size("flagged") == 0)


def nearest_shape(lengths: DataFrame, shapes: DataFrame, order: list[str]) -> DataFrame:
    """Per text the scheme with the fewest conflicts; ties by ``order``.

    A chapter conflicts only where its length is that of another scheme.
    """
    every = shapes.groupBy("book", "chapter").agg(F.collect_set("last").alias("lasts"))
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("scheme"))
    j = lengths.join(shapes.withColumnRenamed("last", "own"), ["book", "chapter"]).join(every, ["book", "chapter"])
    conflict = (F.col("last") != F.col("own")) & F.array_contains("lasts", F.col("last"))
    n = j.groupBy("id", "scheme").agg(F.count_if(conflict).alias("conflicts"))
    best = n.groupBy("id").agg(F.min(F.struct("conflicts", rank.alias("k"), "scheme")).alias("b"))
    grade = F.when(F.col("b.conflicts") == 0, "exact").when(F.col("b.conflicts") <= 5, "near").otherwise("custom")
    return best.select("id", "b.scheme", "b.conflicts", grade.alias("grade"))


def shape_gaps(a: DataFrame, b: DataFrame, touched: DataFrame) -> DataFrame:
    """Chapters whose lengths differ between two shapes and that no map row touches."""
    diff = a.join(b.withColumnRenamed("last", "other"), ["book", "chapter"]).where("last != other")
    return diff.join(touched.select("book", "chapter"), ["book", "chapter"], "left_anti")


def contiguous(refs: DataFrame) -> DataFrame:
    """Whether the references of an id (book, chapter, verse, last of their chapter) follow one another, across chapter ends too."""
    w = Window.partitionBy("id").orderBy("chapter", "verse")
    lag = lambda c: F.lag(c).over(w)
    follows = ((F.col("chapter") == lag("chapter")) & (F.col("verse") == lag("verse") + 1)) | ((F.col("chapter") == lag("chapter") + 1) & (F.col("verse") == 1) & (lag("verse") == lag("last")))
    flagged = refs.withColumn("__f", F.coalesce(follows | lag("verse").isNull(), F.lit(True)))
    return flagged.groupBy("id").agg(F.bool_and("__f").alias("contiguous"))


def neighbour_offset(df: DataFrame, by: list[str], order: str, offset: str) -> DataFrame:
    """An unknown offset from the nearest known ones: where both sides agree or one is there; else the mode of its group."""
    side = lambda k: F.last(offset, ignorenulls=True).over(Window.partitionBy(*by).orderBy(k).rowsBetween(Window.unboundedPreceding, -1))
    before, after = side(F.asc(order)), side(F.desc(order))
    modes = df.where(F.col(offset).isNotNull()).groupBy(*by, offset).agg(F.count("*").alias("__n")).groupBy(*by).agg(F.min(F.struct((-F.col("__n")).alias("k"), F.col(offset).alias("v"))).alias("__m"))
    near = df.withColumns({"__a": before, "__b": after}).join(modes, by, "left")
    pick = F.when(F.col("__a") == F.col("__b"), F.col("__a")).when(F.col("__a").isNull(), F.col("__b")).when(F.col("__b").isNull(), F.col("__a")).otherwise(F.col("__m.v"))
    return near.withColumn("resolved", F.coalesce(F.col(offset), pick)).drop("__a", "__b", "__m")


def render_shape(shape: DataFrame, order: list[str]) -> DataFrame:
    """K5: (position, line) of a scheme's shape; books in ``order``, others after them by name."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("book"))
    items = F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("chapter", "last"))), lambda x: F.concat(x["chapter"].cast("string"), F.lit(":"), x["last"].cast("string"))), " ")
    lines = shape.groupBy("book").agg(items.alias("items"))
    key = F.struct(F.when(place == 0, len(order) + 1).otherwise(place).alias("k"), F.col("book"))
    return lines.select(key.alias("position"), F.concat("book", F.lit(" "), "items").alias("line"))
