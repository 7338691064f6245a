"""Verse maps between numbering schemes.

References are strings ``BOOK C:V``; V is a number, a number with a letter, or ``title``.  A shape is
a table (book, chapter, last), a map a table (s, t).  Rows with a null in what they are read by are
left out.  Shapes are bounded by the canon; how they are joined is left to the optimizer.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lectern.operators import refs
from lectern.operators.graphs import components, cut

_REF = r"^(\S+) (\d+):(\w+)$"


def book_of(ref: Column) -> Column:
    return F.nullif(F.regexp_extract(ref, _REF, 1), F.lit(""))


def chapter_of(ref: Column) -> Column:
    return F.nullif(F.regexp_extract(ref, _REF, 2), F.lit("")).cast("int")


def verse_of(ref: Column) -> Column:
    """The verse as a number; null for titles and parts of verses."""
    v = F.regexp_extract(ref, _REF, 3)
    return F.when(v.rlike(r"^\d+$"), v).cast("int")


def expand_tradition(ref: Column, books: list[str]) -> Column:
    """P25: ``Gen.1:2-3a`` or ``Psa.3:Title`` as an array of references; null where it does not parse or the book is unknown."""
    p = r"^([0-9A-Za-z]+)\.(\d+):(?:(\d+)(?:-(\d+))?([a-z])?|(Title))$"
    ref = F.trim(ref)
    parsed = F.when(ref.rlike(p), F.split(F.regexp_replace(ref, p, "$1\t$2\t$3\t$4\t$5\t$6"), "\t", -1))

    def verses(x: Column) -> Column:
        book, low = F.upper(x[0]), F.nullif(x[2], F.lit("")).cast("int")
        high = F.coalesce(F.nullif(x[3], F.lit("")).cast("int"), low)
        head = F.concat(book, F.lit(" "), x[1], F.lit(":"))
        each = F.when(low > high, F.array().cast("array<string>")).otherwise(F.transform(F.sequence(low, F.greatest(low, high)), lambda v: F.concat(head, v.cast("string"), x[4])))
        return F.when(x.isNotNull() & book.isin(books), F.when(x[5] != "", F.array(F.concat(head, F.lit("title")))).otherwise(each))

    # Through an array of one, so that a reference is parsed once and not for every part of it.
    return F.get(F.transform(F.array(parsed), verses), F.lit(0))


def scan_columns(lines: DataFrame, source: str = "Hebrew", target: str = "English KJV") -> DataFrame:
    """(path, pos, action, s, t) of lines (path, pos, value) under a header that names both columns.

    A header holds ``source`` and a name that begins with ``target``; its columns hold until the next
    line that begins with ``$`` or names ``source``.  Lines are ordered within their file alone.
    """
    w = Window.partitionBy("path").orderBy("pos")
    cells = F.split("value", "\t")
    names = F.transform(cells, lambda x: F.trim(x))
    starts = F.transform(names, lambda n: n.startswith(target))
    named = F.array_contains(names, source)
    header = named & F.array_contains(starts, True)
    at = F.when(header, F.struct(F.array_position(names, source).alias("s"), F.array_position(starts, True).alias("t")))
    ends = F.when(named | F.col("value").startswith("$"), F.struct(F.lit(0).cast("bigint").alias("s"), F.lit(0).cast("bigint").alias("t")))
    held = lines.select("path", "pos", cells.alias("c"), header.alias("h"), F.last(F.coalesce(at, ends), ignorenulls=True).over(w).alias("at"))
    cell = lambda k: F.trim(F.get("c", k.cast("int")))
    first = F.get("c", F.lit(0))
    rows = held.where(~F.col("h") & (F.col("at.s") > 0) & (F.size("c") > F.greatest("at.s", "at.t") - 1) & (F.trim(first) != "") & ~first.startswith(" "))
    out = rows.select("path", "pos", F.trim(first).alias("action"), cell(F.col("at.s") - 1).alias("s"), cell(F.col("at.t") - 1).alias("t"))
    return out.where(~F.col("action").rlike("^(#|TEST)") & (F.col("s") != "") & (F.col("t") != "") & ~F.col("t").contains("&"))


def single_pairs(rows: DataFrame, books: list[str]) -> DataFrame:
    """(s, t) of scanned rows whose sides have as many verses; all verses of a side go to a title."""
    told = rows.where(~F.col("s").rlike("^(NoVerse|Absent|NotExist)") & ~F.col("t").rlike("^(NoVerse|Absent)"))
    both = told.select(expand_tradition(F.col("s"), books).alias("x"), expand_tradition(F.col("t"), books).alias("y")).where("x IS NOT NULL AND y IS NOT NULL")
    titled = (F.size("y") == 1) & F.get("y", F.lit(0)).endswith(":title")
    paired = F.when(titled, F.transform("x", lambda v: F.struct(v.alias("s"), F.get("y", F.lit(0)).alias("t")))).when(F.size("x") == F.size("y"), F.zip_with("x", "y", lambda v, u: F.struct(v.alias("s"), u.alias("t"))))
    return both.select(F.explode(paired).alias("p")).select("p.s", "p.t").distinct()


def section_pairs(lines: DataFrame, part: str, books: list[str], skip: tuple[str, ...] = ("$", "#", "TEST", "English")) -> DataFrame:
    """(s, t) of rows [label, source, target, action] whose label has ``part`` among its ``+`` parts.

    Labels that begin with one of ``skip`` are heads of sections and no rows.
    """
    head = reduce(or_, [F.trim(F.split("value", "\t")[0]).startswith(x) for x in skip])
    c = F.split("value", "\t")
    at = lambda k: F.trim(F.get(c, F.lit(k)))
    rows = lines.where((F.size(c) >= 4) & (at(0) != "") & ~head & F.array_contains(F.split(at(0), r"\+"), part) & ~at(3).rlike("^(Keep|MergedPrev|MergedFoll)"))
    both = rows.select(expand_tradition(at(1), books).alias("x"), expand_tradition(at(2), books).alias("y")).where("size(x) = size(y) AND x IS NOT NULL")
    return both.select(F.explode(F.arrays_zip("x", "y")).alias("p")).select(F.col("p.x").alias("s"), F.col("p.y").alias("t")).distinct()


def test_blocks(lines: DataFrame) -> DataFrame:
    """(path, block, columns, kind, pos, label, cells) of blocks ``$``, ``TEST`` rows, then data rows.

    A block begins at a ``$`` line that a ``TEST`` line follows; its data end at a blank, ``$`` or ``#`` line.
    """
    w = Window.partitionBy("path").orderBy("pos")
    value = F.col("value")
    starts = value.startswith("$") & F.coalesce(F.lead(value).over(w).startswith("TEST"), F.lit(False))
    c = F.transform(F.split("value", "\t"), lambda x: F.trim(x))
    named = F.filter(F.slice(c, 2, F.greatest(F.size(c), F.lit(1))), lambda x: x != "")
    blocks = lines.select("path", "pos", "value", c.alias("c"), starts.alias("start")).withColumn("block", F.sum(F.col("start").cast("int")).over(w)).where("block > 0")
    inside = Window.partitionBy("path", "block").orderBy("pos")
    begun = F.max(~F.col("start") & ~value.startswith("TEST")).over(inside)
    stop = F.max(~F.col("start") & ~value.startswith("TEST") & ((F.trim("value") == "") | value.startswith("$") | value.startswith("#"))).over(inside)
    columns = F.first(F.when(F.col("start"), named), ignorenulls=True).over(inside)
    rows = blocks.select("path", "block", "pos", "c", "start", columns.alias("columns"), begun.alias("b"), stop.alias("e")).where("NOT start AND NOT e")
    return rows.select("path", "block", "columns", F.when(F.col("b"), "row").otherwise("test").alias("kind"), "pos", F.get("c", F.lit(0)).alias("label"), F.slice("c", F.lit(2), F.size("columns")).alias("cells"))


def in_shape(rows: DataFrame, ref: str, shape: DataFrame, flag: str) -> DataFrame:
    """``rows`` with ``flag``: whether the reference lies in the shape; titles and parts of verses always do."""
    s = shape.select(F.col("book").alias("__b"), F.col("chapter").alias("__c"), F.col("last").alias("__last"))
    r = F.col(ref)
    held = rows.join(s, (book_of(r) == F.col("__b")) & (chapter_of(r) == F.col("__c")), "left")
    return held.withColumn(flag, verse_of(r).isNull() | F.coalesce(verse_of(r).between(1, F.col("__last")), F.lit(False))).drop("__b", "__c", "__last")


def map_exceptions(rows: DataFrame, source: DataFrame, target: DataFrame, reordered: str = "JER") -> DataFrame:
    """Rows outside a shape: (s, t, side, kind); the source is judged first."""
    judged = in_shape(in_shape(rows.select("s", "t"), "s", source, "__s"), "t", target, "__t").where("NOT __s OR NOT __t")
    kind = F.when(F.col("__s"), "recension").when(book_of(F.col("s")) == reordered, "reorder").otherwise("boundary-extend")
    return judged.select("s", "t", F.when(F.col("__s"), "target").otherwise("source").alias("side"), kind.alias("kind"))


def apply_crosswalk(rows: DataFrame, rules: DataFrame, drop: list[str] = (), pending: list[str] = ()) -> DataFrame:
    """Map rows with their source in our books, and a status: ok, dropped or pending.

    ``rules``: (book, to, chapter_offset, only_chapter, to_chapter); a rule for one chapter leaves the others as they are.
    """
    s = F.col("s")
    r = rules.select(F.col("book").alias("__b"), "to", "chapter_offset", "only_chapter", "to_chapter")
    held = rows.join(r, book_of(s) == F.col("__b"), "left")
    status = F.when(book_of(s).isin(list(drop)), "dropped").when(book_of(s).isin(list(pending)), "pending").otherwise("ok")
    ruled = F.col("to").isNotNull() & (F.col("only_chapter").isNull() | (F.col("only_chapter") == chapter_of(s))) & (status == "ok")
    chapter = F.when(F.col("only_chapter").isNotNull(), F.coalesce("to_chapter", chapter_of(s))).otherwise(chapter_of(s) + F.coalesce("chapter_offset", F.lit(0)))
    moved = F.concat(F.col("to"), F.lit(" "), chapter.cast("string"), F.lit(":"), F.regexp_extract(s, _REF, 3))
    return held.select(F.when(ruled, moved).otherwise(s).alias("s"), *[c for c in rows.columns if c != "s"], status.alias("status"))


def identity(rows: DataFrame, ref: str, rules: DataFrame) -> DataFrame:
    """``rows`` with ``identity``: the reference back in the books of the other scheme, else itself.

    Rules of one book are exclusive by chapter, so a reference meets at most one that holds.
    """
    r = F.col(ref)
    back = rules.where("to IS NOT NULL").select(F.col("book").alias("__from"), F.col("to").alias("__to"), "chapter_offset", "only_chapter", "to_chapter")
    holds = (
        F.when(F.col("chapter_offset").isNotNull(), chapter_of(r) > F.col("chapter_offset"))
        .when(F.col("only_chapter").isNotNull(), chapter_of(r) == F.coalesce("to_chapter", F.lit(1)))
        .otherwise(True)
    )
    chapter = F.when(F.col("chapter_offset").isNotNull(), chapter_of(r) - F.col("chapter_offset")).when(F.col("only_chapter").isNotNull(), F.col("only_chapter")).otherwise(chapter_of(r))
    moved = F.concat("__from", F.lit(" "), chapter.cast("string"), F.lit(":"), F.regexp_extract(r, _REF, 3))
    held = rows.join(back, (book_of(r) == F.col("__to")) & holds, "left")
    return held.select(*[F.col(c) for c in rows.columns], F.coalesce(moved, r).alias("identity"))


def reconstruction_problems(rows: DataFrame, book: str, shape: DataFrame) -> DataFrame:
    """Chapters of ``book`` into which rows renumber without reaching the length of the shape: (chapter, reached, last)."""
    t = F.col("t")
    reached = rows.where((book_of(t) == book) & verse_of(t).isNotNull()).groupBy(chapter_of(t).alias("chapter")).agg(F.max(verse_of(t)).alias("reached"))
    return reached.join(shape.where(F.col("book") == book).select("chapter", "last"), "chapter").where("reached != last")


def numbered_alike(shape: DataFrame, target: DataFrame, base: DataFrame) -> DataFrame:
    """Chapters (book, chapter) that have the target's length in the scheme, and not the base's."""
    t = target.select("book", "chapter", F.col("last").alias("__t"))
    b = base.select("book", "chapter", F.col("last").alias("__b"))
    return shape.join(t, ["book", "chapter"]).join(b, ["book", "chapter"], "left").where("last = __t AND NOT (last <=> __b)").select("book", "chapter")


def restricted(pairs: DataFrame, source: DataFrame, target: DataFrame, without: DataFrame | None = None) -> DataFrame:
    """Pairs of differing references that lie in both shapes, less those from chapters of ``without``."""
    held = in_shape(in_shape(pairs.where("s != t"), "s", source, "__s"), "t", target, "__t").where("__s AND __t").select("s", "t")
    if without is None:
        return held
    return held.join(without.select(F.col("book").alias("__b"), F.col("chapter").alias("__c")), (book_of(F.col("s")) == F.col("__b")) & (chapter_of(F.col("s")) == F.col("__c")), "left_anti")


def overridden(base: DataFrame, *layers: DataFrame) -> DataFrame:
    """The base less the sources that a layer maps, and all layers' pairs."""
    over = layers[0].select("s", "t")
    for layer in layers[1:]:
        over = over.union(layer.select("s", "t"))
    return base.select("s", "t").join(over.select("s"), "s", "left_anti").union(over).distinct()


def collisions(rows: DataFrame) -> DataFrame:
    """Targets that two or more sources are renumbered to, titles aside: (t, n)."""
    return rows.where("s != t AND t NOT LIKE '%:title'").groupBy("t").agg(F.count("*").alias("n")).where("n > 1")


def _touched(rows: DataFrame, *keep: str) -> DataFrame:
    """(keep, s, t, book, chapter): every chapter that a row's ranges name."""
    chapters = lambda r: F.transform(F.regexp_extract_all(r, F.lit(r"(\d+):"), F.lit(1)), lambda c: F.struct(F.regexp_extract(r, r"^(\S+)", 1).alias("book"), c.cast("int").alias("chapter")))
    each = F.explode(F.array_distinct(F.concat(chapters(F.col("s")), chapters(F.col("t"))))).alias("__x")
    return rows.select(*keep, "s", "t", each).select(*keep, "s", "t", "__x.book", "__x.chapter")


def holding_relations(relations: DataFrame, mine: DataFrame, theirs: DataFrame, shape: DataFrame, base: DataFrame) -> DataFrame:
    """Relations of the base that hold in a scheme: every chapter they touch has the same length and the same single rows.

    Chapters are compared once, by counts of the rows of both sides, and then joined to the relations.
    """
    sides = _touched(mine.withColumn("__side", F.lit(1)), "__side").union(_touched(theirs.withColumn("__side", F.lit(2)), "__side")).distinct()
    unlike = sides.groupBy("book", "chapter", "s", "t").agg(F.count("*").alias("n")).where("n < 2").select("book", "chapter")
    a, b = shape.select("book", "chapter", F.col("last").alias("__a")), base.select("book", "chapter", F.col("last").alias("__b"))
    lengths = a.join(b, ["book", "chapter"], "full").where("NOT (__a <=> __b)").select("book", "chapter")
    broken = _touched(relations).join(unlike.union(lengths).distinct(), ["book", "chapter"]).select("s", "t")
    return relations.join(broken.distinct(), ["s", "t"], "left_anti")


def layout_rows(layouts: DataFrame, ranges: DataFrame, onward: DataFrame) -> DataFrame:
    """Rows (id, s, t, o) of layouts that differ from the target or, through ``onward`` (s, t), from the base.

    ``layouts``: (id, book, chapter, last); ``ranges``: (id, chapter, v1, v2, to_chapter, to_verse).
    """
    verses = layouts.where("last > 0").select("id", "book", "chapter", F.explode(F.sequence(F.lit(1), "last")).alias("verse"))
    moved = ranges.where("v1 <= v2").select("id", "chapter", F.explode(F.sequence("v1", "v2")).alias("verse"), "v1", "to_chapter", "to_verse")
    moved = moved.select("id", "chapter", "verse", "to_chapter", (F.col("to_verse") + F.col("verse") - F.col("v1")).alias("to_verse"))
    each = verses.join(moved, ["id", "chapter", "verse"], "left")
    s = refs.join_ref(F.col("book"), F.col("chapter"), F.col("verse"))
    t = F.when(F.col("to_chapter").isNotNull(), refs.join_ref(F.col("book"), F.col("to_chapter"), F.col("to_verse"))).otherwise(s)
    named = each.select("id", s.alias("s"), t.alias("t"), F.col("to_chapter").isNotNull().alias("__moved"))
    on = onward.select(F.col("s").alias("t"), F.col("t").alias("__o"))
    return named.join(on, "t", "left").withColumn("o", F.coalesce("__o", "t")).where("__moved OR o != s").select("id", "s", "t", "o")


def scheme_links(verses: DataFrame, single: DataFrame, multi: DataFrame, rules: DataFrame) -> DataFrame:
    """(v, e) of a scheme's verses: relations win over single rows, these over the identity.

    ``multi`` holds a row per pair of verses, as ``refs.expand_ranges`` gives them.
    """
    m = multi.select(F.col("s").alias("v"), F.col("t").alias("__m"))
    one = single.select(F.col("s").alias("v"), F.col("t").alias("__t"))
    named = identity(verses.select("v"), "v", rules)
    return named.join(m, "v", "left").join(one, "v", "left").select("v", F.coalesce("__m", "__t", "identity").alias("e")).distinct()


def compose(x_links: DataFrame, o_links: DataFrame, x_shape: DataFrame, o_shape: DataFrame) -> DataFrame:
    """A scheme's verses to the base's, through the verses both link to: (kind, s, t).

    Links are (v, e).  Verses that share links form groups.  Groups of equal sizes pair in order, if
    all their verses link alike or it is one verse a side (``single``, identities left out); one verse
    meets a contiguous range of the other side (``multi``); a group without the base's verses gives
    ``no_base`` rows; all other groups are ``flagged``, with the first and last verse of each side.
    Groups are handled by windows and counts, and no group is collected.
    """
    tag = lambda side, c: F.concat(F.lit(f"{side}|"), F.col(c))
    edges = x_links.select(tag("x", "v").alias("a"), tag("e", "e").alias("b")).union(o_links.select(tag("o", "v"), tag("e", "e")))
    group = cut(components(edges))
    lasts = {"x": x_shape, "o": o_shape}

    def side(links: DataFrame, name: str) -> DataFrame:
        like = links.groupBy("v").agg(F.array_join(F.sort_array(F.collect_set("e")), ",").alias("like"))
        at = F.struct(book_of(F.col("v")).alias("book"), chapter_of(F.col("v")).alias("chapter"), F.coalesce(verse_of(F.col("v")), F.lit(-1)).alias("verse"))
        rows = like.join(group.where(F.col("node").startswith(f"{name}|")).select(F.substr("node", F.lit(3)).alias("v"), "component"), "v").withColumn("at", at)
        shape = lasts[name].select(F.col("book").alias("__b"), F.col("chapter").alias("__c"), F.col("last").alias("last"))
        rows = rows.join(shape, (F.col("at.book") == F.col("__b")) & (F.col("at.chapter") == F.col("__c")), "left").drop("__b", "__c")
        w = Window.partitionBy("component").orderBy("at", "v")
        before, held = F.lag("at").over(w), F.lag("last").over(w)
        steps = (F.col("at.book") == before["book"]) & (
            ((F.col("at.chapter") == before["chapter"]) & (F.col("at.verse") == before["verse"] + 1))
            | ((F.col("at.chapter") == before["chapter"] + 1) & (F.col("at.verse") == 1) & (before["verse"] == held))
        )
        return rows.select("component", "v", "at", "like", F.row_number().over(w).alias("k"), F.coalesce(steps, before.isNull()).alias("steps"))

    def summary(rows: DataFrame, name: str) -> DataFrame:
        ends = F.min(F.struct("at", "v")).alias("lo"), F.max(F.struct("at", "v")).alias("hi")
        s = rows.groupBy("component").agg(F.count("*").alias("n"), F.bool_and("steps").alias("steps"), F.min("like").alias("a"), F.max("like").alias("z"), *ends)
        return s.select("component", *[F.col(c).alias(f"{name}_{c}") for c in s.columns if c != "component"])

    xs, os_ = cut(side(x_links, "x")), cut(side(o_links, "o"))  # read several times below
    groups = summary(xs, "x").join(summary(os_, "o"), "component", "left")
    alike = F.least("x_a", "o_a") == F.greatest("x_z", "o_z")
    kind = (
        F.when(F.col("o_n").isNull(), "no_base")
        .when(F.col("x_n") == F.col("o_n"), F.when((F.col("x_n") == 1) | alike, "single").otherwise("flagged"))
        .when((F.col("x_n") == 1) & F.col("o_steps"), "multi")
        .when((F.col("o_n") == 1) & F.col("x_steps"), "multi")
        .otherwise("flagged")
    )
    groups = groups.withColumn("kind", kind)
    kinds = groups.select("component", "kind")
    pairs = xs.join(kinds.where("kind = 'single'"), "component").join(os_.select("component", "k", F.col("v").alias("t")), ["component", "k"])
    single = pairs.where("v != t").select("kind", F.col("v").alias("s"), "t")
    absent = xs.join(kinds.where("kind = 'no_base'"), "component").select("kind", F.col("v").alias("s"), F.lit(None).cast("string").alias("t"))
    rest = groups.where("kind IN ('multi', 'flagged')").select("kind", _range("x").alias("s"), _range("o").alias("t"))
    return single.union(absent).union(rest)


def _range(name: str) -> Column:
    """The first to the last verse of a side as a range."""
    lo, hi = F.col(f"{name}_lo.at"), F.col(f"{name}_hi.at")
    verse = hi["verse"].cast("string")
    tail = F.when(F.col(f"{name}_n") == 1, "").when(lo["chapter"] == hi["chapter"], F.concat(F.lit("-"), verse)).otherwise(F.concat(F.lit("-"), hi["chapter"].cast("string"), F.lit(":"), verse))
    return F.concat(F.col(f"{name}_lo.v"), tail)


def witness_mismatches(shape: DataFrame, witness: DataFrame) -> DataFrame:
    """Chapters in which a shape and a text that witnesses it differ: (book, chapter, last, seen); seen is null where the text lacks it."""
    seen = witness.groupBy("book", "chapter").agg(F.max("verse").alias("seen"))
    return shape.select("book", "chapter", "last").join(seen, ["book", "chapter"], "left").where("NOT (last <=> seen)")
