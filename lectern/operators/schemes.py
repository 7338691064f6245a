"""Labels of numbering schemes where the probes do not decide, and variants of a scheme."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Verses of Daniel above which a text has the Greek additions; schemes that may take them.
DANIEL = 400
MASORETIC = ("eng", "org", "orgw")


def labelled(texts: DataFrame, additions: int = DANIEL) -> DataFrame:
    """``texts`` with the published label and, where it rests on a default, the reason: (id, label, assumed).

    ``texts`` has id, scheme (of ``refs.classify_scheme``), ps117, ps51, sa17, dan (verses), book_order,
    has_books, books (their number) and ok (of ``refs.checksum``, null where not checked).  A text of at
    most 27 books is eng.  Where the probes leave "?", the order of books, Daniel, and then what the
    psalms have ruled out decide; a text that no rule fits is undetermined.  A Masoretic scheme with
    the Greek Daniel is catm; a label that fails the checksum is irregular.
    """
    c = F.col
    known = lambda x: F.coalesce(x, F.lit(False))
    greek = known(c("dan") > additions)
    rules = [
        (known(c("book_order") == "byzantine"), "rso", F.when(c("ps117").isNull(), "book_order_only")),
        (greek, "catm", F.lit(None).cast("string")),
        (known((c("ps117") < 15) & (c("ps51") > 20)), "org", F.lit("tiebreaker_unconfirmed")),
        (known((c("ps117") >= 15) & c("sa17").isNotNull()), "vul", F.lit("tiebreaker_unconfirmed")),
        (known(c("has_books")) & c("ps117").isNull(), "eng", F.lit("no_psalm_evidence")),
    ]
    fallback = _first(rules, F.struct(F.lit("undetermined").alias("label"), F.lit(None).cast("string").alias("assumed")))
    promoted = F.when(c("scheme").isin(*MASORETIC) & greek, "catm").otherwise(c("scheme"))
    checked = F.when(F.coalesce(c("ok"), F.lit(True)), promoted).otherwise("irregular")
    decided = F.struct(checked.alias("label"), F.lit(None).cast("string").alias("assumed"))
    new_only = F.struct(F.lit("eng").alias("label"), F.lit("nt_only").alias("assumed"))
    told = F.when(F.coalesce(c("books"), F.lit(0)) <= 27, new_only).when(c("scheme") == "?", fallback).otherwise(decided)
    return texts.select("id", told.alias("__t")).select("id", "__t.*")


def _first(rules: list[tuple[Column, str, Column]], otherwise: Column) -> Column:
    out = otherwise
    for when, label, why in reversed(rules):
        out = F.when(when, F.struct(F.lit(label).alias("label"), why.alias("assumed"))).otherwise(out)
    return out


def new_testament_variants(lengths: DataFrame, base: DataFrame, variants: DataFrame, profiles: DataFrame) -> DataFrame:
    """(id, variants, unexplained, profile) of texts from their chapters' lengths (id, book, chapter, last).

    ``base`` (book, chapter, last) is the usual shape, ``variants`` (book, chapter, last, variant) names
    what differs from it, ``profiles`` (variants, profile) names sorted lists of these.  Chapters that the
    base lacks tell nothing; a text with nothing to tell has no row.
    """
    usual = base.select("book", "chapter", F.col("last").alias("__usual"))
    differ = lengths.join(usual, ["book", "chapter"]).where("last != __usual")
    named = differ.join(variants, ["book", "chapter", "last"], "left")
    told = named.groupBy("id").agg(
        F.array_sort(F.collect_set("variant")).alias("variants"),
        F.array_sort(F.collect_list(F.when(F.col("variant").isNull(), F.concat_ws(" ", "book", F.col("chapter").cast("string"))))).alias("unexplained"),
    )
    return told.join(F.broadcast(profiles), "variants", "left").select("id", "variants", "unexplained", "profile")  # a row a known profile


def old_testament_variants(lengths: DataFrame, labels: DataFrame, shapes: DataFrame, blocks: DataFrame) -> DataFrame:
    """(id, variants, unexplained) of texts whose blocks of chapters are divided otherwise than in their scheme.

    ``lengths`` (id, book, chapter, last), ``labels`` (id, scheme), ``shapes`` (scheme, book, chapter,
    last), ``blocks`` (book, chapters, lasts, variant), chapters and lasts being arrays of the same
    length.  A block counts only where the text has all its chapters; a block that is neither as in the
    scheme nor as in a variant is unexplained.  A text with nothing to tell has no row.
    """
    each = blocks.select("book", "chapters").distinct().select("book", "chapters", F.explode("chapters").alias("chapter"))
    parts = lambda c: F.transform(F.array_sort(F.collect_list(F.struct("chapter", c))), lambda x: x[c])
    own = lengths.join(each, ["book", "chapter"]).groupBy("id", "book", "chapters").agg(parts("last").alias("lasts")).where(F.size("lasts") == F.size("chapters"))
    plain = shapes.join(each, ["book", "chapter"]).groupBy("scheme", "book", "chapters").agg(parts("last").alias("__plain"))
    mine = own.join(labels, "id").join(shapes.select("scheme").distinct(), "scheme", "left_semi")
    differ = mine.join(plain, ["scheme", "book", "chapters"], "left").where(~F.col("lasts").eqNullSafe(F.col("__plain")))
    named = differ.join(blocks, ["book", "chapters", "lasts"], "left")
    ends = F.concat("book", F.lit(" "), F.col("chapters")[0].cast("string"), F.lit("-"), F.element_at("chapters", -1).cast("string"), F.lit(": "), F.array_join(F.transform("lasts", lambda x: x.cast("string")), "/"))
    return named.groupBy("id").agg(F.array_sort(F.collect_set("variant")).alias("variants"), F.array_sort(F.collect_list(F.when(F.col("variant").isNull(), ends))).alias("unexplained"))
