"""Quality rules with risk-controlled thresholds, in DataFrame operations only.

A document that fails a base rule is out.  The others are judged by rules whose cutoffs are learned
from labelled documents: per stratum and rule the strictest cutoff is taken for which an exact
binomial bound shows that it rejects at most a given share of good documents.  The share that may be
rejected in all is dealt out to the rules, and the level of the tests is divided by the number of
strata and rules (Bonferroni); within a stratum and rule the cutoffs are tested from the most lenient
on, a fixed sequence that needs no further correction.  Where the labels cannot show it, the rule
rejects nothing.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lectern.llm.common import written

#: White space between words: space and tab to carriage return.
BLANK = " \t\n\x0b\x0c\r"
_BLANKS = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
#: Each rule's measure, in thousandths, and the cutoffs tested for it, from lenient to strict.  A document above a cutoff is rejected.
RULES = {
    "symbols": (("n_symbols", "word_chars"), (500, 300, 200, 150, 100, 75, 50, 30, 20, 10)),
    "dup_lines": (("n_dup_lines", "n_words"), (200, 150, 100, 75, 50, 30, 20, 10)),
    "repeats": (("n_repeat_words", "n_words"), (450, 400, 350, 300, 250, 200, 150, 100, 50)),
    "word_size": (("word_chars", "n_words"), (30000, 20000, 15000, 12000, 10000, 9000, 8000)),
}


def measures(docs: DataFrame, *keep: str) -> DataFrame:
    """The base measures of every whole text: n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed.

    A null text has no words.  A word is a run of characters other than BLANK.  Repeated words are
    those in a window of three words that is found twice or more, first ones included; windows are
    compared by 64-bit hashes, sorted, so that a text costs n log n however much it repeats.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("text0", "\n", -1), lambda x: F.translate(x, BLANK, "") != "")
    first = docs.select(*keep, text.alias("text0")).select(
        *keep,
        F.filter(F.split("text0", _BLANKS, -1), lambda x: x != "").alias("words"),
        F.length(F.translate("text0", BLANK, "")).cast("bigint").alias("word_chars"),
        (F.length("text0") - F.length(F.translate("text0", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        lines.alias("lines"),
    )
    at = lambda i: F.element_at("words", i)
    n = F.size("words")
    windows = F.transform(F.sequence(F.lit(1), n - 2), lambda i: F.struct(F.xxhash64(at(i), at(i + 1), at(i + 2)).alias("h"), i.alias("p")))
    empty = F.array().cast("array<struct<h:bigint,p:int>>")
    second = first.select(
        *keep, "word_chars", "n_symbols",
        n.cast("bigint").alias("n_words"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.sort_array(F.when(n >= 3, windows).otherwise(empty)).alias("windows"),
    )
    same = lambda e, k: F.coalesce(F.get("windows", k)["h"] == e["h"], F.lit(False))
    twice = F.filter("windows", lambda e, k: same(e, k - 1) | same(e, k + 1))
    third = second.select(*keep, "word_chars", "n_symbols", "n_words", "n_dup_lines", F.sort_array(F.transform(twice, lambda e: e["p"])).alias("places"))
    # A window adds as many words as it begins after the one before, three at most.
    start = F.struct(F.lit(-3).alias("last"), F.lit(0).cast("bigint").alias("sum"))
    covered = F.aggregate("places", start, lambda a, p: F.struct(p.alias("last"), (a["sum"] + F.least(F.lit(3), p - a["last"])).alias("sum")), lambda a: a["sum"])
    return third.select(*keep, "n_words", "word_chars", "n_symbols", "n_dup_lines", covered.alias("n_repeat_words")).withColumn(
        "base_failed", (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    )


def _value(rule: str) -> Column:
    """A rule's measure in whole thousandths."""
    over, under = RULES[rule][0]
    return F.floor(1000 * F.col(over) / F.greatest(F.col(under), F.lit(1)))


def binomial_tail(k: Column, n: Column, share: float) -> Column:
    """P(at most k of n) for a binomial of probability ``share``, exactly, summed in logarithms; 1 from the mean on.

    This being at most d is the same as the exact (Clopper-Pearson) upper bound at level 1 - d being
    at most ``share``.
    """
    odds = math.log(share / (1 - share))
    zero = n * math.log(1 - share)
    start = F.struct(zero.alias("term"), zero.alias("sum"))

    def step(a, i):
        term = a["term"] + F.log((n - i + 1) / i) + odds
        top = F.greatest(a["sum"], term)
        return F.struct(term.alias("term"), (top + F.log(F.exp(a["sum"] - top) + F.exp(term - top))).alias("sum"))

    steps = F.when(k >= 1, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= share * n, F.lit(1.0)).otherwise(F.aggregate(steps, start, step, lambda a: F.exp(a["sum"])))


def thresholds(measured: DataFrame, labels: DataFrame, false_rejections: float = 0.1, level: float = 0.05) -> DataFrame:
    """(stratum, rule, cutoff): the strictest cutoffs that are shown to be safe.

    ``measured`` has doc_id, stratum and the measures; ``labels`` doc_id and quality (1: good; null
    labels are left out; of several labels of a document the greatest counts).  Good documents that
    pass the base rules are the holdout.  At confidence 1 - ``level``, for all strata at once, the
    rules reject together at most ``false_rejections`` of a stratum's good documents.
    """
    good = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("quality").alias("quality")).where("quality = 1")
    held = measured.where("NOT base_failed").join(good, "doc_id")
    values = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), _value(r).alias("value")) for r in RULES]))
    counts = held.select("stratum", values.alias("v")).groupBy("stratum", "v.rule", "v.value").agg(F.count("*").alias("n"))
    grid = F.create_map(*[x for r, (_, cuts) in RULES.items() for x in (F.lit(r), F.array(*map(F.lit, cuts)))])
    each = counts.select("stratum", "rule", "value", "n", F.explode(grid[F.col("rule")]).alias("cutoff"))
    tested = each.groupBy("stratum", "rule", "cutoff").agg(F.sum("n").alias("n"), F.sum(F.when(F.col("value") > F.col("cutoff"), F.col("n")).otherwise(0)).alias("k"))
    strata = held.agg(F.count_distinct("stratum")).first()[0]
    share = false_rejections / len(RULES)
    passed = tested.where(binomial_tail(F.col("k"), F.col("n"), share) <= level / (len(RULES) * max(1, strata)))
    return passed.groupBy("stratum", "rule").agg(F.min("cutoff").alias("cutoff"))


def judge(docs: DataFrame, labels: DataFrame, stratum: str = "lang", **risk) -> DataFrame:
    """doc_id, the base measures, base_failed and kept of every row of ``docs`` (doc_id, text and ``stratum``).

    kept is false where a base rule fails or a learned cutoff is passed.  Null strata are one
    stratum, together with empty ones.  Repeated rows are judged alike, each on its own; null doc_ids have no label.  Empty
    tables give no rows, and empty labels no cutoffs.
    """
    named = docs.select("doc_id", "text", F.coalesce(F.col(stratum).cast("string"), F.lit("")).alias("stratum"))
    measured = written(measures(named, "doc_id", "stratum"), "measures")
    cutoffs = thresholds(measured, labels, **risk).groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))  # four at most
    over = [F.coalesce(_value(r) > F.col("cutoffs")[r], F.lit(False)) for r in RULES]
    fails = over[0]
    for x in over[1:]:
        fails = fails | x
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return measured.join(cutoffs, "stratum", "left").select("doc_id", *names, "base_failed", (~F.col("base_failed") & ~fails).alias("kept"))


def _sql() -> str:
    grid = " UNION ALL ".join(f"SELECT '{r}' AS rule, unnest({list(cuts)}) AS cutoff" for r, (_, cuts) in RULES.items())
    value = " UNION ALL ".join(f"SELECT doc_id, stratum, base_failed, '{r}' AS rule, (1000 * {a}) // greatest({b}, 1) AS value FROM b" for r, ((a, b), _) in RULES.items())
    share = 0.1 / len(RULES)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS stratum, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines FROM d),
win AS (
  SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, words[p], words[p + 1], words[p + 2]) AS c
  FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS p FROM w)
), rep AS (
  SELECT doc_id, count(DISTINCT q) AS n FROM (SELECT doc_id, p + unnest([0, 1, 2]) AS q FROM win WHERE c > 1) GROUP BY doc_id
), a AS (
  SELECT doc_id, stratum, len(words) AS n_words, length(array_to_string(words, '')) AS word_chars,
         length(text) - length(translate(text, '{SYMBOLS}', '')) AS n_symbols,
         len(lines) - len(list_distinct(lines)) AS n_dup_lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (doc_id)
), b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM a),
v AS ({value}),
h AS (SELECT * FROM v WHERE NOT base_failed AND doc_id IN (SELECT doc_id FROM labels GROUP BY doc_id HAVING max(quality) = 1)),
t AS (
  SELECT stratum, rule, cutoff, count(*) AS n, count(*) FILTER (value > cutoff) AS k
  FROM h JOIN ({grid}) g USING (rule) GROUP BY ALL
), p AS (
  SELECT *, (SELECT count(DISTINCT stratum) FROM h) AS strata,
         CASE WHEN k >= {share} * n THEN 1.0 ELSE list_sum(list_transform(range(0, k + 1),
           lambda i: exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1) + i * ln({share}) + (n - i) * ln(1 - {share})))) END AS tail
  FROM t
), c AS (SELECT stratum, rule, min(cutoff) AS cutoff FROM p WHERE tail <= 0.05 / ({len(RULES)} * strata) GROUP BY ALL),
bad AS (SELECT DISTINCT v.doc_id FROM v JOIN c USING (stratum, rule) WHERE v.value > c.cutoff)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT base_failed AND doc_id NOT IN (SELECT doc_id FROM bad) AS kept
FROM b"""


ORACLE_SQL = _sql()
