"""Ids and fields of the catalog as column expressions.

Nulls give null unless a function says otherwise.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What a size code says of each testament: certain, uncertain, or nothing.
SIZE_CANON = {
    "C": (True, True),
    "NT": (True, None),
    "OT": (None, True),
    "NTP": (False, None),
    "OTP": (None, False),
    "NTOTP": (True, False),
    "OTNTP": (False, True),
    "NTPOTP": (False, False),
    "S": (None, None),
    "P": (False, False),
}
#: Licenses without derivatives, sources of foreign texts, a placeholder in the place of a name.
NO_DERIVATIVES = ("CC BY-ND", "CC BY-NC-ND")
FOREIGN = ("helloao:", "ebible:")
PLACEHOLDER = "(vernacular name not cached)"
#: The testament that the seventh letter of an id names.
COLLECTIONS = {"O": "OT", "N": "NT", "C": "FULL", "P": "PARTIAL", "S": "STORY"}


def _pick(key: Column, values: dict, otherwise) -> Column:
    return reduce(lambda c, kv: c.when(key == kv[0], F.lit(kv[1])), values.items(), F.when(F.lit(False), F.lit(None))).otherwise(otherwise)


def resolved_id(base: Column, spec: Column) -> Column:
    """The id that a spec names: small letters add to the base, capitals stand alone; foreign texts and other kinds are null."""
    at = F.instr(spec, ":")
    kind, value = F.substring(spec, F.lit(1), at - 1), F.substring(spec, at + 1, F.length(spec))
    foreign = reduce(lambda a, b: a | b, [F.startswith(value, F.lit(x)) for x in FOREIGN])
    return F.when((at > 0) & kind.isin("a", "t") & ~foreign, F.concat(base, value)).when((at > 0) & kind.isin("A", "T"), value)


def first_spec(specs: Column, kinds: tuple[str, ...]) -> Column:
    """The first spec of one of ``kinds``."""
    return F.get(F.filter(specs, lambda s: F.split(s, ":", 2)[0].isin(*kinds)), F.lit(0))


def short_abbreviation(abbr: Column) -> Column:
    """The first six characters."""
    return F.substring(abbr, 1, 6)


def book_set(fileset: Column, size: Column) -> Column:
    """Which books a fileset holds, by the seventh letter of its id and its size code.

    A partial collection stays partial; whole sizes make it full; the size of one testament counts
    where the letter does not name the other or both; else the letter, or VARIOUS.
    """
    named = _pick(F.substring(fileset, 7, 1), COLLECTIONS, F.lit(""))
    size = F.coalesce(size, F.lit(""))
    return (
        F.when(named == "PARTIAL", named)
        .when(size.isin("C", "NTOTP"), "FULL")
        .when(size.isin("NT", "NTP") & ~named.isin("OT", "FULL"), "NT")
        .when(size.isin("OT", "OTP") & ~named.isin("NT", "FULL"), "OT")
        .when(named == "", "VARIOUS")
        .otherwise(named)
    )


def fileset_stem(fileset: Column) -> Column:
    """The version part of a fileset id: without testament, kind and format at its end."""
    return F.regexp_replace(fileset, r"(?:[NOP]\d?(?:_ET|DA))?(?:-json|-usx)?$", "")


def version_id(iso: Column, abbr: Column) -> Column:
    """P10: an abbreviation without the language code it begins with, in any case."""
    return F.when(F.startswith(F.upper(abbr), F.upper(iso)), F.substring(abbr, F.length(iso) + 1, F.length(abbr))).otherwise(abbr)


def standard_id(iso: Column, version: Column, source: str) -> Column:
    """P10: the id that a version has by the rule of a source."""
    if source == "ebible":
        return F.concat(iso, F.lit("-"), F.lower(version))
    if source == "helloao":
        return F.concat(iso, F.lit("_"), F.lower(version))
    return F.concat(F.upper(iso), F.upper(version))


def may_derive(licenses: Column) -> Column:
    """Whether at least one of the licenses, brackets around it aside, allows derivatives; no license allows nothing."""
    bare = lambda x: F.regexp_replace(F.coalesce(x, F.lit("")), r"^[\[\]]+|[\[\]]+$", "")
    return F.coalesce(F.exists(licenses, lambda x: ~bare(x).isin(*NO_DERIVATIVES)), F.lit(False))


def manifest_field(manifest: Column, key: str) -> Column:
    """A field two blanks deep in a YAML text, without its quotes; null where there is none."""
    pattern = rf"(?m)^  {key}: ['\"]?(.*?)['\"]?\s*$"
    return F.when(manifest.rlike(pattern), F.regexp_extract(manifest, pattern, 1))


def story_title(text: Column) -> Column:
    """P20: the first line with text, without leading signs, number and punctuation; null where nothing is left."""
    lines = F.transform(F.split(text, "\r\n|\r|\n"), lambda x: F.regexp_replace(x, r"(?U)^\s+|\s+$", ""))
    line = F.get(F.filter(lines, lambda x: x != ""), F.lit(0))
    return F.nullif(F.regexp_replace(F.regexp_replace(line, r"(?U)^#*\s*(?:\d+[.\-:]?\s*)?", ""), r"(?U)^\s+|\s+$", ""), F.lit(""))


def without_placeholder(name: Column) -> Column:
    """Null in the place of the placeholder."""
    return F.when(~F.endswith(name, F.lit(PLACEHOLDER)), name)


def numeral(number: Column, separator: str = "-", digits: str | None = None) -> Column:
    """A verse label with the range separator and the ten digits of a script; null counts as empty."""
    s = F.coalesce(number.cast("string"), F.lit(""))
    s = F.regexp_replace(s, r"(\d)-(\d)", f"$1{separator}$2") if separator != "-" else s
    return F.translate(s, "0123456789", digits) if digits else s


def canon_certainty(size: Column) -> Column:
    """a struct (nt, ot): whether a size code holds the whole testament for certain, perhaps, or not at all; unknown codes perhaps."""
    side = lambda k: _pick(size, {c: v[k] for c, v in SIZE_CANON.items()}, F.lit(False)).cast("boolean")
    return F.struct(side(0).alias("nt"), side(1).alias("ot"))


def canon_keys(size: Column) -> Column:
    """the keys that a size code is listed under: nt and ot where certain, ntp and otp where not."""
    c = canon_certainty(size)
    key = lambda k: F.when(c[k], F.lit(k)).when(~c[k], F.lit(k + "p"))
    return F.filter(F.array(key("nt"), key("ot")), lambda x: x.isNotNull())


def source_letters(sources: Column, order: dict[str, str]) -> Column:
    """The letters of the sources in the order of ``order``, as one string; null where there is none."""
    each = [F.when(F.array_contains(sources, name), F.lit(letter)).otherwise("") for name, letter in order.items()]
    return F.nullif(F.concat(*each), F.lit(""))


def book_order(books: Column) -> Column:
    """The tradition that the order of New Testament books follows; a null list is unknown."""
    at = lambda b: F.array_position(books, b)
    known = (at("JAS") > 0) & (at("ACT") > 0)
    return (
        F.when(~F.coalesce(known, F.lit(False)), "unknown")
        .when(at("JAS") == at("ACT") + 1, "byzantine")
        .when(F.slice(books, F.greatest(F.size(books) - 3, F.lit(1)), F.lit(4)) == F.array(*map(F.lit, ("HEB", "JAS", "JUD", "REV"))), "antilegomena")
        .when((at("HEB") > 0) & (at("JAS") == at("HEB") + 1), "standard")
        .otherwise("other")
    )
