"""Fields of metadata records and tables put together from them.

All are expressions or joins in the JVM.  A null field counts as absent; where a rule finds nothing the
result is null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Forms of file names and of fields in texts.
NEW_FILE, OLD_FILE, OLD_DAM = r"^([A-Z0-9]{10})_[AB]\d\d_", r"([A-Z0-9]{10})\.mp3$", r"_([NOP][12])([A-Z0-9]{6})\.mp3$"
TIMING_FILE = r"-([1-4A-Za-z]{3})-(\d+)-timing\.txt$"
STORY_AUDIO = r"_obs_v[\d.]+_(\d{2})_\d+kbps\.\w+$"
CC_LICENSE = r"creativecommons\.org/licenses/([a-z-]+)/(\d(?:\.\d+)?)"
ARTIFACT_LINK = r"artifactContent/([0-9a-f]+)"
STORIES = 50


def found(c: Column, pattern: str, group: int = 1) -> Column:
    """A group of a pattern's first match; null without a match."""
    return F.when(c.rlike(pattern), F.regexp_extract(c, pattern, group))


def catalog_crosswalk(ids: DataFrame, column: str = "id") -> DataFrame:
    """(key, id): ids in the other catalog's style; two ids of one key are an error.

    The check runs within the same aggregation, so it costs no pass of its own.
    """
    n = F.count_distinct(column)
    one = F.when(n == 1, F.min(column)).otherwise(F.raise_error(F.concat(F.lit("ids that meet in one key: "), F.concat_ws(", ", F.min(column), F.max(column)))).cast("string"))
    return ids.where(F.col(column).isNotNull()).groupBy(F.upper(F.replace(F.col(column), F.lit("_"), F.lit(""))).alias("key")).agg(one.alias("id"))


def remapped(rows: DataFrame, codes: DataFrame, column: str = "iso") -> DataFrame:
    """Codes by a table (code, to); a code that it lacks stays."""
    r = codes.select(F.col("code").alias("__c"), F.col("to").alias("__to"))
    return rows.join(r, F.col(column) == F.col("__c"), "left").withColumn(column, F.coalesce("__to", column)).drop("__c", "__to")


def audio_fileset(filename: Column, dam_id: Column) -> Column:
    """The fileset of an audio item; the rules hold in this order."""
    name, dam = F.coalesce(filename, F.lit("")), F.nullif(dam_id, F.lit(""))
    return F.coalesce(
        F.when(F.contains(name, dam), dam),
        F.concat(found(name, OLD_DAM, 2), found(name, OLD_DAM, 1), F.lit("DA")),
        found(name, OLD_FILE),
        dam,
        found(name, NEW_FILE),
    )


def book_and_chapter(has_sources: Column, timing_file: Column, book: Column, chapter: Column) -> Column:
    """Struct (book, chapter): the stated ones, unless the record is of the older kind and a timing file names them."""
    pair = lambda b, c: F.struct(F.upper(b).alias("book"), c.cast("int").alias("chapter"))
    timed = F.when(timing_file.rlike(TIMING_FILE), pair(found(timing_file, TIMING_FILE), found(timing_file, TIMING_FILE, 2)))
    stated = F.when((book != "") & (chapter != 0), pair(book, chapter))
    return F.when(F.coalesce(has_sources, F.lit(False)), F.coalesce(stated, timed)).otherwise(F.coalesce(timed, stated))


def quoted(url: Column) -> Column:
    """Percent-encoded UTF-8, with ``:``, ``/`` and ``%`` as they are."""
    out = F.url_encode(url)
    for sign, left in (("+", "%20"), ("*", "%2A"), ("%7E", "~"), ("%3A", ":"), ("%2F", "/"), ("%25", "%")):
        out = F.replace(out, F.lit(sign), F.lit(left))
    return out


def audio_url(has_sources: Column, url: Column, base_url: Column, filename: Column, default_base: Column) -> Column:
    """The address of an audio item: as given in the newer kind of record, else built and quoted."""
    given = F.nullif(url, F.lit(""))
    built = F.coalesce(given, F.concat(F.rtrim(F.nullif(base_url, F.lit("")), F.lit("/")), F.lit("/"), filename), F.concat(default_base, filename))
    return F.when(F.coalesce(has_sources, F.lit(False)), url).otherwise(quoted(built))


def story_audio(assets: DataFrame, key: list[str], order: str) -> DataFrame:
    """(key, story, url) of release assets (name, url); the last asset of a story holds."""
    named = assets.withColumn("story", found(F.col("name"), STORY_AUDIO)).where("story IS NOT NULL")
    return named.groupBy(*key, "story").agg(F.max_by("url", order).alias("url"))


def story_template(template: Column, quality: Column, repository: Column) -> Column:
    """(story, url) of all stories, from an address with ``{quality}`` and ``{chapter}``.

    Null where a placeholder is missing or the file name does not begin with the repository's own
    name.  Whether an address answers is for the caller to find out.
    """
    short = F.regexp_replace(F.element_at(F.split(repository, "/"), -1), "_obs$", "")
    filled = F.replace(template, F.lit("{quality}"), F.coalesce(F.nullif(quality, F.lit("")), F.lit("64kbps")))
    own = F.element_at(F.split(filled, "/"), -1).startswith(F.concat(short, F.lit("_obs_")))
    stories = F.transform(F.sequence(F.lit(1), F.lit(STORIES)), lambda n: F.lpad(n.cast("string"), 2, "0"))
    each = F.transform(stories, lambda s: F.struct(s.alias("story"), F.replace(filled, F.lit("{chapter}"), s).alias("url")))
    return F.when(F.contains(template, F.lit("{chapter}")) & F.contains(template, F.lit("{quality}")) & own, each)


def cc_license(text: Column) -> Column:
    """The licence that a text's address of Creative Commons names."""
    return F.concat(F.lit("CC "), F.upper(found(text, CC_LICENSE)), F.lit(" "), found(text, CC_LICENSE, 2))


def repository_stories(files: Column, rights: Column, license_text: Column) -> Column:
    """Struct (layout, stories, license) of a repository from its listing of (name, type).

    Files ``NN.md`` tell the newer layout.  Without any it is the older one: folders ``NN`` but 00,
    and there a licence text stands in for rights that are not stated.
    """
    ids = lambda p: F.array_sort(F.transform(F.filter(files, p), lambda f: F.substring(f["name"], 1, 2)))
    newer = ids(lambda f: f["name"].rlike(r"^\d{2}\.md$"))
    older = ids(lambda f: (f["type"] == "dir") & f["name"].rlike(r"^\d{2}$") & (f["name"] != "00"))
    is_new = F.size(newer) > 0
    return F.struct(
        F.when(is_new, "md").otherwise("ts-desktop").alias("layout"),
        F.when(is_new, newer).otherwise(older).alias("stories"),
        F.when(is_new, rights).otherwise(F.coalesce(rights, cc_license(license_text))).alias("license"),
    )


def current(versions: Column, field: str) -> Column:
    """A field of the first version that is current."""
    return F.get(F.filter(versions, lambda v: F.coalesce(v["current"], F.lit(False))), F.lit(0))[field]


def first_artifact(versions: Column, kind: str = "USFM") -> Column:
    """The id of the first artifact of a kind in the last current version that has one."""
    of = F.transform(F.filter(versions, lambda v: F.coalesce(v["current"], F.lit(False))), lambda v: F.get(F.filter(v["artifacts"], lambda a: a["format"] == kind), F.lit(0))["id"])
    return F.try_element_at(F.filter(of, lambda i: i.isNotNull()), F.lit(-1))


def descriptions(description: Column, vernacular: Column, length: int = 300) -> Column:
    """Struct (desc, desc_v): cut and stripped at the right; the vernacular one only where it differs."""
    d, v = F.nullif(description, F.lit("")), F.nullif(vernacular, F.lit(""))
    text = F.coalesce(d, v)
    short = lambda c: F.regexp_replace(F.substring(c, 1, length), r"(?U)\s+$", "")
    return F.struct(short(text).alias("desc"), F.when(~v.eqNullSafe(text), short(v)).alias("desc_v"))


def story_index(languages: DataFrame, audio: DataFrame, video: DataFrame, codes: DataFrame) -> DataFrame:
    """(iso, media, n): ``t`` or ``at``, and ``v``, of languages (iso, n); n only above 1.

    All three tables (audio and video: iso) are read by the codes of ``remapped``.
    """
    has = lambda df, name: remapped(df.select("iso"), codes).where("iso IS NOT NULL").distinct().withColumn(name, F.lit(True))
    held = remapped(languages, codes).join(has(audio, "__a"), "iso", "left").join(has(video, "__v"), "iso", "left")
    media = F.concat(F.when(F.col("__a"), "at").otherwise("t"), F.when(F.col("__v"), "v").otherwise(""))
    return held.select("iso", media.alias("media"), F.when(F.col("n") > 1, F.col("n")).alias("n"))


def matched_editions(projects: DataFrame, versions: DataFrame) -> DataFrame:
    """(id, iso, abbr) of projects (id, versions) through the artifact in a version row's link.

    ``versions``: (pos, link, iso, abbr); of rows with one artifact the last holds, and counts only if
    it states both fields.
    """
    rows = versions.withColumn("artifact", found(F.col("link"), ARTIFACT_LINK)).where("artifact IS NOT NULL")
    last = rows.groupBy("artifact").agg(F.max_by(F.struct("iso", "abbr"), "pos").alias("v"))
    named = projects.select("id", first_artifact(F.col("versions")).alias("artifact")).where("artifact IS NOT NULL")
    return named.join(last, "artifact").select("id", "v.iso", "v.abbr").where("iso != '' AND abbr != ''")
