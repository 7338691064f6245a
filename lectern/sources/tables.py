"""Sources (S1-S24): JSON pages, CSV and TSV tables, curated TOML, listings and pinned files."""

from __future__ import annotations

import tomllib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Fixed schema of a page of the raw catalog.
FILESET = T.StructType([T.StructField(n, T.StringType()) for n in ("id", "type", "size", "volume", "bitrate", "codec", "timing_est_err")])
BIBLE = T.StructType([T.StructField(n, T.StringType()) for n in ("iso", "abbr", "language", "autonym", "name", "vname", "mark", "country")] + [T.StructField("filesets", T.MapType(T.StringType(), T.ArrayType(FILESET)))])
PAGE = T.StructType([T.StructField("data", T.ArrayType(BIBLE))])


def catalog_pages(spark: SparkSession, paths) -> DataFrame:
    """Paged JSON; one row per entry, with the page it came from."""
    pages = spark.read.schema(PAGE).option("multiLine", True).json(paths)
    return pages.select(F.input_file_name().alias("page"), F.posexplode("data").alias("pos", "b")).select("page", "pos", "b.*")


def filesets(entries: DataFrame) -> DataFrame:
    """One row per deliverable of an entry."""
    each = entries.select("iso", "abbr", F.explode("filesets").alias("bucket", "list"))
    return each.select("iso", "abbr", "bucket", F.explode("list").alias("f")).select("iso", "abbr", "bucket", "f.*")


def json_directory(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON file per entity; files that do not parse are skipped."""
    full = T.StructType([*schema.fields, T.StructField("_corrupt_record", T.StringType())])
    rows = spark.read.schema(full).option("multiLine", True).option("mode", "PERMISSIVE").json(path)
    return rows.withColumn("file", F.input_file_name()).where("_corrupt_record IS NULL").drop("_corrupt_record")


def csv_table(spark: SparkSession, path: str, schema: str, ints: tuple[str, ...] = ()) -> DataFrame:
    """CSV with a header, a byte order mark taken off; ``ints`` are numbers, 0 where they are none."""
    rows = spark.read.csv(path, header=True, multiLine=True, schema=schema)
    rows = rows.toDF(*[c.lstrip("﻿") for c in rows.columns])
    return rows.withColumns({c: F.coalesce(F.col(c).try_cast("int"), F.lit(0)) for c in ints})


def iso_table(spark: SparkSession, path: str, name_at: int = 6) -> DataFrame:
    """A tab-separated table without its header; rows of fewer than seven columns go."""
    parts = spark.read.text(path).select(F.split("value", "\t").alias("p"))
    return parts.where(F.size("p") > name_at).select(F.get("p", F.lit(0)).alias("code"), F.get("p", F.lit(name_at)).alias("name")).where("lower(code) != 'id'")


def tsv_map(spark: SparkSession, path: str) -> DataFrame:
    """A mapping with comments and a header."""
    return spark.read.csv(path, sep="\t", comment="#", header=True, schema="source_ref string, standard_ref string, action string")


def toml_table(spark: SparkSession, text: str) -> DataFrame:
    """A curated table of two key levels: (key, id, field, value).  Hand-kept, so small."""
    rows = [(k, i, f, str(v)) for k, own in tomllib.loads(text).items() for i, fields in own.items() for f, v in (fields.items() if isinstance(fields, dict) else [("", fields)])]
    return spark.createDataFrame(rows, "key string, id string, field string, value string")


def listing(paths: DataFrame, path: str = "path") -> DataFrame:
    """An object listing ``canon/iso/folder/BOOK/file`` as a table; other depths go."""
    parts = paths.select(path, F.split(path, "/").alias("p")).where(F.size("p") == 5)
    at = lambda k: F.get("p", F.lit(k))
    name = r"^([A-Z0-9]+)_(\d+)_(.+)_timing\.json$"
    return parts.select(at(0).alias("canon"), at(1).alias("iso"), at(2).alias("folder"), at(3).alias("book"), F.regexp_extract(at(4), name, 2).try_cast("int").alias("chapter"), F.nullif(F.regexp_extract(at(4), name, 3), F.lit("")).alias("fileset"))


def pinned(spark: SparkSession, path: str, sha256: str) -> DataFrame:
    """A file as lines, refused where its digest is not the pinned one."""
    found = spark.read.format("binaryFile").load(path).select(F.sha2("content", 256)).first()[0]
    if found != sha256:
        raise ValueError(f"{path}: digest {found}, pinned {sha256}")
    return spark.read.text(path)
