"""USFM books in zip files, their headers, and cached chapter samples."""

from __future__ import annotations

import io
import re
import zipfile

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_BOOK = re.compile(r"^\\id\s+(\S+)", re.M)


def zip_books(spark: SparkSession, path: str) -> DataFrame:
    """(path, name, book, usfm) of the USFM files in zip files; ``book`` is that of the ``\\id`` line, null where there is none.

    A file that is no zip file has no rows.  A zip file is one edition, bounded by nature.
    """

    @F.pandas_udf("array<struct<name:string,book:string,usfm:string>>")
    def members(s: pd.Series) -> pd.Series:
        def one(content: bytes) -> list[dict]:
            try:
                with zipfile.ZipFile(io.BytesIO(content)) as z:
                    texts = [(n, z.read(n).decode("utf-8", "replace")) for n in sorted(z.namelist()) if n.endswith(".usfm")]
            except zipfile.BadZipFile:
                return []
            return [{"name": n, "book": m[1].upper() if (m := _BOOK.search(t)) else None, "usfm": t} for n, t in texts]

        return s.map(one)

    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.explode(members("content")).alias("m")).select("path", "m.*")


def headers(usfm: Column) -> Column:
    """The markers before the first chapter with their text, a map; of a marker met again the first text holds."""
    lines = F.split(usfm, "\r\n|\n")
    end = F.array_position(F.transform(lines, lambda x: F.startswith(x, F.lit("\\c "))), True)
    head = F.when(end > 0, F.slice(lines, F.lit(1), F.greatest(end.cast("int") - 1, F.lit(0)))).otherwise(lines)
    marked = F.filter(F.transform(head, lambda x: F.trim(x)), lambda x: x.rlike(r"^\\[a-z]+\d*\s+\S"))
    pair = F.transform(marked, lambda x: F.struct(F.regexp_extract(x, r"^\\([a-z]+\d*)", 1).alias("key"), F.trim(F.regexp_extract(x, r"^\\[a-z]+\d*\s+(.*)$", 1)).alias("value")))
    first = F.filter(pair, lambda x, k: ~F.exists(F.slice(pair, F.lit(1), k), lambda y: y["key"] == x["key"]))
    return F.map_from_entries(first)


def samples(spark: SparkSession, path: str) -> DataFrame:
    """(iso, fileset, book, chapter, verses) of sample files ``iso/fileset/book/BOOK_chapter_….txt``: lines with something on them."""
    files = spark.read.text(path, wholetext=True, pathGlobFilter="*.txt", recursiveFileLookup=True).select("value", F.input_file_name().alias("path"))
    lines = F.size(F.filter(F.split("value", "\n"), lambda x: ~x.rlike(r"(?U)^\s*$")))
    return _keys(files).select("iso", "fileset", "book", "chapter", lines.alias("verses"))


def markers(spark: SparkSession, path: str) -> DataFrame:
    """(iso, fileset, book, chapter) that are known to be absent, by marker files of the same names."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.absent").option("recursiveFileLookup", True).load(path)
    return _keys(files).select("iso", "fileset", "book", "chapter")


def _keys(files: DataFrame) -> DataFrame:
    part = lambda k: F.element_at(F.split("path", "/"), -k)
    name = r"^([A-Z0-9]+)_(\d+)_"
    return files.withColumns({"iso": part(4), "fileset": part(3), "book": F.regexp_extract(part(1), name, 1), "chapter": F.regexp_extract(part(1), name, 2).try_cast("int")}).where("book != ''")
