"""JSON sinks (K1-K6): one minified document, and one per language.

Null fields are left out, as ``to_json`` does; entries are ordered by their key.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def entry_json(df: DataFrame, key: list[str], sep: str = ":") -> DataFrame:
    """(key, value): rows as JSON under their joined key."""
    fields = [c for c in df.columns if c not in key]
    return df.select(F.concat_ws(sep, *key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def _object(entries: Column) -> Column:
    quoted = F.transform(F.sort_array(entries), lambda e: F.concat(F.to_json(F.array(e["key"])).substr(F.lit(2), F.length(F.to_json(F.array(e["key"]))) - 2), F.lit(":"), e["value"]))
    return F.concat(F.lit("{"), F.array_join(quoted, ","), F.lit("}"))


def documents_by(df: DataFrame, by: list[str], key: list[str], header: str = '"schema_version":1') -> DataFrame:
    """K2: one document per value of ``by``: (by, document); the header is repeated in each."""
    fields = [c for c in df.columns if c not in (*key, *by)]
    entry = F.struct(F.concat_ws(":", *key).alias("key"), F.to_json(F.struct(*fields)).alias("value"))
    body = _object(F.collect_list(entry))
    return df.groupBy(*by).agg(F.concat(F.lit("{" + header + ',"entries":'), body, F.lit("}")).alias("document"))


def write_split(df: DataFrame, path: str, iso: str, key: list[str]) -> None:
    """K2-K4: a file per language under ``first letter / language``."""
    out = documents_by(df, [iso], key).withColumn("iso0", F.substring(iso, 1, 1))
    out.write.mode("overwrite").partitionBy("iso0", iso).text(path)


def meta_document(meta: dict[str, Column], books: Column, formats: Column) -> Column:
    """K6: an edition's own fields, then its books and the formats that are published, as one JSON text."""
    return F.to_json(F.struct(*[c.alias(k) for k, c in meta.items()], books.alias("books"), formats.alias("formats")))


def placed(keys: DataFrame, languages: DataFrame, key: str = "key") -> DataFrame:
    """K3: ``keys`` with the language that each edition's index key belongs to, null where no id space places it.

    A key is ``source:id``; ``languages`` is (id, iso) with ids as editions are published: ``h:`` and
    ``e:`` for two sources, the collections' ids beginning with their language.
    """
    source, ident = F.split(F.col(key), ":", 2)[0], F.split(F.col(key), ":", 2)[1]
    letter = F.when(source == "helloao", "h:").when(source == "ebible", "e:").otherwise("?")
    named = keys.withColumn("__id", F.concat(letter, ident))
    found = named.join(languages.select(F.col("id").alias("__id"), F.col("iso").alias("__iso")), "__id", "left").drop("__id")
    return found.withColumn("iso", F.when(source == "pkf", F.split(ident, "_")[0]).otherwise(F.col("__iso"))).drop("__iso")


def verified(published: DataFrame, local: DataFrame, path: str = "path", digest: str = "sha256") -> DataFrame:
    """(path, state) of every local file: same, differs or missing where it is published."""
    p = published.select(path, F.col(digest).alias("__published"))
    state = F.when(F.col("__published").isNull(), "missing").when(F.col("__published") == F.col(digest), "same").otherwise("differs")
    return local.join(p, path, "left").select(path, state.alias("state"))
