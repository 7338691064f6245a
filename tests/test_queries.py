"""Every registered query of the catalog against its SQL on the small tables."""

import numbers

import duckdb
import pandas as pd
import pytest

import __spark_entry__
from lectern.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents pages labels conversations".split()


def _norm(frame):
    frame = frame[sorted(frame.columns)]
    return sorted(tuple(map(_plain, row)) for row in frame.itertuples(index=False))


def _plain(x):
    if not hasattr(x, "__len__") and pd.isna(x):
        return "null"
    if isinstance(x, numbers.Number):
        return repr(round(float(x), 9))
    return str(list(x)) if hasattr(x, "tolist") and hasattr(x, "__len__") else str(x)


@pytest.fixture(scope="module")
def duck(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query(spark, sf, duck, name):
    got = catalog.QUERIES[name](spark, sf).toPandas()
    if name in catalog.ORACLE_SQL:
        want = duck.sql(catalog.ORACLE_SQL[name]).df()
        assert sorted(got.columns) == sorted(want.columns)
        assert _norm(got) == _norm(want)


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
