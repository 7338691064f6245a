import pytest

from lectern.session import local_session

DOCS = "doc_id bigint, text string, lang string, source string, n_chars bigint, hash string, n bigint"


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def make(spark):
    """Documents from (doc_id, text[, lang]) with extra columns of clashing names."""

    def docs(rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, None, "x", 1) for r in rows]
        return spark.createDataFrame(full, DOCS).repartition(3)

    return docs


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
