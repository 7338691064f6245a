import pytest

from lectern.session import local_session


@pytest.fixture(scope="session")
def spark():
    return local_session(cores=4, **{"spark.sql.shuffle.partitions": "4"})


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"
