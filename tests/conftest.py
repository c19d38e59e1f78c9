import pytest

from tests.compare import connect
from tests.session import session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    spark = session("4")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def con():
    return connect(SF_DIR)


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR
