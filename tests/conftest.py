import glob
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from relata.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(cores="8", memory="8g", app="relata-tests")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def duck():
    connection = duckdb.connect()
    connection.execute("set timezone = 'UTC'")
    for path in glob.glob(f"{SMALL}/*.parquet"):
        connection.execute(f"create view {os.path.basename(path)[:-8]} as select * from '{path}'")
    return connection


@pytest.fixture
def rows(spark):
    """Rows of a DataFrame as sorted tuples."""

    def collect(df):
        return sorted((tuple(row) for row in df.collect()), key=lambda row: tuple((v is None, str(v)) for v in row))

    return collect
