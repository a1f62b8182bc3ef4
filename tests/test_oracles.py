"""Every registered query against its SQL oracle on the smallest tables."""

import math

import pytest

import __spark_entry__ as entry_points
from tests.conftest import SMALL

QUERIES, ORACLES = entry_points.queries(), entry_points.oracle_sql()


def plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else value
    return value


def ordered(found):
    return sorted(found, key=lambda row: tuple((v is None, type(v).__name__, str(v)) for v in row))


@pytest.mark.parametrize("key", sorted(QUERIES))
def test_query(spark, duck, key):
    df = QUERIES[key](spark, SMALL)
    names = sorted(df.columns)
    found = ordered(tuple(plain(row[name]) for name in names) for row in df.collect())
    if key not in ORACLES:
        assert found
        return
    cursor = duck.execute(ORACLES[key])
    columns = [column[0] for column in cursor.description]
    assert sorted(columns) == names
    places = [columns.index(name) for name in names]
    expected = ordered(tuple(plain(row[i]) for i in places) for row in cursor.fetchall())
    assert found == expected


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)


def test_flagship(spark):
    df = entry_points.entry(spark)
    assert df.count() == 150
    assert df.columns[0] == "user_id"
