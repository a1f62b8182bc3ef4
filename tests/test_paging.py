import pytest
from pyspark.sql import functions as F

from relata.operators import paging


@pytest.fixture
def audience(spark):
    return spark.range(500).select(
        F.when(F.col("id") % 4 == 0, F.concat(F.lit("c"), F.col("id").cast("string"))).alias("salesforce_contact_id"),
        F.when(F.col("id") % 7 > 0, F.concat(F.lit("m"), (F.col("id") % 30).cast("string"))).alias("lead_email"),
        F.col("id").cast("string").alias("user_id"),
    )


def expected(audience):
    return sorted((tuple(r) for r in audience.collect()), key=lambda r: tuple(v or "" for v in r))


@pytest.mark.parametrize("limit,offset", [(0, 0), (20, 0), (20, 35), (0, 480), (0, 35), (100, 450)])
def test_page_matches_slicing(audience, limit, offset):
    found = {tuple(r) for r in paging.page(audience, paging.AUDIENCE_ORDER, limit, offset).collect()}
    wanted = expected(audience)[offset : offset + limit if limit else None]
    assert found == set(wanted)


def test_page_beyond_top_rows_uses_the_index(audience, monkeypatch):
    monkeypatch.setattr(paging, "TOP_ROWS", 10)
    found = {tuple(r) for r in paging.page(audience, paging.AUDIENCE_ORDER, 60, 100).collect()}
    assert found == set(expected(audience)[100:160])


def test_global_index_is_dense_and_ordered(spark):
    df = spark.range(1000).select((F.lit(1000) - F.col("id")).alias("v"))
    found = [(row._index, row.v) for row in paging.global_index(df, [F.col("v")]).collect()]
    assert sorted(found) == [(i, i + 1) for i in range(1000)]
