"""Joins under skew, against plain joins."""

import pytest
from pyspark.sql import functions as F

from relata.operators import activation, dedupe, joins


@pytest.fixture
def sides(spark):
    left = spark.range(300).select(
        F.col("id").alias("l"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.concat(F.lit("k"), (F.col("id") % 40).cast("string"))).alias("k"),
    )
    right = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), (F.col("id") % 70).cast("string"))).alias("k"),
        F.col("id").alias("r"),
        F.when(F.col("id") % 4 > 0, F.col("id")).alias("maybe"),
    ).where("k not in ('k1', 'k2')")
    return left, right


@pytest.mark.parametrize("part_rows", [1, 5, 1_000_000])
def test_skewed_left_join_equals_a_plain_one(sides, rows, part_rows):
    left, right = sides
    plain = left.join(right, "k", "left").select("l", "k", "r", "maybe")
    assert rows(joins.skewed_left_join(left, right, "k", part_rows).select("l", "k", "r", "maybe")) == rows(plain)


def test_a_hot_right_key_is_dealt_by_its_size(spark):
    right = spark.range(4000).select(F.when(F.col("id") % 5 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("r"))
    left = spark.createDataFrame([("hot", 1), ("5", 2), (None, 3)], "k string, l int")
    joined = joins.skewed_left_join(left, right, "k", part_rows=100)
    assert joined.count() == 3200 + 2
    plan = joined._jdf.queryExecution().optimizedPlan().toString()
    assert "_part" in plan


#: Sizes that let adaptive execution split small test tables.
SMALL_SPLITS = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "16k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
}


@pytest.fixture
def small_splits(spark):
    before = {key: spark.conf.get(key, None) for key in SMALL_SPLITS}
    for key, value in SMALL_SPLITS.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def hot_fact(spark, hot):
    """Most rows have one key; the values do not compress."""
    key = F.when(F.col("id") % 5 > 0, F.lit(hot)).otherwise(F.concat(F.lit("u"), (F.col("id") % 900).cast("string")))
    return spark.range(60_000, numPartitions=8).select(key.alias("user_id"), F.sha2(F.col("id").cast("string"), 256).alias("v"))


def splits(df):
    df.collect()
    return "skew=true" in df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("hot", ["gone", "u7", None])
def test_a_hot_left_key_is_split(spark, small_splits, hot):
    fact = hot_fact(spark, hot)
    users = spark.range(900).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    assert splits(joins.normalised_left_join(fact, users))
    if hot:
        assert splits(joins.unmatched(fact, users, ["user_id"]))
    found = joins.orphans(fact, users)
    if hot == "gone":
        # Four of five rows are orphans: their join is split.
        assert splits(found) and found.count() == 48_000
    else:
        assert found.count() == 0


def test_a_hot_address_is_split(spark, small_splits):
    audience = hot_fact(spark, None).select(F.col("user_id").alias("lead_email"), F.lit(None).cast("string").alias("salesforce_contact_id"), "v")
    directory = spark.range(900).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("email"), F.col("id").cast("string").alias("id"))
    assert splits(activation.resolve_targets(audience, directory, directory))


@pytest.mark.parametrize("bits", [1, 8, 23])
def test_a_full_sieve_only_costs_time(spark, rows, monkeypatch, bits):
    monkeypatch.setattr(joins, "SIEVE_BITS", bits)
    fact = spark.range(500).select(
        F.when(F.col("id") % 3 == 0, F.lit("gone")).otherwise(F.concat(F.lit(" u"), (F.col("id") % 60).cast("string"))).alias("user_id"),
        F.col("id"),
    )
    users = spark.range(40).select(F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"))
    known = {f"u{i}" for i in range(40)}
    expected = sorted((row.user_id, row.id) for row in fact.collect() if row.user_id.strip() not in known)
    assert len(expected) > 167 and sorted(map(tuple, joins.orphans(fact, users).collect())) == expected


def test_a_sieve_of_any_number_of_keys_is_bounded(spark, monkeypatch):
    monkeypatch.setattr(joins, "SIEVE_BITS", 10)
    keys = spark.range(5000).select(F.col("id").cast("string").alias("_key"))
    rows = joins.sieved(spark.range(9000).select(F.col("id").cast("string").alias("k")), "k", keys, "hit")
    assert rows.where("hit").count() == rows.where("hit or k is null").count() >= 5000
    assert rows.where("not hit and cast(k as int) < 5000").count() == 0


def test_hot_key_is_dealt_to_many_parts(spark):
    right = spark.range(8000).select(F.lit("hot").alias("k"), F.col("id").alias("r"))
    parts = right.select(F.pmod(F.xxhash64("r"), F.lit(16)).alias("p")).groupBy("p").count().collect()
    assert len(parts) == 16 and max(row["count"] for row in parts) < 1000


def test_orphans_ignore_blank_keys(spark, rows):
    fact = spark.createDataFrame([(1, "a"), (2, " b "), (3, None), (4, "  "), (5, "zz"), (6, " zz")], "i int, user_id string")
    users = spark.createDataFrame([("a",), ("b ",), (None,)], "user_id string")
    assert rows(joins.orphans(fact, users)) == [(5, "zz"), (6, " zz")]
    assert joins.orphan_count(fact, users).first()[0] == 2


def test_coverage_of_nothing_fails(spark):
    empty = spark.createDataFrame([], "user_id string")
    row = joins.join_coverage(empty, empty, 0.5).first()
    assert (row.total_rows, row.coverage, row.passed) == (0, 0.0, False)


def test_latest_settles_ties_by_the_other_columns(spark, rows):
    df = spark.createDataFrame(
        [("u", 1, "z"), ("u", 2, "b"), ("u", 2, "a"), ("v", None, "n"), ("v", 1, "o")], "k string, at int, city string"
    )
    assert rows(dedupe.latest_by(df, ["k"], ["at"])) == [("u", 2, "a"), ("v", 1, "o")]


def test_window_limit_prunes_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedupe.latest_by(df, ["k"], ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")
