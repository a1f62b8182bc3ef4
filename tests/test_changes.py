import pytest
from pyspark.sql import functions as F

from relata.operators import cdc
from relata.sources.changes import change_schema
from relata.streaming.changes import ChangeTable, start_cdc

SCHEMA = "k string, v int"
FEED = "k string, v int, op string, seq bigint"


@pytest.fixture
def snapshot(spark):
    return spark.createDataFrame([("a", 1), ("b", 2), ("c", 3), ("d", 4)], SCHEMA)


CHANGES = [
    ("a", 10, "U", 1), ("a", 11, "U", 5), ("b", 2, "D", 2), ("c", 30, "U", 3), ("c", 3, "D", 4), ("e", 50, "I", 6), ("f", 60, "I", 7), ("f", 60, "D", 8),
]
CURRENT = [("a", 11), ("d", 4), ("e", 50)]


def test_apply_changes(spark, snapshot, rows):
    changes = spark.createDataFrame(CHANGES, FEED)
    assert rows(cdc.apply_changes(snapshot, changes, ["k"])) == CURRENT


def test_applying_twice_changes_nothing(spark, snapshot, rows):
    changes = spark.createDataFrame(CHANGES, FEED)
    once = cdc.apply_changes(snapshot, changes, ["k"])
    assert rows(cdc.apply_changes(once, changes, ["k"])) == CURRENT


def test_stream_equals_batch_with_any_order_of_files(spark, snapshot, rows, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "table"), ["k"])
    feed = tmp_path / "feed"
    # The later changes arrive first.
    for number, part in enumerate((CHANGES[4:], CHANGES[:2], CHANGES[2:4])):
        spark.createDataFrame(part, FEED).coalesce(1).write.parquet(f"{feed}/p{number}")
    run = lambda: start_cdc(
        spark, f"{feed}/p*", table, snapshot.schema, str(tmp_path / "cp"), available_now=True, files_per_batch=1
    ).awaitTermination()
    table.backfill(snapshot)
    run()
    assert len(table.log_batches()) == 3
    assert rows(table.current()) == CURRENT
    assert table.compact() == 3 and table.log_batches() == []
    assert rows(table.current()) == CURRENT
    run()
    assert table.log_batches() == []


def test_repeated_batch_and_late_change_after_compaction(spark, snapshot, rows, tmp_path):
    table = ChangeTable(spark, str(tmp_path), ["k"])
    table.backfill(snapshot)
    changes = spark.createDataFrame(CHANGES, FEED)
    table.add_batch(changes, 0)
    table.add_batch(changes, 0)
    table.compact()
    # A change older than what is merged, for a live key and for a deleted one.
    table.add_batch(spark.createDataFrame([("a", 99, "U", 2), ("b", 98, "U", 1)], FEED), 1)
    assert rows(table.current()) == CURRENT
    table.compact()
    assert rows(table.current()) == CURRENT


def test_insert_missing_leaves_present_rows(spark, snapshot, rows):
    source = spark.createDataFrame([("a", 100), ("z", 26)], SCHEMA)
    assert rows(cdc.insert_missing(snapshot, source, ["k"])) == [("a", 1), ("b", 2), ("c", 3), ("d", 4), ("z", 26)]


def test_changes_are_reduced_before_the_snapshot_is_met(spark, snapshot):
    changes = spark.createDataFrame(CHANGES, FEED)
    plan = cdc.apply_changes(snapshot, changes, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" in plan and "WindowGroupLimit" in plan and "CartesianProduct" not in plan


def test_change_schema(snapshot):
    assert change_schema(snapshot.schema).names == ["k", "v", "op", "seq"]


def test_hot_key_in_the_feed(spark, snapshot, rows):
    feed = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, F.lit("a")).otherwise(F.concat(F.lit("n"), F.col("id").cast("string"))).alias("k"),
        F.col("id").cast("int").alias("v"),
        F.lit("U").alias("op"),
        F.col("id").alias("seq"),
    )
    found = {row.k: row.v for row in cdc.apply_changes(snapshot, feed, ["k"]).collect()}
    assert found["a"] == 2997 and len(found) == 2000 + 4


def test_one_ranking_and_one_scan_of_the_base(spark, snapshot, tmp_path):
    snapshot.write.parquet(str(tmp_path / "base"))
    spark.createDataFrame(CHANGES, FEED).write.parquet(str(tmp_path / "feed"))
    base, feed = spark.read.parquet(str(tmp_path / "base")), spark.read.parquet(str(tmp_path / "feed"))
    for merged in (cdc.apply_changes(base, feed, ["k"]), cdc.merge_changes(cdc.as_base(base), feed, ["k"])):
        plan = merged._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("Window [") == 1 and plan.count("Relation [") == 2


def test_a_merge_ranks_both_sides_alike(spark, rows):
    one = [("a", 1, "U", 5), ("b", 1, "I", None), ("c", 1, "D", 3), ("d", None, "U", 2), ("e", 4, "U", None), (None, 1, "U", 1)]
    two = [("a", 2, "D", 5), ("b", 2, "U", 1), ("c", 1, "U", 3), ("d", 7, "U", 2), ("e", 3, "U", None), (None, 2, "U", 9), ("f", 1, "I", 1)]
    one, two = (spark.createDataFrame(x, FEED) for x in (one, two))
    expected = rows(cdc.last_changes(one.unionByName(two), ["k"]).select("k", "v", "op", "seq"))
    assert rows(cdc.merge_changes(one, two, ["k"])) == rows(cdc.merge_changes(two, one, ["k"])) == expected


def bucket_files(table):
    """Base folders by bucket."""
    return {name.rpartition("=")[2]: folders for name, folders in table.log.state().current.items() if name.startswith("kind=base")}


@pytest.fixture
def wide(spark, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "wide"), ["k"], buckets=8, fold_after=None)
    table.backfill(spark.range(400).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").cast("int").alias("v")))
    return table


def test_a_change_to_one_key_rewrites_one_bucket(spark, wide):
    before = bucket_files(wide)
    wide.add_batch(spark.createDataFrame([("k7", -7, "U", 1)], FEED), 0)
    assert bucket_files(wide) == before
    assert wide.current().where("k = 'k7'").first().v == -7
    assert wide.compact() == 1
    after = bucket_files(wide)
    changed = [bucket for bucket in before if before[bucket] != after[bucket]]
    assert len(before) == 8 and len(changed) == 1
    found = {row.k: row.v for row in wide.current().collect()}
    assert len(found) == 400 and found["k7"] == -7 and found["k8"] == 8
    # A table that is opened again keeps its number of buckets.
    assert ChangeTable(spark, wide.path, ["k"], buckets=3).buckets == 8


def test_buckets_without_a_log_are_read_without_a_join(spark, wide):
    assert "Join" not in wide.current()._jdf.queryExecution().optimizedPlan().toString()
    wide.add_batch(spark.createDataFrame([("k7", -7, "U", 1)], FEED), 0)
    plan = wide.current()._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join FullOuter") == 1 and "Union" in plan


def test_the_stream_folds_buckets_whose_log_is_long(spark, snapshot, rows, tmp_path):
    table = ChangeTable(spark, str(tmp_path / "table"), ["k"], buckets=4, fold_after=2)
    feed = tmp_path / "feed"
    for number, change in enumerate(CHANGES):
        spark.createDataFrame([change], FEED).coalesce(1).write.parquet(f"{feed}/p{number}")
    query = start_cdc(
        spark, f"{feed}/p*", table, snapshot.schema, str(tmp_path / "cp"), backfill=snapshot, available_now=True, files_per_batch=1
    )
    query.awaitTermination()
    state = table.log.state().current
    assert all(len(folders) < 2 for name, folders in state.items() if name.startswith("kind=log"))
    assert len(table.log_batches()) < len(CHANGES) and rows(table.current()) == CURRENT


def test_changes_added_during_a_fold_stay(spark, wide, monkeypatch):
    wide.add_batch(spark.createDataFrame([("k7", 1, "U", 1)], FEED), 0)
    real = wide.log.commit

    def later(change, **given):
        monkeypatch.undo()
        wide.add_batch(spark.createDataFrame([("k7", 2, "U", 2)], FEED), 1)
        return real(change, **given)

    monkeypatch.setattr(wide.log, "commit", later)
    assert wide.compact() == 1 and wide.log_batches() == [1]
    assert wide.current().where("k = 'k7'").first().v == 2
    assert wide.compact() == 1 and wide.current().where("k = 'k7'").first().v == 2


@pytest.mark.parametrize("step", ["written", "commit"])
def test_a_fold_that_stops_changes_nothing(spark, wide, monkeypatch, step):
    wide.add_batch(spark.createDataFrame([("k7", 1, "U", 1), ("k8", None, "D", 2)], FEED), 0)
    monkeypatch.setattr(wide.log, step, lambda *given: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        wide.compact()
    monkeypatch.undo()
    assert wide.log_batches() == [0] and wide.current().count() == 399
    assert wide.compact() == 1 and wide.current().count() == 399
