"""Layered tables: replacement, slices, reruns, archive, retention."""

from datetime import date

import pytest
from pyspark.sql import functions as F

from relata.sinks import commits, tables
from relata.sinks.commits import CommitLog
from relata.sinks.tables import Layers, SliceError


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path))


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, n int, run_date date")


D1, D2 = date(2024, 2, 1), date(2024, 2, 2)


def test_replace_reads_its_own_table_and_keeps_two_versions(spark, layers):
    layers.replace(frame(spark, ("a", 1, D1), ("b", 2, D1)), "mart", "t")
    for _ in range(3):
        layers.replace(layers.current("mart", "t").withColumn("n", F.col("n") + 1), "mart", "t")
    assert sorted(row.n for row in layers.current("mart", "t").collect()) == [4, 5]
    assert layers.versions("mart", "t") == [3, 4]


def test_unfinished_version_is_ignored(spark, layers):
    layers.replace(frame(spark, ("a", 1, D1)), "mart", "t")
    spark.createDataFrame([("x",)], "k string").write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        layers.path("mart", "t") + "/v=9"
    )
    assert layers.versions("mart", "t") == [1]


def test_replace_slice_with_no_rows_empties_it(spark, layers):
    layers.append(frame(spark, ("a", 1, D1), ("b", 2, D2)), "audit", "t")
    layers.replace_slice(frame(spark), "audit", "t", {"run_date": D1})
    assert [row.k for row in layers.read("audit", "t").collect()] == ["b"]


def test_replace_slice_may_read_the_slice(spark, layers):
    layers.append(frame(spark, ("a", 1, D1), ("b", 2, D1)), "audit", "t")
    layers.replace_slice(layers.read("audit", "t").where("k = 'a'"), "audit", "t", {"run_date": D1})
    assert [row.k for row in layers.read("audit", "t").collect()] == ["a"]


def test_slice_values_are_escaped_as_spark_does(spark, layers):
    name = "a/b=c: 100%?"
    df = frame(spark, (name, 1, D1), ("plain", 2, D1))
    layers.append(df, "audit", "t", ("k",))
    layers.replace_slice(df.withColumn("n", F.lit(7)), "audit", "t", {"k": name})
    assert sorted((row.k, row.n) for row in layers.read("audit", "t").collect()) == [(name, 7), ("plain", 2)]


def test_declared_table_keeps_its_types(spark, layers):
    schema = "run_date date, name string, n bigint"
    layers.ensure("audit", "runs", schema)
    assert layers.read("audit", "runs").count() == 0
    layers.append_row((D1, "007", 5), "audit", "runs", schema)
    row = layers.read("audit", "runs").first()
    assert row.run_date == D1 and row.name == "007" and row.n == 5


def test_archive_needs_every_slice_and_moves_all(spark, layers):
    layers.append(frame(spark, ("a", 1, D1), ("b", 2, D2)), "raw", "x")
    with pytest.raises(SliceError, match="missing y"):
        layers.archive_slice(["x", "y"], D1)
    assert layers.slices("raw", "x") == ["2024-02-01", "2024-02-02"]
    layers.append(frame(spark, ("c", 3, D1)), "raw", "y")
    layers.archive_slice(["x", "y"], D1)
    assert layers.slices("raw", "x") == ["2024-02-02"] and layers.slices("raw", "y") == []
    assert layers.read("archive", "x").count() == 1


def test_an_interrupted_archive_can_be_run_again(spark, layers, monkeypatch):
    layers.append(frame(spark, ("a", 1, D1)), "raw", "x")
    layers.append(frame(spark, ("c", 3, D1)), "raw", "y")
    real = CommitLog.drop

    def breaks_at_y(log, slices):
        if log.base.endswith("/y"):
            raise OSError("gone away")
        return real(log, slices)

    monkeypatch.setattr(CommitLog, "drop", breaks_at_y)
    with pytest.raises(OSError):
        layers.archive_slice(["x", "y"], D1)
    assert layers.slices("raw", "x") == [] and layers.slices("raw", "y") == ["2024-02-01"]
    monkeypatch.setattr(CommitLog, "drop", real)
    layers.archive_slice(["x", "y"], D1)
    assert layers.slices("raw", "y") == []
    assert [layers.read("archive", name).count() for name in ("x", "y")] == [1, 1]


def test_expire_drops_only_old_slices(spark, layers):
    days = [date(2021, 1, 1), date(2022, 1, 31), date(2022, 2, 1), D1]
    layers.append(frame(spark, *[("a", i, day) for i, day in enumerate(days)]), "raw", "x")
    assert sorted(layers.expire("raw", "x", D1, 730)) == ["2021-01-01", "2022-01-31"]
    assert layers.slices("raw", "x") == ["2022-02-01", "2024-02-01"]


def test_clustered_splits_a_hot_key(spark):
    """One key holds most rows of one day; they must not end in one task."""
    df = spark.range(40000).select(
        F.when(F.col("id") % 10 < 7, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id"),
        F.lit(D1).alias("run_date"),
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        placed = tables.clustered(df, ["run_date"], ["k"], 8)
        sizes = [row["count"] for row in placed.groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert sum(sizes) == 40000 and max(sizes) < 15000


def keys(df):
    return sorted(row.k for row in df.collect())


STEPS = ("new_write", "written", "write_text", "publish", "_drop")


@pytest.mark.parametrize("step", STEPS)
@pytest.mark.parametrize("late", [False, True])
def test_a_write_that_stops_anywhere_leaves_a_whole_slice(spark, layers, monkeypatch, step, late):
    layers.append(frame(spark, ("old1", 1, D1), ("old2", 2, D1), ("other", 3, D2)), "raw", "t")
    layers.replace_slice(frame(spark, ("old1", 1, D1), ("old2", 2, D1)), "raw", "t", {"run_date": D1})
    before = layers.read("raw", "t")
    holder = commits if step in ("write_text", "publish") else CommitLog
    real = getattr(holder, step)

    def stops(*given):
        if late:
            real(*given)
        raise OSError("stopped")

    monkeypatch.setattr(holder, step, stops)
    with pytest.raises(OSError, match="stopped"):
        layers.replace_slice(frame(spark, ("new", 9, D1)), "raw", "t", {"run_date": D1})
    monkeypatch.setattr(holder, step, real)
    done = step == "_drop" or (step == "publish" and late)
    assert keys(layers.read("raw", "t")) == (["new", "other"] if done else ["old1", "old2", "other"])
    # Who began to read before still can, and the write can be run again.
    assert keys(before) == ["old1", "old2", "other"]
    layers.replace_slice(frame(spark, ("new", 9, D1)), "raw", "t", {"run_date": D1})
    assert keys(layers.read("raw", "t")) == ["new", "other"]


def test_two_writers_of_a_slice_do_not_mix(spark, layers, monkeypatch):
    layers.append(frame(spark, ("old", 1, D1), ("other", 3, D2)), "raw", "t")
    real, rivals = commits.publish, [lambda: layers.replace_slice(frame(spark, ("b1", 1, D1), ("b2", 2, D1)), "raw", "t", {"run_date": D1})]
    rivals.append(lambda: layers.append(frame(spark, ("late", 7, D2)), "raw", "t"))

    def overtaken(*given):
        # Another writer publishes the same number first.
        if rivals:
            rivals.pop()()
        return real(*given)

    monkeypatch.setattr(commits, "publish", overtaken)
    layers.replace_slice(frame(spark, ("a1", 1, D1), ("a2", 2, D1)), "raw", "t", {"run_date": D1})
    assert rivals == [] and keys(layers.read("raw", "t")) in (["a1", "a2", "late", "other"], ["b1", "b2", "late", "other"])
    assert layers.log("raw", "t").state().number == 4


def test_threads_that_write_at_once_lose_nothing(spark, layers):
    from concurrent.futures import ThreadPoolExecutor

    with ThreadPoolExecutor(6) as pool:
        list(pool.map(lambda i: layers.append(frame(spark, (f"k{i}", i, D1)), "raw", "t"), range(6)))
    assert keys(layers.read("raw", "t")) == [f"k{i}" for i in range(6)]


def test_several_slices_change_by_one_commit_and_one_write(spark, layers):
    schema = "run_date date, check_name string, n int"
    rows = lambda n: spark.createDataFrame([(D1, "a", n), (D1, "b", n), (D1, "c", n), (D2, "a", n)], schema)
    layers.append(rows(1), "audit", "t", ("run_date", "check_name"))
    layers.replace_checks(rows(2).where("check_name != 'b'"), "audit", "t", D1, ["a", "b"])
    assert sorted((str(r.run_date), r.check_name, r.n) for r in layers.read("audit", "t").collect()) == [
        ("2024-02-01", "a", 2), ("2024-02-01", "c", 1), ("2024-02-02", "a", 1),
    ]
    assert layers.log("audit", "t").state().number == 2


def test_old_folders_go_by_replacement_and_by_vacuum(spark, layers, monkeypatch):
    for n in range(4):
        layers.replace_slice(frame(spark, (f"k{n}", n, D1)), "raw", "t", {"run_date": D1})
    log = layers.log("raw", "t")
    written = lambda: commits.folders_named(spark, log.base, "w=*")
    assert len(written()) == 2 and keys(layers.read("raw", "t")) == ["k3"]
    monkeypatch.setattr(CommitLog, "commit", lambda *given: (_ for _ in ()).throw(OSError("stopped")))
    with pytest.raises(OSError):
        layers.append(frame(spark, ("lost", 1, D1)), "raw", "t")
    monkeypatch.undo()
    assert len(written()) == 3 and log.vacuum() == []
    assert len(log.vacuum(kept_seconds=-60)) == 1 and len(written()) == 2
    assert keys(layers.read("raw", "t")) == ["k3"] and log.state().number == 4


def test_a_dropped_slice_leaves_no_files(spark, layers):
    layers.append(frame(spark, ("a", 1, D1), ("b", 2, D2)), "raw", "t")
    layers.replace_slice(frame(spark, ("c", 1, D1)), "raw", "t", {"run_date": D1})
    layers.log("raw", "t").drop(["run_date=2024-02-01"])
    assert commits.folders_named(spark, layers.path("raw", "t"), "w=*/*") == layers.log("raw", "t").state().folders()
    assert keys(layers.read("raw", "t")) == ["b"]
