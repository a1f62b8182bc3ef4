"""Scans by slices equal scans of everything, and read only what changed."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from relata.operators import scans
from relata.operators.incremental import IncrementalScan, NotMergeable
from relata.sinks.tables import Layers
from relata.sources.rules import ScanRule

NOW = datetime(2024, 2, 10)
SCHEMA = "k string, n int, price decimal(10,2), at timestamp, run_date date"
RULES = (
    ScanRule("n_present", "nonNull", "n"),
    ScanRule("n_positive", "rowCondition", "n", "n > 0"),
    ScanRule("k_is_x", "equals", "k", options={"value": "x"}),
    ScanRule("k_is_number", "parsable", "k", options={"type": "int64"}),
    ScanRule("k_unique", "uniqueness", "k"),
    ScanRule("pairs", "duplicatesAtMost", None, options={"keys": ["k", "n"], "present": ["k"], "max": 2}),
    ScanRule("fresh", "tableCondition", "at", "max(at) >= :as_of - interval 25 hours"),
    ScanRule("sums", "tableCondition", None, "sum(price) > 10 and count(*) < 9 and MIN(n) is not null or count(k) = 3"),
    ScanRule("size", "countBetween", None, options={"min": 1, "max": 6}),
    ScanRule("gone", "nonNull", "missing"),
    ScanRule("gone_too", "tableCondition", None, "max(missing) > 1"),
)


def rows(*values):
    return [(k, n, None if n is None else Decimal(n * 2), datetime(2024, 2, 9, 12), date(2024, 2, day)) for k, n, day in values]


@pytest.fixture
def layers(spark, tmp_path):
    return Layers(spark, str(tmp_path))


def sliced(layers, rules=RULES):
    return IncrementalScan(layers, ("raw", "t"), "run_date", ("audit", "t_states"), rules)


def frame(spark, *values):
    return spark.createDataFrame(rows(*values), SCHEMA)


def results(df):
    return sorted(map(str, df.collect()))


def same(spark, layers, found, rules=RULES):
    whole = scans.scan(layers.read("raw", "t"), "s", rules, NOW)
    assert results(found) == results(whole)


def test_only_changed_slices_are_read(spark, layers, monkeypatch):
    read = []
    real = IncrementalScan._rows
    monkeypatch.setattr(IncrementalScan, "_rows", lambda self, names: read.append(sorted(names)) or real(self, names))
    steps = sliced(layers)
    layers.append(frame(spark, ("x", 1, 1), ("y", None, 1), ("7", -3, 2), (None, 2, 2)), "raw", "t")
    assert steps.update(NOW) == ["run_date=2024-02-01", "run_date=2024-02-02"]
    same(spark, layers, steps.scan("s", NOW))
    # A new day: only its files are read. Its keys repeat those of other days.
    layers.append(frame(spark, ("x", 1, 3), ("x", 1, 3), ("x", 1, 3), ("z", 4, 3)), "raw", "t")
    read.clear()
    assert steps.update(NOW) == ["run_date=2024-02-03"] and read == [["run_date=2024-02-03"]]
    files = real(steps, ["run_date=2024-02-03"]).inputFiles()
    assert files and all("run_date=2024-02-03" in name for name in files)
    same(spark, layers, steps.scan("s", NOW))
    # Late rows, a replaced day, a dropped day.
    layers.append(frame(spark, ("late", 9, 1)), "raw", "t")
    assert steps.update(NOW) == ["run_date=2024-02-01"]
    layers.replace_slice(frame(spark, ("new", 5, 2)), "raw", "t", {"run_date": date(2024, 2, 2)})
    same(spark, layers, steps.scan("s", NOW))
    layers.expire("raw", "t", date(2024, 2, 3), 1)
    same(spark, layers, steps.scan("s", NOW))
    assert steps.update(NOW) == [] and steps.stale() == {}


def test_changed_rules_are_evaluated_again(spark, layers):
    layers.append(frame(spark, ("x", 1, 1), ("y", 2, 2)), "raw", "t")
    sliced(layers, RULES[:2]).update(NOW)
    changed = (RULES[0], ScanRule("n_positive", "rowCondition", "n", "n > 1"))
    assert len(sliced(layers, changed).stale()) == 2
    same(spark, layers, sliced(layers, changed).scan("s", NOW), changed)


def test_null_slices_and_empty_tables(spark, layers):
    layers.ensure("raw", "t", SCHEMA)
    layers.append(frame(spark, ("x", 1, 1)).withColumn("run_date", F.when(F.lit(False), F.col("run_date"))), "raw", "t")
    steps = sliced(layers)
    same(spark, layers, steps.scan("s", NOW))
    layers.log("raw", "t").drop(["run_date=__HIVE_DEFAULT_PARTITION__"])
    same(spark, layers, steps.scan("s", NOW))


def test_rules_that_do_not_merge_are_refused(spark, layers):
    layers.append(frame(spark, ("x", 1, 1)), "raw", "t")
    for rule in (ScanRule("a", "tableCondition", None, "avg(n) > 1"), ScanRule("b", "rowCondition", "at", "at >= :as_of - interval 1 day")):
        with pytest.raises(NotMergeable):
            sliced(layers, (rule,)).scan("s", NOW)


def test_a_stop_between_keys_and_states_is_healed(spark, layers, monkeypatch):
    layers.append(frame(spark, ("x", 1, 1), ("x", 2, 2)), "raw", "t")
    steps = sliced(layers)
    real = Layers.replace_slices

    def stops(self, df, layer, name, *given):
        if name == "t_states":
            raise OSError("stopped")
        return real(self, df, layer, name, *given)

    monkeypatch.setattr(Layers, "replace_slices", stops)
    with pytest.raises(OSError):
        steps.update(NOW)
    monkeypatch.undo()
    assert len(steps.stale()) == 2
    same(spark, layers, steps.scan("s", NOW))
