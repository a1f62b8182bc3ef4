"""Times the headline queries and prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (warm runs, median is reported).

The operators start from raw CRM tables, so these are derived from the given tables and stored as
Parquet first; that step is reported as ``setup_sec`` and is not part of a query's time. A query's
time covers building its plan, reading the stored tables, and computing every row and column into a
sink that keeps nothing. ``governed_graph`` is the whole chain from staging to audience, each layer
written and read back.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import tempfile
import time

from pyspark.sql import DataFrame

from relata.catalog.adapters import AS_OF, RUN_DATE, as_of, view
from relata.catalog.models import Models
from relata.operators import cdc, quality, segments
from relata.plans import nightly
from relata.session import local_session
from relata.sinks.tables import Layers

STORED = (
    "user_raw",
    "crm_sales",
    "crm_support",
    "crm_campaign_events",
    "crm_new_partner_leads",
    "raw_sales",
    "raw_support",
    "raw_events",
    "raw_leads",
    "user_changes",
)


class StoredModels(Models):
    """Models over raw tables that are stored already."""

    def raw(self, name: str) -> DataFrame:
        if name not in self._views:
            self._views[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}")
        return self._views[name]


def store(spark, folder: str, cores: int) -> str:
    target = tempfile.mkdtemp(prefix="relata-bench-")
    for name in STORED:
        view(spark, folder, name).repartition(cores).write.parquet(f"{target}/{name}")
    return target


def drain(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def fit_and_score(m: Models) -> DataFrame:
    features = m.features().persist()
    model = segments.fit_segments(features, segments.GOVERNED_FEATURES)
    return segments.user_segments_governed(model, features, as_of())


def merged_changes(m: Models) -> DataFrame:
    changes = m.raw("user_changes")
    changes = changes.toDF(*[name.lower() for name in changes.columns])
    return cdc.apply_changes(m.lower_users(), changes, ["user_id"])


def governed_graph(m: Models) -> DataFrame:
    raw = {
        "user_raw": m.raw("user_raw"),
        "crm_sales": m.raw("raw_sales"),
        "crm_support": m.raw("raw_support"),
        "crm_campaign_events": m.raw("raw_events"),
        "crm_new_partner_leads": m.raw("raw_leads"),
    }
    layers = Layers(m.spark, tempfile.mkdtemp(prefix="relata-bench-"))
    return nightly.governed_models(layers, raw, AS_OF)


HEADLINE = {
    "d9_user_360": lambda m: m.user_360(),
    "d10_user_360_distinct": lambda m: m.lean_user_360(),
    "d11_user_features": lambda m: m.user_features(),
    "d14_audience_governed": lambda m: m.audience(),
    "l1_quality_report": lambda m: quality.quality_report(m.raw_tables()),
    "l2_rejected_records": lambda m: quality.rejected_records(m.raw_tables(), RUN_DATE, as_of()),
    "k1_k5_fit_and_score": fit_and_score,
    "o1_merged_changes": merged_changes,
    "governed_graph": governed_graph,
}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session(cores, app="relata-bench")
    spark.sparkContext.setLogLevel("ERROR")
    started = time.perf_counter()
    stored = store(spark, folder, int(cores))
    setup = time.perf_counter() - started
    cold, warm = {}, {}
    for name, build in HEADLINE.items():
        times = []
        for _ in range(runs + 1):
            started = time.perf_counter()
            drain(build(StoredModels(spark, stored)))
            times.append(time.perf_counter() - started)
            spark.catalog.clearCache()
        cold[name] = round(times[0], 3)
        warm[name] = round(statistics.median(times[1:]), 3)
    found = re.search(r"sf([0-9.]+)", folder)
    print(
        json.dumps(
            {
                "metric": "sum of median warm times of the headline queries",
                "value": round(sum(warm.values()), 3),
                "unit": "sec",
                "queries": warm,
                "cold": cold,
                "setup_sec": round(setup, 3),
                "sf": float(found.group(1)) if found else None,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
