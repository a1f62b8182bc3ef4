"""One governed night: gates, ingestion, models, scans, push and archive, each an audited step."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Mapping
from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession

from relata.operators import audit, checks
from relata.operators.quality import QualityGateError
from relata.plans.ingestion import ingest
from relata.plans.nightly import activate, governed_models, governed_quality
from relata.session import configure
from relata.sinks.tables import Layers
from relata.sources.contracts import CONTRACTS
from relata.sources.files import listing

DAG_ID = "governed_crm_nightly"
#: Days that raw slices are kept.
RETENTION_DAYS = 730


def governed_run(
    spark: SparkSession,
    layers: Layers,
    raw_prefix: str,
    manifests: DataFrame,
    users: DataFrame,
    directory: Mapping[str, DataFrame],
    run_date: str,
    as_of: datetime,
    campaign_id: str,
    push: bool = False,
    honour_action: bool = False,
    run_id: str | None = None,
    try_number: int = 1,
) -> str:
    """Run the steps in order; the first that fails ends the run and its error goes to the caller. Returns the run's id.

    Files lie in ``raw_prefix/<run date>``. Each step leaves its status row in ``audit.step_status``, messages redacted;
    what earlier steps wrote, evidence and scan results included, stays. Without ``push`` that step is skipped.
    """
    run = run_id or uuid.uuid4().hex
    day = datetime.strptime(run_date, "%Y-%m-%d")
    folder = f"{raw_prefix.rstrip('/')}/{run_date}"
    layers.ensure("audit", "step_status", audit.STEP_STATUS_SCHEMA)

    def step(name: str, work: Callable[[], Any]) -> Any:
        record = lambda row: layers.append(row, "audit", "step_status")
        return audit.audited(spark, record, day, DAG_ID, run, name, work, try_number)

    def arrival() -> None:
        files = listing(spark, folder)
        audit.require_arrival(audit.arrival_report(manifests, files.select("object_uri", "size_bytes"), raw_prefix), run_date)
        # The shuffles of this run start with as many partitions as its files need.
        configure(spark, files.agg({"size_bytes": "sum"}).first()[0])

    def fresh_users() -> None:
        if not checks.users_as_of(users, run_date, minimum=1).first().passed:
            raise QualityGateError(f"no user was updated on or before {run_date}")

    def send() -> str:
        if not push:
            raise audit.SkipStep("pushes are switched off")
        return activate(spark, layers, members, directory, run_date, campaign_id, as_of, dry_run=False)

    step("check_arrival", arrival)
    for name, contract in CONTRACTS.items():
        step(f"ingest_{name}", lambda c=contract, n=name: ingest(spark, c, folder, run_date, layers, f"{layers.path('rejected', n)}/{run_date}"))
    step("check_users", fresh_users)
    raw = {name: layers.read("raw", name) for name in CONTRACTS} | {"user_raw": users}
    members = step("build_models", lambda: governed_models(layers, raw, as_of))
    step("scan_and_gate", lambda: governed_quality(layers, as_of, honour_action))
    step("dry_run", lambda: activate(spark, layers, members, directory, run_date, campaign_id, as_of))
    try:
        step("push", send)
    except audit.SkipStep:
        pass
    step("archive", lambda: layers.archive_slice(list(CONTRACTS), run_date))
    step("expire", lambda: [layers.expire("raw", name, as_of.date(), RETENTION_DAYS) for name in CONTRACTS])
    return run
