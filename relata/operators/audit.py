"""Arrival gates, transfer manifests, step status, reruns and alerts."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from relata.functions.text import redacted
from relata.operators.paging import latest_runs
from relata.operators.quality import QualityGateError

# Source types a run needs and how their files are named.
REQUIRED_SOURCES = ("crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")
MANIFEST_SUCCESS = "SUCCESS"
SUCCESS, SKIPPED, FAILED = "SUCCESS", "SKIPPED", "FAILED"

STEP_STATUS_SCHEMA = (
    "run_date date, dag_id string, dag_run_id string, task_id string, try_number bigint, "
    "status string, started_at timestamp, ended_at timestamp, message string"
)
LINKED_STEP_STATUS_SCHEMA = (
    "run_date date, execution_id string, step_name string, status string, started_at timestamp, "
    "finished_at timestamp, error_message string, rerun_of_execution_id string"
)
RERUN_SCHEMA = (
    "run_date date, dag_id string, dag_run_id string, task_id string, try_number bigint, "
    "rerun_of_dag_run_id string, operator string, started_at timestamp, ended_at timestamp, "
    "status string, message string"
)


def required_file(source_type: Column, run_date: Column) -> Column:
    """``<source type>_<yyyy_mm_dd>.csv``."""
    return F.concat(source_type, F.lit("_"), F.date_format(run_date, "yyyy_MM_dd"), F.lit(".csv"))


def arrival_report(manifests: DataFrame, files: DataFrame, raw_prefix: str) -> DataFrame:
    """Per run date and required source type, whether its file is announced, there, and not empty.

    ``manifests`` holds one row per run date (``run_date``, ``status``, ``files``); ``files`` is a
    listing (``object_uri``, ``size_bytes``). The four required types are an exploded constant.
    """
    announced = (
        manifests.select("run_date", F.explode("files").alias("f"))
        .groupBy("run_date", F.col("f.source_type").alias("source_type"))
        .agg(F.max("f.object_uri").alias("manifest_uri"))
    )
    needed = manifests.select(
        "run_date", "status", F.explode(F.array(*[F.lit(name) for name in REQUIRED_SOURCES])).alias("source_type")
    ).withColumn(
        "object_uri",
        F.concat(
            F.lit(raw_prefix.rstrip("/") + "/"),
            F.date_format("run_date", "yyyy-MM-dd"),
            F.lit("/"),
            required_file(F.col("source_type"), F.col("run_date")),
        ),
    )
    present = files.groupBy("object_uri").agg(F.max("size_bytes").alias("size_bytes"))
    failure = (
        F.when(~F.col("status").eqNullSafe(MANIFEST_SUCCESS), F.lit("manifest status is not SUCCESS"))
        .when(F.col("manifest_uri").isNull(), F.lit("not in manifest"))
        .when(F.col("size_bytes").isNull(), F.lit("missing file"))
        .when(F.col("size_bytes") <= 0, F.lit("empty file"))
        .when(F.col("manifest_uri") != F.col("object_uri"), F.lit("manifest path differs"))
    )
    return (
        needed.join(announced, ["run_date", "source_type"], "left")
        .join(present, "object_uri", "left")
        .select("run_date", "source_type", "object_uri", "size_bytes", failure.alias("failure"))
        .withColumn("passed", F.col("failure").isNull())
    )


def arrival_verdict(report: DataFrame) -> DataFrame:
    """One row per run date: ready only when all four files passed."""
    return report.groupBy("run_date").agg(
        F.bool_and("passed").alias("passed"), F.count_if(~F.col("passed")).alias("failed_files")
    )


def require_arrival(report: DataFrame, run_date: str) -> None:
    verdict = arrival_verdict(report.where(F.col("run_date") == F.lit(run_date).cast("date"))).first()
    if verdict is None:
        raise QualityGateError(f"no transfer manifest for {run_date}")
    if not verdict.passed:
        raise QualityGateError(f"{verdict.failed_files} required files of {run_date} did not arrive")


def transfer_manifest(files: DataFrame, run_date: str, destination: str) -> DataFrame:
    """Manifest rows of a transfer from a listing of the copied files; all present, so exit code 0."""
    return files.select(
        F.lit(run_date).cast("date").alias("run_date"),
        "file_name",
        F.col("object_uri").alias("source_path"),
        "size_bytes",
        F.concat(F.lit(destination.rstrip("/") + "/"), F.col("file_name")).alias("destination"),
        F.lit(0).alias("exit_code"),
    )


def manifest_verdict(manifest: DataFrame, expected: int = len(REQUIRED_SOURCES)) -> DataFrame:
    """One row: the expected number of objects and no failed copy."""
    return manifest.agg(
        F.count(F.lit(1)).alias("object_count"), F.count_if(F.col("exit_code") != 0).alias("failed_copies")
    ).select(
        "object_count",
        "failed_copies",
        ((F.col("object_count") == expected) & (F.col("failed_copies") == 0)).alias("passed"),
    )


class SkipStep(Exception):
    """Raised by a step that has nothing to do; recorded as SKIPPED."""


def audited(
    spark: SparkSession,
    record: Callable[[DataFrame], None],
    run_date: datetime,
    dag_id: str,
    run_id: str,
    task_id: str,
    step: Callable[[], Any],
    try_number: int = 1,
) -> Any:
    """Run a step and record its status row whichever way it ends."""

    def write(status: str, message: str | None) -> None:
        row = (run_date.date(), dag_id, run_id, task_id, try_number, status, started, now(), message)
        # Messages may quote what a remote service was sent.
        record(spark.createDataFrame([row], STEP_STATUS_SCHEMA).withColumn("message", redacted("message")))

    def now() -> datetime:
        return datetime.now(timezone.utc)

    started = now()
    try:
        result = step()
    except SkipStep as skip:
        write(SKIPPED, str(skip))
        raise
    except Exception as error:
        write(FAILED, str(error))
        raise
    write(SUCCESS, None)
    return result


def rerun_history(status: DataFrame) -> DataFrame:
    """Repeated tries of a task, each with the run of the try before it."""
    before = status.groupBy("run_date", "dag_id", "task_id", (F.col("try_number") + 1).alias("try_number")).agg(
        F.max("dag_run_id").alias("rerun_of_dag_run_id")
    )
    return (
        status.where(F.col("try_number") > 1)
        .join(before, ["run_date", "dag_id", "task_id", "try_number"], "left")
        .select(
            "run_date",
            "dag_id",
            "dag_run_id",
            "task_id",
            "try_number",
            "rerun_of_dag_run_id",
            F.lit(None).cast("string").alias("operator"),
            "started_at",
            "ended_at",
            "status",
            "message",
        )
    )


def linked_reruns(status: DataFrame) -> DataFrame:
    """Executions that name the execution they repeat, beside that origin's outcome."""
    origin = status.select(
        F.col("execution_id").alias("rerun_of_execution_id"),
        "step_name",
        F.col("status").alias("origin_status"),
    )
    return status.where(F.col("rerun_of_execution_id").isNotNull()).join(
        origin, ["rerun_of_execution_id", "step_name"], "left"
    ).select("run_date", "execution_id", "step_name", "status", "rerun_of_execution_id", "origin_status")


def status_report(status: DataFrame, n: int = 50) -> DataFrame:
    return latest_runs(status, n)


def ingestion_report(audit: DataFrame, run_date: str, source_type: str | None = None, n: int = 50) -> DataFrame:
    """Counts of a run date's ingestions: newest first for one source type, else by type."""
    rows = audit.where(F.col("run_date") == F.lit(run_date).cast("date"))
    columns = ["run_date", "source_type", "input_count", "valid_count", "rejected_count", "audit_ts"]
    newest = [F.col("audit_ts").desc_nulls_last(), "input_count", "valid_count"]
    if source_type is None:
        return rows.select(*columns).orderBy("source_type", *newest)
    return rows.where(F.col("source_type") == source_type).select(*columns).orderBy(*newest).limit(n)


def failure_alerts(
    verdict: DataFrame,
    pipeline: str,
    task_id: str,
    run_date: str,
    run_id: str,
    rejected_table: str,
    runbook: str,
    log_url: str | None = None,
) -> DataFrame:
    """One JSON alert per failed verdict row, keys in alphabetical order."""
    text = F.concat(F.lit("Data quality validation failed. Failing ERROR rules: "), F.col("failing_errors"))
    fields = {
        "airflow_log_url": F.lit(log_url).cast("string"),
        "exception": text,
        "pipeline_name": F.lit(pipeline),
        "rejected_table": F.lit(rejected_table),
        "run_date": F.lit(run_date),
        "run_id": F.lit(run_id),
        "runbook": F.lit(runbook),
        "severity": F.lit("ERROR"),
        "task_id": F.lit(task_id),
    }
    packed = F.struct(*[fields[name].alias(name) for name in sorted(fields)])
    return verdict.where(~F.col("passed")).select(F.to_json(packed, {"ignoreNullFields": "false"}).alias("payload"))
