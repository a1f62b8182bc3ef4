"""Audience checks, assertions and the remaining small table checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from relata.operators.aggregates import duplicate_keys
from relata.operators.audience import EMAIL_CONSENT, PARTNER_OPT_IN
from relata.operators.quality import QualityGateError

# Names and texts of the two audience checks.
ROW_COUNT_CHECK = "salesforce_audience_row_count"
ROW_COUNT_DETAILS = "mart.salesforce_campaign_audience must have at least one row"
DUPLICATE_CHECK = "salesforce_audience_duplicate_keys"
DUPLICATE_DETAILS = "campaign_id + user_id + run_date must be unique"
AUDIENCE_KEYS = ("campaign_id", "user_id", "run_date")
PASS, FAIL = "PASS", "FAIL"

QUALITY_CHECK_SCHEMA = (
    "run_date date, execution_id string, check_name string, status string, "
    "metric_value double, threshold_value double, checked_at timestamp, details string"
)


def _check_row(metric: Column, passed: Column, threshold: float, name: str, details: str, as_of: Column, execution_id: str | None):
    return [
        F.to_date(as_of).alias("run_date"),
        (F.uuid() if execution_id is None else F.lit(execution_id)).alias("execution_id"),
        F.lit(name).alias("check_name"),
        F.when(passed, F.lit(PASS)).otherwise(F.lit(FAIL)).alias("status"),
        metric.cast("double").alias("metric_value"),
        F.lit(float(threshold)).alias("threshold_value"),
        as_of.alias("checked_at"),
        F.lit(details).alias("details"),
    ]


def check_row_count(audience: DataFrame, as_of: Column, execution_id: str | None = None) -> DataFrame:
    counted = audience.agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return counted.select(*_check_row(n, n > 0, 1, ROW_COUNT_CHECK, ROW_COUNT_DETAILS, as_of, execution_id))


def check_duplicates(audience: DataFrame, as_of: Column, execution_id: str | None = None) -> DataFrame:
    counted = duplicate_keys(audience, AUDIENCE_KEYS).agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    return counted.select(*_check_row(n, n == 0, 0, DUPLICATE_CHECK, DUPLICATE_DETAILS, as_of, execution_id))


def no_fail_verdict(results: DataFrame, as_of: Column) -> DataFrame:
    """One row: are there no failed checks on the day of ``as_of``?"""
    today = (F.col("run_date") == F.to_date(as_of)) & (F.col("status") == FAIL)
    return results.agg(F.count_if(today).alias("failed_checks")).select(
        (F.col("failed_checks") == 0).alias("passed"), "failed_checks"
    )


def assert_no_fail(results: DataFrame, as_of: Column) -> None:
    verdict = no_fail_verdict(results, as_of).first()
    if not verdict.passed:
        raise QualityGateError("Quality checks failed")


def assert_unique_user(profile: DataFrame) -> DataFrame:
    """Violations: user ids with more than one row."""
    return duplicate_keys(profile, ["user_id"])


def assert_consent(audience: DataFrame) -> DataFrame:
    """Violations: rows whose consent is another than the two known ones. A NULL consent is none."""
    return audience.where(~F.col("consent_status").isin(EMAIL_CONSENT, PARTNER_OPT_IN))


def assertion(violations: DataFrame, name: str) -> None:
    """An assertion passes when its query finds nothing."""
    if violations.take(1):
        raise QualityGateError(f"assertion {name} found violations")


def users_as_of(users: DataFrame, run_date: str, minimum: int | None = None) -> DataFrame:
    """How many users were updated on or before the run date; judged only when a minimum is given."""
    current = F.to_date("updated_at") <= F.lit(run_date).cast("date")
    counted = users.agg(F.count_if(current).alias("row_count"))
    if minimum is None:
        return counted
    return counted.select("row_count", (F.col("row_count") >= minimum).alias("passed"))


def source_fresh(df: DataFrame, column: str, run_date: str, max_days: int) -> DataFrame:
    """Newest source timestamp against the run date: neither older than ``max_days`` nor later."""
    latest = F.to_date(F.max(column))
    return df.agg(latest.alias("latest_day")).select(
        "latest_day",
        F.coalesce(
            (F.col("latest_day") <= F.lit(run_date).cast("date"))
            & (F.datediff(F.lit(run_date).cast("date"), "latest_day") <= max_days),
            F.lit(False),
        ).alias("passed"),
    )


def duplicates_at_most(df: DataFrame, keys: Sequence[str], limit: int) -> DataFrame:
    groups = duplicate_keys(df, keys).agg(F.count(F.lit(1)).alias("duplicate_groups"))
    return groups.select("duplicate_groups", (F.col("duplicate_groups") <= limit).alias("passed"))
