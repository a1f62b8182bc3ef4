"""Declarative rule scans of one table: every rule of a document in one aggregate.

Kinds: ``nonNull``, ``uniqueness``, ``rowCondition``, ``tableCondition``, and the documented extras
``countBetween``, ``equals``, ``parsable``, ``duplicatesAtMost``. A row rule passes a row only when
its expression is TRUE; FALSE and NULL both fail. A rule on a column the table lacks does not stop
the scan: it is reported as not passed with the reason.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from relata.functions.records import instant, utc
from relata.operators.joins import never_null
from relata.operators.quality import QualityGateError, _union
from relata.operators.staging import cast_to
from relata.sources.rules import RULE_SCHEMA, ScanRule

BLOCK_DOWNSTREAM = "BLOCK_DOWNSTREAM"
GATE_HOURS = 12


def rules_frame(spark: SparkSession, rules: Sequence[ScanRule]) -> DataFrame:
    """The rule document as a relation."""
    return spark.createDataFrame([rule.as_row() for rule in rules], RULE_SCHEMA)


def _missing(df: DataFrame, build) -> str | None:
    """The reason when an expression names a column the table lacks."""
    try:
        build()
    except AnalysisException as error:
        if (error.getCondition() or "").startswith("UNRESOLVED_COLUMN"):
            name = (error.getMessageParameters() or {}).get("objectName", "").replace("`", "")
            return f"missing column {name}"
        raise
    return None


def _bind(expression: str, as_of: datetime) -> str:
    moment = utc(as_of).astimezone(timezone.utc)
    return expression.replace(":as_of", f"timestamp '{moment:%Y-%m-%dT%H:%M:%S.%f}Z'")


def _row_pass(rule: ScanRule, df: DataFrame, as_of: datetime) -> Column:
    if rule.kind == "nonNull":
        return F.col(rule.column).isNotNull()
    if rule.kind == "rowCondition":
        return never_null(F.expr(_bind(rule.expression, as_of)))
    if rule.kind == "equals":
        return never_null(F.col(rule.column).cast("string") == F.lit(str(rule.options["value"])))
    if rule.kind == "parsable":
        return F.col(rule.column).isNull() | cast_to(df, rule.column, rule.options["type"]).isNotNull()
    raise ValueError(rule.kind)


def _table_pass(rule: ScanRule, as_of: datetime) -> Column:
    if rule.kind == "tableCondition":
        return never_null(F.expr(_bind(rule.expression, as_of)))
    rows = F.count(F.lit(1))
    return (rows >= rule.options["min"]) & (rows <= rule.options["max"])


def _result(rule: ScanRule, passed: Column, rows: Column, rows_passed: Column | None, reason: str | None) -> Column:
    none = F.lit(None).cast("double")
    percent = none if rows_passed is None else F.when(rows > 0, F.lit(100.0) * rows_passed / rows)
    return F.struct(
        F.lit(rule.rule_id.replace("_", "-")).alias("rule_name"),
        F.lit(rule.column).cast("string").alias("rule_column"),
        F.lit(rule.dimension).alias("dimension"),
        F.lit(rule.severity).alias("severity"),
        F.lit(rule.failure_action).alias("failure_action"),
        passed.alias("rule_passed"),
        rows.cast("bigint").alias("rule_rows_evaluated"),
        percent.cast("double").alias("rule_rows_passed_percent"),
        F.lit(reason).cast("string").alias("reason"),
    )


ROW_KINDS = ("nonNull", "rowCondition", "equals", "parsable")
GROUP_KINDS = ("uniqueness", "duplicatesAtMost")


def _group_rows(rule: ScanRule, df: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """The rows ``_rows`` of each key of a uniqueness rule; map-side combined."""
    keys = rule.options.get("keys") or [rule.column]
    chosen = df.where(rule.options["where"]) if rule.options.get("where") else df
    for key in rule.options.get("present", ()):
        chosen = chosen.where(F.col(key).isNotNull())
    return chosen.groupBy(*by, *keys).agg(F.count(F.lit(1)).alias("_rows"))


def _group_result(rule: ScanRule, groups: DataFrame) -> DataFrame:
    totals = groups.agg(
        F.coalesce(F.sum("_rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("_rows") == 1, 1)), F.lit(0)).alias("single"),
        F.count_if(F.col("_rows") > 1).alias("repeated"),
    )
    allowed = int(rule.options.get("max", 0))
    result = _result(rule, F.col("repeated") <= allowed, F.col("rows"), F.col("single"), None)
    return totals.select(F.inline(F.array(result)))


def _group_rule(rule: ScanRule, df: DataFrame) -> DataFrame:
    return _group_result(rule, _group_rows(rule, df))


def scan(
    df: DataFrame, scan_id: str, rules: Sequence[ScanRule], as_of: datetime, sampling_percent: float = 100, seed: int = 17
) -> DataFrame:
    """Result rows of a rule set over one table; below 100 percent over a sample of it."""
    rows = df if sampling_percent >= 100 else df.sample(fraction=sampling_percent / 100.0, seed=seed)
    total = F.col("_total")
    counted, outcomes, grouped = [F.count(F.lit(1)).alias("_total")], [], []
    for position, rule in enumerate(rules):
        name = f"_r{position}"
        if rule.kind in GROUP_KINDS:
            # A filter may still reach columns a projection dropped, so the condition is selected too.
            where = rule.options.get("where")
            reason = _missing(df, lambda: where and df.select(F.expr(where))) or _missing(
                df, lambda: _group_rule(rule, rows)
            )
            if reason is None:
                grouped.append(_group_rule(rule, rows))
                continue
        elif rule.kind in ROW_KINDS:
            reason = _missing(df, lambda: df.select(_row_pass(rule, df, as_of)))
            if reason is None:
                counted.append(F.count_if(_row_pass(rule, df, as_of)).alias(name))
                outcomes.append(_result(rule, F.col(name) == total, total, F.col(name), None))
                continue
        else:
            reason = _missing(df, lambda: df.agg(_table_pass(rule, as_of)))
            if reason is None:
                counted.append(_table_pass(rule, as_of).alias(name))
                outcomes.append(_result(rule, F.col(name), total, None, None))
                continue
        outcomes.append(_result(rule, F.lit(False), total, None, reason))
    parts = list(grouped)
    if outcomes:
        parts.insert(0, rows.agg(*counted).select(F.inline(F.array(*outcomes))))
    return _union(parts).select(F.lit(scan_id).alias("scan_id"), "*", instant(as_of).alias("job_start_time"))


def nested_results(results: DataFrame) -> DataFrame:
    """The export form: scan id and job outcome as nested columns next to each rule row.

    The job outcome is one row per scan, computed by aggregate and joined back by scan id.
    """
    jobs = results.groupBy("scan_id").agg(F.bool_and("rule_passed").alias("_passed"))
    return results.join(jobs, "scan_id").select(
        F.struct(F.col("scan_id").alias("data_scan_id")).alias("data_quality_scan"),
        F.struct(F.col("_passed").alias("passed")).alias("job_quality_result"),
        *[name for name in results.columns if name != "scan_id"],
    )


def gate_verdict(results: DataFrame, as_of: datetime, hours: int = GATE_HOURS, honour_action: bool = False) -> DataFrame:
    """One row: failed rule rows of the last ``hours``; with ``honour_action`` only blocking rules count."""
    failed = ~F.col("rule_passed") & (F.col("job_start_time") >= instant(as_of) - F.expr(f"interval {int(hours)} hours"))
    if honour_action:
        failed = failed & (F.col("failure_action") == BLOCK_DOWNSTREAM)
    return results.agg(F.count_if(failed).alias("failed_count")).select(
        (F.col("failed_count") == 0).alias("passed"), "failed_count"
    )


def scan_gate(results: DataFrame, as_of: datetime, hours: int = GATE_HOURS, honour_action: bool = False) -> None:
    verdict = gate_verdict(results, as_of, hours, honour_action).first()
    if not verdict.passed:
        raise QualityGateError(f"Quality gate failed: {verdict.failed_count} failed rule rows")


def rule_alerts(results: DataFrame, run_date: str, table: str) -> DataFrame:
    """One notification row per failed rule: date, table, rule, severity, failed share."""
    return results.where(~F.col("rule_passed")).select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(table).alias("failed_table"),
        F.col("rule_name").alias("failed_rule_id"),
        "severity",
        F.round(F.lit(100.0) - F.col("rule_rows_passed_percent"), 6).alias("failed_percent"),
        "rule_rows_evaluated",
        "failure_action",
    )
