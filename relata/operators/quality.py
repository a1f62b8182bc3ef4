"""Rules over the raw tables: a report of failed-row counts, evidence of every failed row, gates.

A rule is data. Each table is read once for all of its rules, however many there are, references to other tables too;
evidence needs the missing keys first, for which the key column alone is read.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.records import fallback_key, hash_hex, row_json
from relata.functions.text import is_blank, is_email, trimmed, upper_trimmed
from relata.operators.joins import known_keys, missing_keys, never_null, sieved
from relata.operators.staging import cast_to

ERROR, WARNING = "ERROR", "WARNING"
USERS, SALES, SUPPORT, EVENTS, LEADS = "user_raw", "crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads"


@dataclass(frozen=True)
class RawRule:
    rule_id: str
    severity: str
    table: str
    kind: str
    column: str | None
    message: str
    args: tuple = ()
    #: Columns tried in turn as the key of an evidence row; None for rules without row evidence.
    keys: tuple[str, ...] | None = None


# The 31 rules, their severities, texts, limits, and evidence keys.
RAW_RULES = (
    RawRule("raw_user_count_positive", ERROR, USERS, "count_positive", None, "raw.user_raw must contain at least one row"),
    RawRule("crm_sales_count_positive", ERROR, SALES, "count_positive", None, "raw.crm_sales must contain at least one row"),
    RawRule("crm_support_count_positive", ERROR, SUPPORT, "count_positive", None, "raw.crm_support must contain at least one row"),
    RawRule("crm_campaign_events_count_positive", ERROR, EVENTS, "count_positive", None, "raw.crm_campaign_events must contain at least one row"),
    RawRule("crm_partner_leads_count_positive", ERROR, LEADS, "count_positive", None, "raw.crm_new_partner_leads must contain at least one row"),
    RawRule("raw_user_count_floor", WARNING, USERS, "count_floor", None, "raw.user_raw is below the 2026-05-26 lab count floor of 10000 rows", (10000,)),
    RawRule("crm_sales_count_floor", WARNING, SALES, "count_floor", None, "raw.crm_sales is below the 2026-05-26 lab count floor of 20000 rows", (20000,)),
    RawRule("crm_support_count_floor", WARNING, SUPPORT, "count_floor", None, "raw.crm_support is below the 2026-05-26 lab count floor of 8000 rows", (8000,)),
    RawRule("crm_campaign_events_count_floor", WARNING, EVENTS, "count_floor", None, "raw.crm_campaign_events is below the 2026-05-26 lab count floor of 50000 rows", (50000,)),
    RawRule("crm_partner_leads_count_floor", WARNING, LEADS, "count_floor", None, "raw.crm_new_partner_leads is below the 2026-05-26 lab count floor of 5000 rows", (5000,)),
    RawRule("user_raw_user_id_required", ERROR, USERS, "required", "USER_ID", "raw.user_raw.USER_ID is required", keys=()),
    RawRule("crm_sales_user_id_required", ERROR, SALES, "required", "user_id", "raw.crm_sales.user_id is required", keys=("deal_id", "customer_id")),
    RawRule("crm_sales_deal_id_required", ERROR, SALES, "required", "deal_id", "raw.crm_sales.deal_id is required", keys=("customer_id", "user_id")),
    RawRule("crm_support_user_id_required", ERROR, SUPPORT, "required", "user_id", "raw.crm_support.user_id is required", keys=("ticket_id",)),
    RawRule("crm_support_ticket_id_required", ERROR, SUPPORT, "required", "ticket_id", "raw.crm_support.ticket_id is required", keys=("user_id",)),
    RawRule("crm_campaign_user_id_required", ERROR, EVENTS, "required", "user_id", "raw.crm_campaign_events.user_id is required", keys=("event_id", "campaign_id")),
    RawRule("crm_campaign_event_id_required", ERROR, EVENTS, "required", "event_id", "raw.crm_campaign_events.event_id is required", keys=("campaign_id", "user_id")),
    RawRule("crm_partner_lead_id_required", ERROR, LEADS, "required", "external_lead_id", "raw.crm_new_partner_leads.external_lead_id is required", keys=("email",)),
    RawRule("crm_partner_email_required", ERROR, LEADS, "required", "email", "raw.crm_new_partner_leads.email is required", keys=("external_lead_id",)),
    RawRule("crm_sales_user_exists_in_oracle", ERROR, SALES, "exists", "user_id", "raw.crm_sales.user_id must exist in raw.user_raw.USER_ID", (USERS, "USER_ID"), ("deal_id", "customer_id")),
    RawRule("crm_support_user_exists_in_oracle", ERROR, SUPPORT, "exists", "user_id", "raw.crm_support.user_id must exist in raw.user_raw.USER_ID", (USERS, "USER_ID"), ("ticket_id",)),
    RawRule("crm_campaign_user_exists_in_oracle", ERROR, EVENTS, "exists", "user_id", "raw.crm_campaign_events.user_id must exist in raw.user_raw.USER_ID", (USERS, "USER_ID"), ("event_id", "campaign_id")),
    RawRule("user_raw_email_format_valid", ERROR, USERS, "email", "EMAIL", "raw.user_raw.EMAIL must be a valid email when present", keys=("USER_ID",)),
    RawRule("user_raw_consent_email_valid", ERROR, USERS, "in_set", "CONSENT_EMAIL", "raw.user_raw.CONSENT_EMAIL must be Y, N, or null", ("Y", "N"), ("USER_ID",)),
    RawRule("crm_partner_email_format_valid", ERROR, LEADS, "email", "email", "raw.crm_new_partner_leads.email must be a valid email", keys=("external_lead_id",)),
    RawRule("crm_partner_opt_in_true", WARNING, LEADS, "is_true", "opt_in", "raw.crm_new_partner_leads.opt_in should be TRUE for activation eligibility"),
    RawRule("crm_sales_deal_amount_non_negative", ERROR, SALES, "range", "deal_amount", "raw.crm_sales.deal_amount must be non-negative", ("numeric", 0, None), ("deal_id", "customer_id")),
    RawRule("crm_support_csat_score_range", ERROR, SUPPORT, "range", "csat_score", "raw.crm_support.csat_score must be null or between 1 and 5", ("int64", 1, 5), ("ticket_id",)),
    RawRule("crm_partner_lead_score_range", ERROR, LEADS, "range", "lead_score", "raw.crm_new_partner_leads.lead_score must be null or between 0 and 100", ("int64", 0, 100), ("external_lead_id", "email")),
    RawRule("crm_sales_currency_known", WARNING, SALES, "in_set", "currency", "raw.crm_sales.currency should be USD, TWD, EUR, or JPY", ("USD", "TWD", "EUR", "JPY")),
    RawRule("crm_campaign_channel_present", WARNING, EVENTS, "required", "channel", "raw.crm_campaign_events.channel should be present"),
)

COUNT_KINDS = ("count_positive", "count_floor")


def violation(rule: RawRule, table: DataFrame) -> Column:
    """True where a row breaks a row rule; never NULL, so unreadable values pass range rules."""
    if rule.kind == "required":
        return is_blank(rule.column)
    if rule.kind == "email":
        return never_null(~is_blank(rule.column) & ~is_email(trimmed(rule.column)))
    if rule.kind == "in_set":
        return never_null(~is_blank(rule.column) & ~upper_trimmed(rule.column).isin(*rule.args))
    if rule.kind == "is_true":
        return ~F.col(rule.column).eqNullSafe(F.lit(True))
    if rule.kind == "range":
        target, low, high = rule.args
        value = cast_to(table, rule.column, target)
        outside = F.lit(False)
        if low is not None:
            outside = outside | (value < low)
        if high is not None:
            outside = outside | (value > high)
        return never_null(outside)
    raise ValueError(f"{rule.rule_id}: {rule.kind} is not a row rule")


def _report_row(rule: RawRule, failed: Column) -> Column:
    return F.struct(
        F.lit(rule.rule_id).alias("rule_id"),
        F.lit(rule.severity).alias("severity"),
        F.lit(f"raw.{rule.table}").alias("source_table"),
        failed.cast("bigint").alias("failed_row_count"),
        F.lit(rule.message).alias("sample_error"),
    )


def table_report(table: DataFrame, rules: list[RawRule], dimensions: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """All rules of one table by one scan, one row per rule.

    Without references it is one aggregate. With them, rows are counted per key first, for every rule at once: that is combined
    before the shuffle, so a hot key is one row, and meets the known keys as such.
    """
    references = [rule for rule in rules if rule.kind == "exists"]
    keys = list(dict.fromkeys(rule.column for rule in references))
    rows_of = [rule for rule in rules if rule.kind not in (*COUNT_KINDS, "exists")]
    counters = [F.count(F.lit(1)).alias("_rows"), *[F.count_if(violation(rule, table)).alias(rule.rule_id) for rule in rows_of]]
    key_columns = [F.when(~is_blank(key), trimmed(key)).alias(f"_key{i}") for i, key in enumerate(keys)]
    counted = table.groupBy(*key_columns).agg(*counters) if keys else table.agg(*counters)
    failed = {rule.rule_id: F.col(rule.rule_id) for rule in rows_of}
    for i, rule in enumerate(references):
        dimension, key = rule.args
        at = f"_key{keys.index(rule.column)}"
        known = known_keys(dimensions[dimension], key).select(F.col("_key").alias(at), F.lit(True).alias(f"_known{i}"))
        counted = counted.join(known, at, "left")
        failed[rule.rule_id] = F.when(F.col(at).isNotNull() & F.col(f"_known{i}").isNull(), F.col("_rows"))
    if keys:
        sums = [F.coalesce(F.sum(count), F.lit(0)).alias(name) for name, count in {"_rows": F.col("_rows"), **failed}.items()]
        counted = counted.agg(*sums)
    limits = {"count_positive": lambda rule: F.col("_rows") <= 0, "count_floor": lambda rule: F.col("_rows") < rule.args[0]}
    values = [limits[rule.kind](rule) if rule.kind in COUNT_KINDS else F.col(rule.rule_id) for rule in rules]
    return counted.select(F.inline(F.array(*[_report_row(rule, value) for rule, value in zip(rules, values, strict=True)])))


def quality_report(tables: Mapping[str, DataFrame], rules: tuple[RawRule, ...] = RAW_RULES) -> DataFrame:
    """One row per rule: id, severity, table, failed rows, text; errors first, then by id."""
    owned = {name: [rule for rule in rules if rule.table == name] for name in tables}
    return order_rules(_union([table_report(tables[name], own, tables) for name, own in owned.items() if own]))


def _union(parts: list[DataFrame]) -> DataFrame:
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def order_rules(report: DataFrame) -> DataFrame:
    rank = F.when(F.col("severity") == ERROR, 1).when(F.col("severity") == WARNING, 2).otherwise(3)
    return report.orderBy(rank, "rule_id")


def source_key(rule: RawRule, record_json: Column) -> Column:
    return fallback_key(rule.keys or (), hash_hex(record_json))


def table_evidence(table: DataFrame, rules: list[RawRule], missing: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """One row per broken rule and row, by one scan. Clean rows are filtered out before any JSON is built.

    ``missing`` has the missing keys of each rule that refers to another table. Rows that a sieve of these keys lets through
    are joined with the keys themselves; that join has only such and broken rows, and adaptive execution can split it.
    """
    references = {rule.rule_id: i for i, rule in enumerate(rules) if rule.kind == "exists"}
    rows, broken = table, F.lit(False)
    for rule in rules:
        if rule.rule_id in references:
            i = references[rule.rule_id]
            rows = sieved(rows.withColumn(f"_key{i}", F.when(~is_blank(rule.column), trimmed(rule.column))), f"_key{i}", missing[rule.rule_id], f"_possible{i}")
            broken = broken | F.col(f"_possible{i}")
        else:
            broken = broken | violation(rule, table)
    rows = rows.where(broken)
    for rule_id, i in references.items():
        keys = missing[rule_id].select(F.col("_key").alias(f"_key{i}"), F.lit(True).alias(f"_missing{i}"))
        rows = rows.join(keys, f"_key{i}", "left")
    rows = rows.withColumn("_json", row_json(table))
    found = F.array(
        *[
            F.when(
                F.col(f"_missing{references[rule.rule_id]}").isNotNull() if rule.rule_id in references else violation(rule, table),
                F.struct(
                    F.lit(rule.rule_id).alias("rule_id"),
                    source_key(rule, F.col("_json")).alias("source_key"),
                    F.lit(rule.message).alias("error_reason"),
                ),
            )
            for rule in rules
        ]
    )
    return (
        rows.select("_json", F.explode(found).alias("_hit"))
        .where(F.col("_hit").isNotNull())
        .select(
            "_hit.rule_id",
            F.lit(f"raw.{rules[0].table}").alias("source_table"),
            "_hit.source_key",
            "_hit.error_reason",
            F.col("_json").alias("record_json"),
        )
    )


def rejected_records(
    tables: Mapping[str, DataFrame],
    run_date: str,
    created_at: Column,
    dag_id: str = "nightly_crm_pipeline",
    task_id: str = "validate_data_quality",
    rules: tuple[RawRule, ...] = RAW_RULES,
) -> DataFrame:
    """Evidence rows for every rule that has evidence keys; a row appears once per rule it breaks.

    Missing keys are found when this is called; the result reads each table once.
    """
    parts = []
    for name, table in tables.items():
        own = [rule for rule in rules if rule.table == name and rule.keys is not None]
        missing = {rule.rule_id: missing_keys(table, tables[rule.args[0]], rule.column, rule.args[1]) for rule in own if rule.kind == "exists"}
        if own:
            parts.append(table_evidence(table, own, missing))
    return _union(parts).select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(dag_id).alias("dag_id"),
        F.lit(task_id).alias("task_id"),
        "rule_id",
        "source_table",
        "source_key",
        "error_reason",
        "record_json",
        created_at.alias("created_at"),
    )


def failing(report: DataFrame, severity: str) -> DataFrame:
    return report.where((F.col("failed_row_count") > 0) & (F.col("severity") == severity))


def severity_verdict(report: DataFrame) -> DataFrame:
    """One row: passed unless an ERROR rule fails; the ids of failing rules by severity.

    The report has one row per rule, so the lists are as short as the rule table.
    """

    def ids(severity: str) -> Column:
        hit = (F.col("failed_row_count") > 0) & (F.col("severity") == severity)
        return F.array_join(F.sort_array(F.collect_list(F.when(hit, F.col("rule_id")))), ", ")

    return report.agg(ids(ERROR).alias("failing_errors"), ids(WARNING).alias("failing_warnings")).select(
        (F.col("failing_errors") == "").alias("passed"), "failing_errors", "failing_warnings"
    )


class QualityGateError(RuntimeError):
    """A gate stopped the run."""


def enforce(report: DataFrame) -> None:
    """Stop the run when an ERROR rule fails; warnings only appear in the verdict."""
    verdict = severity_verdict(report).first()
    if not verdict.passed:
        raise QualityGateError(f"Data quality validation failed. Failing ERROR rules: {verdict.failing_errors}")


def empty_tables_verdict(counts: DataFrame) -> DataFrame:
    """One row: passed unless a counted table is empty; the names of the empty ones."""
    names = F.array_join(F.sort_array(F.collect_list(F.when(F.col("row_count") <= 0, F.col("table_name")))), ", ")
    return counts.agg(names.alias("empty_tables")).select((F.col("empty_tables") == "").alias("passed"), "empty_tables")


def fail_if_empty(counts: DataFrame) -> None:
    verdict = empty_tables_verdict(counts).first()
    if not verdict.passed:
        raise QualityGateError(f"Raw validation failed. Empty tables: {verdict.empty_tables}")
