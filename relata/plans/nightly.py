"""The nightly runs: plain functions that call the operators in order.

Three variants share the operators but not the business definitions:

* governed: typed staging, won revenue, declarative scans with a gate, scored or fallback segments;
* classic: deduplicated per-user features, the 31 raw rules with row evidence, selected segments;
* lean: cleaned facts, distinct-count view, two audience checks.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession, functions as F

from relata.functions.records import instant
from relata.functions.text import BEARER_REDACTED, BEARER_TOKEN
from relata.operators import activation, audience, checks, curated, quality, scans, segments, staging
from relata.operators.aggregates import row_counts
from relata.sinks.tables import Layers
from relata.sources.rules import built_in_rules

REJECTED_SCHEMA = (
    "run_date date, dag_id string, task_id string, rule_id string, source_table string, "
    "source_key string, error_reason string, record_json string, created_at timestamp"
)
SCAN_SCHEMA = (
    "scan_id string, rule_name string, rule_column string, dimension string, severity string, failure_action string, "
    "rule_passed boolean, rule_rows_evaluated bigint, rule_rows_passed_percent double, reason string, "
    "job_start_time timestamp, run_date date"
)


def governed_models(layers: Layers, raw: Mapping[str, DataFrame], as_of: datetime, model: segments.SegmentModel | None = None) -> DataFrame:
    """Staging to audience; every layer is materialised once and read back by the next.

    Users are scored by ``model``, an earlier fit, or else by one fitted to these features.
    """
    now = instant(as_of)
    users = layers.replace(staging.stg_users(raw["user_raw"]), "staging", "stg_oracle_users")
    sales = layers.replace(staging.stg_crm_sales(raw["crm_sales"]), "staging", "stg_crm_sales")
    support = layers.replace(staging.stg_crm_support(raw["crm_support"]), "staging", "stg_crm_support")
    events = layers.replace(
        staging.stg_crm_campaign_events(raw["crm_campaign_events"]), "staging", "stg_crm_campaign_events"
    )
    leads = layers.replace(
        staging.stg_partner_leads(raw["crm_new_partner_leads"]), "staging", "stg_crm_new_partner_leads"
    )
    matches = layers.replace(curated.partner_lead_matches(leads, users, now), "curated", "partner_lead_matches")
    profile = layers.replace(curated.user_360(users, sales, support, events, now), "curated", "user_360")
    checks.assertion(checks.assert_unique_user(profile), "user_360_unique")
    features = layers.replace(curated.segmentation_features(profile, now), "mart", "user_segmentation_features")
    model = model or segments.fit_segments(features, segments.GOVERNED_FEATURES)
    scored = segments.user_segments_governed(model, features, now)
    scored = layers.replace(scored, "mart", "user_segments")
    members = layers.replace(
        audience.audience_governed(profile, scored, matches, now), "mart", "salesforce_campaign_audience"
    )
    checks.assertion(checks.assert_consent(members), "salesforce_audience_has_consent")
    return members


def governed_quality(layers: Layers, as_of: datetime, honour_action: bool = False) -> None:
    """Scan the two curated tables, keep the results, then judge them."""
    for table, name, rules in (
        (("curated", "user_360"), "user-360", "user_360"),
        (("mart", "salesforce_campaign_audience"), "audience", "audience"),
    ):
        found = built_in_rules(rules)
        results = scans.scan(layers.current(*table), name, found.rules, as_of, found.sampling_percent)
        layers.ensure("audit", "quality_results", SCAN_SCHEMA)
        layers.append(results.withColumn("run_date", F.to_date("job_start_time")), "audit", "quality_results")
    scans.scan_gate(layers.read("audit", "quality_results"), as_of, honour_action=honour_action)


def classic_quality(layers: Layers, raw: Mapping[str, DataFrame], run_date: str, as_of: datetime) -> DataFrame:
    """Evidence first, then the report, then the gate: evidence outlives a failed gate."""
    quality.fail_if_empty(row_counts({f"raw.{name}": table for name, table in raw.items()}))
    evidence = quality.rejected_records(raw, run_date, instant(as_of))
    layers.ensure("raw", "crm_rejected_records", REJECTED_SCHEMA)
    key = {"run_date": run_date, "dag_id": "nightly_crm_pipeline", "task_id": "validate_data_quality"}
    layers.replace_slice(evidence, "raw", "crm_rejected_records", key)
    report = quality.quality_report(raw)
    quality.enforce(report)
    return report


def classic_models(layers: Layers, raw: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    now = instant(as_of)
    features = layers.replace(
        curated.user_features(raw["user_raw"], raw["crm_sales"], raw["crm_support"], raw["crm_campaign_events"], now),
        "mart",
        "user_features",
    )
    model = segments.fit_segments(features, segments.CLASSIC_FEATURES)
    scored = layers.replace(segments.user_segments_classic(model, features, now), "mart", "user_segments")
    return layers.replace(audience.audience_classic(scored, now), "mart", "salesforce_campaign_audience")


def lean_models(layers: Layers, raw: Mapping[str, DataFrame], as_of: datetime) -> DataFrame:
    now = instant(as_of)
    sales = layers.replace(staging.sales_clean(raw["crm_sales"]), "staging", "crm_sales_clean")
    support = layers.replace(staging.support_clean(raw["crm_support"]), "staging", "crm_support_clean")
    layers.replace(staging.campaign_clean(raw["crm_campaign_events"]), "staging", "crm_campaign_events_clean")
    users = raw["user_raw"].toDF(*[name.lower() for name in raw["user_raw"].columns])
    profile = layers.replace(curated.user_360_distinct(users, sales, support), "curated", "user_360")
    return layers.replace(audience.audience_lean(profile, now), "mart", "salesforce_campaign_audience")


def lean_quality(layers: Layers, as_of: datetime, execution_id: str | None = None) -> None:
    """Replace today's check rows, then assert that none failed."""
    now, run_date = instant(as_of), as_of.date()
    execution = execution_id or str(uuid.uuid4())
    members = layers.current("mart", "salesforce_campaign_audience")
    results = checks.check_row_count(members, now, execution).unionByName(checks.check_duplicates(members, now, execution))
    layers.ensure("audit", "quality_check_results", checks.QUALITY_CHECK_SCHEMA)
    layers.replace_checks(
        results, "audit", "quality_check_results", run_date, (checks.ROW_COUNT_CHECK, checks.DUPLICATE_CHECK)
    )
    checks.assert_no_fail(layers.read("audit", "quality_check_results"), now)


def activate(
    spark: SparkSession,
    layers: Layers,
    members: DataFrame,
    directory: Mapping[str, DataFrame],
    run_date: str,
    campaign_id: str,
    as_of: datetime,
    dry_run: bool = True,
    allow_repeat: bool = False,
    limit: int = 0,
    offset: int = 0,
    create_missing: str | None = None,
    member_status: str = activation.DEFAULT_MEMBER_STATUS,
) -> str:
    """Write the payloads of a push and its audit row; returns the run's status.

    ``directory`` holds ``contacts``, ``leads`` (``id``, ``email``) and ``members`` (``campaign_id``,
    ``id_field``, ``member_id``). Payloads are written as files; sending them is the caller's.
    ``create_missing`` is ``LeadId`` or ``ContactId`` to write a batch of such people for addresses that no directory
    knows, and members that refer to them by address. An exception leaves a FAILED audit row and goes on to the caller.
    """
    if create_missing not in (None, activation.LEAD_ID, activation.CONTACT_ID):
        raise ValueError(f"people cannot be created as {create_missing}")
    schema, started = activation.PUSH_RUN_SCHEMA, datetime.now(timezone.utc)
    layers.ensure("audit", "salesforce_push_runs", schema)
    day = datetime.strptime(run_date, "%Y-%m-%d").date()

    def record(status: str, count: int, message: str | None = None) -> str:
        row = (day, campaign_id, started, datetime.now(timezone.utc), status, count, dry_run, message)
        layers.append_row(row, "audit", "salesforce_push_runs", schema)
        return status

    history = layers.read("audit", "salesforce_push_runs")
    if not dry_run and not allow_repeat and activation.already_pushed(history, run_date, campaign_id):
        return record(activation.SUCCESS, 0, activation.ALREADY_PUSHED)
    out = f"{layers.path('activation', campaign_id)}/run_date={run_date}"
    try:
        rows = activation.eligible_page(members, run_date, limit, offset)
        if dry_run:
            activation.payloads(rows, campaign_id).write.mode("overwrite").text(f"{out}/dry_run")
            return record(activation.SUCCESS, spark.read.text(f"{out}/dry_run").count())
        # Written once: the payloads, the failures and the counts all read them back.
        targets = activation.resolve_targets(rows, directory["contacts"], directory["leads"])
        targets.write.mode("overwrite").parquet(f"{out}/targets")
        targets = spark.read.schema(targets.schema).parquet(f"{out}/targets")
        if create_missing:
            people = activation.missing_leads if create_missing == activation.LEAD_ID else activation.missing_contacts
            people(targets).write.mode("overwrite").json(f"{out}/people")
            targets = activation.with_created(targets, create_missing)
        fresh = activation.new_members(targets, directory["members"], campaign_id)
        activation.member_payloads(fresh, campaign_id, member_status).write.mode("overwrite").json(f"{out}/members")
        activation.created_members(fresh, campaign_id, member_status).write.mode("overwrite").json(f"{out}/created_members")
        activation.push_failures(targets).write.mode("overwrite").json(f"{out}/failures")
        counts = activation.outcome_counts(targets, directory["members"], campaign_id)
        ended = instant(datetime.now(timezone.utc))
        audit = activation.push_audit(counts, run_date, campaign_id, instant(started), ended).first()
    except Exception as error:
        record(activation.FAILED, 0, re.sub(BEARER_TOKEN, BEARER_REDACTED, str(error)))
        raise
    layers.append_row(tuple(audit), "audit", "salesforce_push_runs", schema)
    return audit.status
