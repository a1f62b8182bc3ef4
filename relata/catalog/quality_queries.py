"""Registered queries: raw-table rules, scans, gates, checks, arrival, audit and alerts."""

from __future__ import annotations

from collections import defaultdict

from pyspark.sql import DataFrame, functions as F

from relata.catalog.adapters import AS_OF, RUN_DATE, as_of
from relata.catalog.models import Models
from relata.catalog.oracles import AMOUNT, PIECES, oracle
from relata.catalog.portable import portable
from relata.functions.records import instant
from relata.operators import audit, checks, quality, scans
from relata.operators.aggregates import row_counts
from relata.operators.incremental import IncrementalScan
from relata.session import scratch_path
from relata.sinks.tables import Layers
from relata.sources.rules import ScanRule, built_in_rules

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, rounded_columns: tuple[str, ...] = ()):
    def register(build):
        QUERIES[key] = lambda spark, sf_dir: portable(build(Models(spark, sf_dir)), rounded_columns)
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


_RAW = ("user_raw", "crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")

# ---------------------------------------------------------------- oracle of the 31 rules, written per rule

_EMAIL = "^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$"


def _blank(c: str) -> str:
    return f"({c} is null or trim(cast({c} as varchar)) = '')"


def _no_user(t: str) -> str:
    return f"(not {_blank(t + '.user_id')} and not exists (select 1 from user_raw u where trim(u.USER_ID) = trim({t}.user_id)))"


#: rule id -> (severity, table, condition on a broken row or on the row count, text, evidence keys or None)
_RULES = {
    "raw_user_count_positive": ("ERROR", "user_raw", "count <= 0", "raw.user_raw must contain at least one row", None),
    "crm_sales_count_positive": ("ERROR", "crm_sales", "count <= 0", "raw.crm_sales must contain at least one row", None),
    "crm_support_count_positive": ("ERROR", "crm_support", "count <= 0", "raw.crm_support must contain at least one row", None),
    "crm_campaign_events_count_positive": ("ERROR", "crm_campaign_events", "count <= 0", "raw.crm_campaign_events must contain at least one row", None),
    "crm_partner_leads_count_positive": ("ERROR", "crm_new_partner_leads", "count <= 0", "raw.crm_new_partner_leads must contain at least one row", None),
    "raw_user_count_floor": ("WARNING", "user_raw", "count < 10000", "raw.user_raw is below the 2026-05-26 lab count floor of 10000 rows", None),
    "crm_sales_count_floor": ("WARNING", "crm_sales", "count < 20000", "raw.crm_sales is below the 2026-05-26 lab count floor of 20000 rows", None),
    "crm_support_count_floor": ("WARNING", "crm_support", "count < 8000", "raw.crm_support is below the 2026-05-26 lab count floor of 8000 rows", None),
    "crm_campaign_events_count_floor": ("WARNING", "crm_campaign_events", "count < 50000", "raw.crm_campaign_events is below the 2026-05-26 lab count floor of 50000 rows", None),
    "crm_partner_leads_count_floor": ("WARNING", "crm_new_partner_leads", "count < 5000", "raw.crm_new_partner_leads is below the 2026-05-26 lab count floor of 5000 rows", None),
    "user_raw_user_id_required": ("ERROR", "user_raw", _blank("t.USER_ID"), "raw.user_raw.USER_ID is required", ()),
    "crm_sales_user_id_required": ("ERROR", "crm_sales", _blank("t.user_id"), "raw.crm_sales.user_id is required", ("deal_id", "customer_id")),
    "crm_sales_deal_id_required": ("ERROR", "crm_sales", _blank("t.deal_id"), "raw.crm_sales.deal_id is required", ("customer_id", "user_id")),
    "crm_support_user_id_required": ("ERROR", "crm_support", _blank("t.user_id"), "raw.crm_support.user_id is required", ("ticket_id",)),
    "crm_support_ticket_id_required": ("ERROR", "crm_support", _blank("t.ticket_id"), "raw.crm_support.ticket_id is required", ("user_id",)),
    "crm_campaign_user_id_required": ("ERROR", "crm_campaign_events", _blank("t.user_id"), "raw.crm_campaign_events.user_id is required", ("event_id", "campaign_id")),
    "crm_campaign_event_id_required": ("ERROR", "crm_campaign_events", _blank("t.event_id"), "raw.crm_campaign_events.event_id is required", ("campaign_id", "user_id")),
    "crm_partner_lead_id_required": ("ERROR", "crm_new_partner_leads", _blank("t.external_lead_id"), "raw.crm_new_partner_leads.external_lead_id is required", ("email",)),
    "crm_partner_email_required": ("ERROR", "crm_new_partner_leads", _blank("t.email"), "raw.crm_new_partner_leads.email is required", ("external_lead_id",)),
    "crm_sales_user_exists_in_oracle": ("ERROR", "crm_sales", _no_user("t"), "raw.crm_sales.user_id must exist in raw.user_raw.USER_ID", ("deal_id", "customer_id")),
    "crm_support_user_exists_in_oracle": ("ERROR", "crm_support", _no_user("t"), "raw.crm_support.user_id must exist in raw.user_raw.USER_ID", ("ticket_id",)),
    "crm_campaign_user_exists_in_oracle": ("ERROR", "crm_campaign_events", _no_user("t"), "raw.crm_campaign_events.user_id must exist in raw.user_raw.USER_ID", ("event_id", "campaign_id")),
    "user_raw_email_format_valid": ("ERROR", "user_raw", f"not {_blank('t.EMAIL')} and not regexp_matches(trim(t.EMAIL), '{_EMAIL}')", "raw.user_raw.EMAIL must be a valid email when present", ("USER_ID",)),
    "user_raw_consent_email_valid": ("ERROR", "user_raw", f"not {_blank('t.CONSENT_EMAIL')} and upper(trim(t.CONSENT_EMAIL)) not in ('Y', 'N')", "raw.user_raw.CONSENT_EMAIL must be Y, N, or null", ("USER_ID",)),
    "crm_partner_email_format_valid": ("ERROR", "crm_new_partner_leads", f"not {_blank('t.email')} and not regexp_matches(trim(t.email), '{_EMAIL}')", "raw.crm_new_partner_leads.email must be a valid email", ("external_lead_id",)),
    "crm_partner_opt_in_true": ("WARNING", "crm_new_partner_leads", "t.opt_in is distinct from true", "raw.crm_new_partner_leads.opt_in should be TRUE for activation eligibility", None),
    "crm_sales_deal_amount_non_negative": ("ERROR", "crm_sales", f"{AMOUNT} < 0", "raw.crm_sales.deal_amount must be non-negative", ("deal_id", "customer_id")),
    "crm_support_csat_score_range": ("ERROR", "crm_support", "t.csat_score < 1 or t.csat_score > 5", "raw.crm_support.csat_score must be null or between 1 and 5", ("ticket_id",)),
    "crm_partner_lead_score_range": ("ERROR", "crm_new_partner_leads", "t.lead_score < 0 or t.lead_score > 100", "raw.crm_new_partner_leads.lead_score must be null or between 0 and 100", ("external_lead_id", "email")),
    "crm_sales_currency_known": ("WARNING", "crm_sales", f"not {_blank('t.currency')} and upper(trim(t.currency)) not in ('USD', 'TWD', 'EUR', 'JPY')", "raw.crm_sales.currency should be USD, TWD, EUR, or JPY", None),
    "crm_campaign_channel_present": ("WARNING", "crm_campaign_events", _blank("t.channel"), "raw.crm_campaign_events.channel should be present", None),
}


def _report_part(rule_id: str) -> str:
    severity, table, condition, message, _ = _RULES[rule_id]
    if condition.startswith("count "):
        failed = f"(select cast(case when count(*) {condition[6:]} then 1 else 0 end as bigint) from {table})"
    else:
        failed = f"(select count(*) from {table} t where {condition})"
    return (
        f"select '{rule_id}' as rule_id, '{severity}' as severity, 'raw.{table}' as source_table, "
        f"{failed} as failed_row_count, '{message}' as sample_error"
    )


_INSTANT = "rtrim(rtrim(strftime({c}, '%Y-%m-%dT%H:%M:%S.%f'), '0'), '.') || 'Z'"
_JSON_FIELDS = {
    "user_raw": [
        (c, f"t.{c}") for c in ("USER_ID", "EMAIL", "FIRST_NAME", "LAST_NAME", "GENDER")
    ] + [("BIRTH_DATE", "cast(t.BIRTH_DATE as varchar)"), ("CITY", "t.CITY"), ("COUNTRY", "t.COUNTRY"), ("SIGNUP_DATE", "cast(t.SIGNUP_DATE as varchar)"),
         ("CONSENT_EMAIL", "t.CONSENT_EMAIL"), ("INCOME_BAND", "t.INCOME_BAND"), ("LAST_LOGIN_AT", _INSTANT.format(c="t.LAST_LOGIN_AT")),
         ("SOURCE_SYSTEM", "t.SOURCE_SYSTEM"), ("UPDATED_AT", _INSTANT.format(c="t.UPDATED_AT"))],
    "crm_sales": [(c, f"t.{c}") for c in ("customer_id", "user_id", "deal_id", "deal_stage", "deal_amount", "currency")]
    + [("closed_date", "cast(t.closed_date as varchar)"), ("owner_region", "t.owner_region")],
    "crm_support": [(c, f"t.{c}") for c in ("ticket_id", "user_id", "priority", "status", "category", "csat_score")],
    "crm_campaign_events": [(c, f"t.{c}") for c in ("event_id", "user_id", "campaign_id", "channel", "event_type")]
    + [("event_ts", _INSTANT.format(c="t.event_ts"))],
    "crm_new_partner_leads": [(c, f"t.{c}") for c in ("external_lead_id", "email", "partner_name", "lead_score", "utm_source")]
    + [("created_at", _INSTANT.format(c="t.created_at")), ("opt_in", "t.opt_in")],
}


def _evidence_part(rule_id: str) -> str:
    _, table, condition, message, keys = _RULES[rule_id]
    packed = ", ".join(f"'{name}', {value}" for name, value in _JSON_FIELDS[table])
    record = f"cast(json_object({packed}) as varchar)"
    chain = "".join(f"nullif(trim(t.{key}), ''), " for key in keys)
    return (
        f"select '{RUN_DATE}' as run_date, 'nightly_crm_pipeline' as dag_id, 'validate_data_quality' as task_id, '{rule_id}' as rule_id, "
        f"'raw.{table}' as source_table, coalesce({chain}sha256({record})) as source_key, '{message}' as error_reason, "
        f"{record} as record_json, '2024-02-01 00:00:00' as created_at from {table} t where {condition}"
    )


def _union(parts) -> str:
    return " union all ".join(parts)


PIECES["report"] = (_RAW, (), _union(_report_part(r) for r in _RULES))
PIECES["evidence"] = (_RAW, (), _union(_evidence_part(r) for r in _RULES if _RULES[r][4] is not None))


def _report(m: Models) -> DataFrame:
    return quality.quality_report(m.raw_tables())


def _evidence(m: Models) -> DataFrame:
    return quality.rejected_records(m.raw_tables(), RUN_DATE, as_of())


query("l1_quality_report", oracle("select * from report", "report"))(_report)
query("h1_rule_order", oracle("select * from report order by case severity when 'ERROR' then 1 when 'WARNING' then 2 else 3 end, rule_id", "report"))(_report)
query("l2_rejected_records", oracle("select * from evidence", "evidence"))(_evidence)
query("l2_rejected_records_measured", oracle("select * from evidence", "evidence"))(
    # The order of rules does not matter.
    lambda m: quality.rejected_records(m.raw_tables(), RUN_DATE, as_of(), rules=tuple(reversed(quality.RAW_RULES)))
)
query(
    "i3_evidence_per_rule",
    oracle("select rule_id, source_table, count(*) as evidence_rows, count(distinct source_key) as keys from evidence group by rule_id, source_table", "evidence"),
)(lambda m: _evidence(m).groupBy("rule_id", "source_table").agg(F.count(F.lit(1)).alias("evidence_rows"), F.count_distinct("source_key").alias("keys")))

_KIND_KEYS = defaultdict(list)
for _rule in quality.RAW_RULES:
    _KIND_KEYS[_rule.kind].append(_rule.rule_id)
for _key, _kind in (
    ("l3_count_positive", "count_positive"),
    ("l4_count_floor", "count_floor"),
    ("l5_l12_required", "required"),
    ("l6_user_exists", "exists"),
    ("l7_email_format", "email"),
    ("l8_l11_in_set", "in_set"),
    ("l9_is_true", "is_true"),
    ("l10_range", "range"),
):
    _ids = _KIND_KEYS[_kind]
    query(_key, oracle(f"select * from report where rule_id in ({', '.join(repr(i) for i in _ids)})", "report"))(
        lambda m, kind=_kind: quality.quality_report(
            m.raw_tables(), tuple(rule for rule in quality.RAW_RULES if rule.kind == kind)
        )
    )
query(
    "i2_union_of_rules",
    oracle("select severity, count(*) as rules, cast(sum(failed_row_count) as bigint) as failed_rows from report group by severity", "report"),
)(lambda m: _report(m).groupBy("severity").agg(F.count(F.lit(1)).alias("rules"), F.sum("failed_row_count").alias("failed_rows")))
query("l13_source_keys", oracle("select rule_id, source_key from evidence", "evidence"))(lambda m: _evidence(m).select("rule_id", "source_key"))

_VERDICT = (
    "select count(*) filter (where failed_row_count > 0 and severity = 'ERROR') = 0 as passed, "
    "coalesce(string_agg(rule_id, ', ' order by rule_id) filter (where failed_row_count > 0 and severity = 'ERROR'), '') as failing_errors, "
    "coalesce(string_agg(rule_id, ', ' order by rule_id) filter (where failed_row_count > 0 and severity = 'WARNING'), '') as failing_warnings from report"
)
query("l14_severity_verdict", oracle(_VERDICT, "report"))(lambda m: quality.severity_verdict(_report(m)))
query(
    "l31_empty_tables_verdict",
    oracle("select count(*) = 0 as passed, coalesce(string_agg(n, ', '), '') as empty_tables from (select 'raw.' || 'user_raw' as n from (select count(*) as c from user_raw) q where c = 0) z", "user_raw"),
)(lambda m: quality.empty_tables_verdict(_row_counts(m)))


def _row_counts(m: Models) -> DataFrame:
    return row_counts({f"raw.{name}": table for name, table in m.raw_tables().items()})


# ---------------------------------------------------------------- declarative scans

_LOOSE = "^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$"
_NOW = "timestamp '2024-02-01 00:00:00'"


def _scan_row(scan_id: str, rule: ScanRule, table: str, passed: str, percent: str, reason: str = "null") -> str:
    column = f"'{rule.column}'" if rule.column else "cast(null as varchar)"
    return (
        f"select '{scan_id}' as scan_id, '{rule.rule_id.replace('_', '-')}' as rule_name, {column} as rule_column, '{rule.dimension}' as dimension, "
        f"'{rule.severity}' as severity, '{rule.failure_action}' as failure_action, {passed} as rule_passed, count(*) as rule_rows_evaluated, "
        f"round(cast({percent} as double), 6) as rule_rows_passed_percent, cast({reason} as varchar) as reason, '2024-02-01 00:00:00' as job_start_time from {table}"
    )


def _row_rule(condition: str) -> tuple[str, str]:
    good = f"count(*) filter (where {condition})"
    return f"{good} = count(*)", f"case when count(*) > 0 then 100.0 * {good} / count(*) end"


def _scan_sql(scan_id: str, name: str, table: str, conditions: dict[str, tuple[str, str] | str]) -> str:
    parts = []
    for rule in built_in_rules(name).rules:
        found = conditions[rule.rule_id]
        if isinstance(found, str):
            if found.startswith("missing"):
                parts.append(_scan_row(scan_id, rule, table, "false", "null", f"'{found}'"))
            elif found.startswith("unique "):
                # Groups first; the outer count is over their rows.
                key, where = (found[7:].split(" where ") + ["true"])[:2]
                inner = f"(select {key}, count(*) as n from {table} where {where} group by {key}) g"
                text = _scan_row(scan_id, rule, inner, "count(*) filter (where n > 1) = 0", "100.0 * count(*) filter (where n = 1) / sum(n)")
                parts.append(text.replace("count(*) as rule_rows_evaluated", "cast(sum(n) as bigint) as rule_rows_evaluated"))
            else:
                parts.append(_scan_row(scan_id, rule, table, found, "null"))
        else:
            parts.append(_scan_row(scan_id, rule, table, *found))
    return _union(parts)


_BOOL = _row_rule("consent_email or not consent_email or consent_email is null")
PIECES["scan_user_360"] = (
    (),
    ("user_360",),
    _scan_sql(
        "user-360", "user_360", "user_360",
        {
            "user_360_row_count_gt_zero": "count(*) > 0",
            "user_360_user_id_not_null": _row_rule("user_id is not null"),
            "user_360_email_not_null": _row_rule("email is not null"),
            "user_360_email_format_valid": _row_rule(f"regexp_matches(email, '{_LOOSE}')"),
            "user_360_user_id_unique": "unique user_id",
            "user_360_consent_email_is_bool": _BOOL,
            "user_360_deal_count_non_negative": _row_rule("deal_count >= 0"),
            "user_360_won_revenue_non_negative": _row_rule("won_revenue >= 0"),
            "user_360_transformed_at_fresh": f"max(transformed_at) >= {_NOW} - interval 25 hours",
        },
    ),
)


def _audience_conditions(segments: str, typed: bool) -> dict:
    return {
        "sf_audience_row_count_gt_zero": "count(*) > 0",
        "sf_audience_consent_status_valid": _row_rule("consent_status in ('email_consent', 'partner_opt_in')"),
        "sf_audience_type_valid": _row_rule("audience_type in ('existing_user', 'matched_user', 'prospect')") if typed else "missing column audience_type",
        "sf_audience_identifier_not_null": _row_rule("coalesce(user_id, lead_email) is not null"),
        "sf_audience_lead_email_format": _row_rule(f"lead_email is null or regexp_matches(lead_email, '{_LOOSE}')"),
        "sf_audience_score_in_range": _row_rule("score between 0 and 100"),
        "sf_audience_run_date_not_null": _row_rule("run_date is not null"),
        "sf_audience_run_date_fresh": "max(run_date) >= date '2024-01-25'",
        "sf_audience_segment_name_valid": _row_rule(f"segment_name in ({segments})"),
        "sf_audience_existing_user_not_duplicate": "unique run_date, user_id where audience_type = 'existing_user' and user_id is not null" if typed else "missing column audience_type",
    }


_NAMES = "'high_value', 'support_followup', 'nurture', 'partner_hot_lead', 'partner_nurture'"
PIECES["scan_audience"] = ((), ("audience",), _scan_sql("audience", "audience", "audience", _audience_conditions(_NAMES, False)))
PIECES["scan_audience_typed"] = (
    (),
    ("audience",),
    _scan_sql("audience", "audience_typed", "audience", _audience_conditions(_NAMES + ", 'segment_1', 'segment_2', 'segment_3', 'segment_4'", True)),
)
PIECES["scan_staging_sales"] = (
    (),
    ("stg_sales",),
    _scan_sql(
        "stg-crm-sales", "staging_sales", "stg_sales",
        {
            "stg_crm_sales_row_count_gt_zero": "count(*) > 0",
            "stg_crm_sales_deal_id_not_null": _row_rule("deal_id is not null"),
            "stg_crm_sales_user_id_not_null": _row_rule("user_id is not null"),
            "stg_crm_sales_deal_stage_valid": _row_rule("deal_stage in ('won', 'lost', 'in_progress', 'qualified', 'proposal', 'negotiation', 'closed')"),
            "stg_crm_sales_deal_amount_non_negative": _row_rule("deal_amount is null or deal_amount >= 0"),
            "stg_crm_sales_run_date_not_null": _row_rule("run_date is not null"),
            "stg_crm_sales_ingestion_ts_fresh": f"max(ingestion_ts) >= {_NOW} - interval 25 hours",
        },
    ),
)
PIECES["scan_staging_users"] = (
    (),
    ("stg_users",),
    _scan_sql(
        "stg-users", "staging_users", "stg_users",
        {
            "stg_oracle_users_user_id_not_null": _row_rule("user_id is not null"),
            "stg_oracle_users_email_format": _row_rule(f"email is null or regexp_matches(email, '{_LOOSE}')"),
            "stg_oracle_users_user_id_unique": "unique user_id",
            "stg_oracle_users_consent_email_bool": _BOOL,
        },
    ),
)


def _scan(m: Models, table: DataFrame, scan_id: str, name: str) -> DataFrame:
    found = built_in_rules(name)
    return scans.scan(table, scan_id, found.rules, AS_OF, found.sampling_percent)


_PCT = ("rule_rows_passed_percent",)
query("l20_scan_user_360", oracle("select * from scan_user_360", "scan_user_360"), _PCT)(lambda m: _scan(m, m.user_360(), "user-360", "user_360"))
def _scanned_by_slices(m: Models) -> DataFrame:
    """The view in slices, scanned when six are there and again with the last; only that one is read anew."""
    layers = Layers(m.spark, scratch_path(m.spark, "sliced"))
    cohort = F.pmod(F.xxhash64("user_id"), F.lit(7)).cast("int")
    rows = m.user_360().withColumn("cohort", cohort)
    found = built_in_rules("user_360")
    layers.append(rows.where("cohort < 6"), "curated", "user_360", ("cohort",))
    slices = IncrementalScan(layers, ("curated", "user_360"), "cohort", ("audit", "user_360_states"), found.rules)
    slices.update(AS_OF)
    layers.append(rows.where("cohort = 6"), "curated", "user_360", ("cohort",))
    return slices.scan("user-360", AS_OF)


query("l20_scan_by_slices", oracle("select * from scan_user_360", "scan_user_360"), _PCT)(_scanned_by_slices)
query("l21_scan_audience", oracle("select * from scan_audience", "scan_audience"), _PCT)(lambda m: _scan(m, m.audience(), "audience", "audience"))
query("l21_scan_audience_typed", oracle("select * from scan_audience_typed", "scan_audience_typed"), _PCT)(
    lambda m: _scan(m, m.audience(with_type=True), "audience", "audience_typed")
)
query("l22_scan_staging_sales", oracle("select * from scan_staging_sales", "scan_staging_sales"), _PCT)(lambda m: _scan(m, m.stg_sales(), "stg-crm-sales", "staging_sales"))
query("l22_scan_staging_users", oracle("select * from scan_staging_users", "scan_staging_users"), _PCT)(lambda m: _scan(m, m.stg_users(), "stg-users", "staging_users"))

for _key, _kinds in (
    ("l15_non_null", ("nonNull",)),
    ("l16_unique", ("uniqueness",)),
    ("l17_row_condition", ("rowCondition",)),
    ("l18_table_condition", ("tableCondition", "duplicatesAtMost")),
):
    _rules = tuple(r for r in built_in_rules("user_360").rules if r.kind in _kinds)
    _list = ", ".join(repr(r.rule_id.replace("_", "-")) for r in _rules)
    query(_key, oracle(f"select rule_name, rule_passed, rule_rows_evaluated from scan_user_360 where rule_name in ({_list})", "scan_user_360"))(
        lambda m, rules=_rules: scans.scan(m.user_360(), "user-360", rules, AS_OF).select("rule_name", "rule_passed", "rule_rows_evaluated")
    )

query(
    "l19_freshness",
    oracle(
        f"select max(event_ts) >= {_NOW} - interval 25 hours as events_fresh, max(cast(event_ts as date)) >= date '2024-01-25' as events_recent from crm_campaign_events",
        "crm_campaign_events",
    ),
)(
    lambda m: m.raw("crm_campaign_events").agg(
        (F.max("event_ts") >= as_of() - F.expr("interval 25 hours")).alias("events_fresh"),
        (F.max(F.to_date("event_ts")) >= F.date_sub(F.to_date(as_of()), 7)).alias("events_recent"),
    )
)

_FRESH = (
    ScanRule("events_fresh", "tableCondition", expression="max(event_ts) >= :as_of - interval 25 hours"),
    ScanRule("events_recent", "tableCondition", expression="max(to_date(event_ts)) >= date_sub(to_date(:as_of), 7)"),
)
query(
    "l19_scanned_freshness",
    oracle(
        f"select 'events-fresh' as rule_name, max(event_ts) >= {_NOW} - interval 25 hours as rule_passed from crm_campaign_events "
        "union all select 'events-recent', max(cast(event_ts as date)) >= date '2024-01-25' from crm_campaign_events",
        "crm_campaign_events",
    ),
)(lambda m: scans.scan(m.raw("crm_campaign_events"), "events", _FRESH, AS_OF).select("rule_name", "rule_passed"))


def _sampled_share(m: Models) -> DataFrame:
    """Whether each rule of a half sample saw about half of the rows: within six deviations."""
    rows = m.stg_sales()
    total = rows.agg(F.count(F.lit(1)).cast("double")).scalar()
    found = scans.scan(rows, "stg-crm-sales", built_in_rules("staging_sales").rules, AS_OF, 50)
    within = F.abs(F.col("rule_rows_evaluated") - total / 2) <= 6 * F.sqrt(total / 4)
    return found.select("rule_name", within.alias("within"))


query("l23_sampled_share", oracle("select rule_name, true as within from scan_staging_sales", "scan_staging_sales"))(_sampled_share)
query("l23_sampled_scan")(lambda m: scans.scan(m.stg_sales(), "stg-crm-sales", built_in_rules("staging_sales").rules, AS_OF, 50))
query(
    "l24_nested_results",
    oracle(
        "select '{\"data_scan_id\":\"' || scan_id || '\"}' as data_quality_scan, '{\"passed\":' || cast(bool_and(rule_passed) over (partition by scan_id) as varchar) || '}' as job_quality_result, "
        "rule_name, rule_column, rule_passed, rule_rows_evaluated from scan_user_360",
        "scan_user_360",
    ),
)(
    lambda m: scans.nested_results(_scan(m, m.user_360(), "user-360", "user_360")).select(
        "data_quality_scan", "job_quality_result", "rule_name", "rule_column", "rule_passed", "rule_rows_evaluated"
    )
)


def _both_scans(m: Models) -> DataFrame:
    return _scan(m, m.user_360(), "user-360", "user_360").unionByName(_scan(m, m.audience(), "audience", "audience"))


_BOTH = "(select * from scan_user_360 union all select * from scan_audience)"
query(
    "l25_gate_verdict",
    oracle(f"select count(*) filter (where not rule_passed) = 0 as passed, count(*) filter (where not rule_passed) as failed_count from {_BOTH} q", "scan_user_360", "scan_audience"),
)(lambda m: scans.gate_verdict(_both_scans(m), AS_OF))
query(
    "l26_gate_by_action",
    oracle(
        f"select count(*) filter (where not rule_passed and failure_action = 'BLOCK_DOWNSTREAM') = 0 as passed, count(*) filter (where not rule_passed and failure_action = 'BLOCK_DOWNSTREAM') as failed_count from {_BOTH} q",
        "scan_user_360", "scan_audience",
    ),
)(lambda m: scans.gate_verdict(_both_scans(m), AS_OF, honour_action=True))


def _event_results(m: Models) -> DataFrame:
    """Scan-result rows spread over time, on both sides of the gate's window."""
    return m.raw("crm_campaign_events").select(
        (F.col("event_type") != "purchase").alias("rule_passed"),
        F.col("event_ts").alias("job_start_time"),
        F.when(F.col("campaign_id") == "CMP1", "BLOCK_DOWNSTREAM").otherwise("ALERT_ONLY").alias("failure_action"),
    )


query(
    "l25_gate_window",
    oracle(
        f"select count(*) = 0 as passed, count(*) as failed_count from crm_campaign_events where not (event_type <> 'purchase') and event_ts >= timestamp '2024-01-10 00:00:00' - interval 12 hours",
        "crm_campaign_events",
    ),
)(lambda m: scans.gate_verdict(_event_results(m), AS_OF.replace(month=1, day=10)))

# ---------------------------------------------------------------- small checks

_CHECK = "'2024-02-01' as run_date, 'x1' as execution_id"
query(
    "l27_check_row_count",
    oracle(
        f"select {_CHECK}, 'salesforce_audience_row_count' as check_name, case when count(*) > 0 then 'PASS' else 'FAIL' end as status, cast(count(*) as double) as metric_value, "
        "cast(1 as double) as threshold_value, '2024-02-01 00:00:00' as checked_at, 'mart.salesforce_campaign_audience must have at least one row' as details from audience",
        "audience",
    ),
)(lambda m: checks.check_row_count(m.audience(), as_of(), "x1"))
query(
    "l28_check_duplicates",
    oracle(
        f"select {_CHECK}, 'salesforce_audience_duplicate_keys' as check_name, case when count(*) = 0 then 'PASS' else 'FAIL' end as status, cast(count(*) as double) as metric_value, "
        "cast(0 as double) as threshold_value, '2024-02-01 00:00:00' as checked_at, 'campaign_id + user_id + run_date must be unique' as details "
        "from (select campaign_id, user_id, run_date from audience group by campaign_id, user_id, run_date having count(*) > 1) q",
        "audience",
    ),
)(lambda m: checks.check_duplicates(m.audience(), as_of(), "x1"))
query(
    "l29_no_fail_verdict",
    oracle(
        "select count(*) filter (where run_date = date '2024-01-10' and status = 'FAIL') = 0 as passed, count(*) filter (where run_date = date '2024-01-10' and status = 'FAIL') as failed_checks from check_results",
        "check_results",
    ),
)(lambda m: checks.no_fail_verdict(m.raw("check_results"), instant(AS_OF.replace(month=1, day=10))))
query("l30_assert_unique_user", oracle("select user_id, count(*) as duplicate_count from versions group by user_id having count(*) > 1", "versions"))(
    lambda m: checks.assert_unique_user((lambda u: u.toDF(*[c.lower() for c in u.columns]))(m.raw("user_versions")))
)


def _doubtful_audience(m: Models) -> DataFrame:
    """The audience with other and missing consents planted by score."""
    return m.audience().withColumn(
        "consent_status",
        F.when(F.col("score") == 25, F.lit("unknown")).when(F.col("score") == 45, F.lit(None)).otherwise(F.col("consent_status")),
    )


query(
    "l30_assert_consent",
    oracle(
        "select lead_email, user_id, consent_status from (select lead_email, user_id, case when score = 25 then 'unknown' when score = 45 then null else consent_status end as consent_status from audience) q "
        "where consent_status not in ('email_consent', 'partner_opt_in')",
        "audience",
    ),
)(lambda m: checks.assert_consent(_doubtful_audience(m)).select("lead_email", "user_id", "consent_status"))
query("l32_users_as_of", oracle("select count(*) as row_count from users where cast(updated_at as date) <= date '2023-12-15'", "users"))(
    lambda m: checks.users_as_of(m.lower_users(), "2023-12-15")
)

_EXTRA = (
    ScanRule("audience_count_between", "countBetween", options={"min": 1, "max": 1000000}),
    ScanRule("audience_count_too_small", "countBetween", options={"min": 10000000, "max": 20000000}),
    ScanRule("run_date_equals", "equals", column="run_date", options={"value": RUN_DATE}),
    ScanRule("amount_parsable", "parsable", column="deal_amount", options={"type": "numeric"}),
    ScanRule("date_parsable", "parsable", column="closed_date", options={"type": "date"}),
    ScanRule("deal_duplicates", "duplicatesAtMost", options={"keys": ["deal_id"], "max": 5}),
)
query(
    "l33_documented_extras",
    oracle(
        f"""select 'audience-count-between' as rule_name, count(*) between 1 and 1000000 as rule_passed, count(*) as rule_rows_evaluated from raw_sales
        union all select 'audience-count-too-small', count(*) between 10000000 and 20000000, count(*) from raw_sales
        union all select 'run-date-equals', count(*) filter (where run_date = date '{RUN_DATE}') = count(*), count(*) from raw_sales
        union all select 'amount-parsable', count(*) filter (where deal_amount is null or {AMOUNT} is not null) = count(*), count(*) from raw_sales
        union all select 'date-parsable', true, count(*) from raw_sales
        union all select 'deal-duplicates', count(*) filter (where n > 1) <= 5, cast(sum(n) as bigint) from (select deal_id, count(*) as n from raw_sales group by deal_id) g""",
        "raw_sales",
    ),
)(lambda m: scans.scan(m.raw("raw_sales"), "extra", _EXTRA, AS_OF).select("rule_name", "rule_passed", "rule_rows_evaluated"))
query(
    "l33_source_fresh",
    oracle("select cast(max(cast(event_ts as date)) as varchar) as latest_day, max(cast(event_ts as date)) <= date '2024-02-01' and date_diff('day', max(cast(event_ts as date)), date '2024-02-01') <= 2 as passed from crm_campaign_events", "crm_campaign_events"),
)(lambda m: checks.source_fresh(m.raw("crm_campaign_events"), "event_ts", RUN_DATE, 2))

# ---------------------------------------------------------------- M: arrival, audit, alerts


def _manifests(m: Models) -> DataFrame:
    """One manifest row per day with its nested file list."""
    files = m.raw("arrival_announced").groupBy("run_date").agg(
        F.collect_list(F.struct("source_type", "object_uri", F.col("size_bytes").cast("bigint").alias("size_bytes"))).alias("files")
    )
    return m.raw("arrival_days").select("run_date", "status").join(files, "run_date", "left")


def _arrivals(m: Models) -> DataFrame:
    return audit.arrival_report(_manifests(m), m.raw("arrival_files"), "raw/crm")


_NEEDED = " union all ".join(
    f"select run_date, status, '{s}' as source_type, 'raw/crm/' || cast(run_date as varchar) || '/{s}_' || strftime(run_date, '%Y_%m_%d') || '.csv' as object_uri from arrival_days"
    for s in audit.REQUIRED_SOURCES
)
PIECES["arrivals"] = (
    ("arrival_days", "arrival_announced", "arrival_files"),
    (),
    f"""select n.run_date, n.source_type, n.object_uri, cast(f.size_bytes as bigint) as size_bytes,
        case when n.status <> 'SUCCESS' then 'manifest status is not SUCCESS' when a.object_uri is null then 'not in manifest'
          when f.object_uri is null then 'missing file' when f.size_bytes <= 0 then 'empty file'
          when a.object_uri <> n.object_uri then 'manifest path differs' end as failure
        from ({_NEEDED}) n left join arrival_announced a on a.run_date = n.run_date and a.source_type = n.source_type
        left join arrival_files f on f.object_uri = n.object_uri""",
)
query("m1_m2_m3_arrival_report", oracle("select cast(run_date as varchar) as run_date, source_type, object_uri, size_bytes, failure, failure is null as passed from arrivals", "arrivals"))(_arrivals)
query(
    "m1_arrival_verdict",
    oracle("select cast(run_date as varchar) as run_date, bool_and(failure is null) as passed, count(failure) as failed_files from arrivals group by run_date", "arrivals"),
)(lambda m: audit.arrival_verdict(_arrivals(m)))
query(
    "m4_transfer_manifest",
    oracle(
        "select '2024-02-01' as run_date, split_part(object_uri, '/', 4) as file_name, object_uri as source_path, cast(size_bytes as bigint) as size_bytes, "
        "'dest/' || split_part(object_uri, '/', 4) as destination, cast(0 as bigint) as exit_code from arrival_files",
        "arrival_files",
    ),
)(
    lambda m: audit.transfer_manifest(
        m.raw("arrival_files").withColumn("file_name", F.substring_index("object_uri", "/", -1)), RUN_DATE, "dest"
    )
)
query(
    "m4_manifest_verdict",
    oracle("select count(*) as object_count, cast(0 as bigint) as failed_copies, count(*) = 4 as passed from arrival_files", "arrival_files"),
)(
    lambda m: audit.manifest_verdict(
        audit.transfer_manifest(
            m.raw("arrival_files").withColumn("file_name", F.substring_index("object_uri", "/", -1)), RUN_DATE, "dest"
        )
    )
)
query(
    "m6_status_report",
    oracle("select dag_run_id, task_id, cast(try_number as bigint) as try_number, status, cast(ended_at as varchar) as ended_at from step_status order by started_at desc limit 50", "step_status"),
)(lambda m: audit.status_report(m.raw("step_status")).select("dag_run_id", "task_id", F.col("try_number").cast("bigint").alias("try_number"), "status", "ended_at"))
query(
    "m6_rerun_history",
    oracle(
        "select cast(s.run_date as varchar) as run_date, s.dag_run_id, s.task_id, cast(s.try_number as bigint) as try_number, p.dag_run_id as rerun_of_dag_run_id, s.status from step_status s "
        "left join step_status p on p.run_date = s.run_date and p.dag_id = s.dag_id and p.task_id = s.task_id and p.try_number = s.try_number - 1 where s.try_number > 1",
        "step_status",
    ),
)(
    lambda m: audit.rerun_history(m.raw("step_status")).select(
        "run_date", "dag_run_id", "task_id", F.col("try_number").cast("bigint").alias("try_number"), "rerun_of_dag_run_id", "status"
    )
)
query(
    "m6_linked_reruns",
    oracle(
        "select cast(s.run_date as varchar) as run_date, s.execution_id, s.step_name, s.status, s.rerun_of_execution_id, o.status as origin_status from linked_status s "
        "left join linked_status o on o.execution_id = s.rerun_of_execution_id and o.step_name = s.step_name where s.rerun_of_execution_id is not null",
        "linked_status",
    ),
)(lambda m: audit.linked_reruns(m.raw("linked_status")))
query(
    "m6_ingestion_report",
    oracle(
        "select cast(run_date as varchar) as run_date, source_type, cast(input_count as bigint) as input_count, cast(valid_count as bigint) as valid_count, cast(rejected_count as bigint) as rejected_count, "
        "cast(audit_ts as varchar) as audit_ts from ingestion_runs where run_date = date '2024-01-05' and source_type = 'crm_sales' order by audit_ts desc limit 5",
        "ingestion_runs",
    ),
)(lambda m: audit.ingestion_report(m.raw("ingestion_runs"), "2024-01-05", "crm_sales", 5))
query(
    "m6_push_report",
    oracle("select campaign_id, status, cast(records_processed as bigint) as records_processed, is_dry_run, cast(started_at as varchar) as started_at from push_runs order by started_at desc limit 20", "push_runs"),
)(lambda m: audit.latest_runs(m.raw("push_runs"), 20).select("campaign_id", "status", "records_processed", "is_dry_run", "started_at"))
query(
    "m7_failure_alerts",
    oracle(
        "select cast(json_object('airflow_log_url', null, 'exception', 'Data quality validation failed. Failing ERROR rules: ' || failing_errors, 'pipeline_name', 'nightly_crm', "
        f"'rejected_table', 'raw.crm_rejected_records', 'run_date', '{RUN_DATE}', 'run_id', 'run-1', 'runbook', 'docs/quality', 'severity', 'ERROR', 'task_id', 'validate_data_quality') as varchar) as payload "
        f"from ({_VERDICT}) v where not passed",
        "report",
    ),
)(
    lambda m: audit.failure_alerts(
        quality.severity_verdict(_report(m)), "nightly_crm", "validate_data_quality", RUN_DATE, "run-1", "raw.crm_rejected_records", "docs/quality"
    )
)
query(
    "m8_rule_alerts",
    oracle(
        f"select '{RUN_DATE}' as run_date, 'curated.user_360' as failed_table, rule_name as failed_rule_id, severity, round(100.0 - rule_rows_passed_percent, 6) as failed_percent, rule_rows_evaluated, failure_action "
        "from scan_user_360 where not rule_passed",
        "scan_user_360",
    ),
    ("failed_percent",),
)(lambda m: scans.rule_alerts(_scan(m, m.user_360(), "user-360", "user_360"), RUN_DATE, "curated.user_360"))
