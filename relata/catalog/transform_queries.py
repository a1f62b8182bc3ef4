"""Registered queries: validation, staging, curated and mart models, joins, aggregates, windows, paging, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from relata.catalog.adapters import RUN_DATE, SQL_AS_OF, as_of
from relata.catalog.models import Models
from relata.catalog.oracles import AMOUNT, PIECES, doubles, oracle, rounded, texts
from relata.catalog.portable import portable
from relata.functions import casting, records, text
from relata.operators import aggregates, audience, curated, dedupe, joins, paging, staging, validation
from relata.operators.validation import ACCEPTED, FILE, NUMBER, OFFSET, RAW_ROW
from relata.sources.contracts import CONTRACTS

QUERIES: dict = {}
ORACLES: dict[str, str] = {}


def query(key: str, sql: str | None = None, rounded_columns: tuple[str, ...] = ()):
    def register(build):
        QUERIES[key] = lambda spark, sf_dir: portable(build(Models(spark, sf_dir)), rounded_columns)
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


# ---------------------------------------------------------------- C: row validation

SALES, LEADS = CONTRACTS["crm_sales"], CONTRACTS["crm_new_partner_leads"]


def _scanned(m: Models, name: str, contract) -> DataFrame:
    """Text rows in the shape of a CSV scan."""
    rows = m.raw(name)
    raw_row = F.create_map(*[p for c in sorted(contract.names) for p in (F.lit(c), F.coalesce(F.col(c), F.lit("")))])
    return rows.select(
        *contract.names,
        raw_row.alias(RAW_ROW),
        F.lit("crm.csv").alias(FILE),
        F.monotonically_increasing_id().alias(NUMBER),
        F.lit(0).cast("bigint").alias(OFFSET),
    )


def _checked(m: Models, name: str, contract) -> DataFrame:
    return validation.validated(_scanned(m, name, contract), contract)


_INT_OK = "regexp_full_match(trim(lead_score), '[+-]?[0-9]+')"
_BOOL = "case when lower(trim(opt_in)) in ('true','t','1','yes','y') then true when lower(trim(opt_in)) in ('false','f','0','no','n') then false end"
_TS_OK = "regexp_full_match(created_at, '[0-9]{4}-[0-9]{2}-[0-9]{2}([ T][0-9]{2}:[0-9]{2}:[0-9]{2}(Z|[+-][0-9]{2}:[0-9]{2})?)?')"
_TS = f"case when {_TS_OK} then case when created_at like '%+02:00' then try_cast(replace(left(created_at, 19), 'T', ' ') as timestamp) - interval 2 hours else try_cast(replace(left(created_at, 19), 'T', ' ') as timestamp) end end"
_FLOAT_OK = "regexp_full_match(trim(deal_amount), '[+-]?[0-9]+(\\.[0-9]+)?')"
_DATE_OK = "(regexp_full_match(closed_date, '[0-9]{4}-[0-9]{2}-[0-9]{2}') and try_cast(closed_date as date) is not null)"

PIECES["checked_leads"] = (
    ("text_leads",),
    (),
    f"""select *, nullif(lead_score, '') is not null and not {_INT_OK} as bad_score,
    nullif(created_at, '') is not null and ({_TS}) is null as bad_created, nullif(opt_in, '') is not null and ({_BOOL}) is null as bad_opt,
    nullif(external_lead_id, '') is null as no_id, nullif(email, '') is null as no_email from text_leads""",
)
PIECES["checked_sales"] = (
    ("text_sales",),
    (),
    f"""select *, nullif(deal_amount, '') is not null and not {_FLOAT_OK} as bad_amount,
    nullif(closed_date, '') is not null and not {_DATE_OK} as bad_date,
    nullif(user_id, '') is null as no_user, nullif(deal_id, '') is null as no_deal from text_sales""",
)
_LEADS_BAD = "(bad_score or bad_created or bad_opt or no_id or no_email)"
_SALES_BAD = "(bad_amount or bad_date or no_user or no_deal)"


@query(
    "c1_required_errors",
    oracle("select deal_id, customer_id, case when nullif(user_id, '') is null then 'user_id is required' end as user_error, "
           "case when nullif(deal_id, '') is null then 'deal_id is required' end as deal_error from text_sales", "text_sales"),
)
def c1(m):
    by_name = {c.name: c for c in SALES.columns}
    return m.raw("text_sales").select(
        "deal_id",
        "customer_id",
        validation.column_error(by_name["user_id"]).alias("user_error"),
        validation.column_error(by_name["deal_id"]).alias("deal_error"),
    )


@query(
    "c2_integer_coercion",
    oracle(f"select external_lead_id, lead_score as text, case when {_INT_OK} then cast(trim(lead_score) as bigint) end as value from text_leads", "text_leads"),
)
def c2(m):
    return m.raw("text_leads").select("external_lead_id", F.col("lead_score").alias("text"), casting.contract_integer("lead_score").alias("value"))


@query(
    "c3_float_coercion",
    oracle(f"select customer_id, deal_id, deal_amount as text, case when {_FLOAT_OK} then cast(trim(deal_amount) as double) end as value from text_sales", "text_sales"),
)
def c3(m):
    return m.raw("text_sales").select("customer_id", "deal_id", F.col("deal_amount").alias("text"), casting.contract_float("deal_amount").alias("value"))


@query("c4_bool_coercion", oracle(f"select external_lead_id, opt_in as text, {_BOOL} as value from text_leads", "text_leads"))
def c4(m):
    return m.raw("text_leads").select("external_lead_id", F.col("opt_in").alias("text"), casting.contract_bool("opt_in").alias("value"))


@query(
    "c5_date_coercion",
    oracle(f"select customer_id, deal_id, closed_date as text, cast(case when {_DATE_OK} then try_cast(closed_date as date) end as varchar) as value from text_sales", "text_sales"),
)
def c5(m):
    return m.raw("text_sales").select("customer_id", "deal_id", F.col("closed_date").alias("text"), casting.contract_date("closed_date").alias("value"))


@query(
    "c6_timestamp_coercion",
    oracle(f"select external_lead_id, created_at as text, cast({_TS} as varchar) as value from text_leads", "text_leads"),
)
def c6(m):
    return m.raw("text_leads").select("external_lead_id", F.col("created_at").alias("text"), casting.contract_timestamp("created_at").alias("value"))


@query(
    "c8_row_errors",
    oracle(
        "select customer_id, coalesce(deal_id, '') as deal_id, concat_ws('; ', case when no_user then 'user_id is required' end, "
        "case when no_deal then 'deal_id is required' end, case when bad_amount then 'deal_amount: invalid FLOAT: ' || deal_amount end, "
        f"case when bad_date then 'closed_date: invalid DATE: ' || closed_date end) as errors from checked_sales where {_SALES_BAD}",
        "checked_sales",
    ),
)
def c8(m):
    bad = _checked(m, "text_sales", SALES).where(~F.col(ACCEPTED))
    return bad.select(
        "customer_id",
        F.coalesce("deal_id", F.lit("")).alias("deal_id"),
        F.array_join(validation.row_errors(SALES), "; ").alias("errors"),
    )


@query(
    "c9_accepted_rows",
    oracle(
            f"select external_lead_id, email, partner_name, case when {_INT_OK} then cast(trim(lead_score) as bigint) end as lead_score, utm_source, "
            f"cast({_TS} as varchar) as created_at, {_BOOL} as opt_in, '{RUN_DATE}' as run_date, 'crm_new_partner_leads' as source_type, "
            f"'crm.csv' as source_file, '2024-02-01 00:00:00' as ingestion_ts from checked_leads where not {_LEADS_BAD}",
            "checked_leads",
        ),
)
def c9(m):
    return validation.accepted_rows(_checked(m, "text_leads", LEADS), LEADS, RUN_DATE, as_of())


@query(
    "c10_rejected_rows",
    oracle(
            f"select '{RUN_DATE}' as run_date, 'crm_new_partner_leads' as source_type, 'crm.csv' as source_file, "
            "cast(json_object('created_at', coalesce(created_at, ''), 'email', coalesce(email, ''), 'external_lead_id', coalesce(external_lead_id, ''), "
            "'lead_score', coalesce(lead_score, ''), 'opt_in', coalesce(opt_in, ''), 'partner_name', coalesce(partner_name, ''), 'utm_source', coalesce(utm_source, '')) as varchar) as raw_row, "
            "cast(to_json(list_filter([case when no_id then 'external_lead_id is required' end, case when no_email then 'email is required' end, "
            "case when bad_score then 'lead_score: invalid INTEGER: ' || lead_score end, case when bad_created then 'created_at: invalid TIMESTAMP: ' || created_at end, "
            "case when bad_opt then 'opt_in: invalid BOOL: ' || opt_in end], lambda x: x is not null)) as varchar) as error_reasons, "
            f"'2024-02-01 00:00:00' as rejected_ts from checked_leads where {_LEADS_BAD}",
            "checked_leads",
        ),
)
def c10(m):
    return validation.rejected_rows(_checked(m, "text_leads", LEADS), LEADS, RUN_DATE, as_of(), with_row_number=False).drop("row_number")


@query(
    "c11_metadata",
    oracle(f"select customer_id, deal_id, '{RUN_DATE}' as run_date, 'crm_sales' as source_type, 'crm.csv' as source_file, '2024-02-01 00:00:00' as ingestion_ts from text_sales", "text_sales"),
)
def c11(m):
    rows = _scanned(m, "text_sales", SALES).select("customer_id", "deal_id", FILE)
    return validation.enriched(rows, "crm_sales", RUN_DATE, as_of())


@query(
    "c13_ingestion_audit",
    oracle(
            f"select '{RUN_DATE}' as run_date, 'crm_sales' as source_type, 'in' as input_prefix, 'contract' as schema_config_path, 'raw.crm_sales' as output_table, "
            "'out' as rejected_output_prefix, count(*) as input_count, count(*) filter (where not "
            f"{_SALES_BAD}) as valid_count, count(*) filter (where {_SALES_BAD}) as rejected_count, '2024-02-01 00:00:00' as audit_ts from checked_sales",
            "checked_sales",
        ),
)
def c13(m):
    return validation.ingestion_audit(
        _checked(m, "text_sales", SALES), SALES, RUN_DATE, "in", "contract", "raw.crm_sales", "out", as_of()
    )


@query(
    "c14_reject_verdict",
    oracle(
            f"select 'crm_sales' as source_type, count(*) filter (where {_SALES_BAD}) as rejected_count, cast(0 as bigint) as max_bad_records, "
            f"count(*) filter (where {_SALES_BAD}) <= 0 as passed from checked_sales",
            "checked_sales",
        ),
)
def c14(m):
    audit = validation.ingestion_audit(
        _checked(m, "text_sales", SALES), SALES, RUN_DATE, "in", "contract", "raw.crm_sales", "out", as_of()
    )
    return validation.reject_verdict(audit, SALES)


@query(
    "c15_safe_casts",
    oracle(
        f"select customer_id, deal_id, cast({AMOUNT} as double) as as_numeric, "
        "case when regexp_full_match(trim(deal_amount), '[+-]?[0-9]+') then try_cast(trim(deal_amount) as bigint) end as as_int64, "
        "case lower(trim(deal_amount)) when 'true' then true when 'false' then false end as as_bool, "
        "cast(case when regexp_full_match(trim(closed_date), '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') then try_cast(trim(closed_date) as date) end as varchar) as as_date, "
        "cast(case when regexp_full_match(trim(closed_date), '[0-9]{4}-[0-9]{1,2}-[0-9]{1,2}') then try_cast(trim(closed_date) as timestamp) end as varchar) as as_timestamp "
        "from text_sales",
        "text_sales",
    ),
)
def c15(m):
    return m.raw("text_sales").select(
        "customer_id",
        "deal_id",
        casting.safe_cast("deal_amount", "numeric").alias("as_numeric"),
        casting.safe_cast("deal_amount", "int64").alias("as_int64"),
        casting.safe_cast("deal_amount", "bool").alias("as_bool"),
        casting.safe_cast("closed_date", "date").alias("as_date"),
        casting.safe_cast("closed_date", "timestamp").alias("as_timestamp"),
    )


# ---------------------------------------------------------------- D: models

_META = texts("run_date", "ingestion_ts") + ", source_type, source_file"

query(
    "d1_stg_crm_sales",
    oracle(f"select customer_id, user_id, deal_id, deal_stage, {doubles('deal_amount')}, currency, {texts('closed_date')}, owner_region, {_META} from stg_sales", "stg_sales"),
)(lambda m: m.stg_sales())

query(
    "d2_stg_crm_support",
    oracle(f"select ticket_id, user_id, priority, status, category, {doubles('csat_score')}, {_META} from stg_support", "stg_support"),
)(lambda m: m.stg_support())

query(
    "d3_stg_crm_campaign_events",
    oracle(f"select event_id, user_id, campaign_id, channel, event_type, {texts('event_ts')}, {_META} from stg_events", "stg_events"),
)(lambda m: m.stg_events())

query(
    "d4_stg_partner_leads",
    oracle(f"select external_lead_id, lead_email, partner_name, lead_score, utm_source, {texts('created_at')}, opt_in, {_META} from stg_leads", "stg_leads"),
)(lambda m: m.stg_leads())

query(
    "d5_stg_users",
    oracle(
        f"select user_id, email, first_name, last_name, gender, {texts('birth_date')}, city, country, {texts('signup_date')}, consent_email, income_band, "
        f"{texts('last_login_at')}, source_system, {texts('updated_at')} from stg_users",
        "stg_users",
    ),
)(lambda m: m.stg_users())

query(
    "d6_sales_clean",
    oracle(f"select customer_id, user_id, deal_id, deal_stage, {doubles('deal_amount')}, currency, {texts('closed_date')}, owner_region from sales_clean", "sales_clean"),
)(lambda m: staging.sales_clean(m.raw("crm_sales")))

query(
    "d7_support_clean",
    oracle("select ticket_id, user_id, priority, status, category, cast(csat_score as bigint) as csat_score from support_clean", "support_clean"),
)(lambda m: staging.support_clean(m.raw("crm_support")))

query(
    "d8_campaign_clean",
    oracle(f"select event_id, user_id, campaign_id, channel, event_type, {texts('event_ts')} from crm_campaign_events where user_id is not null and campaign_id is not null", "crm_campaign_events"),
)(lambda m: staging.campaign_clean(m.raw("crm_campaign_events")))

query(
    "d9_user_360",
    oracle(
        "select user_id, email, first_name, last_name, city, country, consent_email, income_band, deal_count, won_deal_count, "
        f"{texts('signup_date', 'last_login_at', 'latest_deal_date', 'latest_campaign_event_ts', 'transformed_at')}, {doubles('won_revenue')}, "
        f"ticket_count, open_ticket_count, {rounded('avg_csat_score')}, campaign_event_count, high_intent_event_count from user_360",
        "user_360",
    ),
    ("avg_csat_score",),
)(lambda m: m.user_360())

query(
    "d10_user_360_distinct",
    oracle(
        f"select l.user_id, l.email, l.country, l.sales_deal_count, {doubles('l.total_deal_amount')}, l.support_ticket_count, {rounded('l.avg_csat_score')}, "
        "cast(coalesce(x.amount, 0) as double) as total_deal_amount_exact "
        "from lean_360 l left join (select user_id, sum(deal_amount) as amount from sales_clean group by user_id) x on x.user_id = l.user_id",
        "lean_360",
    ),
    ("avg_csat_score",),
)(lambda m: m.lean_user_360())

_FEATURE_SELECT = (
    "select user_id, email, first_name, last_name, city, country, income_band, source_system, consent_email, "
    f"{texts('signup_at', 'last_login_at', 'updated_at')}, sales_deal_count, won_deal_count, {doubles('total_deal_amount')}, "
    f"{rounded('avg_deal_amount', 'avg_csat_score')}, support_ticket_count, campaign_event_count, campaign_click_count, campaign_open_count, "
    "days_since_signup, days_since_last_login, can_email from "
)

query("d11_user_features", oracle(_FEATURE_SELECT + "user_features", "user_features"), ("avg_deal_amount", "avg_csat_score"))(
    lambda m: m.user_features()
)
query(
    "d11_user_features_of_versions",
    oracle(_FEATURE_SELECT + "user_features_versions", "user_features_versions"),
    ("avg_deal_amount", "avg_csat_score"),
)(lambda m: m.user_features("user_versions"))

query(
    "d12_partner_lead_matches",
    oracle(
        "select external_lead_id, lead_email, partner_name, lead_score, utm_source, opt_in, matched_user_id, matched_user_consent_email, identity_status, "
        f"{texts('created_at', 'run_date', 'transformed_at')} from matches",
        "matches",
    ),
)(lambda m: m.matches())

query(
    "d12_shared_email_matches",
    oracle(
        "select external_lead_id, lead_email, partner_name, count(*) as matched_users from matches where identity_status = 'matched_user' "
        "group by external_lead_id, lead_email, partner_name having count(*) > 1",
        "matches",
    ),
)(lambda m: curated.shared_email_matches(m.matches()))

query(
    "d13_segmentation_features",
    oracle(
        f"select user_id, email, country, income_band, consent_email, deal_count, won_deal_count, {doubles('won_revenue')}, ticket_count, open_ticket_count, "
        f"{rounded('avg_csat_score')}, campaign_event_count, high_intent_event_count, account_age_days, days_since_last_login, {texts('feature_generated_at')} from features",
        "features",
    ),
    ("avg_csat_score",),
)(lambda m: m.features())

_AUDIENCE_SELECT = (
    f"select {texts('run_date')}, campaign_id, user_id, lead_email, salesforce_contact_id, segment_name, score, consent_status, activation_status, quality_gate_status"
)
query("d14_audience_governed", oracle(f"{_AUDIENCE_SELECT} from audience", "audience"))(lambda m: m.audience())
query("d14_audience_with_type", oracle(f"{_AUDIENCE_SELECT}, audience_type from audience", "audience"))(
    lambda m: m.audience(with_type=True)
)

_SELECTED = (
    "(select 1 as segment_id, 'campaign_engaged_growth' as campaign_code, 'Campaign Engaged Growth' as campaign_name, "
    "'High campaign engagement with meaningful purchase activity' as audience_reason "
    "union all select 2, 'high_value_sales_growth', 'High Value Sales Growth', 'High sales activity and deal value')"
)
query(
    "d15_audience_classic",
    oracle(
        "select f.user_id, f.email, x.campaign_code, x.campaign_name, cast(x.segment_id as bigint) as segment_id, 'segment_' || cast(x.segment_id as varchar) as segment_name, "
        f"x.audience_reason, f.city, f.country, f.income_band, {doubles('f.total_deal_amount')}, f.sales_deal_count, f.won_deal_count, f.campaign_event_count, "
        "f.campaign_click_count, f.days_since_last_login, '2024-02-01 00:00:00' as segmented_at, '2024-02-01 00:00:00' as audience_created_at, "
        f"'READY_TO_SEND' as activation_status from user_features f join {_SELECTED} x on x.segment_id = cast(substr(f.user_id, 2) as bigint) % 4 + 1 "
        "where f.can_email = true and trim(f.email) <> ''",
        "user_features",
    ),
)(lambda m: audience.audience_classic(m.classic_segments(), as_of()))

query(
    "d16_audience_lean",
    oracle(
        "select 'cmp_20240201' as campaign_id, user_id, email, '2024-02-01' as run_date, 'high_value_or_support_followup' as segment_name, "
        "'2024-02-01 00:00:00' as selected_at from lean_360 where email is not null and (total_deal_amount > 0 or support_ticket_count > 0)",
        "lean_360",
    ),
)(lambda m: audience.audience_lean(m.lean_user_360(), as_of()))

query(
    "d17_fallback_segment",
    oracle(
        "select user_id, case when high_intent_event_count >= 2 then 'high_value' when won_revenue >= 10000 then 'high_value' "
        "when open_ticket_count > 0 then 'support_followup' else 'nurture' end as segment_name from user_360",
        "user_360",
    ),
)(lambda m: m.user_360().select("user_id", audience.fallback_segment().alias("segment_name")))

query(
    "d18_fallback_score",
    oracle(
        "select user_id, case when p > 100 then 100.0 else cast(p as double) end as score from (select user_id, 15 * high_intent_event_count + 20 * won_deal_count + 5 * deal_count as p from user_360) q",
        "user_360",
    ),
)(lambda m: m.user_360().select("user_id", audience.fallback_score().alias("score")))

query(
    "d19_partner_tier",
    oracle(
        "select external_lead_id, lead_email, lead_score, if(coalesce(lead_score, 0) >= 70, 'partner_hot_lead', 'partner_nurture') as tier from stg_leads",
        "stg_leads",
    ),
)(lambda m: m.stg_leads().select("external_lead_id", "lead_email", "lead_score", audience.partner_tier().alias("tier")))

# ---------------------------------------------------------------- E: joins

query(
    "e1_left_join_users_sales",
    oracle("select u.user_id, u.email, s.n as deal_count from stg_users u left join (select user_id, count(*) as n from stg_sales group by user_id) s using (user_id)", "stg_users", "stg_sales"),
)(lambda m: m.stg_users().select("user_id", "email").join(aggregates.agg_sales(m.stg_sales()).select("user_id", "deal_count"), "user_id", "left"))

query(
    "e2_normalised_left_join",
    oracle(
        "select s.deal_id, s.customer_id, s.user_id, u.k as matched_user_id from crm_sales s left join (select distinct trim(user_id) as k from users where trim(user_id) <> '') u on u.k = trim(s.user_id)",
        "crm_sales", "users",
    ),
)(lambda m: joins.normalised_left_join(m.raw("crm_sales").select("deal_id", "customer_id", "user_id"), m.raw("user_raw")))

query(
    "e3_selected_segments_join",
    oracle(
        f"select u.user_id, x.campaign_code from users u join {_SELECTED} x on x.segment_id = cast(substr(u.user_id, 2) as bigint) % 4 + 1",
        "users",
    ),
)(
    lambda m: m.raw("user_raw")
    .select("user_id", (F.expr("substring(user_id, 2)").cast("bigint") % 4 + 1).alias("segment_id"))
    .join(F.broadcast(audience.selected_segments(m.spark)), "segment_id")
    .select(F.col("user_id"), "campaign_code")
)

query(
    "e4_run_date_constant",
    oracle("select u.user_id, cast(r.d as varchar) as run_date from users u, (select max(run_date) as d from stg_leads) r", "users", "stg_leads"),
)(
    lambda m: m.raw("user_raw").select(
        F.col("user_id"), audience.pipeline_run_date(m.stg_leads(), as_of()).scalar().alias("run_date")
    )
)


def _orphan_sql(fact: str, columns: str) -> str:
    return oracle(
        f"select {columns} from {fact} f left join users u on trim(f.user_id) = trim(u.user_id) where f.user_id is not null and trim(f.user_id) <> '' and u.user_id is null",
        fact, "users",
    )


query("e5_orphan_sales", _orphan_sql("crm_sales", "f.deal_id, f.customer_id, f.user_id"))(
    lambda m: joins.orphans(m.raw("crm_sales").select("deal_id", "customer_id", "user_id"), m.raw("user_raw"))
)
query("e5_orphan_support", _orphan_sql("crm_support", "f.ticket_id, f.user_id"))(
    lambda m: joins.orphans(m.raw("crm_support").select("ticket_id", "user_id"), m.raw("user_raw"))
)
query("e5_orphan_events", _orphan_sql("crm_campaign_events", "f.event_id, f.user_id"))(
    lambda m: joins.orphans(m.raw("crm_campaign_events").select("event_id", "user_id"), m.raw("user_raw"))
)

query("e5_measured_orphan_sales", _orphan_sql("crm_sales", "f.deal_id, f.customer_id, f.user_id"))(
    lambda m: joins.orphans(m.raw("crm_sales").select("deal_id", "customer_id", "user_id"), m.lower_users())
)

query(
    "e6_many_to_many_distinct",
    oracle(
        "select u.user_id, count(distinct s.deal_id) as deals, count(distinct t.ticket_id) as tickets, cast(sum(coalesce(s.deal_amount, 0)) as double) as fanned_amount "
        "from users u left join sales_clean s on s.user_id = u.user_id left join support_clean t on t.user_id = u.user_id group by u.user_id",
        "users", "sales_clean", "support_clean",
    ),
)(
    lambda m: m.lean_user_360().select(
        "user_id",
        F.col("sales_deal_count").alias("deals"),
        F.col("support_ticket_count").alias("tickets"),
        F.col("total_deal_amount").alias("fanned_amount"),
    )
)

query(
    "e7_email_left_join",
    oracle("select l.external_lead_id, l.lead_email, l.partner_name, u.user_id from stg_leads l left join stg_users u on u.email = l.lead_email", "stg_leads", "stg_users"),
)(
    lambda m: joins.skewed_left_join(
        m.stg_leads().select("external_lead_id", "lead_email", "partner_name"),
        m.stg_users().select(F.col("email").alias("lead_email"), "user_id"),
        "lead_email",
    )
)

query(
    "e7_email_left_join_hot_keys",
    oracle("select l.external_lead_id, l.lead_email, l.partner_name, u.user_id from stg_leads l left join stg_users u on u.email = l.lead_email", "stg_leads", "stg_users"),
)(
    # The same result with every repeated address taking the hot-key route.
    lambda m: joins.skewed_left_join(
        m.stg_leads().select("external_lead_id", "lead_email", "partner_name"),
        m.stg_users().select(F.col("email").alias("lead_email"), "user_id"),
        "lead_email",
        part_rows=1,
    )
)

query(
    "e8_keyed_counts",
    oracle(f"select count(*) as input_count, count(*) filter (where not {_LEADS_BAD}) as valid_count, count(*) filter (where {_LEADS_BAD}) as rejected_count from checked_leads", "checked_leads"),
)(lambda m: validation.ingestion_counts(_checked(m, "text_leads", LEADS)))

for _fact in ("crm_sales", "crm_support", "crm_campaign_events"):
    query(
        f"e11_join_coverage_{_fact}",
        oracle(
            "select count(*) as total_rows, count(u.k) as matched_rows, round(count(u.k) / cast(count(*) as double), 6) as coverage, 0.95 as min_ratio, "
            f"count(u.k) / cast(count(*) as double) >= 0.95 as passed from {_fact} f left join (select distinct trim(user_id) as k from users) u on u.k = trim(f.user_id)",
            _fact, "users",
        ).replace("0.95 as min_ratio", "cast(0.95 as double) as min_ratio"),
        ("coverage",),
    )(lambda m, fact=_fact: joins.join_coverage(m.raw(fact), m.raw("user_raw"), 0.95))

# ---------------------------------------------------------------- F: aggregates

query(
    "f1_agg_sales",
    oracle(
        "select user_id, count(*) as deal_count, count(*) filter (where deal_stage = 'won') as won_deal_count, "
        "cast(sum(case when deal_stage = 'won' then deal_amount else 0 end) as double) as won_revenue, cast(max(closed_date) as varchar) as latest_deal_date from stg_sales group by user_id",
        "stg_sales",
    ),
)(lambda m: aggregates.agg_sales(m.stg_sales()))
query(
    "f2_agg_support",
    oracle(
        "select user_id, count(*) as ticket_count, count(*) filter (where status <> 'closed') as open_ticket_count, round(cast(avg(csat_score) as double), 6) as avg_csat_score from stg_support group by user_id",
        "stg_support",
    ),
    ("avg_csat_score",),
)(lambda m: aggregates.agg_support(m.stg_support()))
query(
    "f3_agg_campaign",
    oracle(
        "select user_id, count(*) as campaign_event_count, count(*) filter (where event_type in ('click', 'purchase')) as high_intent_event_count, cast(max(event_ts) as varchar) as latest_campaign_event_ts from stg_events group by user_id",
        "stg_events",
    ),
)(lambda m: aggregates.agg_campaign(m.stg_events()))
query(
    "f4_agg_sales_classic",
    oracle(
        f"select user_id, count(*) as sales_deal_count, count(*) filter (where lower(deal_stage) in ('closed_won', 'won')) as won_deal_count, cast(sum({AMOUNT}) as double) as total_deal_amount, "
        f"round(cast(avg({AMOUNT}) as double), 6) as avg_deal_amount from deduped_sales group by user_id",
        "deduped_sales",
    ),
    ("avg_deal_amount",),
)(lambda m: aggregates.agg_sales_classic(curated.deduplicated(m.raw("crm_sales"), "deal_id")))
query(
    "f5_agg_support_classic",
    oracle("select user_id, count(*) as support_ticket_count, round(avg(csat_score), 6) as avg_csat_score from deduped_support group by user_id", "deduped_support"),
    ("avg_csat_score",),
)(lambda m: aggregates.agg_support_classic(curated.deduplicated(m.raw("crm_support"), "ticket_id")))
query(
    "f5_agg_campaign_classic",
    oracle(
        "select user_id, count(*) as campaign_event_count, count(*) filter (where lower(event_type) in ('click', 'clicked')) as campaign_click_count, "
        "count(*) filter (where lower(event_type) in ('open', 'opened')) as campaign_open_count from deduped_events group by user_id",
        "deduped_events",
    ),
)(lambda m: aggregates.agg_campaign_classic(curated.deduplicated(m.raw("crm_campaign_events"), "event_id")))
query("f6_count_distinct", oracle("select user_id, count(distinct deal_id) as deals from crm_sales group by user_id", "crm_sales"))(
    lambda m: aggregates.distinct_count(m.raw("crm_sales"), ["user_id"], "deal_id", "deals")
)
query("f7_any_value", oracle("select user_id, max(email) as email, max(country) as country from users group by user_id", "users"))(
    lambda m: aggregates.representative(m.lower_users(), ["user_id"], ["email", "country"])
)
query(
    "f8_conditional_count",
    oracle("select category, count(*) filter (where status = 'Open') as open_tickets, count(*) filter (where csat_score > 3) as happy from crm_support group by category", "crm_support"),
)(
    lambda m: m.raw("crm_support").groupBy("category").agg(
        F.count_if(F.col("status") == "Open").alias("open_tickets"), F.count_if(F.col("csat_score") > 3).alias("happy")
    )
)
_RAW = ("user_raw", "crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")
query(
    "f9_row_counts",
    oracle(" union all ".join(f"select 'raw.{n}' as table_name, (select count(*) from {n}) as row_count" for n in _RAW), *_RAW),
)(lambda m: aggregates.row_counts({f"raw.{name}": table for name, table in m.raw_tables().items()}))
query("f10_duplicate_keys", oracle("select deal_id, count(*) as duplicate_count from crm_sales group by deal_id having count(*) > 1", "crm_sales"))(
    lambda m: aggregates.duplicate_keys(m.raw("crm_sales"), ["deal_id"])
)
query("f10_duplicate_tickets", oracle("select ticket_id, count(*) as duplicate_count from crm_support group by ticket_id having count(*) > 1", "crm_support"))(
    lambda m: aggregates.duplicate_keys(m.raw("crm_support"), ["ticket_id"])
)
query("f11_max_with_default", oracle(f"select cast(coalesce(max(run_date), cast({SQL_AS_OF} as date)) as varchar) as run_date from raw_leads", "raw_leads"))(
    lambda m: audience.pipeline_run_date(m.raw("raw_leads"), as_of())
)
query(
    "f11_max_of_empty",
    oracle(f"select cast(coalesce(max(run_date), cast({SQL_AS_OF} as date)) as varchar) as run_date from raw_leads where run_date > date '2100-01-01'", "raw_leads"),
)(lambda m: audience.pipeline_run_date(m.raw("raw_leads").where("run_date > date '2100-01-01'"), as_of()))
query(
    "f12_count_of_groups",
    oracle("select count(*) as groups from (select campaign_id, user_id from crm_campaign_events group by campaign_id, user_id having count(*) > 1) q", "crm_campaign_events"),
)(
    lambda m: aggregates.duplicate_keys(m.raw("crm_campaign_events"), ["campaign_id", "user_id"]).agg(
        F.count(F.lit(1)).alias("groups")
    )
)

# ---------------------------------------------------------------- G: windows

query(
    "g1_latest_user_version",
    oracle(
        "select user_id, city, cast(updated_at as varchar) as updated_at from versions qualify row_number() over (partition by user_id order by updated_at desc nulls last, "
        "email nulls last, first_name nulls last, last_name nulls last, gender nulls last, birth_date nulls last, city nulls last) = 1",
        "versions",
    ),
)(
    lambda m: (lambda u: dedupe.latest_by(u.toDF(*[c.lower() for c in u.columns]), ["user_id"], ["updated_at"]))(
        m.raw("user_versions")
    ).select("user_id", "city", "updated_at")
)
for _name, _fact, _key, _columns in (
    ("sales", "crm_sales", "deal_id", "deal_id, customer_id, user_id, deal_stage, deal_amount"),
    ("support", "crm_support", "ticket_id", "ticket_id, user_id, priority, status, category, cast(csat_score as bigint) as csat_score"),
    ("events", "crm_campaign_events", "event_id", "event_id, user_id, campaign_id, channel, event_type"),
):
    query(f"g2_dedupe_{_name}", oracle(f"select {_columns} from deduped_{_name}", f"deduped_{_name}"))(
        lambda m, fact=_fact, key=_key, columns=_columns: curated.deduplicated(m.raw(fact), key).selectExpr(
            *[c.strip() for c in columns.split(", ")]
        )
    )
query(
    "g3_newest_leads",
    oracle(
        "select external_lead_id, lead_email, partner_name, cast(created_at as varchar) as created_at, lead_score from stg_leads qualify row_number() over "
        "(partition by lead_email, partner_name order by created_at desc nulls last, external_lead_id desc nulls last, lead_score nulls last) = 1",
        "stg_leads",
    ),
)(lambda m: curated.newest_leads(m.stg_leads()).select("external_lead_id", "lead_email", "partner_name", "created_at", "lead_score"))

# ---------------------------------------------------------------- H: order and paging

_PAGED = "lead_email, user_id, segment_name, score"
_ORDER = (
    "order by coalesce(salesforce_contact_id, ''), coalesce(lead_email, ''), coalesce(user_id, ''), run_date nulls first, campaign_id nulls first, "
    "segment_name nulls first, score nulls first, consent_status nulls first"
)


def _page(m: Models, limit: int, offset: int) -> DataFrame:
    return paging.page(m.audience(), ("salesforce_contact_id", "lead_email", "user_id"), limit, offset).select(
        "lead_email", "user_id", "segment_name", "score"
    )


query("h2_total_order", oracle(f"select {_PAGED} from audience", "audience"))(lambda m: _page(m, 0, 0))
query(
    "h2_order_of_rows",
    oracle(f"select {_PAGED}, place from (select *, row_number() over ({_ORDER}) as place from audience) q where place between 101 and 150", "audience"),
)(
    # The page's own order, shown by numbering the rows as they come.
    lambda m: _page(m, 50, 100).agg(F.collect_list(F.struct("*")).alias("rows")).select(F.posexplode("rows").alias("at", "row")).select(
        "row.*", (F.col("at") + 101).alias("place")
    )
)
query("h3_page", oracle(f"select {_PAGED} from (select * from audience {_ORDER} limit 50 offset 100) q", "audience"))(lambda m: _page(m, 50, 100))
query("h3_page_offset_only", oracle(f"select {_PAGED} from (select * from audience {_ORDER} offset 100) q", "audience"))(lambda m: _page(m, 0, 100))
query(
    "h4_latest_runs",
    oracle("select dag_run_id, task_id, status, cast(started_at as varchar) as started_at from step_status order by started_at desc, run_date, dag_id, dag_run_id limit 50", "step_status"),
)(lambda m: paging.latest_runs(m.raw("step_status"), 50).select("dag_run_id", "task_id", "status", "started_at"))

# ---------------------------------------------------------------- I: set operations

query(
    "i1_union_of_branches",
    oracle("select consent_status, audience_type, count(*) as members from audience group by consent_status, audience_type", "audience"),
)(lambda m: m.audience(with_type=True).groupBy("consent_status", "audience_type").agg(F.count(F.lit(1)).alias("members")))

# ---------------------------------------------------------------- J: scalar functions

query(
    "j1_normal_forms",
    oracle("select deal_id, customer_id, lower(trim(deal_stage)) as lowered, upper(trim(currency)) as uppered from crm_sales", "crm_sales"),
)(lambda m: m.raw("crm_sales").select("deal_id", "customer_id", text.lower_trimmed("deal_stage").alias("lowered"), text.upper_trimmed("currency").alias("uppered")))
query(
    "j2_blank_test",
    oracle("select deal_id, customer_id, coalesce(trim(user_id), '') = '' as blank from crm_sales", "crm_sales"),
)(lambda m: m.raw("crm_sales").select("deal_id", "customer_id", text.is_blank("user_id").alias("blank")))

_SALES_JSON = (
    "cast(json_object('customer_id', customer_id, 'user_id', user_id, 'deal_id', deal_id, 'deal_stage', deal_stage, 'deal_amount', deal_amount, "
    "'currency', currency, 'closed_date', cast(closed_date as varchar), 'owner_region', owner_region) as varchar)"
)
query(
    "j3_fallback_key",
    oracle(f"select customer_id, deal_id, coalesce(nullif(trim(deal_id), ''), nullif(trim(user_id), ''), sha256({_SALES_JSON})) as source_key from crm_sales", "crm_sales"),
)(
    lambda m: (lambda s: s.select("customer_id", "deal_id", records.fallback_key(("deal_id", "user_id"), records.hash_hex(records.row_json(s))).alias("source_key")))(
        m.raw("crm_sales")
    )
)
query(
    "j4_j5_null_defaults_and_cases",
    oracle(
        "select ticket_id, user_id, coalesce(csat_score, 0) as score, case when csat_score >= 4 then 'happy' when csat_score is null then 'silent' else 'other' end as mood from crm_support",
        "crm_support",
    ).replace("coalesce(csat_score, 0) as score", "cast(coalesce(csat_score, 0) as bigint) as score"),
)(
    lambda m: m.raw("crm_support").select(
        "ticket_id",
        "user_id",
        F.coalesce("csat_score", F.lit(0)).alias("score"),
        F.when(F.col("csat_score") >= 4, "happy").when(F.col("csat_score").isNull(), "silent").otherwise("other").alias("mood"),
    )
)
query(
    "j6_membership_with_null",
    oracle("select ticket_id, user_id, status in ('Open') as listed, status not in ('Open') as unlisted from crm_support", "crm_support"),
)(
    lambda m: m.raw("crm_support").select(
        "ticket_id", "user_id", F.col("status").isin("Open").alias("listed"), (~F.col("status").isin("Open")).alias("unlisted")
    )
)
query(
    "j7_is_true",
    oracle("select email, external_lead_id, opt_in is not distinct from true as yes, opt_in is distinct from true as not_yes from crm_new_partner_leads", "crm_new_partner_leads"),
)(
    lambda m: m.raw("crm_new_partner_leads").select(
        "email",
        "external_lead_id",
        F.col("opt_in").eqNullSafe(F.lit(True)).alias("yes"),
        (~F.col("opt_in").eqNullSafe(F.lit(True))).alias("not_yes"),
    )
)
query(
    "j8_j9_email_shapes",
    oracle(
        "select user_id, regexp_matches(trim(email), '^[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}$') as strict, regexp_matches(email, '^[^@\\s]+@[^@\\s]+\\.[^@\\s]+$') as loose from users",
        "users",
    ),
)(
    lambda m: m.raw("user_raw").select(
        F.col("user_id"), text.is_email(text.trimmed("email")).alias("strict"), text.is_email("email", strict=False).alias("loose")
    )
)
query(
    "j10_j11_j12_calendar",
    oracle(
        f"select user_id, date_diff('day', cast(last_login_at as date), cast({SQL_AS_OF} as date)) as age, cast(signup_date - interval 7 day as date)::varchar as week_before, "
        "cast(updated_at - interval 25 hours as varchar) as day_before, 'cmp_' || strftime(signup_date, '%Y%m%d') as campaign_id from users",
        "users",
    ),
)(
    lambda m: m.raw("user_raw").select(
        F.col("user_id"),
        records.days_between(as_of(), "last_login_at").alias("age"),
        F.date_sub("signup_date", 7).alias("week_before"),
        records.hours_before(F.col("updated_at"), 25).alias("day_before"),
        F.concat(F.lit("cmp_"), records.compact_day("signup_date")).alias("campaign_id"),
    )
)
query(
    "j13_j14_row_json_and_hash",
    oracle(f"select {_SALES_JSON} as record_json, sha256({_SALES_JSON}) as record_hash from crm_sales", "crm_sales"),
)(
    lambda m: (lambda s: s.select(records.row_json(s).alias("record_json")).withColumn("record_hash", records.hash_hex("record_json")))(
        m.raw("crm_sales")
    )
)
query(
    "j15_rounding_and_least",
    oracle("select user_id, round(100.0 / (1.0 + deal_count), 2) as score, least(100, 5 * deal_count) as points from user_360", "user_360"),
)(
    lambda m: m.user_360().select(
        "user_id",
        F.round(F.lit(100.0) / (F.lit(1.0) + F.col("deal_count")), 2).alias("score"),
        F.least(F.lit(100).cast("bigint"), F.col("deal_count") * 5).alias("points"),
    )
)
query("j16_uuid_shape", "select count(*) as rows, count(*) as ids, true as shaped from customer")(
    lambda m: m.raw("user_raw").select(F.uuid().alias("id")).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct("id").alias("ids"),
        F.bool_and(F.col("id").rlike("^[0-9a-f]{8}-[0-9a-f]{4}-4[0-9a-f]{3}-[89ab][0-9a-f]{3}-[0-9a-f]{12}$")).alias("shaped"),
    )
)
query("j16_uuid")(lambda m: m.raw("user_raw").select(F.col("user_id"), F.uuid().alias("execution_id")))
query(
    "j19_contact_name",
    oracle("select external_lead_id, email, coalesce(nullif(left(split_part(email, '@', 1), 80), ''), 'Unknown') as last_name from crm_new_partner_leads", "crm_new_partner_leads"),
)(lambda m: m.raw("crm_new_partner_leads").select("external_lead_id", "email", text.contact_name("email").alias("last_name")))
query(
    "j20_redacted",
    oracle("select dag_run_id, regexp_replace(message, 'Bearer\\s+[^''\"]+', 'Bearer [REDACTED]', 'g') as message from step_status", "step_status"),
)(lambda m: m.raw("step_status").select("dag_run_id", text.redacted("message").alias("message")))
query(
    "j21_j22_constants_and_casts",
    oracle("select user_id, 'CAMP_MOCK_1' as campaign_id, cast(null as varchar) as contact_id, cast(deal_count as varchar) as deals, cast(ticket_count as double) as tickets from user_360", "user_360"),
)(
    lambda m: m.user_360().select(
        "user_id",
        F.lit(audience.CAMPAIGN_ID).alias("campaign_id"),
        F.lit(None).cast("string").alias("contact_id"),
        F.col("deal_count").cast("string").alias("deals"),
        F.col("ticket_count").cast("double").alias("tickets"),
    )
)
