"""The CRM input tables, derived from the generic test tables.

Every expression is valid in Spark SQL and in DuckDB, so both engines get equal inputs; what is
computed from them is written separately for each. Values that break rules are planted by modulo.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession

from relata.functions.records import instant

AS_OF = datetime(2024, 2, 1)
RUN_DATE = "2024-02-01"
SQL_AS_OF = "timestamp '2024-02-01 00:00:00'"
SQL_RUN_DATE = "date '2024-02-01'"


def as_of() -> Column:
    return instant(AS_OF)


_USER_COLUMNS = """
concat('U', cast(c_custkey as string)) as USER_ID
case when c_custkey % 89 = 7 then null when c_custkey % 97 = 7 then 'not-an-email' else concat(' User', cast(c_custkey - (case when c_custkey % 50 = 49 then 1 else 0 end) as string), '@Example.com ') end as EMAIL
concat('First', cast(c_custkey as string)) as FIRST_NAME
concat('Last', cast(c_custkey as string)) as LAST_NAME
case when c_custkey % 2 = 0 then 'F' else 'M' end as GENDER
date '1960-01-01' + cast(c_custkey % 15000 as int) as BIRTH_DATE
c_mktsegment as CITY
n_name as COUNTRY
date '2020-01-01' + cast(c_custkey % 1400 as int) as SIGNUP_DATE
case when c_custkey % 101 = 9 then 'X' when c_custkey % 5 = 0 then null when c_custkey % 5 = 1 then 'N' when c_custkey % 5 = 2 then ' y' else 'Y' end as CONSENT_EMAIL
case when c_acctbal < 0 then 'LOW' when c_acctbal < 5000 then 'MID' else 'HIGH' end as INCOME_BAND
cast(date '2023-06-01' + cast(c_custkey % 200 as int) as timestamp) as LAST_LOGIN_AT
'oracle' as SOURCE_SYSTEM
cast(date '2023-12-01' + cast(c_custkey % 30 as int) as timestamp) as UPDATED_AT
"""

_SALES_COLUMNS = """
concat('C', cast(o_custkey as string)) as customer_id
case when o_orderkey % 503 = 3 then null when o_orderkey % 499 = 3 then '  ' when o_orderkey % 491 = 3 then 'X999999' else concat('U', cast(o_custkey as string)) end as user_id
case when o_orderkey % 487 = 3 then null else concat('D', cast(o_orderkey - (case when o_orderkey % 400 = 1 then 1 else 0 end) as string)) end as deal_id
case o_orderstatus when 'F' then ' Won ' when 'O' then 'Lost' else 'closed_won' end as deal_stage
case when o_orderkey % 307 = 3 then 'n/a' when o_orderkey % 311 = 3 then '-12.50' else cast(cast(o_totalprice as decimal(18,2)) as string) end as deal_amount
case o_orderpriority when '1-URGENT' then 'USD' when '2-HIGH' then ' twd' when '3-MEDIUM' then 'EUR' when '4-NOT SPECIFIED' then null else 'XXX' end as currency
cast(o_orderdate as date) as closed_date
o_orderpriority as owner_region
"""

_SUPPORT_COLUMNS = """
case when l_partkey % 293 = 3 then null else concat('T', cast(l_orderkey as string), '-', cast(l_linenumber as string)) end as ticket_id
case when l_partkey % 283 = 3 then null when l_partkey % 281 = 3 then 'X999998' else concat('U', cast(o_custkey as string)) end as user_id
case l_linenumber % 3 when 0 then ' HIGH' when 1 then 'Low' else 'medium' end as priority
case when l_suppkey % 11 = 0 then null when l_linestatus = 'O' then 'Open' else ' Closed ' end as status
case when l_tax > 0.04 then 'Billing' else 'Delivery' end as category
case when cast(l_quantity as int) % 8 = 7 then null when l_partkey % 101 = 3 then 9 else cast(l_quantity as int) % 5 + 1 end as csat_score
"""

_EVENT_COLUMNS = """
case when event_id % 479 = 3 then null else concat('E', cast(event_id as string)) end as event_id
case when event_id % 467 = 3 then null when event_id % 463 = 3 then 'X999997' else concat('U', cast(user_id as string)) end as user_id
concat('CMP', cast(event_id % 5 as string)) as campaign_id
case when event_type = 'error' then null when event_type = 'view' then ' ' when event_id % 2 = 0 then ' Email' else 'SMS ' end as channel
case event_type when 'click' then ' Click' when 'view' then 'Opened' else event_type end as event_type
cast(ts as timestamp) as event_ts
"""

_LEAD_COLUMNS = """
case when p_partkey % 193 = 3 then null else concat('L', cast(p_partkey as string)) end as external_lead_id
case when p_partkey % 191 = 3 then null when p_partkey % 181 = 3 then 'bad@@mail' when p_partkey % 3 = 0 then concat('USER', cast(p_partkey % 150 as string), '@example.com') else concat('lead', cast(p_partkey % 700 as string), '@partner.io') end as email
concat(' ', p_brand) as partner_name
case when p_partkey % 13 = 0 then null else p_size * 2 + 5 end as lead_score
p_type as utm_source
cast(date '2024-01-01' + cast(p_partkey % 29 as int) as timestamp) as created_at
case p_partkey % 4 when 0 then false when 1 then null else true end as opt_in
"""


def _lines(block: str) -> list[str]:
    return [line.strip() for line in block.strip().splitlines()]


_USERS_FROM = "customer join nation on c_nationkey = n_nationkey"
_SUPPORT_FROM = "lineitem join orders on l_orderkey = o_orderkey"

#: name -> (source text, columns). Sources name the given tables.
_BASE = {
    "user_raw": (_USERS_FROM, _lines(_USER_COLUMNS)),
    "crm_sales": ("orders", _lines(_SALES_COLUMNS)),
    "crm_support": (_SUPPORT_FROM, _lines(_SUPPORT_COLUMNS)),
    "crm_campaign_events": ("events", _lines(_EVENT_COLUMNS)),
    "crm_new_partner_leads": ("part", _lines(_LEAD_COLUMNS)),
}


def _metadata(key: str, source_type: str) -> list[str]:
    """Raw-table metadata; a NULL run date is planted on some rows."""
    return [
        f"case when {key} % 53 = 1 then null else {SQL_RUN_DATE} end as run_date",
        f"'{source_type}' as source_type",
        f"'crm/2024-02-01/{source_type}_2024_02_01.csv' as source_file",
        f"{SQL_AS_OF} as ingestion_ts",
    ]


# Text-typed rows as a CSV reader hands them over, with one bad value per type planted.
_TEXT_SALES = """
concat('C', cast(o_custkey as string)) as customer_id
case when o_orderkey % 503 = 3 then '' else concat('U', cast(o_custkey as string)) end as user_id
case when o_orderkey % 487 = 3 then null else concat('D', cast(o_orderkey as string)) end as deal_id
case o_orderstatus when 'F' then ' Won, "really" ' else 'Lost' end as deal_stage
case when o_orderkey % 307 = 3 then 'n/a' when o_orderkey % 311 = 3 then ' -12.5 ' when o_orderkey % 313 = 3 then '1_000' when o_orderkey % 317 = 3 then '' else cast(cast(o_totalprice as decimal(18,2)) as string) end as deal_amount
case o_orderpriority when '1-URGENT' then 'USD' else '' end as currency
case when o_orderkey % 211 = 3 then '2024' when o_orderkey % 223 = 3 then '2024-02-30' when o_orderkey % 227 = 3 then '2024-01-02 junk' else cast(cast(o_orderdate as date) as string) end as closed_date
o_orderpriority as owner_region
"""

_TEXT_LEADS = """
case when p_partkey % 193 = 3 then '' else concat('L', cast(p_partkey as string)) end as external_lead_id
case when p_partkey % 191 = 3 then null else concat('lead', cast(p_partkey % 700 as string), '@partner.io') end as email
p_brand as partner_name
case when p_partkey % 37 = 5 then 'many' when p_partkey % 41 = 5 then '12.5' when p_partkey % 43 = 5 then ' 7 ' when p_partkey % 47 = 5 then '' else cast(p_size as string) end as lead_score
p_type as utm_source
case p_partkey % 7 when 0 then '2024-01-05 10:30:00' when 1 then '2024-01-05T10:30:00+02:00' when 2 then '2024-13-01' when 3 then '2024-01-05' when 4 then '2024-01-05T10:30:00Z' when 5 then '05.01.2024' else '' end as created_at
case p_partkey % 9 when 0 then 'Yes' when 1 then ' t ' when 2 then '0' when 3 then 'NO' when 4 then 'maybe' when 5 then '1' when 6 then 'F' when 7 then 'y' else '' end as opt_in
"""


def _with(name: str, *extra: str) -> tuple[str, list[str]]:
    source, columns = _BASE[name]
    return source, [*columns, *extra]


_moved = [c if not c.endswith(" as CITY") else "'MOVED' as CITY" for c in _lines(_USER_COLUMNS)]
_later = [
    c if not c.endswith(" as UPDATED_AT")
    else "cast(date '2023-12-02' + cast(c_custkey % 30 as int) as timestamp) as UPDATED_AT"
    for c in _moved
]
_tied = [c if not c.endswith(" as CITY") else "'TIED' as CITY" for c in _lines(_USER_COLUMNS)]
_as_is = _lines(_USER_COLUMNS)


def _shifted(columns: list[str]) -> list[str]:
    """A new key, with a letter that no source key begins with."""
    return ["concat('N', cast(c_custkey as string)) as USER_ID" if c.endswith(" as USER_ID") else c for c in columns]


def _select(source: str, columns: list[str], where: str | None = None) -> str:
    return f"select {', '.join(columns)} from {source}" + (f" where {where}" if where else "")


def _unions(*parts: str) -> str:
    return " union all ".join(parts)


VIEWS: dict[str, str] = {name: _select(*spec) for name, spec in _BASE.items()}
VIEWS["raw_sales"] = _select(*_with("crm_sales", *_metadata("o_orderkey", "crm_sales")))
VIEWS["raw_support"] = _select(*_with("crm_support", *_metadata("l_partkey", "crm_support")))
VIEWS["raw_events"] = _select(*_with("crm_campaign_events", *_metadata("events.event_id", "crm_campaign_events")))
VIEWS["raw_leads"] = _select(*_with("crm_new_partner_leads", *_metadata("p_partkey", "crm_new_partner_leads")))
VIEWS["text_sales"] = _select("orders", _lines(_TEXT_SALES))
VIEWS["text_leads"] = _select("part", _lines(_TEXT_LEADS))
# Several versions of some users: a newer row, and an exact tie on the update time.
VIEWS["user_versions"] = _unions(
    VIEWS["user_raw"],
    _select(_USERS_FROM, _later, "c_custkey % 37 = 1"),
    _select(_USERS_FROM, _tied, "c_custkey % 41 = 1"),
)
# Changes: update, delete, update then delete, insert; sequence numbers rise in that order.
VIEWS["user_changes"] = _unions(
    _select(_USERS_FROM, [*_moved, "'U' as op", "c_custkey * 10 as seq"], "c_custkey % 10 in (0, 2)"),
    _select(_USERS_FROM, [*_as_is, "'D' as op", "c_custkey * 10 + 1 as seq"], "c_custkey % 10 in (1, 2)"),
    _select(_USERS_FROM, [*_shifted(_as_is), "'I' as op", "c_custkey * 10 + 2 as seq"], "c_custkey % 10 = 3"),
)
# Directories of the member interface.
_EMAIL = "lower(trim(case when c_custkey % 89 = 7 then null when c_custkey % 97 = 7 then 'not-an-email' else concat(' User', cast(c_custkey - (case when c_custkey % 50 = 49 then 1 else 0 end) as string), '@Example.com ') end))"
_LEAD_EMAIL = "concat('lead', cast(p_partkey % 700 as string), '@partner.io')"
VIEWS["contacts"] = f"select concat('003', cast(c_custkey as string)) as id, {_EMAIL} as email from customer where c_custkey % 3 = 0"
VIEWS["lead_directory"] = f"select concat('00Q', cast(p_partkey as string)) as id, {_LEAD_EMAIL} as email from part where p_partkey % 5 = 0"
VIEWS["members"] = _unions(
    "select 'CAMP_MOCK_1' as campaign_id, 'ContactId' as id_field, concat('003', cast(c_custkey as string)) as member_id from customer where c_custkey % 6 = 0",
    "select 'CAMP_OTHER' as campaign_id, 'ContactId' as id_field, concat('003', cast(c_custkey as string)) as member_id from customer where c_custkey % 9 = 0",
)
# One manifest per order day; files announced and delivered with gaps.
_DAY = "cast(o_orderdate as date)"
_FILE = "concat('raw/crm/', cast(d as string), '/', s, '_', replace(cast(d as string), '-', '_'), '.csv')"
_DAYS = f"(select {_DAY} as d, count(*) as n from orders group by {_DAY})"
_SOURCE_TYPES = ("crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")


def _per_source(columns: str, where: str) -> str:
    """The same selection for each source type ``s`` with number ``i``."""
    return _unions(
        *[
            f"select {columns} from (select d, n, '{name}' as s, {i} as i from {_DAYS} x) y where {where}"
            for i, name in enumerate(_SOURCE_TYPES)
        ]
    )


VIEWS["arrival_days"] = f"select d as run_date, case when n % 11 = 0 then 'FAILED' else 'SUCCESS' end as status, n from {_DAYS} x"
VIEWS["arrival_announced"] = _per_source(
    f"d as run_date, s as source_type, case when n % 7 = 0 and i = 3 then 'elsewhere.csv' else {_FILE} end as object_uri, n * 100 as size_bytes",
    "not (n % 5 = 0 and i = 2)",
)
VIEWS["arrival_files"] = _per_source(
    f"{_FILE} as object_uri, case when n % 13 = 0 and i = 1 then 0 else n * 100 end as size_bytes",
    "not (n % 3 = 0 and i = 0)",
)
# Step status, check results and push runs derived from events.
VIEWS["step_status"] = (
    "select cast(ts as date) as run_date, 'nightly_crm' as dag_id, concat('run-', cast(event_id as string)) as dag_run_id, "
    "concat('task_', event_type, cast(user_id as string)) as task_id, "
    "row_number() over (partition by cast(ts as date), event_type, user_id order by ts, event_id) as try_number, "
    "case when event_id % 5 = 0 then 'FAILED' when event_id % 5 = 1 then 'SKIPPED' else 'SUCCESS' end as status, "
    "cast(ts as timestamp) as started_at, cast(ts as timestamp) + interval 5 minutes as ended_at, "
    "case when event_id % 5 = 0 then concat('failed with Bearer abc', cast(event_id as string)) else null end as message from events"
)
VIEWS["linked_status"] = (
    "select cast(ts as date) as run_date, concat('x', cast(event_id as string)) as execution_id, 'run_transform_sql' as step_name, "
    "case when event_id % 5 = 0 then 'FAILED' else 'SUCCESS' end as status, cast(ts as timestamp) as started_at, "
    "cast(ts as timestamp) as finished_at, cast(null as string) as error_message, "
    "case when event_id % 7 = 0 and event_id > 0 then concat('x', cast(event_id - 1 as string)) else null end as rerun_of_execution_id from events"
)
VIEWS["push_runs"] = (
    "select cast(ts as date) as run_date, concat('CAMP_MOCK_', cast(event_id % 3 as string)) as campaign_id, cast(ts as timestamp) as started_at, "
    "cast(ts as timestamp) as completed_at, case when event_id % 4 = 0 then 'FAILED' else 'SUCCESS' end as status, event_id as records_processed, "
    "event_id % 2 = 0 as is_dry_run, cast(null as string) as error_message from events"
)
VIEWS["ingestion_runs"] = (
    "select cast(ts as date) as run_date, case event_id % 4 when 0 then 'crm_sales' when 1 then 'crm_support' when 2 then 'crm_campaign_events' else 'crm_new_partner_leads' end as source_type, "
    "event_id + user_id as input_count, event_id as valid_count, user_id as rejected_count, cast(ts as timestamp) as audit_ts from events"
)
VIEWS["check_results"] = (
    "select cast(ts as date) as run_date, concat('e', cast(event_id as string)) as execution_id, event_type as check_name, "
    "case when event_id % 50 = 0 then 'FAIL' else 'PASS' end as status, value as metric_value, cast(ts as timestamp) as checked_at from events"
)

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")
def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One derived table as a DataFrame over the given Parquet tables."""
    text = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if _mentions(text, t)}
    # Tables are passed as named arguments of the statement, so no catalog entry is left behind.
    return spark.sql(_braced(text, used), **used)


def _mentions(text: str, table: str) -> bool:
    return any(f"{word} {table}" in text for word in ("from", "join"))


def _braced(text: str, used: dict) -> str:
    for table in used:
        for word in ("from", "join"):
            text = text.replace(f"{word} {table}", f"{word} {{{table}}} {table}")
    return text


def ctes(*names: str) -> str:
    """A WITH clause that defines derived tables for DuckDB."""
    return "with " + ", ".join(f"{name} as ({VIEWS[name]})" for name in names)
