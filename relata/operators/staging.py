"""Staging models. Two families: *governed* (typed, 1:1 with raw) and *lean* (upper-cased, key-filtered)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.casting import safe_cast
from relata.functions.text import lower_trimmed, upper_trimmed

# The user table's columns, in order.
USER_COLUMNS = (
    "user_id",
    "email",
    "first_name",
    "last_name",
    "gender",
    "birth_date",
    "city",
    "country",
    "signup_date",
    "consent_email",
    "income_band",
    "last_login_at",
    "source_system",
    "updated_at",
)
METADATA_COLUMNS = ("run_date", "source_type", "source_file", "ingestion_ts")


def types_of(df: DataFrame) -> dict[str, str]:
    return {field.name.lower(): field.dataType.simpleString() for field in df.schema.fields}


def cast_to(df: DataFrame, name: str, target: str) -> Column:
    """A safe cast of one column that knows the column's present type."""
    return safe_cast(name, target, types_of(df)[name.lower()])


def _staged(raw: DataFrame, *columns: Column) -> DataFrame:
    return raw.where(F.col("run_date").isNotNull()).select(*columns, *METADATA_COLUMNS)


def stg_crm_sales(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        F.col("customer_id"),
        F.col("user_id"),
        F.col("deal_id"),
        lower_trimmed("deal_stage").alias("deal_stage"),
        cast_to(raw, "deal_amount", "numeric").alias("deal_amount"),
        F.col("currency"),
        cast_to(raw, "closed_date", "date").alias("closed_date"),
        F.col("owner_region"),
    )


def stg_crm_support(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        F.col("ticket_id"),
        F.col("user_id"),
        *[lower_trimmed(name).alias(name) for name in ("priority", "status", "category")],
        cast_to(raw, "csat_score", "numeric").alias("csat_score"),
    )


def stg_crm_campaign_events(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        F.col("event_id"),
        F.col("user_id"),
        F.col("campaign_id"),
        *[lower_trimmed(name).alias(name) for name in ("channel", "event_type")],
        cast_to(raw, "event_ts", "timestamp").alias("event_ts"),
    )


def stg_partner_leads(raw: DataFrame) -> DataFrame:
    return _staged(
        raw,
        F.col("external_lead_id"),
        lower_trimmed("email").alias("lead_email"),
        lower_trimmed("partner_name").alias("partner_name"),
        cast_to(raw, "lead_score", "int64").alias("lead_score"),
        lower_trimmed("utm_source").alias("utm_source"),
        cast_to(raw, "created_at", "timestamp").alias("created_at"),
        cast_to(raw, "opt_in", "bool").alias("opt_in"),
    )


def stg_users(raw: DataFrame) -> DataFrame:
    """Renamed user columns; consent is compared with ``Y`` as stored, so NULL stays NULL."""
    replaced = {
        "email": lower_trimmed("email"),
        "birth_date": cast_to(raw, "birth_date", "date"),
        "signup_date": cast_to(raw, "signup_date", "date"),
        "consent_email": F.col("consent_email") == "Y",
        "last_login_at": cast_to(raw, "last_login_at", "timestamp"),
        "updated_at": cast_to(raw, "updated_at", "timestamp"),
    }
    return raw.where(F.col("user_id").isNotNull()).select(
        *[replaced.get(name, F.col(name)).alias(name) for name in USER_COLUMNS]
    )


def sales_clean(raw: DataFrame) -> DataFrame:
    amount = cast_to(raw, "deal_amount", "numeric")
    return raw.where(F.col("user_id").isNotNull()).select(
        "customer_id",
        "user_id",
        "deal_id",
        upper_trimmed("deal_stage").alias("deal_stage"),
        F.coalesce(amount, F.lit(0).cast("decimal(38,9)")).alias("deal_amount"),
        "currency",
        "closed_date",
        "owner_region",
    )


def support_clean(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("user_id").isNotNull()).select(
        "ticket_id",
        "user_id",
        upper_trimmed("priority").alias("priority"),
        upper_trimmed("status").alias("status"),
        "category",
        "csat_score",
    )


def campaign_clean(raw: DataFrame) -> DataFrame:
    return raw.where(F.col("user_id").isNotNull() & F.col("campaign_id").isNotNull()).select(
        "event_id", "user_id", "campaign_id", "channel", "event_type", "event_ts"
    )
