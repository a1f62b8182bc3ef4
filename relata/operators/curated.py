"""Curated models: the per-user view in three variants, and partner-lead identity matching."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.casting import NUMERIC
from relata.functions.records import days_between
from relata.functions.text import is_blank, lower_trimmed, upper_trimmed
from relata.operators.aggregates import (
    agg_campaign,
    agg_campaign_classic,
    agg_sales,
    agg_sales_classic,
    agg_support,
    agg_support_classic,
)
from relata.operators.dedupe import dedupe_by, latest_by
from relata.operators.joins import skewed_left_join
from relata.operators.staging import cast_to

# Identity states of a partner lead.
PROSPECT = "prospect"
MATCHED_USER = "matched_user"


def _or_zero(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0)).alias(name)


def user_360(users: DataFrame, sales: DataFrame, support: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Governed variant: aggregates first, then three left joins on the same key.

    All four inputs are partitioned by ``user_id`` once; the joins add no further shuffle, and since
    each aggregate has one row per user, no join can fan out.
    """
    return (
        users.join(agg_sales(sales), "user_id", "left")
        .join(agg_support(support), "user_id", "left")
        .join(agg_campaign(events), "user_id", "left")
        .select(
            "user_id",
            "email",
            "first_name",
            "last_name",
            "city",
            "country",
            "signup_date",
            "consent_email",
            "income_band",
            "last_login_at",
            _or_zero("deal_count"),
            _or_zero("won_deal_count"),
            F.coalesce("won_revenue", F.lit(0).cast(NUMERIC)).alias("won_revenue"),
            "latest_deal_date",
            _or_zero("ticket_count"),
            _or_zero("open_ticket_count"),
            "avg_csat_score",
            _or_zero("campaign_event_count"),
            _or_zero("high_intent_event_count"),
            "latest_campaign_event_ts",
            as_of.alias("transformed_at"),
        )
    )


def _times(amount: Column, copies: Column) -> Column:
    """``amount`` times a whole number below 10^18, exact, for results of up to 28 digits before the point.

    One product of both at full width would lose decimals. So billions and the rest are multiplied apart; the types below
    are wide enough for each step to be exact.
    """
    billion = F.lit(10**9).cast("decimal(10,0)")
    count = copies.cast("decimal(18,0)")
    rest = amount % billion
    billions = ((amount - rest) / billion).cast("decimal(20,0)")
    high = (billions * count).cast("decimal(20,0)") * billion
    return (high.cast("decimal(37,9)") + (rest * count).cast("decimal(37,9)")).cast(NUMERIC)


def user_360_distinct(users: DataFrame, sales: DataFrame, support: DataFrame) -> DataFrame:
    """Lean variant: what joining users x sales x tickets and then grouping by user yields.

    The joined rows are never built. Within a user every sale meets every ticket, so a distinct
    count does not change, a sum over sales is multiplied by the number of tickets (1 when there is
    none) and by the number of user rows, and an average over tickets does not change. The sum
    without that multiplication is added as ``total_deal_amount_exact``.
    """
    people = users.groupBy("user_id").agg(
        F.max("email").alias("email"), F.max("country").alias("country"), F.count(F.lit(1)).alias("_people")
    )
    deals = sales.groupBy("user_id").agg(
        F.count_distinct("deal_id").alias("_deals"), F.sum("deal_amount").alias("_amount")
    )
    tickets = support.groupBy("user_id").agg(
        F.count_distinct("ticket_id").alias("_tickets"),
        F.count(F.lit(1)).alias("_ticket_rows"),
        F.avg("csat_score").alias("avg_csat_score"),
    )
    amount = F.coalesce("_amount", F.lit(0).cast(NUMERIC))
    copies = F.col("_people") * F.coalesce("_ticket_rows", F.lit(1))
    return (
        people.join(deals, "user_id", "left")
        .join(tickets, "user_id", "left")
        .select(
            "user_id",
            "email",
            "country",
            F.coalesce("_deals", F.lit(0)).alias("sales_deal_count"),
            _times(amount, copies).alias("total_deal_amount"),
            F.coalesce("_tickets", F.lit(0)).alias("support_ticket_count"),
            "avg_csat_score",
            amount.alias("total_deal_amount_exact"),
        )
    )


def current_users(raw: DataFrame) -> DataFrame:
    """Classic variant's users: normalised, blank ids dropped, newest row per id."""
    normalised = raw.where(~is_blank("user_id")).select(
        F.col("user_id").cast("string").alias("user_id"),
        lower_trimmed("email").alias("email"),
        *[F.col(name).alias(name) for name in ("first_name", "last_name", "city", "country", "income_band", "source_system")],
        upper_trimmed("consent_email").alias("consent_email"),
        cast_to(raw, "signup_date", "timestamp").alias("signup_at"),
        cast_to(raw, "last_login_at", "timestamp").alias("last_login_at"),
        cast_to(raw, "updated_at", "timestamp").alias("updated_at"),
    )
    return latest_by(normalised, ["user_id"], ["updated_at"])


def deduplicated(fact: DataFrame, key: str) -> DataFrame:
    """Classic variant's facts: blank business keys dropped, one row per key."""
    return dedupe_by(fact.where(~is_blank(key)), key)


def user_features(users: DataFrame, sales: DataFrame, support: DataFrame, events: DataFrame, as_of: Column) -> DataFrame:
    """Classic variant of the per-user view: deduplicated inputs, missing values as 0, ages in days."""
    deals = agg_sales_classic(deduplicated(sales, "deal_id"))
    tickets = agg_support_classic(deduplicated(support, "ticket_id"))
    touches = agg_campaign_classic(deduplicated(events, "event_id"))
    return (
        current_users(users)
        .join(deals, "user_id", "left")
        .join(tickets, "user_id", "left")
        .join(touches, "user_id", "left")
        .select(
            "user_id",
            "email",
            "first_name",
            "last_name",
            "city",
            "country",
            "income_band",
            "source_system",
            "consent_email",
            "signup_at",
            "last_login_at",
            "updated_at",
            *[
                _or_zero(name)
                for name in (
                    "sales_deal_count",
                    "won_deal_count",
                    "total_deal_amount",
                    "avg_deal_amount",
                    "support_ticket_count",
                    "avg_csat_score",
                    "campaign_event_count",
                    "campaign_click_count",
                    "campaign_open_count",
                )
            ],
            days_between(as_of, "signup_at").alias("days_since_signup"),
            days_between(as_of, "last_login_at").alias("days_since_last_login"),
            (F.col("consent_email") == "Y").alias("can_email"),
        )
    )


def newest_leads(leads: DataFrame) -> DataFrame:
    """The newest lead per (e-mail, partner)."""
    return latest_by(leads, ["lead_email", "partner_name"], ["created_at", "external_lead_id"])


def partner_lead_matches(leads: DataFrame, users: DataFrame, as_of: Column) -> DataFrame:
    """Newest leads with the users of the same e-mail; one row per match, so shared addresses multiply."""
    people = users.select(
        F.col("email").alias("lead_email"),
        F.col("user_id").alias("matched_user_id"),
        F.col("consent_email").alias("matched_user_consent_email"),
    ).where(F.col("lead_email").isNotNull())
    return skewed_left_join(newest_leads(leads), people, "lead_email").select(
        "external_lead_id",
        "lead_email",
        "partner_name",
        "lead_score",
        "utm_source",
        "created_at",
        "opt_in",
        "matched_user_id",
        "matched_user_consent_email",
        F.when(F.col("matched_user_id").isNull(), F.lit(PROSPECT)).otherwise(F.lit(MATCHED_USER)).alias("identity_status"),
        "run_date",
        as_of.alias("transformed_at"),
    )


def shared_email_matches(matches: DataFrame) -> DataFrame:
    """Leads that met more than one user, with the number of users."""
    return (
        matches.where(F.col("identity_status") == MATCHED_USER)
        .groupBy("external_lead_id", "lead_email", "partner_name")
        .agg(F.count(F.lit(1)).alias("matched_users"))
        .where(F.col("matched_users") > 1)
    )


def segmentation_features(profile: DataFrame, as_of: Column) -> DataFrame:
    return profile.select(
        "user_id",
        "email",
        "country",
        "income_band",
        "consent_email",
        "deal_count",
        "won_deal_count",
        "won_revenue",
        "ticket_count",
        "open_ticket_count",
        "avg_csat_score",
        "campaign_event_count",
        "high_intent_event_count",
        days_between(as_of, "signup_date").alias("account_age_days"),
        days_between(as_of, "last_login_at").alias("days_since_last_login"),
        as_of.alias("feature_generated_at"),
    )
