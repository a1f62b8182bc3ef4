"""Campaign audiences in three variants, with the fallbacks of the governed one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from relata.functions.records import compact_day
from relata.functions.text import is_blank
from relata.operators.aggregates import latest_or

# Names and thresholds the audience contract fixes.
CAMPAIGN_ID = "CAMP_MOCK_1"
EMAIL_CONSENT = "email_consent"
PARTNER_OPT_IN = "partner_opt_in"
READY = "ready"
PASSED = "passed"
HIGH_VALUE = "high_value"
SUPPORT_FOLLOWUP = "support_followup"
NURTURE = "nurture"
PARTNER_HOT_LEAD = "partner_hot_lead"
PARTNER_NURTURE = "partner_nurture"
HIGH_INTENT_EVENTS = 2
HIGH_REVENUE = 10000
HOT_LEAD_SCORE = 70
SCORE_CAP = 100
SCORE_PER_HIGH_INTENT = 15
SCORE_PER_WON_DEAL = 20
SCORE_PER_DEAL = 5
LEAN_SEGMENT = "high_value_or_support_followup"
LEAN_CAMPAIGN_PREFIX = "cmp_"
READY_TO_SEND = "READY_TO_SEND"
EXISTING_USER = "existing_user"

# The segments the classic audience picks.
SELECTED_SEGMENTS = (
    (1, "campaign_engaged_growth", "Campaign Engaged Growth", "High campaign engagement with meaningful purchase activity"),
    (2, "high_value_sales_growth", "High Value Sales Growth", "High sales activity and deal value"),
)


def selected_segments(spark: SparkSession) -> DataFrame:
    """The built-in selection as a constant relation."""
    names = ("campaign_code", "campaign_name", "audience_reason")
    rows = [
        F.struct(F.lit(number).cast("bigint").alias("segment_id"), *[F.lit(t).alias(n) for n, t in zip(names, texts)])
        for number, *texts in SELECTED_SEGMENTS
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def fallback_segment() -> Column:
    return (
        F.when(
            (F.col("high_intent_event_count") >= HIGH_INTENT_EVENTS) | (F.col("won_revenue") >= HIGH_REVENUE),
            F.lit(HIGH_VALUE),
        )
        .when(F.col("open_ticket_count") > 0, F.lit(SUPPORT_FOLLOWUP))
        .otherwise(F.lit(NURTURE))
    )


def fallback_score() -> Column:
    points = (
        F.col("high_intent_event_count") * SCORE_PER_HIGH_INTENT
        + F.col("won_deal_count") * SCORE_PER_WON_DEAL
        + F.col("deal_count") * SCORE_PER_DEAL
    )
    return F.least(F.lit(SCORE_CAP).cast("bigint"), points).cast("double")


def partner_tier() -> Column:
    return F.when(F.col("lead_score") >= HOT_LEAD_SCORE, F.lit(PARTNER_HOT_LEAD)).otherwise(F.lit(PARTNER_NURTURE))


def pipeline_run_date(matches: DataFrame, as_of: Column) -> DataFrame:
    """One row: the newest run date of the partner leads, else the day of ``as_of``."""
    return latest_or(matches, "run_date", F.to_date(as_of))


def _member(run_date: Column, user_id: Column, segment: Column, score: Column, consent: str, kind: Column) -> list[Column]:
    return [
        run_date.alias("run_date"),
        F.lit(CAMPAIGN_ID).alias("campaign_id"),
        user_id.alias("user_id"),
        F.col("lead_email"),
        F.lit(None).cast("string").alias("salesforce_contact_id"),
        segment.alias("segment_name"),
        score.alias("score"),
        F.lit(consent).alias("consent_status"),
        F.lit(READY).alias("activation_status"),
        F.lit(PASSED).alias("quality_gate_status"),
        kind.alias("audience_type"),
    ]


def audience_governed(
    profile: DataFrame, segments: DataFrame, matches: DataFrame, as_of: Column, with_type: bool = False
) -> DataFrame:
    """Consenting users and all opted-in partner leads.

    The run date is a scalar of the lead matches, so it joins as a constant. ``with_type`` adds the
    ``audience_type`` column that two of the audience's quality rules look at.
    """
    run_date = pipeline_run_date(matches, as_of).scalar()
    scored = segments.select("user_id", F.col("segment_name").alias("_segment"), F.col("segment_score").alias("_score"))
    existing = (
        profile.where(F.col("consent_email"))
        .withColumnRenamed("email", "lead_email")
        .join(scored, "user_id", "left")
        .select(
            *_member(
                run_date,
                F.col("user_id"),
                F.coalesce("_segment", fallback_segment()),
                F.coalesce("_score", fallback_score()),
                EMAIL_CONSENT,
                F.lit(EXISTING_USER),
            )
        )
    )
    partners = matches.where(F.col("opt_in")).select(
        *_member(
            F.col("run_date"),
            F.col("matched_user_id"),
            partner_tier(),
            F.col("lead_score").cast("double"),
            PARTNER_OPT_IN,
            F.col("identity_status"),
        )
    )
    everyone = existing.unionByName(partners)
    return everyone if with_type else everyone.drop("audience_type")


def audience_classic(segments: DataFrame, as_of: Column, selected: DataFrame | None = None) -> DataFrame:
    """Mailable users of the selected segments. The built-in selection is two rows, so it is broadcast;
    a caller's own selection is left to the optimiser."""
    if selected is None:
        selected = F.broadcast(selected_segments(segments.sparkSession))
    return (
        segments.where(F.col("can_email") & ~is_blank("email"))
        .join(selected, "segment_id")
        .select(
            "user_id",
            "email",
            "campaign_code",
            "campaign_name",
            "segment_id",
            "segment_name",
            "audience_reason",
            "city",
            "country",
            "income_band",
            "total_deal_amount",
            "sales_deal_count",
            "won_deal_count",
            "campaign_event_count",
            "campaign_click_count",
            "days_since_last_login",
            "segmented_at",
            as_of.alias("audience_created_at"),
            F.lit(READY_TO_SEND).alias("activation_status"),
        )
    )


def audience_lean(profile: DataFrame, as_of: Column) -> DataFrame:
    """Users with an address and either revenue or tickets, under a dated campaign id."""
    return profile.where(
        F.col("email").isNotNull() & ((F.col("total_deal_amount") > 0) | (F.col("support_ticket_count") > 0))
    ).select(
        F.concat(F.lit(LEAN_CAMPAIGN_PREFIX), compact_day(as_of)).alias("campaign_id"),
        "user_id",
        "email",
        F.to_date(as_of).alias("run_date"),
        F.lit(LEAN_SEGMENT).alias("segment_name"),
        as_of.alias("selected_at"),
    )
