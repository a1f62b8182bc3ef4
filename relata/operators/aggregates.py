"""Per-user aggregates of the fact tables, one function per variant, and duplicate groups.

Each is a single hash aggregate with map-side combine on ``user_id``.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.casting import NUMERIC
from relata.operators.staging import cast_to

# What counts as won or engaged in each variant.
GOVERNED_WON = "won"
GOVERNED_CLOSED = "closed"
GOVERNED_HIGH_INTENT = ("click", "purchase")
CLASSIC_WON = ("closed_won", "won")
CLASSIC_CLICK = ("click", "clicked")
CLASSIC_OPEN = ("open", "opened")


def agg_sales(staged: DataFrame) -> DataFrame:
    won = F.col("deal_stage") == GOVERNED_WON
    zero = F.lit(0).cast(NUMERIC)
    return staged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("deal_count"),
        F.count_if(won).alias("won_deal_count"),
        F.sum(F.when(won, F.col("deal_amount")).otherwise(zero)).alias("won_revenue"),
        F.max("closed_date").alias("latest_deal_date"),
    )


def agg_support(staged: DataFrame) -> DataFrame:
    return staged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("ticket_count"),
        F.count_if(F.col("status") != GOVERNED_CLOSED).alias("open_ticket_count"),
        F.avg("csat_score").alias("avg_csat_score"),
    )


def agg_campaign(staged: DataFrame) -> DataFrame:
    return staged.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("campaign_event_count"),
        F.count_if(F.col("event_type").isin(*GOVERNED_HIGH_INTENT)).alias("high_intent_event_count"),
        F.max("event_ts").alias("latest_campaign_event_ts"),
    )


def agg_sales_classic(sales: DataFrame) -> DataFrame:
    amount = cast_to(sales, "deal_amount", "numeric")
    return sales.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("sales_deal_count"),
        F.count_if(F.lower("deal_stage").isin(*CLASSIC_WON)).alias("won_deal_count"),
        F.sum(amount).alias("total_deal_amount"),
        F.avg(amount).alias("avg_deal_amount"),
    )


def agg_support_classic(support: DataFrame) -> DataFrame:
    return support.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("support_ticket_count"),
        F.avg(cast_to(support, "csat_score", "numeric")).alias("avg_csat_score"),
    )


def agg_campaign_classic(events: DataFrame) -> DataFrame:
    kind = F.lower("event_type")
    return events.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("campaign_event_count"),
        F.count_if(kind.isin(*CLASSIC_CLICK)).alias("campaign_click_count"),
        F.count_if(kind.isin(*CLASSIC_OPEN)).alias("campaign_open_count"),
    )


def distinct_count(df: DataFrame, keys: Sequence[str], column: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.count_distinct(column).alias(name))


def representative(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """One value per group and column. Any would do; the largest makes reruns agree."""
    return df.groupBy(*keys).agg(*[F.max(name).alias(name) for name in columns])


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Table name and row count of each table, as one relation."""
    result = None
    for name, table in tables.items():
        counted = table.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        result = counted if result is None else result.unionByName(counted)
    return result


def duplicate_keys(df: DataFrame, keys: Sequence[str], name: str = "duplicate_count") -> DataFrame:
    """Key groups of more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name)).where(F.col(name) > 1)


def latest_or(df: DataFrame, column: str, default: Column) -> DataFrame:
    """One row: the largest value of a column, or a default for an empty table."""
    return df.agg(F.coalesce(F.max(column), default).alias(column))
