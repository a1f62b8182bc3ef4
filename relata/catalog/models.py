"""The operators applied to the derived tables, shared by the registered queries and the bench."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from relata.catalog.adapters import as_of, view
from relata.operators import audience, curated, staging


class Models:
    """Lazy models over one data folder."""

    def __init__(self, spark: SparkSession, sf_dir: str) -> None:
        self.spark, self.sf_dir = spark, sf_dir
        self._views: dict[str, DataFrame] = {}

    def raw(self, name: str) -> DataFrame:
        """A derived table; built once, since each build reads the files' footers."""
        if name not in self._views:
            self._views[name] = view(self.spark, self.sf_dir, name)
        return self._views[name]

    def raw_tables(self) -> dict[str, DataFrame]:
        names = ("user_raw", "crm_sales", "crm_support", "crm_campaign_events", "crm_new_partner_leads")
        return {name: self.raw(name) for name in names}

    def lower_users(self) -> DataFrame:
        users = self.raw("user_raw")
        return users.toDF(*[name.lower() for name in users.columns])

    def stg_sales(self) -> DataFrame:
        return staging.stg_crm_sales(self.raw("raw_sales"))

    def stg_support(self) -> DataFrame:
        return staging.stg_crm_support(self.raw("raw_support"))

    def stg_events(self) -> DataFrame:
        return staging.stg_crm_campaign_events(self.raw("raw_events"))

    def stg_leads(self) -> DataFrame:
        return staging.stg_partner_leads(self.raw("raw_leads"))

    def stg_users(self) -> DataFrame:
        return staging.stg_users(self.raw("user_raw"))

    def user_360(self) -> DataFrame:
        return curated.user_360(self.stg_users(), self.stg_sales(), self.stg_support(), self.stg_events(), as_of())

    def lean_user_360(self) -> DataFrame:
        return curated.user_360_distinct(
            self.lower_users(),
            staging.sales_clean(self.raw("crm_sales")),
            staging.support_clean(self.raw("crm_support")),
        )

    def user_features(self, users: str = "user_raw") -> DataFrame:
        return curated.user_features(
            self.raw(users), self.raw("crm_sales"), self.raw("crm_support"), self.raw("crm_campaign_events"), as_of()
        )

    def matches(self) -> DataFrame:
        return curated.partner_lead_matches(self.stg_leads(), self.stg_users(), as_of())

    def features(self) -> DataFrame:
        return curated.segmentation_features(self.user_360(), as_of())

    def given_segments(self) -> DataFrame:
        """Model output for every fourth user, so that both the score and the fallback occur."""
        number = F.expr("substring(user_id, 2)").cast("bigint")
        return self.stg_users().where(number % 4 == 0).select(
            "user_id",
            F.concat(F.lit("segment_"), (number % 3 + 1).cast("string")).alias("segment_name"),
            (number % 100).cast("double").alias("segment_score"),
        )

    def audience(self, with_type: bool = False) -> DataFrame:
        return audience.audience_governed(self.user_360(), self.given_segments(), self.matches(), as_of(), with_type)

    def classic_segments(self) -> DataFrame:
        """Per-user features with a segment id by rule, in the scored table's form."""
        number = F.expr("substring(user_id, 2)").cast("bigint")
        return self.user_features().select(
            "*",
            (number % 4 + 1).alias("segment_id"),
            F.concat(F.lit("segment_"), (number % 4 + 1).cast("string")).alias("segment_name"),
            as_of().alias("segmented_at"),
        )


Build = Callable[[SparkSession, str], DataFrame]
