"""K-means segmentation: an exact fit by aggregates, or one with ``pyspark.ml``; scoring with plain column expressions.

A fitted model is small (k centers of ten or so numbers), so scoring puts means, deviations and
centers into the plan as literals: one code-generated projection, no join and no vectors.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import asdict, dataclass

from pyspark import StorageLevel
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import Imputer, StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from relata.operators import exact_kmeans

# Features of each variant, in order, and the model options.
GOVERNED_FEATURES = (
    "deal_count",
    "won_deal_count",
    "won_revenue",
    "ticket_count",
    "open_ticket_count",
    "avg_csat_score",
    "campaign_event_count",
    "high_intent_event_count",
    "account_age_days",
    "days_since_last_login",
)
CLASSIC_FEATURES = (
    "sales_deal_count",
    "won_deal_count",
    "total_deal_amount",
    "avg_deal_amount",
    "support_ticket_count",
    "avg_csat_score",
    "campaign_event_count",
    "campaign_click_count",
    "campaign_open_count",
    "days_since_signup",
    "days_since_last_login",
)
CLUSTERS = 4
ITERATIONS = 20
MODEL_NAME = "user_segment_model"
MODEL_VERSION = "v1"

SEED = 42


@dataclass(frozen=True)
class SegmentModel:
    """What scoring needs: per feature its mean and deviation, and the centers in scaled space."""

    features: tuple[str, ...]
    means: tuple[float, ...]
    deviations: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]

    def to_json(self) -> str:
        return json.dumps(asdict(self))

    @staticmethod
    def from_json(text: str) -> SegmentModel:
        raw = json.loads(text)
        return SegmentModel(
            tuple(raw["features"]),
            tuple(raw["means"]),
            tuple(raw["deviations"]),
            tuple(tuple(center) for center in raw["centers"]),
        )

    def ordered_by(self, feature: str, descending: bool = True) -> SegmentModel:
        """The same model with centers renumbered along one feature, so numbers agree between fits."""
        at = self.features.index(feature)
        return SegmentModel(
            self.features,
            self.means,
            self.deviations,
            tuple(sorted(self.centers, key=lambda center: center[at], reverse=descending)),
        )


def feature_frame(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Rows with a user id, the features as doubles; a value that cannot be cast fails the job."""
    return df.where(F.col("user_id").isNotNull()).select(
        *[F.col(name).cast("double").alias(name) for name in features]
    )


def segment_stages(features: Sequence[str], clusters: int, iterations: int, seed: int) -> Pipeline:
    names = list(features)
    filled = [f"{name}_filled" for name in names]
    return Pipeline(
        stages=[
            Imputer(strategy="mean", inputCols=names, outputCols=filled),
            VectorAssembler(inputCols=filled, outputCol="assembled"),
            StandardScaler(inputCol="assembled", outputCol="scaled", withMean=True, withStd=True),
            KMeans(k=clusters, maxIter=iterations, seed=seed, featuresCol="scaled", predictionCol="prediction"),
        ]
    )


def fit_stages(
    df: DataFrame, features: Sequence[str], clusters: int = CLUSTERS, iterations: int = ITERATIONS, seed: int = SEED
) -> PipelineModel:
    """Fit on the whole table. Each iteration is one pass over the persisted features."""
    frame = feature_frame(df, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return segment_stages(features, clusters, iterations, seed).fit(frame)
    finally:
        frame.unpersist()


def scoring_model(fitted: PipelineModel, features: Sequence[str]) -> SegmentModel:
    scaler, kmeans = fitted.stages[2], fitted.stages[3]
    return SegmentModel(
        tuple(features),
        tuple(float(x) for x in scaler.mean),
        tuple(float(x) for x in scaler.std),
        tuple(tuple(float(x) for x in center) for center in kmeans.clusterCenters()),
    )


def fit_segments(
    df: DataFrame, features: Sequence[str], clusters: int = CLUSTERS, iterations: int = ITERATIONS, seed: int = SEED
) -> SegmentModel:
    """The exact fit: equal rows give equal centers, whatever their order and partitions."""
    found = exact_kmeans.fit(df, features, clusters, iterations, seed)
    return SegmentModel(
        tuple(features),
        tuple(mean / exact_kmeans.VALUE_UNIT for mean in found.means),
        tuple(deviation / exact_kmeans.VALUE_UNIT for deviation in found.deviations),
        tuple(tuple(value / exact_kmeans.SCALED_UNIT for value in center) for center in found.centers),
    )


def impute_mean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """NULLs replaced by the column's mean over the whole table."""
    means = df.agg(*[F.avg(F.col(name).cast("double")).alias(name) for name in columns])
    return df.withColumns(
        {name: F.coalesce(F.col(name).cast("double"), means.select(name).scalar()) for name in columns}
    )


def standardise(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Z-scores with the sample deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[
                part
                for name in columns
                for part in (
                    F.avg(F.col(name).cast("double")).alias(f"{name}_mean"),
                    F.stddev_samp(F.col(name).cast("double")).alias(f"{name}_dev"),
                )
            ]
        ).alias("s")
    ).scalar()
    packed = df.withColumn("_stats", stats)

    def score(name: str) -> Column:
        value, mean, dev = F.col(name).cast("double"), F.col(f"_stats.{name}_mean"), F.col(f"_stats.{name}_dev")
        return F.when(value.isNotNull(), F.when(dev > 0, (value - mean) / dev).otherwise(F.lit(0.0)))

    return packed.withColumns({name: score(name) for name in columns}).drop("_stats")


def _distance(scaled: Sequence[Column], center: Sequence[float]) -> Column:
    total = F.lit(0.0)
    for value, middle in zip(scaled, center):
        total = total + (value - F.lit(float(middle))) * (value - F.lit(float(middle)))
    return F.sqrt(total)


def center_distances(scaled: Sequence[Column], centers: Sequence[Sequence[float]]) -> Column:
    """All (distance, 1-based center id) pairs, nearest first; equal distances by id."""
    pairs = [
        F.struct(_distance(scaled, center).alias("distance"), F.lit(i).cast("bigint").alias("centroid_id"))
        for i, center in enumerate(centers, start=1)
    ]
    return F.sort_array(F.array(*pairs))


def assign_to_centers(df: DataFrame, columns: Sequence[str], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Nearest of the given centers for columns that are already in the centers' space."""
    return df.withColumn(
        "nearest_centroids_distance", center_distances([F.col(name).cast("double") for name in columns], centers)
    ).withColumn("centroid_id", F.col("nearest_centroids_distance")[0]["centroid_id"])


def score_segments(model: SegmentModel, df: DataFrame) -> DataFrame:
    """Input rows with ``centroid_id`` and all distances ascending."""
    scaled = []
    for name, mean, deviation in zip(model.features, model.means, model.deviations):
        value = F.coalesce(F.col(name).cast("double"), F.lit(mean))
        scaled.append((value - F.lit(mean)) / F.lit(deviation) if deviation > 0 else F.lit(0.0))
    return (
        df.where(F.col("user_id").isNotNull())
        .withColumn("nearest_centroids_distance", center_distances(scaled, model.centers))
        .withColumn("centroid_id", F.col("nearest_centroids_distance")[0]["centroid_id"])
    )


def segment_name() -> Column:
    return F.concat(F.lit("segment_"), F.col("centroid_id").cast("string"))


def segment_score() -> Column:
    return F.round(F.lit(100.0) / (F.lit(1.0) + F.col("nearest_centroids_distance")[0]["distance"]), 2)


def user_segments_governed(model: SegmentModel, features: DataFrame, as_of: Column) -> DataFrame:
    return score_segments(model, features).select(
        F.to_date(as_of).alias("run_date"),
        "user_id",
        segment_name().alias("segment_name"),
        segment_score().alias("segment_score"),
        F.lit(MODEL_NAME).alias("model_name"),
        F.lit(MODEL_VERSION).alias("model_version"),
        as_of.alias("scored_at"),
    )


def user_segments_classic(model: SegmentModel, features: DataFrame, as_of: Column) -> DataFrame:
    """Segment id and name with the user's descriptive columns and features passed through."""
    return score_segments(model, features).select(
        "user_id",
        "email",
        "can_email",
        "city",
        "country",
        "income_band",
        F.col("centroid_id").alias("segment_id"),
        segment_name().alias("segment_name"),
        *[F.col(name).cast("double").alias(name) for name in CLASSIC_FEATURES],
        as_of.alias("segmented_at"),
    )
