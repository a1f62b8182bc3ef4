import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from relata.catalog.models import Models
from relata.catalog.registry import all_queries
from relata.operators import exact_kmeans, segments
from tests.conftest import SMALL

FEATURES = ("a", "b")


@pytest.fixture(scope="module")
def points(spark):
    return spark.range(400).select(
        F.concat(F.lit("u"), F.col("id").cast("string")).alias("user_id"),
        ((F.col("id") % 4) * 10 + F.rand(1)).alias("a"),
        F.when(F.col("id") % 10 > 0, (F.col("id") % 4) * 5 + F.rand(2)).alias("b"),
        (F.col("id") % 4).alias("truth"),
    ).persist()


def test_clusters_are_found_and_numbered_from_one(points):
    model = segments.fit_segments(points, FEATURES)
    scored = segments.score_segments(model, points)
    assert {row.centroid_id for row in scored.select("centroid_id").distinct().collect()} == {1, 2, 3, 4}
    assert len(model.centers) == 4
    clear = scored.where("b is not null").groupBy("truth").agg(F.count_distinct("centroid_id").alias("n"))
    assert {row.n for row in clear.collect()} == {1}


def test_same_seed_same_model(points):
    assert segments.fit_segments(points, FEATURES) == segments.fit_segments(points, FEATURES)


def test_scoring_agrees_with_the_fitted_stages(points):
    fitted = segments.fit_stages(points, FEATURES)
    model = segments.scoring_model(fitted, FEATURES)
    own = segments.score_segments(model, points).select("user_id", "centroid_id")
    theirs = fitted.transform(points).select("user_id", (F.col("prediction") + 1).alias("theirs"))
    assert own.join(theirs, "user_id").where("centroid_id <> theirs").count() == 0


def test_distances_ascend_and_are_euclidean(spark):
    df = spark.createDataFrame([("u", 0.0, 0.0)], "user_id string, a double, b double")
    near = segments.assign_to_centers(df, FEATURES, ((3.0, 4.0), (0.0, 1.0), (1.0, 0.0))).first()
    assert [(d.distance, d.centroid_id) for d in near.nearest_centroids_distance] == [(1.0, 2), (1.0, 3), (5.0, 1)]
    assert near.centroid_id == 2


def test_cost_falls_with_more_clusters(points):
    costs = []
    for k in (2, 3, 4):
        model = segments.fit_segments(points, FEATURES, clusters=k)
        near = F.col("nearest_centroids_distance")[0]["distance"]
        costs.append(segments.score_segments(model, points).agg(F.sum(near * near)).first()[0])
    assert costs[0] > costs[1] > costs[2]


def test_model_survives_json_and_reordering(points):
    model = segments.fit_segments(points, FEATURES)
    assert segments.SegmentModel.from_json(model.to_json()) == model
    ordered = model.ordered_by("a")
    assert [c[0] for c in ordered.centers] == sorted((c[0] for c in model.centers), reverse=True)


def test_constant_column_standardises_to_zero(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0), (None, 5.0)], "x double, c double")
    found = segments.standardise(df, ["x", "c"]).collect()
    assert [row.c for row in found] == [0.0] * 3
    assert math.isclose(found[0].x, -1 / math.sqrt(2)) and found[2].x is None


def test_impute_mean(spark):
    df = spark.createDataFrame([(1.0,), (None,), (3.0,)], "x double")
    assert [row.x for row in segments.impute_mean(df, ["x"]).collect()] == [1.0, 2.0, 3.0]


def test_failing_cast_stops_the_fit(spark):
    df = spark.createDataFrame([("u", "many")], "user_id string, a string")
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        segments.feature_frame(df, ["a"]).collect()


def test_classic_scored_columns(spark):
    features = Models(spark, SMALL).user_features()
    model = segments.fit_segments(features, segments.CLASSIC_FEATURES)
    scored = segments.user_segments_classic(model, features, F.lit("2024-02-01").cast("timestamp"))
    assert scored.count() == features.count()
    assert scored.columns[6:8] == ["segment_id", "segment_name"] and len(scored.columns) == 20


def test_distances_are_exact_beyond_64_bits():
    points = np.array([[4 * 10**9, -4 * 10**9], [3, 4], [0, 0]])
    centers = [(-4 * 10**9, 4 * 10**9), (0, 0)]
    assert exact_kmeans.squares(points, centers).tolist() == [[128 * 10**18, 32 * 10**18], [32 * 10**18 - 8 * 10**9 + 25, 25], [32 * 10**18, 0]]
    assert exact_kmeans.squares(points[1:], [(0, 0)]).dtype == np.int64


def test_seeds_and_rounds_are_those_of_plain_loops(spark):
    """Ties and repeated rows included."""
    rnd = random.Random(8)
    rows = [(rnd.randrange(50), f"u{i}", rnd.randrange(-3, 4) * 10_000, rnd.randrange(-3, 4) * 10_000) for i in range(300)]
    df = spark.createDataFrame(rows, "h bigint, key string, z0 bigint, z1 bigint").repartition(5)

    def apart(row, center):
        return sum((value - middle) ** 2 for value, middle in zip(row[2:], center, strict=True))

    chosen = [min(rows)[2:]]
    while len(chosen) < 4:
        race = [(row[0] // min(apart(row, seed) for seed in chosen), *row) for row in rows if row[2:] not in chosen]
        chosen.append(min(race)[3:])
    assert exact_kmeans.seeds(df, 4, 2) == chosen
    centers = chosen
    for _ in range(3):
        near = [min(range(4), key=lambda k, row=row: apart(row, centers[k])) for row in rows]
        own = [[row[2:] for row, at in zip(rows, near, strict=True) if at == k] for k in range(4)]
        centers = [tuple(exact_kmeans._cut(sum(column), len(group)) for column in zip(*group)) if group else centers[k] for k, group in enumerate(own)]
    assert exact_kmeans.lloyd(df, chosen, 3) == centers
    # Fewer distinct rows than seeds.
    assert exact_kmeans.seeds(df.where("z0 = 0 and z1 = 0"), 3, 2) == [(0, 0)] * 3


@pytest.mark.parametrize("key", ["k2_fit_classic", "k8_scored_users", "k8_scored_shape"])
def test_fit_and_scoring_read_one_table_of_features(spark, key):
    plan = all_queries()[key](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
