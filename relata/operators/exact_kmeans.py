"""K-means whose result depends on the rows alone, not on their order or partitions.

Everything that is summed is a whole number, so sums do not depend on their order. Features are fixed-point numbers of six
decimals; their means and deviations are whole numbers of that unit, and scaled values are whole ten-thousandths of a deviation.
A missing value takes the mean. Quotients are cut towards zero.

Seeds: the row whose id has the least hash, and then, one after the other, the row that wins a race in which each one's hash
is divided by its squared distance from the nearest seed. Lloyd's rounds follow: every row goes to its nearest center, the
lower number at equal distances, and each center moves to the mean of its rows, until none moves. A center without rows
stays. Each seed and each round is one pass over the scaled rows, from which the driver gets one row per center. Distances
are computed on Arrow batches.

Equal rows are interchangeable; with fewer distinct rows than clusters the last seeds repeat the first. A value beyond
nine million millions, or one that is no number, stops the fit; so does a table without rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from relata.sinks.scratch import stored

VALUE_UNIT = 1_000_000
SCALED_UNIT = 10_000
#: Hexadecimal digits of a row's hash.
HASH_DIGITS = 15


@dataclass(frozen=True)
class WholeFit:
    """Means and deviations in millionths, centers in ten-thousandths of a deviation."""

    means: tuple[int, ...]
    deviations: tuple[int, ...]
    centers: tuple[tuple[int, ...], ...]


def _cut(above: int, below: int) -> int:
    """A quotient cut towards zero."""
    return abs(above) // below * (1 if above >= 0 else -1)


def _div(above: Column, below: Column | int) -> Column:
    """The same of columns of whole numbers."""
    return F.call_function("div", above, below if isinstance(below, Column) else F.lit(below).cast("bigint"))


def _scaled(away: Column, deviation: int) -> Column:
    """A constant feature is 0 everywhere."""
    return _div(away * F.lit(SCALED_UNIT).cast("bigint"), deviation) if deviation else F.lit(0).cast("bigint")


def _points(wide: int) -> list[str]:
    return [f"z{i}" for i in range(wide)]


def scaled_rows(df: DataFrame, key: str, features: Sequence[str], seed: int) -> tuple[DataFrame, list[int], list[int]]:
    """Rows with a key as hash ``h``, ``key`` and scaled values ``z0``, ``z1`` and so on, stored; with means and deviations."""
    wide = range(len(features))
    numbers = [F.floor(F.col(name).cast("double") * VALUE_UNIT + 0.5).cast("bigint").alias(f"x{i}") for i, name in enumerate(features)]
    digits = F.substring(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")).cast("binary")), 1, HASH_DIGITS)
    rows = df.where(F.col(key).isNotNull()).select(F.conv(digits, 16, 10).cast("bigint").alias("h"), F.col(key).alias("key"), *numbers)
    rows = stored(rows, "fixed-point")
    sums = rows.agg(*[part for i in wide for part in (F.sum(F.col(f"x{i}").cast("decimal(20,0)")).alias(f"s{i}"), F.count(f"x{i}").alias(f"n{i}"))]).first()
    means = [_cut(int(sums[f"s{i}"] or 0), max(1, sums[f"n{i}"])) for i in wide]
    away = [F.coalesce(F.col(f"x{i}") - F.lit(means[i]).cast("bigint"), F.lit(0).cast("bigint")) for i in wide]
    squares = [F.sum(a.cast("decimal(19,0)") * a.cast("decimal(19,0)")).alias(f"v{i}") for i, a in enumerate(away)]
    found = rows.agg(F.count(F.lit(1)).alias("n"), *squares).first()
    if not found["n"]:
        raise ValueError("no rows to fit")
    deviations = [int(math.sqrt(float(int(found[f"v{i}"]) // max(1, found["n"] - 1)))) for i in wide]
    scaled = [_scaled(a, deviation).alias(f"z{i}") for i, (a, deviation) in enumerate(zip(away, deviations, strict=True))]
    return stored(rows.select("h", "key", *scaled), "scaled"), means, deviations


def _matrix(batch: pa.RecordBatch, wide: int) -> np.ndarray:
    return np.stack([batch.column(name).to_numpy() for name in _points(wide)], axis=1)


def squares(points: np.ndarray, centers: Sequence[Sequence[int]]) -> np.ndarray:
    """The squared distance of each row of ``points`` from each center, exact: where 64 bits could overflow, as Python's whole numbers."""
    most = max(int(points.max()), -int(points.min()), *[abs(value) for center in centers for value in center])
    kind = np.int64 if 4 * most * most * points.shape[1] < 1 << 63 else object
    points = points.astype(kind)
    return np.stack([((points - np.array(center, kind)) ** 2).sum(axis=1) for center in centers], axis=1)


def _racers(batches: Iterator[pa.RecordBatch], chosen: Sequence[Sequence[int]]) -> Iterator[pa.RecordBatch]:
    """The winners of each batch, equal ones included; a row at a seed takes no part."""
    for batch in batches:
        if not batch.num_rows:
            continue
        apart = squares(_matrix(batch, len(chosen[0])), chosen).min(axis=1)
        runs = np.flatnonzero(apart > 0)
        race = batch.column("h").to_numpy()[runs] // apart[runs]
        if len(race):
            first = race == race.min()
            won = batch.take(pa.array(runs[first]))
            yield pa.RecordBatch.from_arrays([pa.array(race[first], pa.int64()), *won.columns], names=["race", *won.schema.names])


def seeds(rows: DataFrame, clusters: int, wide: int) -> list[tuple[int, ...]]:
    points = _points(wide)
    chosen = [tuple(rows.orderBy("h", "key", *points).select(points).first())]
    kinds = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in rows.schema)
    while len(chosen) < clusters:
        race = rows.mapInArrow(lambda batches, chosen=tuple(chosen): _racers(batches, chosen), f"race bigint, {kinds}")
        won = race.orderBy("race", "h", "key", *points).select(points).first()
        chosen.append(tuple(won) if won else chosen[0])
    return chosen


def _gathered(batches: Iterator[pa.RecordBatch], centers: Sequence[Sequence[int]]) -> Iterator[pa.RecordBatch]:
    """The number and the sums of a task's rows that are nearest to each center, the lower one at equal distances."""
    wide = len(centers[0])
    counts, sums = [0] * len(centers), np.zeros((len(centers), wide), object)
    for batch in batches:
        if not batch.num_rows:
            continue
        points = _matrix(batch, wide)
        nearest = squares(points, centers).argmin(axis=1)
        for k in range(len(centers)):
            own = points[nearest == k]
            counts[k] += len(own)
            # Halves of 32 bits, as their sums over a batch cannot overflow.
            sums[k] += (own >> 32).sum(axis=0).astype(object) * (1 << 32) + (own & 0xFFFFFFFF).sum(axis=0).astype(object)
    columns = [pa.array(range(len(centers)), pa.int32()), pa.array(counts, pa.int64()), *[pa.array(list(sums[:, i]), pa.int64()) for i in range(wide)]]
    yield pa.RecordBatch.from_arrays(columns, names=["id", "n", *_points(wide)])


def lloyd(rows: DataFrame, centers: list[tuple[int, ...]], rounds: int) -> list[tuple[int, ...]]:
    """Centers after at most ``rounds`` rounds, or when none moves."""
    points = _points(len(centers[0]))
    kinds = "id int, n bigint, " + ", ".join(f"{name} bigint" for name in points)
    for _ in range(rounds):
        near = rows.select(points).mapInArrow(lambda batches, centers=tuple(centers): _gathered(batches, centers), kinds)
        sums = near.groupBy("id").agg(F.sum("n").alias("n"), *[F.sum(name).alias(name) for name in points])
        moved = list(centers)
        for row in sums.where("n > 0").collect():
            moved[row.id] = tuple(_cut(row[name], row.n) for name in points)
        if moved == centers:
            break
        centers = moved
    return centers


def fit(df: DataFrame, features: Sequence[str], clusters: int, rounds: int, seed: int, key: str = "user_id") -> WholeFit:
    """The fit of the features of ``df``, one row per ``key``; rows without a key are left out."""
    rows, means, deviations = scaled_rows(df, key, features, seed)
    return WholeFit(tuple(means), tuple(deviations), tuple(lloyd(rows, seeds(rows, clusters, len(features)), rounds)))
