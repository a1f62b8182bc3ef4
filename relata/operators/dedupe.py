"""One row per key. Spark prunes each map partition to its winners before the shuffle
(``WindowGroupLimit``), so a hot key sends one row per partition, not all of its rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

_RANK = "_rank"


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    ranked = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, ranked).where(F.col(_RANK) == 1).drop(_RANK)


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row per key: ``order`` descending, NULLs last, ties settled by the other columns."""
    rest = [name for name in df.columns if name not in {*keys, *order}]
    ordering = [F.col(name).desc_nulls_last() for name in order]
    return first_per_key(df, keys, ordering + [F.col(name).asc_nulls_last() for name in rest])


def dedupe_by(df: DataFrame, key: str) -> DataFrame:
    """One row per business key; of several, the first by all other columns, NULLs last."""
    rest = [F.col(name).asc_nulls_last() for name in df.columns if name != key]
    return first_per_key(df, [key], rest)
