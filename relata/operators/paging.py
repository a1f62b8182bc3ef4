"""Ordered pages, top rows, and a global row index that needs no single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from relata.session import shared_folder

#: Up to this many leading rows a page is a plain top-k, which each task prunes before the merge.
TOP_ROWS = 100_000

# The order in which an audience is paged; NULL sorts as the empty text.
AUDIENCE_ORDER = ("salesforce_contact_id", "lead_email", "user_id")


def blank_first(columns: Sequence[str]) -> list[Column]:
    return [F.coalesce(F.col(name), F.lit("")) for name in columns]


def global_index(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``_index`` from 0 in the given order.

    Rows are range-partitioned and sorted where they are; only the row count of each partition goes
    through a window. The sorted rows are checkpointed, so the counts and the rows they number come
    from one and the same evaluation even when executors are lost in between.
    """
    shared_folder(df.sparkSession)
    keys = [column.alias(f"_k{i}") for i, column in enumerate(order)]
    names = [f"_k{i}" for i in range(len(keys))]
    placed = (
        df.select("*", *keys)
        .repartitionByRange(*names)
        .sortWithinPartitions(*names)
        .drop(*names)
        .withColumn("_id", F.monotonically_increasing_id())
        .checkpoint()
    )
    part, local = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    # One row per shuffle partition, a number the session's settings bound.
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .withColumn("_index", F.col("_start") + local)
        .drop("_part", "_id", "_start")
    )


def page(df: DataFrame, order: Sequence[str], limit: int = 0, offset: int = 0) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of the total order; 0 means no limit, no offset.

    Equal order keys are settled by all other columns, so pages neither overlap nor leave gaps.
    """
    ties = [F.col(name) for name in df.columns if name not in order]
    total = [*blank_first(order), *ties]
    if limit <= 0 and offset <= 0:
        return df.orderBy(*total)
    if 0 < limit and limit + offset <= TOP_ROWS:
        return df.orderBy(*total).offset(offset).limit(limit)
    wanted = F.col("_index") >= offset
    if limit > 0:
        wanted = wanted & (F.col("_index") < offset + limit)
    return global_index(df, total).where(wanted).drop("_index")


def latest_runs(audit: DataFrame, n: int, order: str = "started_at") -> DataFrame:
    """The newest ``n`` audit rows."""
    rest = [F.col(name).asc_nulls_last() for name in audit.columns if name != order]
    return audit.orderBy(F.col(order).desc_nulls_last(), *rest).limit(n)
