"""Connected components of a stored edge table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from relata.llm.frames import stored


def _mark(edges: DataFrame) -> tuple:
    """Number and digest of an edge table, to see whether a round changed it."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def _star(arcs: DataFrame) -> DataFrame:
    """``arcs`` (a, b) with the least end that ``a`` reaches by one arc, itself included, as ``least``."""
    ends = arcs.groupBy("a").agg(F.min("b").alias("least"))
    # Stored, so that the arcs of a node with very many of them can be split over tasks in the join.
    ends = stored(ends.select("a", F.least("a", "least").alias("least")), "ends")
    return arcs.join(ends, "a")


def components(edges: DataFrame) -> DataFrame:
    """``node`` and the least node of its component as ``root``, for every node but the roots.

    ``edges`` has two numeric columns ``a`` and ``b``. Rounds of large and small stars: first the greater neighbours
    of a node move to its least neighbour, then the smaller ones do. It ends when a round changes nothing; that takes
    about the logarithm of the longest path. Hubs are combined before shuffles and split in joins; no table is collected.
    """
    edges = stored(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a != b").distinct(), "edges")
    before = _mark(edges)
    while before[0]:
        both = edges.union(edges.select("b", "a"))
        large = _star(both).where("b > a").select(F.col("b").alias("a"), F.col("least").alias("b")).where("a != b").distinct()
        large = stored(large, "edges")
        small = _star(large)
        small = small.select("b", "least").union(small.select("a", "least")).toDF("a", "b").where("a != b").distinct()
        edges = stored(small, "edges")
        after = _mark(edges)
        if after == before:
            break
        before = after
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
