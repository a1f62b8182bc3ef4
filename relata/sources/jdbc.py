"""Database snapshot of the user table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession

from relata.operators.staging import USER_COLUMNS

# Rows per round trip, and the table the snapshot is taken of.
FETCH_SIZE = 1000
USER_TABLE = "APP.USER_RAW"


def read_users_jdbc(
    spark: SparkSession,
    url: str,
    table: str = USER_TABLE,
    columns: Sequence[str] = USER_COLUMNS,
    ranges: Sequence[str] | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """The named columns of a table, in upper case.

    One split by default. ``ranges`` are WHERE conditions that together cover the table (for
    example ranges of the user id); each becomes a task with its own query, which is how a large
    table is read in parallel.
    """
    projection = ", ".join(columns)
    properties = {"fetchsize": str(FETCH_SIZE), **(options or {})}
    source = f"(SELECT {projection} FROM {table}) users"
    if ranges:
        scan = spark.read.jdbc(url, source, predicates=list(ranges), properties=properties)
    else:
        scan = spark.read.jdbc(url, source, properties=properties)
    return scan.toDF(*[name.upper() for name in scan.columns])
