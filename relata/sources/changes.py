"""The change feed: the source's columns with an operation and a sequence number."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, types as T

from relata.operators.cdc import OP, SEQ


def change_schema(table: T.StructType) -> T.StructType:
    return T.StructType([*table.fields, T.StructField(OP, T.StringType()), T.StructField(SEQ, T.LongType())])


def read_changes(spark: SparkSession, path: str, table: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """The feed as a stream of Parquet files: backfill aside, every change of one table."""
    reader = spark.readStream.schema(change_schema(table))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)
