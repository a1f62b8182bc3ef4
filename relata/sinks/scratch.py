"""Intermediate tables in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from relata.session import scratch_path


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written once and read back: later plans see its true size, and a join with it is one of plain shuffles."""
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
