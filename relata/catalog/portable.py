"""Query results in types both engines print alike."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T


def portable(df: DataFrame, rounded: Sequence[str] = (), digits: int = 6) -> DataFrame:
    """Days and instants as text, decimals as doubles, nested values as JSON, integers as bigint."""
    columns = []
    for field in df.schema.fields:
        column, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            column = column.cast("string")
        elif isinstance(kind, T.DecimalType):
            column = column.cast("double")
        elif isinstance(kind, (T.IntegerType, T.ShortType, T.ByteType)):
            column = column.cast("bigint")
        elif isinstance(kind, (T.ArrayType, T.MapType, T.StructType)):
            column = F.to_json(column, {"ignoreNullFields": "false"})
        if field.name in rounded:
            column = F.round(column, digits)
        columns.append(column.alias(field.name))
    return df.select(*columns)
