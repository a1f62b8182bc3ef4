"""Moving columns between Spark and Python tasks in bounded pieces, and tables between jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from relata.session import scratch_path

#: Text bytes a task works on at a time; one longer text is a piece of its own.
PIECE_BYTES = 1 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` as a Parquet table in the shared folder: cuts the lineage, survives lost executors.

    A join of two stored tables is a join of two plain shuffles, which adaptive execution can split
    where one key holds many rows.
    """
    path = scratch_path(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def offsets_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string array without nulls, and where each text starts and ends in them."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    marks = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    held = texts.buffers()[2]
    data = np.frombuffer(held, np.uint8)[marks[0] : marks[-1]] if held is not None else np.zeros(0, np.uint8)
    return data, marks - marks[0]


def pieces(batch: pa.RecordBatch, text: int, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose texts have about ``most`` bytes; the null texts of column ``text`` become empty."""
    if not batch.num_rows:
        return
    filled = pc.fill_null(batch.column(text), "")
    batch = batch.set_column(text, batch.schema.field(text).with_nullable(True), filled)
    _, marks = offsets_of(filled)
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(marks, marks[low] + most, side="right")) - 1)
        yield batch.slice(low, high - low)
        low = high


def map_texts(
    df: DataFrame, columns: list[str], schema: str, work: Callable[[pa.RecordBatch], list], setup: Callable | None = None
) -> DataFrame:
    """Map pieces of ``columns`` (the last one holds texts) to columns of ``schema``, batch by batch.

    ``work`` gets a piece and returns the output columns as Arrow arrays or lists. With ``setup``, its result,
    made once per task, is passed as well.
    """
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    out = to_arrow_schema(StructType.fromDDL(schema))
    last = len(columns) - 1

    def run(batches):
        made = setup() if setup else None
        for batch in batches:
            for piece in pieces(batch, last):
                found = work(piece, made) if setup else work(piece)
                arrays = [
                    column.cast(field.type) if isinstance(column, pa.Array) else pa.array(column, field.type)
                    for column, field in zip(found, out, strict=True)
                ]
                yield pa.RecordBatch.from_arrays(arrays, schema=out)

    return df.select(*columns).mapInArrow(run, schema)
