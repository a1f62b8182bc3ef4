"""A table kept current from a change feed by Structured Streaming.

The table lies in buckets by a hash of the key. Each bucket has a base and a log of changes, and one manifest
(``sinks.commits``) names the current folders of all:

    <path>/w=base-<id>/kind=base/bucket=<b>/...     a part of a finished snapshot or fold
    <path>/w=batch-<id>/kind=log/bucket=<b>/...     changes of one micro-batch, the last one of each key

A micro-batch only adds its changes to the logs of the buckets they fall into: its work grows with the feed, not with the
table. A bucket whose log has grown to ``fold_after`` batches is folded in the same micro-batch: only such buckets are read
and written anew, and one commit puts the new base in place of the old one and of the changes it holds. Readers merge
the buckets that have a log and take the others as they are, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from relata.operators.cdc import as_base, last_changes, live_rows, merge_changes
from relata.sinks.commits import WRITE, CommitLog, State
from relata.sinks.tables import Layers
from relata.sources.changes import read_changes
from relata.sources.files import exists, read_text, write_text

# Fixed value: the table may lag its source by this many seconds.
FRESHNESS_SECONDS = 900

KIND, BUCKET = "kind", "bucket"
BASE, LOG = f"{KIND}=base", f"{KIND}=log"
BATCH = f"{WRITE}=batch-"


def _bucket(name: str) -> int:
    return int(name.rpartition("=")[2])


@dataclass
class _Folders:
    """The current folders of a table by bucket."""

    base: dict[int, list[str]]
    log: dict[int, list[str]]

    @classmethod
    def of(cls, state: State) -> _Folders:
        parts = {kind: {_bucket(name): folders for name, folders in state.current.items() if name.startswith(f"{kind}/")} for kind in (BASE, LOG)}
        return cls(parts[BASE], parts[LOG])


class ChangeTable:
    """``buckets`` is fixed when the table is first written; choose it so that one bucket is a reasonable job."""

    def __init__(self, spark: SparkSession, path: str, key: Sequence[str], buckets: int = 64, fold_after: int | None = 8) -> None:
        self.spark, self.path, self.key, self.fold_after = spark, path.rstrip("/"), list(key), fold_after
        self.log = CommitLog(spark, self.path)
        self.layers = Layers(spark, self.path)
        held = f"{self.path}/_buckets"
        self.buckets = int(read_text(spark, held)) if exists(spark, held) else buckets

    def _bucketed(self, rows: DataFrame, kind: str) -> DataFrame:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        return rows.withColumns({KIND: F.lit(kind), BUCKET: bucket})

    def _write(self, rows: DataFrame, write: str) -> dict[str, str]:
        """Rows with kind and bucket into the folder of one write; what an interrupted one left there is replaced."""
        rows.repartition(BUCKET).write.mode("overwrite").partitionBy(KIND, BUCKET).parquet(self.log.write_path(write))
        return self.log.written(write, 2)

    def _schema(self) -> T.StructType:
        schema = self.layers.declared(".", "columns")
        if schema is None:
            raise FileNotFoundError(f"{self.path} has no base yet")
        return schema

    def _read(self, folders: dict[int, list[str]]) -> DataFrame:
        schema = T.StructType([*self._schema().fields, T.StructField(BUCKET, T.IntegerType())])
        paths = [f"{self.path}/{folder}" for held in folders.values() for folder in held]
        if not paths:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", self.path).parquet(*paths).select(*schema.names)

    def backfill(self, snapshot: DataFrame) -> None:
        """Write the full snapshot as the base; changes come after it."""
        rows = as_base(snapshot)
        write_text(self.spark, f"{self.path}/_buckets", str(self.buckets))
        self.layers.ensure(".", "columns", rows.schema)
        folders = self._write(self._bucketed(rows, "base"), f"base-{self.log.new_write()}")
        self.log.swap([BASE], folders)

    def log_batches(self) -> list[int]:
        """The micro-batches of which some bucket still has changes in its log."""
        folders = _Folders.of(self.log.state()).log.values()
        return sorted({int(folder.split("/")[0].removeprefix(BATCH)) for held in folders for folder in held})

    def add_batch(self, changes: DataFrame, batch_id: int) -> None:
        """Add a micro-batch to the logs of its buckets, then fold those that have grown long.

        A batch that runs again after a failure is not added twice; one that was folded meanwhile may be, which changes nothing.
        """
        write = f"batch-{batch_id}"
        if not any(folder.startswith(f"{WRITE}={write}/") for folder in self.log.state().named()):
            self.log.add(self._write(self._bucketed(last_changes(changes, self.key), "log"), write))
        if self.fold_after:
            self.compact(self.fold_after)

    def _merged(self, folders: _Folders) -> DataFrame:
        """Base and log of some buckets, merged bucket by bucket."""
        return merge_changes(self._read(folders.base), self._read(folders.log), [BUCKET, *self.key])

    def current(self) -> DataFrame:
        """The current rows: base and log merged where there is a log, deleted rows left out."""
        found = _Folders.of(self.log.state())
        still = {bucket: held for bucket, held in found.base.items() if bucket not in found.log}
        rows = self._read(still)
        if found.log:
            moved = {bucket: held for bucket, held in found.base.items() if bucket in found.log}
            rows = rows.unionByName(self._merged(_Folders(moved, found.log)))
        return live_rows(rows.drop(BUCKET))

    def compact(self, at_least: int = 1) -> int:
        """Fold the buckets whose log has ``at_least`` batches; returns how many batches were folded.

        Sequence numbers and marks of deleted rows are kept, so a change that comes late is merged without harm. Changes
        that are added meanwhile stay in the log.
        """
        found = _Folders.of(self.log.state())
        log = {bucket: held for bucket, held in found.log.items() if len(held) >= at_least}
        if not log:
            return 0
        taken = _Folders({bucket: found.base.get(bucket, []) for bucket in log}, log)
        rows = self._merged(taken).withColumn(KIND, F.lit("base"))
        folders = self._write(rows, f"base-{self.log.new_write()}")

        def change(state: State) -> None:
            now = _Folders.of(state)
            if any(now.base.get(bucket, []) != held for bucket, held in taken.base.items()):
                raise RuntimeError("another fold or backfill came between")
            for bucket, held in log.items():
                rest = [folder for folder in now.log.get(bucket, []) if folder not in held]
                state.current.pop(f"{LOG}/{BUCKET}={bucket}", None)
                if rest:
                    state.current[f"{LOG}/{BUCKET}={bucket}"] = rest
            for name, folder in folders.items():
                state.current[name] = [folder]

        self.log.commit(change)
        return len({folder.split("/")[0] for held in log.values() for folder in held})


def start_cdc(
    spark: SparkSession,
    source: str,
    target: ChangeTable,
    table: T.StructType,
    checkpoint: str,
    backfill: DataFrame | None = None,
    available_now: bool = False,
    files_per_batch: int | None = None,
) -> StreamingQuery:
    """Follow a change feed. Live, a batch starts every ``FRESHNESS_SECONDS``; with ``available_now``
    the query works off what is there and stops. ``backfill`` is written before the first change."""
    if backfill is not None:
        target.backfill(backfill)
    writer = (
        read_changes(spark, source, table, files_per_batch)
        .writeStream.foreachBatch(target.add_batch)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{FRESHNESS_SECONDS} seconds"}
    return writer.trigger(**trigger).start()
