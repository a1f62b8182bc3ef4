"""Layered Parquet tables without a table format.

Two kinds of table live below ``root/<layer>/<name>``:

* *versioned* (``v=<n>`` folders): replaced as a whole. A new version is written beside the old one
  and is current once its job's success marker exists, so readers never see a half-written table
  and a table may be computed from itself.
* *sliced* (``<column>=<value>`` folders): appended to, or replaced slice by slice. Every write has folders of its own
  below its slices, and a numbered manifest (``commits``) says which of them are current.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from contextlib import suppress
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from relata.functions.records import sorted_json
from relata.sinks.commits import WRITE, CommitLog
from relata.sources.files import child_names, exists, remove_path

DEFAULT_PARTITION = "__HIVE_DEFAULT_PARTITION__"

# Characters Spark escapes in partition folder names, besides control characters.
ESCAPED_CHARACTERS = "\"#%'*/:=?\\\x7f{[]^"

# Days each kind of data is kept.
RETENTION_DAYS = {"raw": 730, "staging": 730, "archive": 2555, "rejected": 2555, "manifest": 2555}


def escaped(value: str) -> str:
    """A partition value the way Spark spells it in a folder name."""
    return "".join(f"%{ord(c):02X}" if c in ESCAPED_CHARACTERS or ord(c) < 32 else c for c in value)


class SliceError(RuntimeError):
    """A slice could not be moved safely."""


def clustered(df: DataFrame, partition: Sequence[str], cluster: Sequence[str], files: int | None = None) -> DataFrame:
    """Rows ranged over (partition, cluster) and sorted, so each file covers a narrow key range.

    Ranging over the cluster columns too lets one day spread over many tasks; the row hash at the
    end splits a single hot key as well.
    """
    rest = [name for name in df.columns if name not in {*partition, *cluster}]
    hashable = [name for name in rest if not isinstance(df.schema[name].dataType, T.MapType)]
    salt = F.xxhash64(*hashable) if hashable else F.lit(0)
    keys = [*[F.col(name) for name in (*partition, *cluster)], salt]
    ranged = df.repartitionByRange(files, *keys) if files else df.repartitionByRange(*keys)
    return ranged.sortWithinPartitions(*partition, *cluster)


class Layers:
    """Tables of all layers below one root folder."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark = spark
        self.root = root.rstrip("/")

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    # -- versioned tables -------------------------------------------------------------------

    def versions(self, layer: str, name: str) -> list[int]:
        base = self.path(layer, name)
        numbers = [int(child[2:]) for child in child_names(self.spark, base) if child.startswith("v=")]
        return sorted(n for n in numbers if exists(self.spark, f"{base}/v={n}/_SUCCESS"))

    def replace(
        self,
        df: DataFrame,
        layer: str,
        name: str,
        partition: Sequence[str] = (),
        cluster: Sequence[str] = (),
        keep: int = 2,
    ) -> DataFrame:
        """Create or replace a table from a query; the newest ``keep`` versions stay readable."""
        done = self.versions(layer, name)
        target = f"{self.path(layer, name)}/v={(done[-1] if done else 0) + 1}"
        rows = clustered(df, partition, cluster) if cluster else df
        rows.write.mode("overwrite").partitionBy(*partition).parquet(target)
        for old in done[: max(0, len(done) + 1 - keep)]:
            remove_path(self.spark, f"{self.path(layer, name)}/v={old}")
        return self.spark.read.parquet(target)

    def current(self, layer: str, name: str) -> DataFrame:
        done = self.versions(layer, name)
        if not done:
            raise FileNotFoundError(f"no finished version of {layer}.{name}")
        return self.spark.read.parquet(f"{self.path(layer, name)}/v={done[-1]}")

    # -- sliced tables ----------------------------------------------------------------------

    def ensure(self, layer: str, name: str, schema: str | T.StructType) -> None:
        """Create an empty table with its declared schema when it is not there."""
        base = self.path(layer, name)
        if not exists(self.spark, base):
            self.spark.createDataFrame([], schema).write.parquet(f"{base}/_schema")

    def declared(self, layer: str, name: str) -> T.StructType | None:
        base = f"{self.path(layer, name)}/_schema"
        return self.spark.read.parquet(base).schema if exists(self.spark, base) else None

    def log(self, layer: str, name: str) -> CommitLog:
        return CommitLog(self.spark, self.path(layer, name))

    def read(self, layer: str, name: str, under: str | Sequence[str] = "") -> DataFrame:
        """All current slices, or those at or below some. A declared schema gives the column types; else they come from the files."""
        base, schema = self.path(layer, name), self.declared(layer, name)
        state = self.log(layer, name).state()
        folders = [f"{base}/{folder}" for part in ([under] if isinstance(under, str) else under) for folder in state.folders(part)]
        if not folders:
            if schema is None:
                raise FileNotFoundError(f"no slice of {layer}.{name}")
            return self.spark.createDataFrame([], schema)
        reader = self.spark.read.option("basePath", base)
        if schema is None:
            return reader.parquet(*folders).drop(WRITE)
        return reader.schema(schema).parquet(*folders).select(*schema.names)

    def _write(self, df: DataFrame, layer: str, name: str, partition: Sequence[str], cluster: Sequence[str]) -> dict[str, str]:
        """Write rows into fresh folders, which nobody reads before a commit; the folders by slice."""
        log = self.log(layer, name)
        write = log.new_write()
        rows = clustered(df, partition, [name for name in cluster if name not in partition]) if cluster else df
        rows.write.partitionBy(*partition).parquet(log.write_path(write))
        return log.written(write, len(partition))

    def append(
        self, df: DataFrame, layer: str, name: str, partition: Sequence[str] = ("run_date",), cluster: Sequence[str] = ()
    ) -> None:
        self.log(layer, name).add(self._write(df, layer, name, partition, cluster))

    def append_row(self, row: tuple, layer: str, name: str, schema: str) -> None:
        """Insert one audit row, creating the table if needed."""
        self.ensure(layer, name, schema)
        self.append(self.spark.createDataFrame([row], schema).coalesce(1), layer, name)

    @staticmethod
    def slice_name(values: Mapping[str, object]) -> str:
        """A slice's path below its table, spelled as Spark does."""
        return "/".join(f"{column}={DEFAULT_PARTITION if value is None else escaped(str(value))}" for column, value in values.items())

    def replace_slices(
        self, df: DataFrame, layer: str, name: str, slices: Sequence[Mapping[str, object]], cluster: Sequence[str] = ()
    ) -> None:
        """Put the rows of ``df`` that belong to the named slices in their place, all at once; a slice without rows is emptied.

        The rows are written once, into folders of their own, and become current by one commit. A reader finds all
        of the old slices or all of the new ones, also when the write stops anywhere. Of two writers the later commit stays.
        """
        columns = list(slices[0])
        wanted = F.lit(False)
        for values in slices:
            same = F.lit(True)
            for column, value in values.items():
                same = same & F.col(column).eqNullSafe(F.lit(value).cast(df.schema[column].dataType))
            wanted = wanted | same
        folders = self._write(df.where(wanted), layer, name, columns, cluster)
        self.log(layer, name).swap([self.slice_name(values) for values in slices], folders)

    def replace_slice(
        self, df: DataFrame, layer: str, name: str, values: Mapping[str, object], cluster: Sequence[str] = ()
    ) -> None:
        """Replace one slice, also by none of the rows."""
        self.replace_slices(df, layer, name, [values], cluster)

    def replace_checks(self, df: DataFrame, layer: str, name: str, run_date: object, checks: Sequence[str]) -> None:
        """Replace the rows of named checks of one run date; other checks of that day stay."""
        self.replace_slices(df, layer, name, [{"run_date": run_date, "check_name": check} for check in checks])

    def load_run(
        self, df: DataFrame, layer: str, name: str, run_date: object, source_type: str, cluster: Sequence[str] = ()
    ) -> None:
        """Append that a rerun may repeat: the run's own slice is cleared first."""
        self.replace_slice(df, layer, name, {"run_date": run_date, "source_type": source_type}, cluster)

    def slices(self, layer: str, name: str, column: str = "run_date") -> list[str]:
        """The values of the first slice column."""
        prefix = f"{column}="
        found = {held.split("/")[0] for held in self.log(layer, name).state().current}
        return sorted(part[len(prefix) :] for part in found if part.startswith(prefix))

    def expire(self, layer: str, name: str, as_of: date, days: int) -> list[str]:
        """Drop the ``run_date`` slices that ``expired_slices`` names, and their files."""
        limit, old = as_of - timedelta(days=days), []
        for name_of_slice in self.slices(layer, name):
            with suppress(ValueError):  # a slice without a date stays
                if date.fromisoformat(name_of_slice) < limit:
                    old.append(name_of_slice)
        if old:
            self.log(layer, name).drop([self.slice_name({"run_date": run_date}) for run_date in old])
        return old

    def archive_slice(self, names: Sequence[str], run_date: object, source: str = "raw", target: str = "archive") -> None:
        """Copy a run date's slice of every table to the archive layer, then drop the originals.

        Nothing is copied unless each table has its slice or, from an interrupted run, its archived copy. Originals go
        only after all copies were read back with the same number of rows, so a rerun can finish what was begun.
        """
        under = self.slice_name({"run_date": run_date})
        held = {layer: {name: bool(self.log(layer, name).state().folders(under)) for name in names} for layer in (source, target)}
        present = [name for name in names if held[source][name]]
        missing = [name for name in names if not held[source][name] and not held[target][name]]
        if missing or not present:
            raise SliceError(f"cannot archive {run_date}: missing {', '.join(missing or names)}")
        for name in present:
            self.replace_slice(self.read(source, name, under), target, name, {"run_date": run_date})
            counts = [self.read(layer, name, under).count() for layer in (source, target)]
            if counts[0] != counts[1]:
                raise SliceError(f"archive of {name} {run_date} has {counts[1]} of {counts[0]} rows")
        for name in present:
            self.log(source, name).drop([under])


def truncate_load(df: DataFrame, path: str) -> None:
    """Replace the contents of a path, creating it if needed. ``df`` must not read from ``path``."""
    df.write.mode("overwrite").parquet(path)


def expired_slices(slices: DataFrame, as_of: date, days: int) -> DataFrame:
    """Distinct run dates older than ``days`` before ``as_of``."""
    return slices.where(F.col("run_date") < F.date_sub(F.lit(as_of).cast("date"), days)).select("run_date").distinct()


def rejected_lines(df: DataFrame) -> DataFrame:
    """Rejected rows as JSON text, keys sorted, NULLs written, non-ASCII kept."""
    return df.select(sorted_json(df).alias("value"))


def write_rejected(df: DataFrame, prefix: str) -> None:
    rejected_lines(df).write.mode("overwrite").text(prefix.rstrip("/") + "/part")
