"""CSV records of large files, read block by block in parallel though quoted values hold newlines.

Where a record begins depends on whether a quoted value is open at the start of a line, and so on everything before it in
the file. A first pass lets each task *survey* its blocks under both assumptions at once: for a block that begins outside or
inside of a quoted value, in which state it ends and how many records begin in it. The states compose over the
blocks of a file, so one running aggregate over blocks, never over lines, fixes every block's true state, the number of
its first record and its byte offset. A second pass then cuts each block into records on its own. Pieces of
records that lie across block borders are few; they alone are grouped and put together.

A quote opens a value only at the start of a field; inside of it a doubled quote is a quote, and after the closing one any
further characters up to the delimiter belong to the field. Lines end with a line feed, before which one carriage return
is dropped at the end of a record. The line reader takes away a byte-order mark at the start of a file; offsets do not
count it. Empty lines between records are no records. An unclosed quote runs to the end of its file.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from relata.session import scratch_path

FILE, BLOCK = "_file", "_block"

SURVEY = pa.schema(
    [(FILE, pa.string()), (BLOCK, pa.int64()), ("bytes", pa.int64())]
    + [(name, pa.int64()) for name in ("end_out", "end_in", "count_out", "count_in")]
    + [("header", pa.binary()), ("header_open", pa.bool_())]
)
RECORDS = pa.schema([(FILE, pa.string()), ("number", pa.int64()), ("offset", pa.int64()), ("text", pa.binary()), ("piece", pa.int64())])


@dataclass(frozen=True)
class Dialect:
    """Delimiter and quote, each one ASCII character. Without a quote every line is a record."""

    delimiter: str
    quote: str | None

    def __post_init__(self) -> None:
        for character in (self.delimiter, self.quote):
            if character is not None and (len(character) != 1 or ord(character) > 127):
                raise ValueError(f"{character!r} is not one ASCII character")

    @cached_property
    def opens(self) -> tuple[re.Pattern, re.Pattern]:
        """Lines that end inside of a quoted value, for lines that begin outside and inside of one."""
        d, q = re.escape(self.delimiter), re.escape(self.quote)
        inner, rest = f"(?:[^{q}]++|{q}{q})*+", f"[^{d}]*+"
        fields = f"(?:(?:{q}{inner}{q}{rest}|[^{q}{d}]{rest})?+{d})*+{q}{inner}\\Z"
        return re.compile(fields.encode(), re.S), re.compile(f"{inner}(?:\\Z|{q}{rest}{d}{fields})".encode(), re.S)

    def quoted(self, lines: pa.Array) -> np.ndarray:
        """Places of the lines that hold a quote; all others leave the state as it is."""
        if self.quote is None:
            return np.zeros(0, np.int64)
        return np.flatnonzero(pc.match_substring(lines, self.quote).to_numpy(zero_copy_only=False))

    def after(self, state: int, line: bytes) -> int:
        return int(self.opens[state].match(line[:-1] if line.endswith(b"\r") else line) is not None)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Slices of a batch by block, in the order of the lines."""
    files, blocks = batch.column(FILE), batch.column(BLOCK)
    low = 0
    while low < batch.num_rows:
        key = (files[low].as_py(), blocks[low].as_py())
        same = pc.and_(pc.equal(files.slice(low), key[0]), pc.equal(blocks.slice(low), key[1])).to_numpy(zero_copy_only=False)
        high = low + (int(np.argmin(same)) if not same.all() else len(same))
        yield key, batch.slice(low, high - low)
        low = high


def _filled(lines: pa.Array, first: bool) -> np.ndarray:
    """Which lines are a record if they begin one: all but empty ones, and always a file's first."""
    size = pc.binary_length(lines).to_numpy(zero_copy_only=False)
    found = (size > 1) | ((size == 1) & pc.not_equal(lines, b"\r").to_numpy(zero_copy_only=False))
    if first and len(found):
        found[0] = True
    return found


def surveyed(batches: Iterator[pa.RecordBatch], dialect: Dialect) -> Iterator[pa.RecordBatch]:
    """One row for each block: its bytes, and its end and number of records for both states it may begin in."""
    key, size, states, counts, header, header_open = None, 0, [0, 1], [0, 0], [], False

    def row() -> pa.RecordBatch:
        text = b"\n".join(header) if key[1] == 0 else None
        values = (key[0], key[1], size, *states, *counts, text, header_open)
        return pa.RecordBatch.from_arrays([pa.array([v], field.type) for v, field in zip(values, SURVEY, strict=True)], schema=SURVEY)

    for batch in batches:
        for found, part in _runs(batch):
            fresh = found != key
            if fresh:
                if key is not None:
                    yield row()
                key, size, states, counts, header, header_open = found, 0, [0, 1], [0, 0], [], found[1] == 0
            lines = part.column("value")
            size += int(pc.sum(pc.binary_length(lines)).as_py()) + len(lines)
            first = fresh and key[1] == 0
            before = np.concatenate([[0], np.cumsum(_filled(lines, first))])
            marked = dialect.quoted(lines)
            texts = lines.take(pa.array(marked)).to_pylist()
            at = [0, 0]
            for place, text in zip(marked.tolist(), texts, strict=True):
                joined = states[0] == states[1]
                for start in (0, 1):
                    if states[start] == 0:
                        counts[start] += int(before[place + 1] - before[at[start]])
                    at[start] = place + 1
                ends = dialect.after(states[0], text)
                states = [ends, ends if joined else dialect.after(states[1], text)]
            for start in (0, 1):
                if states[start] == 0:
                    counts[start] += int(before[-1] - before[at[start]])
            place = 0
            while header_open and place < len(lines):
                line = lines[place].as_py()
                header.append(line)
                state = 1 if len(header) > 1 else 0
                header_open = dialect.quote is not None and bool(dialect.after(state, line))
                place += 1
    if key is not None:
        yield row()


def located(survey: DataFrame) -> DataFrame:
    """The true ``state`` of each block, the number of records that begin before it, and its ``offset`` in the file.

    A block either ends in one state whatever it begins with, or keeps the state, or turns it round. So a block's state
    is the end of the last block before it of the first kind, turned as often as blocks after that turn.
    """
    order = Window.partitionBy(FILE).orderBy(BLOCK)
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    fixed, turns = F.col("end_out") == F.col("end_in"), ((F.col("end_out") == 1) & (F.col("end_in") == 0)).cast("long")
    turned = survey.withColumn("turned", F.sum(turns).over(order))
    last = F.last(F.when(fixed, F.struct("end_out", "turned")), ignorenulls=True).over(earlier)
    # The first block of a file begins outside of any value, as if a fixed block came before.
    passed = F.coalesce(F.lag("turned").over(order), F.lit(0))
    state = F.pmod(F.coalesce(last["end_out"], F.lit(0)) + passed - F.coalesce(last["turned"], F.lit(0)), F.lit(2))
    true = turned.withColumn("state", state)
    count = F.when(F.col("state") == 1, F.col("count_in")).otherwise(F.col("count_out"))
    end = F.when(F.col("state") == 1, F.col("end_in")).otherwise(F.col("end_out"))
    return true.select(
        FILE,
        BLOCK,
        "state",
        end.alias("end"),
        F.coalesce(F.sum(count).over(earlier), F.lit(0)).alias("before"),
        F.coalesce(F.sum("bytes").over(earlier), F.lit(0)).alias("offset"),
        "header",
        "header_open",
    )


def cut(batches: Iterator[pa.RecordBatch], dialect: Dialect, whole: bool) -> Iterator[pa.RecordBatch]:
    """The records that lie within a block (``whole``), or the pieces of those that do not, numbered from 1 in their file.

    Batches have the lines of blocks in order, each with its block's state, records before and offset.
    """
    key, state, number, offset, held, began, here = None, 0, 0, 0, [], None, False

    def rows(numbers, offsets, texts, pieces) -> pa.RecordBatch:
        name = pa.DictionaryArray.from_arrays(pa.array(np.zeros(len(numbers), np.int32)), pa.array([key[0]])).cast(pa.string())
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.binary())
        return pa.RecordBatch.from_arrays([name, pa.array(numbers, pa.int64()), pa.array(offsets, pa.int64()), texts, pa.array(pieces, pa.int64())], schema=RECORDS)

    def open_piece() -> pa.RecordBatch | None:
        if whole or not held:
            return None
        return rows([began[0]], [began[1]], [b"\n".join(held)], [key[1]])

    for batch in batches:
        for found, part in _runs(batch):
            fresh = found != key
            if fresh:
                if key is not None and (rest := open_piece()):
                    yield rest
                if part.column("state")[0].as_py() is None:
                    raise RuntimeError(f"block {found} was not surveyed: the files or their split changed since")
                key, state, number, offset = found, *(part.column(name)[0].as_py() for name in ("state", "before", "offset"))
                # A record that begins in an earlier block goes on here.
                held, began, here = [], (number, offset), False
            lines = part.column("value")
            sizes = pc.binary_length(lines).to_numpy(zero_copy_only=False).astype(np.int64) + 1
            places = offset + np.cumsum(sizes) - sizes
            offset += int(sizes.sum())
            first = fresh and key[1] == 0
            marked = dialect.quoted(lines)
            ends = np.zeros(len(marked), np.int8)
            running = state
            for i, text in enumerate(lines.take(pa.array(marked)).to_pylist()):
                running = ends[i] = dialect.after(running, text)
            # The state before each line and after the last.
            spans = np.diff(np.concatenate([[-1], marked, [len(lines) - 1]]))
            before = np.repeat(np.concatenate([[state], ends]), spans)
            after = np.concatenate([before[1:], [running]])
            starts = (before == 0) & _filled(lines, first)
            numbers = number + np.cumsum(starts)
            alone = np.flatnonzero(starts & (after == 0))
            if whole and len(alone):
                texts = lines.take(pa.array(alone))
                texts = pc.if_else(pc.ends_with(texts, b"\r"), pc.binary_slice(texts, 0, -1), texts)
                yield rows(numbers[alone], places[alone], texts, np.full(len(alone), None))
            several = np.flatnonzero((before == 1) | (after == 1))
            closed = []
            for place, line in zip(several.tolist(), lines.take(pa.array(several)).to_pylist(), strict=True):
                if before[place] == 0:
                    held, began, here = [], (int(numbers[place]), int(places[place])), True
                held.append(line)
                if after[place] == 0:
                    text = b"\n".join(held)
                    closed.append((*began, text[:-1] if text.endswith(b"\r") else text, here))
                    held = []
            chosen = [row for row in closed if row[3] == whole]
            if chosen:
                yield rows([r[0] for r in chosen], [r[1] for r in chosen], [r[2] for r in chosen], [None if whole else key[1]] * len(chosen))
            state, number = int(running), int(numbers[-1]) if len(numbers) else number
    if key is not None and (rest := open_piece()):
        yield rest


def joined(pieces: DataFrame) -> DataFrame:
    """Whole records of their pieces."""
    parts = F.transform(F.sort_array(F.collect_list(F.struct("piece", "text"))), lambda part: part["text"].cast("string"))
    found = pieces.groupBy(FILE, "number").agg(F.min("offset").alias("offset"), parts.alias("parts"))
    text = F.regexp_replace(F.array_join("parts", "\n"), "\\r\\z", "")
    return found.select(FILE, "number", "offset", text.alias("text"))


class BlockFiles:
    """Some files, surveyed: where their blocks begin, and their headers.

    Spark divides files by the bytes of all that one scan reads, so the files are always read together.
    """

    def __init__(self, spark: SparkSession, paths: list[str], dialect: Dialect) -> None:
        self.spark, self.dialect, self.paths = spark, dialect, paths
        self._listed = {_place(spark, path): path for path in paths}
        path = scratch_path(spark, "csv-blocks")
        survey = self._lines().select("value", FILE, BLOCK).mapInArrow(lambda batches: surveyed(batches, dialect), _ddl(SURVEY))
        located(survey).write.parquet(path)
        #: One row for each block.
        self.blocks = spark.read.parquet(path)

    def _lines(self) -> DataFrame:
        """The lines of the files as bytes, in order within a block."""
        scan = self.spark.read.option("lineSep", "\n").text(self.paths)
        return scan.select(
            F.col("value").cast("binary").alias("value"),
            F.col("_metadata.file_path").alias(FILE),
            F.col("_metadata.file_block_start").alias(BLOCK),
        )

    def _cut(self, blocks: DataFrame, how: str, whole: bool) -> DataFrame:
        dialect = self.dialect
        states = blocks.select(FILE, BLOCK, "state", "before", "offset")
        # One row for each block joins each line, always by broadcast: it keeps the lines in the scan's order, and no task
        # holds a block's lines to sort them. The driver lists as many files anyway.
        lines = self._lines().join(F.broadcast(states), [FILE, BLOCK], how)
        return lines.mapInArrow(lambda batches: cut(batches, dialect, whole), _ddl(RECORDS))

    def records(self) -> DataFrame:
        """All records: file, ``number`` (the first is 1), byte ``offset``, and ``text`` without its line end."""
        found = self._cut(self.blocks, "left", True).select(FILE, "number", "offset", F.col("text").cast("string").alias("text"))
        # Blocks that begin or end inside of a value are cut once more for what crosses their borders.
        crossed = self.blocks.where("state = 1 or end = 1")
        return found if crossed.isEmpty() else found.union(joined(self._cut(crossed, "inner", False)))

    def headers(self) -> dict[str, str]:
        """The first record of each file that holds a line, by path."""
        rows = self.blocks.where(F.col(BLOCK) == 0).select(FILE, F.col("header").cast("string").alias("text"), "header_open").collect()
        if any(row.header_open for row in rows):
            # A header that is longer than a block.
            rows = self.records().where("number = 1").collect()
        return {self._listed[_place(self.spark, row[FILE], encoded=True)]: row.text.removesuffix("\r") for row in rows}


def _ddl(schema: pa.Schema) -> str:
    names = {pa.string(): "string", pa.int64(): "bigint", pa.binary(): "binary", pa.bool_(): "boolean"}
    return ", ".join(f"{field.name} {names[field.type]}" for field in schema)


def _place(spark: SparkSession, path: str, encoded: bool = False) -> str:
    """A path without scheme, whether it is written as listed or as an encoded address."""
    uri = spark._jvm.java.net.URI(path) if encoded else spark._jvm.org.apache.hadoop.fs.Path(path).toUri()
    return f"{uri.getAuthority() or ''}{uri.getPath()}"
