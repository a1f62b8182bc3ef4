"""CSV scans: by header name for governed ingestion, by position for plain typed loads."""

from __future__ import annotations

import csv
import io
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from relata.operators.validation import FILE, NUMBER, OFFSET, RAW_ROW
from relata.sources.contracts import Contract
from relata.sources.csv_blocks import BlockFiles, Dialect
from relata.sources.files import matching_files


def file_glob(prefix: str, contract: Contract) -> str:
    return prefix.rstrip("/") + "/" + contract.file_pattern


def header_names(text: str, contract: Contract) -> tuple[str, ...]:
    """The column names in a file's first record; none where its first line is empty."""
    record = io.StringIO(text, newline="")
    return tuple(next(csv.reader(record, delimiter=contract.delimiter, quotechar=contract.quote), []))


def _without_header(records: DataFrame, contract: Contract) -> DataFrame:
    """The records of files that begin with an empty line: no contract column has a value, the raw row keeps the text."""
    absent = F.lit(None).cast("string")
    return records.select(
        *[absent.alias(name) for name in contract.names],
        F.create_map(F.lit(""), F.col("text")).alias(RAW_ROW),
        FILE,
        F.col("number").alias(NUMBER),
        F.col("offset").alias(OFFSET),
    )


def _one_header(records: DataFrame, header: tuple[str, ...], contract: Contract) -> DataFrame:
    fields = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
    options = {"sep": contract.delimiter, "quote": contract.quote, "escape": contract.quote, "mode": "PERMISSIVE"}
    parsed = records.withColumn("fields", F.from_csv("text", fields.simpleString(), options))
    # A repeated header name keeps its last column, as a dict of the row would.
    last = {name: F.col(f"fields.c{i}") for i, name in enumerate(header)}
    raw_row = F.create_map(*[part for name in sorted(last) for part in (F.lit(name), F.coalesce(last[name], F.lit("")))])
    absent = F.lit(None).cast("string")
    return parsed.select(
        *[last.get(name, absent).alias(name) for name in contract.names],
        raw_row.alias(RAW_ROW),
        FILE,
        F.col("number").alias(NUMBER),
        F.col("offset").alias(OFFSET),
    )


def read_crm_csv(spark: SparkSession, prefix: str, contract: Contract, multi_line: bool = True) -> DataFrame:
    """All files of a contract below ``prefix``, columns taken by header name.

    Columns the header lacks are NULL, further ones are ignored but kept in the raw row. A file whose first line is empty
    has no header: its rows lack every column and are rejected as such, not lost. Each row has its file, its record number
    (the header is 1) and its byte offset. Quoted values may hold newlines, and large files are still cut among tasks
    (``csv_blocks``); without ``multi_line`` every line is a record. Files are surveyed when this is called, once, and once
    more where headers differ.
    """
    paths = matching_files(spark, file_glob(prefix, contract))
    groups: dict[tuple[str, ...], list[str]] = defaultdict(list)
    dialect = Dialect(contract.delimiter, contract.quote if multi_line else None)
    if paths:
        files = BlockFiles(spark, paths, dialect)
        for path, text in files.headers().items():
            groups[header_names(text, contract)].append(path)
    result = None
    for header in sorted(groups):
        members = sorted(groups[header])
        # Files of one header are read apart from others, if there are any.
        records = (files if members == paths else BlockFiles(spark, members, dialect)).records().where("number > 1")
        part = _one_header(records, header, contract) if any(header) else _without_header(records, contract)
        result = part if result is None else result.unionByName(part)
    if result is None:
        raw_map = T.MapType(T.StringType(), T.StringType())
        schema = T.StructType([T.StructField(n, T.StringType()) for n in contract.names])
        schema.add(RAW_ROW, raw_map).add(FILE, T.StringType()).add(NUMBER, T.LongType()).add(OFFSET, T.LongType())
        return spark.createDataFrame([], schema)
    return result


def load_typed_csv(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",", quoted: bool = True
) -> DataFrame:
    """Typed load by position, one header line per file; any bad row fails the load."""
    return (
        spark.read.schema(schema)
        .options(
            header=True,
            sep=delimiter,
            quote='"' if quoted else "",
            escape='"' if quoted else "\\",
            mode="FAILFAST",
            enforceSchema=True,
            dateFormat="yyyy-MM-dd",
        )
        .csv(path)
    )


def scan_positional_csv(spark: SparkSession, path: str, schema: T.StructType, delimiter: str = ",") -> DataFrame:
    """Scan by position with quoting switched off: quote characters are ordinary data."""
    return load_typed_csv(spark, path, schema, delimiter, quoted=False)
