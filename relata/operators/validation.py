"""Row rules of a contract: coercion, error texts, the accepted/rejected split, the run's audit row.

Raw text columns stay as read until the split. ``validated`` only adds the flag the split needs, so
typed values are built for accepted rows alone and error texts for rejected rows alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from relata.functions.casting import CONTRACT_CASTS
from relata.sources.contracts import Contract, ContractColumn

ACCEPTED = "_accepted"
FILE, NUMBER, OFFSET, RAW_ROW = "_file", "_number", "_offset", "_raw_row"


def _absent(name: str) -> Column:
    return F.col(name).isNull() | (F.col(name) == "")


def _uncastable(column: ContractColumn) -> Column:
    cast = CONTRACT_CASTS[column.type][1]
    return ~_absent(column.name) & cast(column.name).isNull()


def column_error(column: ContractColumn) -> Column:
    """The error text of one column, NULL when the column is fine."""
    checks = F.when(
        _uncastable(column),
        F.concat(F.lit(f"{column.name}: invalid {column.type}: "), F.col(column.name)),
    )
    if column.required:
        return F.when(_absent(column.name), F.lit(f"{column.name} is required")).otherwise(checks)
    return checks


def row_errors(contract: Contract) -> Column:
    """All errors of a row in contract order."""
    return F.array_compact(F.array(*[column_error(column) for column in contract.columns]))


def validated(df: DataFrame, contract: Contract) -> DataFrame:
    """Add the accepted flag; contract columns the scan lacks count as absent."""
    present = set(df.columns)
    for column in contract.columns:
        if column.name not in present:
            df = df.withColumn(column.name, F.lit(None).cast("string"))
    broken = F.lit(False)
    for column in contract.columns:
        if column.required:
            broken = broken | _absent(column.name)
        if column.type != "STRING":
            broken = broken | _uncastable(column)
    return df.withColumn(ACCEPTED, ~broken)


def coerced(df: DataFrame, contract: Contract, keep: list[str] | None = None) -> DataFrame:
    """Typed contract columns; empty text becomes NULL."""
    typed = [
        F.when(~_absent(c.name), CONTRACT_CASTS[c.type][1](c.name)).alias(c.name) for c in contract.columns
    ]
    return df.select(*typed, *(keep or []))


def accepted_rows(checked: DataFrame, contract: Contract, run_date: str, loaded_at: Column | None = None) -> DataFrame:
    """Typed accepted rows with run date, source type, source file and load time."""
    rows = coerced(checked.where(ACCEPTED), contract, keep=[FILE])
    return enriched(rows, contract.source_type, run_date, loaded_at)


def enriched(rows: DataFrame, source_type: str, run_date: str, loaded_at: Column | None = None) -> DataFrame:
    """The four metadata columns; the scan's file column becomes ``source_file``."""
    return rows.select(
        *[name for name in rows.columns if name != FILE],
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(source_type).alias("source_type"),
        F.col(FILE).alias("source_file"),
        (F.current_timestamp() if loaded_at is None else loaded_at).alias("ingestion_ts"),
    )


def rejected_rows(
    checked: DataFrame,
    contract: Contract,
    run_date: str,
    rejected_at: Column | None = None,
    with_row_number: bool = True,
) -> DataFrame:
    """Evidence of the rejected rows: where each came from, the raw row, and all its errors.

    The number counts the records of the file and its header, as the scan numbers them: the first data row is 2.
    """
    number = F.col(NUMBER) if with_row_number else F.lit(None)
    return checked.where(~F.col(ACCEPTED)).select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(contract.source_type).alias("source_type"),
        F.col(FILE).alias("source_file"),
        number.cast("bigint").alias("row_number"),
        F.col(RAW_ROW).alias("raw_row"),
        row_errors(contract).alias("error_reasons"),
        (F.current_timestamp() if rejected_at is None else rejected_at).alias("rejected_ts"),
    )


def ingestion_counts(checked: DataFrame) -> DataFrame:
    """Input, accepted and rejected counts in one aggregate; zeros for an empty input."""
    return checked.agg(
        F.count(F.lit(1)).alias("input_count"),
        F.count_if(F.col(ACCEPTED)).alias("valid_count"),
        F.count_if(~F.col(ACCEPTED)).alias("rejected_count"),
    )


def ingestion_audit(
    checked: DataFrame,
    contract: Contract,
    run_date: str,
    input_prefix: str,
    schema_config_path: str,
    output_table: str,
    rejected_output_prefix: str,
    audited_at: Column | None = None,
) -> DataFrame:
    """The one audit row of an ingestion run."""
    return ingestion_counts(checked).select(
        F.lit(run_date).cast("date").alias("run_date"),
        F.lit(contract.source_type).alias("source_type"),
        F.lit(input_prefix).alias("input_prefix"),
        F.lit(schema_config_path).alias("schema_config_path"),
        F.lit(output_table).alias("output_table"),
        F.lit(rejected_output_prefix).alias("rejected_output_prefix"),
        "input_count",
        "valid_count",
        "rejected_count",
        (F.current_timestamp() if audited_at is None else audited_at).alias("audit_ts"),
    )


def reject_verdict(audit: DataFrame, contract: Contract) -> DataFrame:
    """One row per audit row: did the rejected rows stay within the contract's limit?"""
    limit = contract.max_bad_records
    return audit.select(
        "source_type",
        "rejected_count",
        F.lit(limit).cast("bigint").alias("max_bad_records"),
        (F.col("rejected_count") <= limit).alias("passed"),
    )


def numbering(scanned: DataFrame) -> DataFrame:
    """Whether the records of every file are numbered from 2 without gap or repetition, and how many there are.

    The distinct numbers are counted exactly as bits of words of 64, which shuffles and holds one row for a word.
    """
    number = F.col(NUMBER)
    words = scanned.groupBy(FILE, F.shiftright(number, 6).alias("word")).agg(
        F.min(number).alias("low"),
        F.max(number).alias("high"),
        F.count(F.lit(1)).alias("records"),
        F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(number, F.lit(64)).cast("int"))).alias("bits"),
    )
    files = words.groupBy(FILE).agg(
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("records").alias("records"), F.sum(F.bit_count("bits")).alias("numbers")
    )
    good = (F.col("low") == 2) & (F.col("high") == F.col("records") + 1) & (F.col("numbers") == F.col("records"))
    return files.agg(F.bool_and(good).alias("numbered_without_gap"), F.sum("records").alias("records"))
