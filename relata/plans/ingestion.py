"""CSV ingestion of one source type: accepted rows, rejected rows, one audit row."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import Row, SparkSession

from relata.operators.quality import QualityGateError
from relata.operators.validation import accepted_rows, ingestion_audit, reject_verdict, rejected_rows, validated
from relata.sinks.tables import Layers, write_rejected
from relata.sources.contracts import CLUSTERING, Contract
from relata.sources.csv_files import read_crm_csv

INGESTION_RUN_SCHEMA = (
    "run_date date, source_type string, input_prefix string, schema_config_path string, output_table string, "
    "rejected_output_prefix string, input_count bigint, valid_count bigint, rejected_count bigint, audit_ts timestamp"
)


def ingest(
    spark: SparkSession,
    contract: Contract,
    prefix: str,
    run_date: str,
    layers: Layers,
    rejected_prefix: str,
    schema_config_path: str = "built-in",
    rerun_safe: bool = True,
    multi_line: bool = True,
    enforce_limit: bool = False,
) -> Row:
    """Scan and check once; write accepted and rejected rows and the audit row; return the audit.

    The checked rows are persisted on disk because three outputs read them. A lost block is read
    again from the same file splits, so counts and record numbers stay consistent.
    """
    name = contract.source_type
    checked = validated(read_crm_csv(spark, prefix, contract, multi_line), contract).persist(StorageLevel.DISK_ONLY)
    try:
        accepted = accepted_rows(checked, contract, run_date)
        cluster = CLUSTERING.get(name, ())
        if rerun_safe:
            layers.load_run(accepted, "raw", name, run_date, name, cluster)
        else:
            layers.append(accepted, "raw", name, ("run_date", "source_type"), cluster)
        if contract.write_bad_rows:
            write_rejected(rejected_rows(checked, contract, run_date), rejected_prefix)
        audit = ingestion_audit(
            checked, contract, run_date, prefix, schema_config_path, f"raw.{name}", rejected_prefix
        )
        row = audit.first()
        layers.append_row(tuple(row), "audit", "ingestion_runs", INGESTION_RUN_SCHEMA)
        if enforce_limit:
            verdict = reject_verdict(spark.createDataFrame([row], INGESTION_RUN_SCHEMA), contract).first()
            if not verdict.passed:
                raise QualityGateError(
                    f"{name}: {verdict.rejected_count} rejected rows, at most {verdict.max_bad_records} allowed"
                )
        return row
    finally:
        checked.unpersist()
