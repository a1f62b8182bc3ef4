"""Transfer manifests: JSON documents with a nested list of files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

MANIFEST_SCHEMA = (
    "run_date date, transfer_job_name string, transfer_operation_id string, status string, "
    "files array<struct<source_type: string, object_uri: string, size_bytes: bigint, generation: string>>"
)


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """One row per manifest document; a file may hold a document over many lines."""
    return spark.read.schema(MANIFEST_SCHEMA).json(path, multiLine=True, dateFormat="yyyy-MM-dd")


def manifest_files(manifests: DataFrame) -> DataFrame:
    """One row per announced file."""
    return manifests.selectExpr("run_date", "status", "inline(files)")
