"""Schema contracts of the file sources and their driver-side loader."""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import SparkSession, types as T

from relata.functions.casting import CONTRACT_CASTS

# The four file contracts as (column, type, required), in file order.
CRM_SALES = (
    ("customer_id", "STRING", True),
    ("user_id", "STRING", True),
    ("deal_id", "STRING", True),
    ("deal_stage", "STRING", False),
    ("deal_amount", "FLOAT", False),
    ("currency", "STRING", False),
    ("closed_date", "DATE", False),
    ("owner_region", "STRING", False),
)
CRM_SUPPORT = (
    ("ticket_id", "STRING", True),
    ("user_id", "STRING", True),
    ("priority", "STRING", False),
    ("status", "STRING", False),
    ("category", "STRING", False),
    ("csat_score", "FLOAT", False),
)
CRM_CAMPAIGN_EVENTS = (
    ("event_id", "STRING", True),
    ("user_id", "STRING", True),
    ("campaign_id", "STRING", True),
    ("channel", "STRING", False),
    ("event_type", "STRING", False),
    ("event_ts", "TIMESTAMP", False),
)
CRM_NEW_PARTNER_LEADS = (
    ("external_lead_id", "STRING", True),
    ("email", "STRING", True),
    ("partner_name", "STRING", False),
    ("lead_score", "INTEGER", False),
    ("utm_source", "STRING", False),
    ("created_at", "TIMESTAMP", False),
    ("opt_in", "BOOL", False),
)

# Clustering columns of each raw table, which all are split by run_date.
CLUSTERING = {
    "crm_sales": ("user_id", "deal_id"),
    "crm_support": ("user_id", "ticket_id"),
    "crm_campaign_events": ("user_id", "campaign_id"),
    "crm_new_partner_leads": ("external_lead_id", "email"),
}

#: Columns appended to every accepted row.
METADATA = T.StructType(
    [
        T.StructField("run_date", T.DateType()),
        T.StructField("source_type", T.StringType()),
        T.StructField("source_file", T.StringType()),
        T.StructField("ingestion_ts", T.TimestampType()),
    ]
)


class ContractError(ValueError):
    """The contract itself is unusable; no row is read."""


@dataclass(frozen=True)
class ContractColumn:
    name: str
    type: str
    required: bool = False


@dataclass(frozen=True)
class Contract:
    source_type: str
    file_pattern: str
    columns: tuple[ContractColumn, ...]
    delimiter: str = ","
    quote: str = '"'
    max_bad_records: int = 0
    write_bad_rows: bool = True

    def __post_init__(self) -> None:
        unknown = sorted({c.type for c in self.columns} - set(CONTRACT_CASTS))
        if unknown:
            raise ContractError(f"{self.source_type}: unsupported column types {unknown}")

    @property
    def names(self) -> list[str]:
        return [column.name for column in self.columns]

    def schema(self) -> T.StructType:
        """Typed columns of the contract, all nullable: requiredness is a rule on rows."""
        schema = T.StructType()
        for column in self.columns:
            schema.add(column.name, CONTRACT_CASTS[column.type][0])
        return schema

    def raw_schema(self) -> T.StructType:
        return T.StructType(self.schema().fields + METADATA.fields)


def _built_in(source_type: str, columns) -> Contract:
    return Contract(source_type, f"{source_type}_*.csv", tuple(ContractColumn(*c) for c in columns))


CONTRACTS = {
    "crm_sales": _built_in("crm_sales", CRM_SALES),
    "crm_support": _built_in("crm_support", CRM_SUPPORT),
    "crm_campaign_events": _built_in("crm_campaign_events", CRM_CAMPAIGN_EVENTS),
    "crm_new_partner_leads": _built_in("crm_new_partner_leads", CRM_NEW_PARTNER_LEADS),
}


def contract_from_document(document: dict, source_type: str | None = None) -> Contract:
    """A contract from its JSON document; the run's ``source_type`` must be the document's."""
    declared = document["source_type"]
    if source_type is not None and declared != source_type:
        raise ContractError(f"the run is for {source_type} but the contract describes {declared}")
    layout = document.get("csv", {})
    policy = document.get("reject_policy", {})
    return Contract(
        source_type=declared,
        file_pattern=document["file_pattern"],
        columns=tuple(
            ContractColumn(c["name"], c["type"], bool(c.get("required"))) for c in document["columns"]
        ),
        delimiter=layout.get("delimiter", ","),
        quote=layout.get("quote", '"'),
        max_bad_records=int(policy.get("max_bad_records", 0)),
        write_bad_rows=bool(policy.get("write_bad_rows", True)),
    )


def load_contract(spark: SparkSession, path: str, source_type: str | None = None) -> Contract:
    """Read one small contract file from wherever Spark can read."""
    rows = spark.read.text(path, wholetext=True).take(1)
    if not rows:
        raise ContractError(f"empty contract file {path}")
    return contract_from_document(json.loads(rows[0].value), source_type)
