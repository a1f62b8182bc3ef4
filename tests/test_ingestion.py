"""CSV files as exports deliver them: byte-order mark, quotes, newlines, shuffled and ragged rows."""

import json

import pytest
from py4j.protocol import Py4JJavaError
from pyspark.sql import functions as F

from relata.operators import validation
from relata.operators.quality import QualityGateError
from relata.plans.ingestion import INGESTION_RUN_SCHEMA, ingest
from relata.sinks.tables import Layers
from relata.sources import csv_files
from relata.sources.contracts import CONTRACTS, ContractError, contract_from_document, load_contract

LEADS = CONTRACTS["crm_new_partner_leads"]
HEADER = "external_lead_id,email,partner_name,lead_score,utm_source,created_at,opt_in"


@pytest.fixture
def folder(tmp_path):
    first = "﻿" + "\n".join(
        [
            HEADER,
            'L1,a@b.co,"Acme, ""Inc""",10,web,2024-01-05 10:30:00,yes',
            'L2,b@b.co,"two\nlines",x,web,2024-01-05,no',
            ",,Solo,5,web,,maybe",
            "L4,d@b.co,Short,7",
            "L5,e@b.co,Long,8,web,2024-01-05,t,extra,more",
        ]
    )
    second = "\n".join(["opt_in,email,external_lead_id,note,lead_score", "1,f@b.co,L6,é,12", "0,,L7,hello,"])
    (tmp_path / "crm_new_partner_leads_2024_02_01.csv").write_text(first + "\n", encoding="utf-8")
    (tmp_path / "crm_new_partner_leads_late.csv").write_text(second + "\n", encoding="utf-8")
    (tmp_path / "other.csv").write_text("x\n1\n")
    return tmp_path


def test_scan_by_name(spark, folder):
    df = csv_files.read_crm_csv(spark, str(folder), LEADS)
    found = {row.external_lead_id: row for row in df.collect()}
    assert len(found) == 7
    assert found["L1"].partner_name == 'Acme, "Inc"'
    assert found["L2"].partner_name == "two\nlines"
    assert found["L4"].utm_source is None and found["L4"].opt_in is None
    assert found["L5"].opt_in == "t"
    assert found["L6"].email == "f@b.co" and found["L6"].partner_name is None and found["L6"].opt_in == "1"
    assert found["L6"]._raw_row == {"email": "f@b.co", "external_lead_id": "L6", "lead_score": "12", "note": "é", "opt_in": "1"}


def test_no_files_is_an_empty_scan(spark, tmp_path):
    df = csv_files.read_crm_csv(spark, str(tmp_path), LEADS)
    checked = validation.validated(df, LEADS)
    assert tuple(validation.ingestion_counts(checked).first()) == (0, 0, 0)


def test_ingestion_writes_rows_evidence_and_audit(spark, folder, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("layers"))
    layers = Layers(spark, root)
    for _ in range(2):
        audit = ingest(spark, LEADS, str(folder), "2024-02-01", layers, f"{root}/rejected")
    assert (audit.input_count, audit.valid_count, audit.rejected_count) == (7, 4, 3)
    loaded = layers.read("raw", LEADS.source_type)
    assert sorted(row.external_lead_id for row in loaded.collect()) == ["L1", "L4", "L5", "L6"]
    one = loaded.where("external_lead_id = 'L1'").first()
    assert one.lead_score == 10 and one.opt_in is True and str(one.run_date) == "2024-02-01"
    assert layers.read("audit", "ingestion_runs").count() == 2

    lines = [json.loads(row.value) for row in spark.read.text(f"{root}/rejected/part").collect()]
    assert all(list(line) == sorted(line) and list(line["raw_row"]) == sorted(line["raw_row"]) for line in lines)
    by_number = {(line["source_file"].rsplit("_", 1)[-1], line["row_number"]): line["error_reasons"] for line in lines}
    assert by_number == {
        ("01.csv", 3): ["lead_score: invalid INTEGER: x"],
        ("01.csv", 4): ["external_lead_id is required", "email is required", "opt_in: invalid BOOL: maybe"],
        ("late.csv", 3): ["email is required"],
    }


def test_appending_keeps_both_loads(spark, folder, tmp_path_factory):
    layers = Layers(spark, str(tmp_path_factory.mktemp("layers")))
    for _ in range(2):
        ingest(spark, LEADS, str(folder), "2024-02-01", layers, layers.path("rejected", "leads"), rerun_safe=False)
    assert layers.read("raw", LEADS.source_type).count() == 8


def test_reject_limit_stops_after_the_evidence(spark, folder, tmp_path_factory):
    layers = Layers(spark, str(tmp_path_factory.mktemp("layers")))
    with pytest.raises(QualityGateError, match="3 rejected rows, at most 0"):
        ingest(spark, LEADS, str(folder), "2024-02-01", layers, layers.path("rejected", "leads"), enforce_limit=True)
    assert spark.read.text(layers.path("rejected", "leads") + "/part").count() == 3


def test_contract_errors(spark, tmp_path):
    document = {"source_type": "a", "file_pattern": "a_*.csv", "columns": [{"name": "x", "type": "STRING", "required": True}]}
    path = tmp_path / "contract.json"
    path.write_text(json.dumps(document, indent=1))
    contract = load_contract(spark, str(path), "a")
    assert contract.names == ["x"] and contract.max_bad_records == 0 and contract.delimiter == ","
    with pytest.raises(ContractError, match="for b but the contract describes a"):
        load_contract(spark, str(path), "b")
    document["columns"][0]["type"] = "GEOGRAPHY"
    with pytest.raises(ContractError, match="unsupported column types"):
        contract_from_document(document)


def test_typed_load_fails_on_a_bad_row(spark, tmp_path):
    schema = CONTRACTS["crm_support"].schema()
    good = tmp_path / "good.csv"
    good.write_text("a,b,c,d,e,f\nT1,U1,high,open,billing,4.5\n")
    assert csv_files.load_typed_csv(spark, str(good), schema).first().csat_score == 4.5
    bad = tmp_path / "bad.csv"
    bad.write_text("a,b,c,d,e,f\nT1,U1,high,open,billing,many\n")
    with pytest.raises(Py4JJavaError, match="many"):
        csv_files.load_typed_csv(spark, str(bad), schema).collect()


def test_audit_schema_matches(spark, folder):
    checked = validation.validated(csv_files.read_crm_csv(spark, str(folder), LEADS), LEADS)
    audit = validation.ingestion_audit(checked, LEADS, "2024-02-01", "a", "b", "c", "d")
    expected = spark.createDataFrame([], INGESTION_RUN_SCHEMA).schema
    assert [(f.name, f.dataType) for f in audit.schema.fields] == [(f.name, f.dataType) for f in expected.fields]
    row = audit.first()
    assert row.input_count == row.valid_count + row.rejected_count


@pytest.mark.parametrize("multi_line", [True, False])
def test_a_file_that_begins_with_an_empty_line_is_rejected_not_lost(spark, tmp_path, multi_line):
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(HEADER + "\nL1,a@b.co,P,1,web,,yes\n")
    (tmp_path / "crm_new_partner_leads_b.csv").write_text("\n" + HEADER + "\nL2,b@b.co,P,1,web,,yes\n")
    checked = validation.validated(csv_files.read_crm_csv(spark, str(tmp_path), LEADS, multi_line), LEADS)
    assert tuple(validation.ingestion_counts(checked).first()) == (3, 1, 2)
    raw = {row._raw_row[""] for row in checked.where(F.size("_raw_row") == 1).collect()}
    assert raw == {HEADER, "L2,b@b.co,P,1,web,,yes"}


def test_a_quoted_newline_in_the_header_stays_in_its_name(spark, tmp_path):
    header = 'external_lead_id,"a\nnote",email,lead_score'
    (tmp_path / "crm_new_partner_leads_a.csv").write_text(header + '\nL1,"one\ntwo",a@b.co,7\n')
    (row,) = csv_files.read_crm_csv(spark, str(tmp_path), LEADS).collect()
    assert (row.external_lead_id, row.email, row.lead_score) == ("L1", "a@b.co", "7")
    assert row._raw_row["a\nnote"] == "one\ntwo"
