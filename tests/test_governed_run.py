"""The governed night over files, with a gate that fails and one that does not."""

import pytest
from pyspark.sql import functions as F

from relata.catalog.adapters import AS_OF, RUN_DATE
from relata.catalog.models import Models
from relata.operators.quality import QualityGateError
from relata.plans import governed
from relata.sinks.tables import Layers
from relata.sources.contracts import CONTRACTS
from tests.conftest import SMALL

VIEWS = {"crm_sales": "crm_sales", "crm_support": "crm_support", "crm_campaign_events": "crm_campaign_events", "crm_new_partner_leads": "crm_new_partner_leads"}


@pytest.fixture(scope="module")
def exported(spark, tmp_path_factory):
    """The raw tables as one CSV file per source, as a transfer leaves them."""
    root = tmp_path_factory.mktemp("exported")
    folder = root / RUN_DATE
    folder.mkdir()
    models = Models(spark, SMALL)
    for name, contract in CONTRACTS.items():
        rows = models.raw(VIEWS[name]).where(f"{contract.names[1]} is not null").limit(400).toPandas()[contract.names]
        rows.to_csv(folder / f"{name}_{RUN_DATE.replace('-', '_')}.csv", index=False)
    return root


def run(spark, layers, exported, announced=True, **options):
    base = str(exported)
    names = list(CONTRACTS) if announced else list(CONTRACTS)[:3]
    uris = [(name, f"file:{base}/{RUN_DATE}/{name}_{RUN_DATE.replace('-', '_')}.csv") for name in names]
    manifests = spark.createDataFrame([(RUN_DATE, "SUCCESS", uris)], "run_date string, status string, files array<struct<source_type: string, object_uri: string>>")
    manifests = manifests.withColumn("run_date", F.to_date("run_date"))
    none = "id string, email string"
    directory = {
        "contacts": spark.createDataFrame([("003", "user2@example.com")], none),
        "leads": spark.createDataFrame([], none),
        "members": spark.createDataFrame([], "campaign_id string, id_field string, member_id string"),
    }
    users = Models(spark, SMALL).raw("user_raw").where("USER_ID is not null")
    return governed.governed_run(spark, layers, f"file:{base}", manifests, users, directory, RUN_DATE, AS_OF, "CAMP_MOCK_1", **options)


def statuses(layers):
    return {row.task_id: row.status for row in layers.read("audit", "step_status").collect()}


def test_a_missing_file_stops_the_run_at_once(spark, exported, tmp_path):
    layers = Layers(spark, str(tmp_path))
    with pytest.raises(QualityGateError):
        run(spark, layers, exported, announced=False)
    assert statuses(layers) == {"check_arrival": "FAILED"}


def test_a_failing_gate_keeps_evidence_and_runs_nothing_later(spark, exported, tmp_path):
    layers = Layers(spark, str(tmp_path))
    with pytest.raises(QualityGateError):
        run(spark, layers, exported)
    found = statuses(layers)
    assert found.pop("scan_and_gate") == "FAILED" and set(found.values()) == {"SUCCESS"}
    assert set(found) == {"check_arrival", *[f"ingest_{name}" for name in CONTRACTS], "check_users", "build_models"}
    assert layers.read("audit", "quality_results").where("not rule_passed").count() > 0
    assert layers.read("audit", "ingestion_runs").count() == 4
    assert layers.slices("raw", "crm_sales") == [RUN_DATE]


def test_all_steps(spark, exported, tmp_path, monkeypatch):
    monkeypatch.setattr(governed, "governed_quality", lambda *_: None)
    layers = Layers(spark, str(tmp_path))
    run(spark, layers, exported)
    found = statuses(layers)
    assert found["push"] == "SKIPPED" and found["archive"] == found["expire"] == found["dry_run"] == "SUCCESS"
    assert layers.slices("raw", "crm_sales") == [] and layers.slices("archive", "crm_sales") == [RUN_DATE]
