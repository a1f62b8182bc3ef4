"""The nightly runs from raw tables to activation, on the smallest tables."""

import pytest
from pyspark.sql import functions as F

from relata.catalog.adapters import AS_OF, RUN_DATE
from relata.catalog.models import Models
from relata.operators import activation
from relata.operators.quality import QualityGateError
from relata.plans import nightly
from relata.sinks.tables import Layers
from tests.conftest import SMALL


@pytest.fixture(scope="module")
def models(spark):
    return Models(spark, SMALL)


@pytest.fixture(scope="module")
def governed(spark, models, tmp_path_factory):
    layers = Layers(spark, str(tmp_path_factory.mktemp("governed")))
    raw = {
        "user_raw": models.raw("user_raw"),
        "crm_sales": models.raw("raw_sales"),
        "crm_support": models.raw("raw_support"),
        "crm_campaign_events": models.raw("raw_events"),
        "crm_new_partner_leads": models.raw("raw_leads"),
    }
    return layers, nightly.governed_models(layers, raw, AS_OF)


def test_governed_run(governed):
    layers, members = governed
    profile = layers.current("curated", "user_360")
    assert profile.count() == 150 == profile.select("user_id").distinct().count()
    consenting = profile.where("consent_email").count()
    assert members.where("consent_status = 'email_consent'").count() == consenting
    assert layers.current("mart", "user_segments").count() == 150
    assert members.where("segment_name like 'segment_%'").count() == consenting


def test_governed_gate_keeps_results(spark, governed):
    layers, _ = governed
    with pytest.raises(QualityGateError):
        nightly.governed_quality(layers, AS_OF)
    results = layers.read("audit", "quality_results")
    assert results.groupBy("scan_id").count().count() == 2
    assert {row.scan_id: row["count"] for row in results.groupBy("scan_id").count().collect()} == {"user-360": 9, "audience": 10}


def test_activation_is_idempotent(spark, models, governed):
    layers, members = governed
    directory = {
        "contacts": models.raw("contacts"),
        "leads": members.where("lead_email is not null").select(F.concat(F.lit("00Q"), "lead_email").alias("id"), F.col("lead_email").alias("email")),
        "members": models.raw("members"),
    }
    reachable = members.where("lead_email is not null")
    push = lambda **options: nightly.activate(
        spark, layers, reachable, directory, RUN_DATE, "CAMP_MOCK_1", AS_OF, **options
    )
    assert push() == "SUCCESS"
    assert push(dry_run=False) == "SUCCESS"
    assert push(dry_run=False) == "SUCCESS"
    audit = layers.read("audit", "salesforce_push_runs").collect()
    assert len(audit) == 3
    dry, real, skipped = (
        next(row for row in audit if row.is_dry_run),
        next(row for row in audit if not row.is_dry_run and row.error_message is None),
        next(row for row in audit if row.error_message == activation.ALREADY_PUSHED),
    )
    assert dry.records_processed == reachable.count() == real.records_processed
    assert skipped.records_processed == 0
    written = spark.read.json(f"{layers.path('activation', 'CAMP_MOCK_1')}/run_date={RUN_DATE}/members")
    assert written.count() > 0 and {row.Status for row in written.select("Status").distinct().collect()} == {"Sent"}


def test_classic_run_keeps_evidence_of_a_failed_gate(spark, models, tmp_path):
    layers = Layers(spark, str(tmp_path))
    raw = models.raw_tables()
    for _ in range(2):
        with pytest.raises(QualityGateError, match="crm_sales_user_id_required"):
            nightly.classic_quality(layers, raw, RUN_DATE, AS_OF)
    evidence = layers.read("raw", "crm_rejected_records")
    assert evidence.count() == evidence.select("rule_id", "source_key", "record_json").count() > 0
    assert evidence.where("rule_id = 'crm_sales_user_id_required'").count() == raw["crm_sales"].where("user_id is null or trim(user_id) = ''").count()


def test_classic_models(spark, models, tmp_path):
    layers = Layers(spark, str(tmp_path))
    members = nightly.classic_models(layers, models.raw_tables(), AS_OF)
    assert {row.campaign_code for row in members.select("campaign_code").distinct().collect()} <= {
        "campaign_engaged_growth", "high_value_sales_growth",
    }
    assert members.where("activation_status <> 'READY_TO_SEND'").count() == 0


def test_lean_run(spark, models, tmp_path):
    layers = Layers(spark, str(tmp_path))
    members = nightly.lean_models(layers, models.raw_tables(), AS_OF)
    nightly.lean_quality(layers, AS_OF, "x1")
    nightly.lean_quality(layers, AS_OF, "x2")
    results = layers.read("audit", "quality_check_results").collect()
    assert len(results) == 2 and {row.execution_id for row in results} == {"x2"}
    assert next(row for row in results if "row_count" in row.check_name).metric_value == members.count()


def test_push_outcomes_count_every_row(spark):
    targets = spark.createDataFrame(
        [("u1", "ContactId", "c1")] * 3 + [("u2", "ContactId", "c2"), ("u3", None, None), ("u4", "LeadId", "c1")],
        "user_id string, id_field string, member_id string",
    )
    members = spark.createDataFrame([("X", "ContactId", "c2"), ("Y", "LeadId", "c1")], "campaign_id string, id_field string, member_id string")
    assert tuple(activation.outcome_counts(targets, members, "X").first()) == (2, 3, 1)
    empty = targets.where("user_id = 'none'")
    assert tuple(activation.outcome_counts(empty, members, "X").first()) == (0, 0, 0)


def test_failed_rows_fail_the_push(spark):
    counts = spark.createDataFrame([(2, 3, 1)], "created_count bigint, skipped_count bigint, failed_count bigint")
    now = F.lit(AS_OF)
    row = activation.push_audit(counts, RUN_DATE, "X", now, now).first()
    assert (row.status, row.records_processed) == ("FAILED", 2)
    row = activation.push_audit(counts.withColumn("failed_count", F.lit(0)), RUN_DATE, "X", now, now).first()
    assert (row.status, row.records_processed, row.error_message) == ("SUCCESS", 5, None)


def test_a_push_creates_missing_people_and_records_a_failure(spark, tmp_path):
    layers = Layers(spark, str(tmp_path / "layers"))
    audience = spark.createDataFrame(
        [("u1", " A@x.co", 3.0), ("u2", "b@x.co", 2.0), ("u3", "b@x.co ", 1.0), ("u4", None, 1.0)], "user_id string, lead_email string, score double"
    ).selectExpr(
        f"date '{RUN_DATE}' as run_date", "'CAMP_MOCK_1' as campaign_id", "*", "'s' as segment_name", "'EMAIL_CONSENT' as consent_status",
        "cast(null as string) as salesforce_contact_id",
    )
    audience = audience.withColumn("consent_status", F.lit(activation.EMAIL_CONSENT))
    directory = {
        "contacts": spark.createDataFrame([("003", "a@X.co")], "id string, email string"),
        "leads": spark.createDataFrame([], "id string, email string"),
        "members": spark.createDataFrame([], "campaign_id string, id_field string, member_id string"),
    }
    options = {"dry_run": False, "create_missing": "LeadId", "member_status": "Responded"}
    nightly.activate(spark, layers, audience, directory, RUN_DATE, "CAMP_MOCK_1", AS_OF, **options)
    out = f"{layers.path('activation', 'CAMP_MOCK_1')}/run_date={RUN_DATE}"
    assert [tuple(r) for r in spark.read.json(f"{out}/created_members").select("Email", "IdField", "Status").collect()] == [("b@x.co", "LeadId", "Responded")]
    assert [r.ContactId for r in spark.read.json(f"{out}/members").collect()] == ["003"]
    assert {r.Company for r in spark.read.json(f"{out}/people").collect()} == {"Partner Lead"}
    assert [r.user_id for r in spark.read.json(f"{out}/failures").collect()] == ["u4"]
    (row,) = layers.read("audit", "salesforce_push_runs").collect()
    assert (row.status, row.records_processed) == ("FAILED", 2) and row.completed_at >= row.started_at
    broken = {**directory, "contacts": directory["contacts"].drop("email")}
    with pytest.raises(Exception, match="email"):
        nightly.activate(spark, layers, audience, broken, RUN_DATE, "CAMP_OTHER", AS_OF, dry_run=False)
    assert layers.read("audit", "salesforce_push_runs").where("campaign_id = 'CAMP_OTHER'").first().status == "FAILED"
