import json

from relata.sources import files, jdbc
from relata.sources.manifest import manifest_files, read_manifest
from relata.operators import audit


def test_manifest_and_arrival_from_files(spark, tmp_path):
    run = "2024-02-01"
    folder = tmp_path / "raw" / run
    folder.mkdir(parents=True)
    entries = []
    for name in audit.REQUIRED_SOURCES:
        path = folder / f"{name}_2024_02_01.csv"
        path.write_text("" if name == "crm_support" else "x\n")
        entries.append({"source_type": name, "object_uri": f"file:{path}", "size_bytes": 2, "generation": "1"})
    document = {"run_date": run, "transfer_job_name": "j", "transfer_operation_id": "o", "status": "SUCCESS", "files": entries[1:]}
    manifest = tmp_path / "manifest.json"
    manifest.write_text(json.dumps(document, indent=2))
    manifests = read_manifest(spark, str(manifest))
    assert manifest_files(manifests).count() == 3
    listed = files.listing(spark, str(tmp_path / "raw"), "*.csv")
    assert "content" not in listed.columns
    report = audit.arrival_report(manifests, listed, f"file:{tmp_path}/raw")
    assert {row.source_type: row.failure for row in report.collect()} == {
        "crm_sales": "not in manifest", "crm_support": "empty file", "crm_campaign_events": None, "crm_new_partner_leads": None,
    }
    try:
        audit.require_arrival(report, run)
    except Exception as error:
        assert "2 required files" in str(error)
    else:
        raise AssertionError("the gate let an incomplete arrival pass")


def test_jdbc_options():
    """No database is started here; this checks only what is asked of the reader."""
    seen = {}

    class Scan:
        columns = ["user_id", "email"]

        def toDF(self, *names):
            return names

    class Reader:
        def jdbc(self, url, source, **options):
            seen.update(url=url, source=source, **options)
            return Scan()

    class Session:
        read = Reader()

    assert jdbc.read_users_jdbc(Session(), "jdbc:x", ranges=["user_id < 'M'", "user_id >= 'M'"]) == ("USER_ID", "EMAIL")
    assert seen["source"].startswith("(SELECT user_id, email, first_name") and seen["source"].endswith("FROM APP.USER_RAW) users")
    assert seen["predicates"] == ["user_id < 'M'", "user_id >= 'M'"] and seen["properties"]["fetchsize"] == "1000"
