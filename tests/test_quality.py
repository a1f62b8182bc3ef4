"""Rule kinds on literal rows, gates, and the agreement of report and evidence."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from relata.catalog.models import Models
from relata.operators import audit, checks, quality, scans
from relata.sources.rules import ScanRule, built_in_rules, load_rules, parse_rules
from tests.conftest import SMALL

NOW = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def raw(spark):
    return Models(spark, SMALL).raw_tables()


def test_there_are_31_rules_and_18_with_evidence():
    assert len(quality.RAW_RULES) == 31
    assert sum(rule.keys is not None for rule in quality.RAW_RULES) == 18
    assert len({rule.rule_id for rule in quality.RAW_RULES}) == 31


def test_report_counts_equal_evidence_counts(raw):
    report = {row.rule_id: row.failed_row_count for row in quality.quality_report(raw).collect()}
    evidence = quality.rejected_records(raw, "2024-02-01", F.lit(NOW)).groupBy("rule_id").count()
    found = {row.rule_id: row["count"] for row in evidence.collect()}
    with_keys = [rule.rule_id for rule in quality.RAW_RULES if rule.keys is not None]
    assert {rule: report[rule] for rule in with_keys} == {rule: found.get(rule, 0) for rule in with_keys}


def test_each_table_is_scanned_once_for_its_row_rules(raw):
    rules = [rule for rule in quality.RAW_RULES if rule.table == "crm_sales" and rule.kind != "exists"]
    plan = quality.table_report(raw["crm_sales"], rules)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1


def test_each_fact_is_scanned_once_for_rows_and_references(raw):
    for name in ("crm_sales", "crm_campaign_events"):
        rules = [rule for rule in quality.RAW_RULES if rule.table == name]
        fact = {"crm_sales": "orders.parquet", "crm_campaign_events": "events.parquet"}[name]
        report = quality.table_report(raw[name], rules, raw)
        evidence = quality.rejected_records(raw, "2024-02-01", F.lit(NOW), rules=tuple(rules))
        for df in (report, evidence):
            plan = df._jdf.queryExecution().executedPlan().toString()
            assert plan.count("FileScan") - plan.count("customer.parquet") - plan.count("nation.parquet") <= 1 + plan.count("missing-keys")
            assert plan.count(fact) == 1


def test_references_of_empty_and_unknown_rows(spark):
    users = spark.createDataFrame([("u1",), (None,), (" u2",)], "USER_ID string")
    schema = "deal_id string, customer_id string, user_id string, deal_amount string, currency string"
    rows = [("d1", "c", "u1 ", "1", "USD"), ("d2", "c", "u9", "-1", "USD"), ("d3", "c", None, "1", "USD"), ("d4", "c", " ", "1", None), (None, "c5", "u2", "1", "USD")]
    rules = tuple(rule for rule in quality.RAW_RULES if rule.table == "crm_sales")
    for held in (rows, []):
        tables = {"user_raw": users, "crm_sales": spark.createDataFrame(held, schema)}
        report = {row.rule_id: row.failed_row_count for row in quality.quality_report(tables, rules).collect()}
        assert report["crm_sales_user_exists_in_oracle"] == (1 if held else 0) and report["crm_sales_user_id_required"] == (2 if held else 0)
        assert report["crm_sales_count_positive"] == (0 if held else 1) and report["crm_sales_deal_amount_non_negative"] == (1 if held else 0)
        found = quality.rejected_records(tables, "2024-02-01", F.lit(NOW), rules=rules).collect()
        assert sorted((row.rule_id, row.source_key) for row in found) == ([
            ("crm_sales_deal_amount_non_negative", "d2"), ("crm_sales_deal_id_required", "c5"), ("crm_sales_user_exists_in_oracle", "d2"),
            ("crm_sales_user_id_required", "d3"), ("crm_sales_user_id_required", "d4"),
        ] if held else [])


def test_report_order(raw):
    found = [(row.severity, row.rule_id) for row in quality.quality_report(raw).collect()]
    assert found == sorted(found)


def test_gate_lists_errors_only(spark):
    schema = "rule_id string, severity string, source_table string, failed_row_count bigint, sample_error string"
    warning = spark.createDataFrame([("w", "WARNING", "t", 5, ""), ("e", "ERROR", "t", 0, "")], schema)
    quality.enforce(warning)
    assert quality.severity_verdict(warning).first().failing_warnings == "w"
    failing = warning.unionByName(spark.createDataFrame([("b", "ERROR", "t", 1, ""), ("a", "ERROR", "t", 2, "")], schema))
    with pytest.raises(quality.QualityGateError, match="Failing ERROR rules: a, b$"):
        quality.enforce(failing)


def test_empty_tables_stop_the_run(spark):
    counts = spark.createDataFrame([("raw.a", 1), ("raw.c", 0), ("raw.b", 0)], "table_name string, row_count bigint")
    with pytest.raises(quality.QualityGateError, match="Empty tables: raw.b, raw.c"):
        quality.fail_if_empty(counts)
    quality.fail_if_empty(counts.where("row_count > 0"))


def test_range_lets_unreadable_values_pass(spark):
    rule = quality.RawRule("r", "ERROR", "t", "range", "x", "", ("int64", 1, 5))
    df = spark.createDataFrame([("0",), ("3",), ("9",), ("many",), (None,), ("2.5",)], "x string")
    assert df.where(quality.violation(rule, df)).count() == 2


def results(spark, df, *rules):
    return {row.rule_name: row for row in scans.scan(df, "s", rules, NOW).collect()}


def test_null_and_false_both_fail_a_row_condition(spark):
    df = spark.createDataFrame([(1,), (None,), (-1,), (2,)], "n int")
    row = results(spark, df, ScanRule("a_b", "rowCondition", "n", "n > 0"))["a-b"]
    assert (row.rule_passed, row.rule_rows_evaluated, row.rule_rows_passed_percent) == (False, 4, 50.0)


def test_missing_column_is_reported(spark):
    df = spark.createDataFrame([(1,)], "n int")
    found = results(
        spark, df, ScanRule("a", "rowCondition", None, "gone = 1"), ScanRule("b", "nonNull", "gone"),
        ScanRule("c", "uniqueness", "gone"), ScanRule("d", "tableCondition", None, "max(gone) > 1"), ScanRule("e", "nonNull", "n"),
    )
    assert {name: row.reason for name, row in found.items() if not row.rule_passed} == dict.fromkeys("abcd", "missing column gone")
    assert found["e"].rule_passed


def test_other_analysis_errors_are_not_swallowed(spark):
    df = spark.createDataFrame([(1,)], "n int")
    with pytest.raises(Exception, match="UNRESOLVED_ROUTINE|PARSE_SYNTAX|no_such"):
        scans.scan(df, "s", [ScanRule("a", "rowCondition", None, "no_such_function(n)")], NOW).collect()


def test_uniqueness_counts_groups(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",), (None,), (None,)], "k string")
    row = results(spark, df, ScanRule("u", "uniqueness", "k"))["u"]
    assert (row.rule_passed, row.rule_rows_evaluated, row.rule_rows_passed_percent) == (False, 5, 20.0)


def test_freshness_edges(spark):
    rule = ScanRule("f", "tableCondition", None, "max(t) >= :as_of - interval 25 hours")
    for hour, passed in ((23, True), (22, False)):
        df = spark.createDataFrame([(datetime(2024, 1, 30, hour),)], "t timestamp")
        assert results(spark, df, rule)["f"].rule_passed is passed


def test_gate_window_and_actions(spark):
    schema = "rule_passed boolean, job_start_time timestamp, failure_action string"
    old = (False, datetime(2024, 1, 31, 11, 59), "BLOCK_DOWNSTREAM")
    alert = (False, datetime(2024, 1, 31, 12, 0), "ALERT_ONLY")
    assert scans.gate_verdict(spark.createDataFrame([old], schema), NOW).first().passed
    both = spark.createDataFrame([old, alert], schema)
    with pytest.raises(quality.QualityGateError, match="1 failed rule rows"):
        scans.scan_gate(both, NOW)
    scans.scan_gate(both, NOW, honour_action=True)


def test_sampling_below_hundred_percent(spark):
    df = spark.range(10000).withColumnRenamed("id", "n")
    row = scans.scan(df, "s", [ScanRule("a", "nonNull", "n")], NOW, sampling_percent=10).first()
    assert 500 < row.rule_rows_evaluated < 1500
    assert scans.scan(df, "s", [ScanRule("a", "nonNull", "n")], NOW, 100).first().rule_rows_evaluated == 10000


def test_rule_documents(spark, tmp_path):
    assert [len(built_in_rules(n).rules) for n in ("user_360", "audience", "staging_sales", "staging_users")] == [9, 10, 7, 4]
    text = "dataQualitySpec:\n  samplingPercent: 50\n  rules:\n    - ruleId: a_b\n      column: x\n      nonNullExpectation: {}\n"
    path = tmp_path / "rules.yaml"
    path.write_text(text)
    found = load_rules(spark, str(path))
    assert found.sampling_percent == 50 and found.rules[0].kind == "nonNull"
    assert scans.rules_frame(spark, built_in_rules("user_360").rules).count() == 9
    with pytest.raises(ValueError, match="exactly one expectation"):
        parse_rules('{"dataQualitySpec": {"rules": [{"ruleId": "x"}]}}')


def test_null_consent_escapes_the_assertion(spark):
    df = spark.createDataFrame([("email_consent",), ("partner_opt_in",), (None,), ("other",)], "consent_status string")
    assert [row.consent_status for row in checks.assert_consent(df).collect()] == ["other"]
    with pytest.raises(quality.QualityGateError):
        checks.assertion(checks.assert_consent(df), "consent")


def test_checks_gate(spark):
    empty = spark.createDataFrame([], "campaign_id string, user_id string, run_date date")
    found = checks.check_row_count(empty, F.lit(NOW), "x").unionByName(checks.check_duplicates(empty, F.lit(NOW), "x"))
    assert {row.check_name: row.status for row in found.collect()} == {
        "salesforce_audience_row_count": "FAIL", "salesforce_audience_duplicate_keys": "PASS",
    }
    with pytest.raises(quality.QualityGateError):
        checks.assert_no_fail(found, F.lit(NOW))
    checks.assert_no_fail(found, F.lit(datetime(2024, 2, 2)))


def test_audited_steps(spark):
    seen = []

    def skip():
        raise audit.SkipStep("nothing to do")

    def fail():
        raise ValueError("broken")

    record = lambda df: seen.append(df.first())
    assert audit.audited(spark, record, NOW, "dag", "run", "a", lambda: 5) == 5
    with pytest.raises(audit.SkipStep):
        audit.audited(spark, record, NOW, "dag", "run", "b", skip)
    with pytest.raises(ValueError):
        audit.audited(spark, record, NOW, "dag", "run", "c", fail)
    assert [(row.task_id, row.status, row.message) for row in seen] == [
        ("a", "SUCCESS", None), ("b", "SKIPPED", "nothing to do"), ("c", "FAILED", "broken"),
    ]
