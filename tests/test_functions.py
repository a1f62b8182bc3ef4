"""Edge values of the column helpers."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from relata.functions import casting, records, text


def values(spark, inputs, column, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, x {kind}")
    return [row.y for row in df.select("i", column.alias("y")).orderBy("i").collect()]


def test_trim_strips_every_kind_of_whitespace(spark):
    found = values(spark, ["\t a \n", " b　", "   ", None, "c d"], text.trimmed("x"))
    assert found == ["a", "b", "", None, "c d"]


def test_blank_is_never_null(spark):
    assert values(spark, [None, "", " \t\n", "x", " "], text.is_blank("x")) == [True, True, True, False, True]


def test_filled(spark):
    assert values(spark, [None, " ", " k "], text.filled("x")) == [None, None, "k"]


@pytest.mark.parametrize(
    "address,strict,loose",
    [
        ("a@b.co", True, True),
        ("a@b.co\n", False, False),
        ("a@@b.co", False, False),
        ("a b@c.de", False, False),
        ("ä@b.co", False, True),
        ("a@b.c", False, True),
        ("a+b%c@d-e.fr", True, True),
        ("", False, False),
    ],
)
def test_email_shapes(spark, address, strict, loose):
    assert values(spark, [address], text.is_email("x")) == [strict]
    assert values(spark, [address], text.is_email("x", strict=False)) == [loose]


def test_contact_name(spark):
    found = values(spark, ["ann@x.y", "@x.y", "l" * 100 + "@x.y", "plain"], text.contact_name("x"))
    assert found == ["ann", "Unknown", "l" * 80, "plain"]


def test_redaction(spark):
    assert values(spark, ["curl -H 'Authorization: Bearer abc.def' x"], text.redacted("x")) == [
        "curl -H 'Authorization: Bearer [REDACTED]' x"
    ]


def test_contract_integer(spark):
    found = values(spark, ["12", " 7 ", "+3", "-4", "1_000", "12.5", "1e2", "", "99999999999999999999"], casting.contract_integer("x"))
    assert found == [12, 7, 3, -4, None, None, None, None, None]


def test_contract_float(spark):
    found = values(spark, ["1.5", " -2 ", "1e2", ".5", "1_0", "abc", "1.5d", "inf"], casting.contract_float("x"))
    assert found == [1.5, -2.0, 100.0, 0.5, None, None, None, float("inf")]


def test_contract_bool(spark):
    found = values(spark, ["true", "T", "1", " YES ", "y", "False", "f", "0", "no", "N", "2", ""], casting.contract_bool("x"))
    assert found == [True] * 5 + [False] * 5 + [None, None]


def test_contract_date(spark):
    found = values(spark, ["2025-01-02", "2025", "2025-01", "2025-01-02 junk", "2025-1-2", "2025-02-30"], casting.contract_date("x"))
    assert found == [date(2025, 1, 2)] + [None] * 5


def test_contract_timestamp_is_utc_in_any_session_zone(spark):
    inputs = ["2024-01-05 10:30:00", "2024-01-05T10:30:00Z", "2024-01-05T10:30:00+02:00", "2024-01-05", "2024-01-05T10:30", "05.01.2024", "2024-13-01"]
    expected = ["2024-01-05T10:30:00Z", "2024-01-05T10:30:00Z", "2024-01-05T08:30:00Z", "2024-01-05T00:00:00Z", "2024-01-05T10:30:00Z", None, None]
    assert values(spark, inputs, records.utc_text(casting.contract_timestamp("x"))) == expected
    stamp = casting.contract_timestamp("x").cast("double")
    utc = values(spark, inputs, stamp)
    spark.conf.set("spark.sql.session.timeZone", "Asia/Taipei")
    try:
        assert values(spark, inputs, stamp) == utc
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_safe_casts(spark):
    assert values(spark, ["1.5", "x", " 2 ", "-12.50"], casting.safe_cast("x", "numeric")) == [
        Decimal("1.5"), None, Decimal("2"), Decimal("-12.5"),
    ]
    assert values(spark, ["12.5", "12", "1e2"], casting.safe_cast("x", "int64")) == [None, 12, None]
    assert values(spark, [4.6, -2.5, None], casting.safe_cast("x", "int64", "double"), "double") == [5, -3, None]
    assert values(spark, ["2024-1-5", "2024", "2024-01-05 x"], casting.safe_cast("x", "date")) == [date(2024, 1, 5), None, None]
    assert values(spark, ["2024-01-05 01:02:03 UTC", "x"], casting.safe_cast("x", "timestamp")) == [datetime(2024, 1, 5, 1, 2, 3), None]
    assert values(spark, [" TRUE ", "yes"], casting.safe_cast("x", "bool")) == [True, None]


def test_row_json_keeps_nulls_and_order(spark):
    df = spark.createDataFrame([("é", None, datetime(2024, 1, 5, 1, 2, 3, 500000))], "b string, a string, t timestamp")
    assert df.select(records.row_json(df)).first()[0] == '{"b":"é","a":null,"t":"2024-01-05T01:02:03.5Z"}'
    assert df.select(records.sorted_json(df)).first()[0].startswith('{"a":null,"b":"é"')


def test_fallback_key(spark):
    df = spark.createDataFrame([("d", "c"), (" ", "c"), (None, "")], "deal string, customer string")
    column = records.fallback_key(("deal", "customer"), F.lit("hash"))
    assert [row[0] for row in df.select(column).collect()] == ["d", "c", "hash"]


def test_instants_do_not_depend_on_the_drivers_zone(spark, monkeypatch):
    import time

    monkeypatch.setenv("TZ", "Asia/Taipei")
    time.tzset()
    try:
        found = spark.range(1).select(records.utc_text(records.instant(datetime(2024, 2, 1))).alias("t")).first().t
    finally:
        monkeypatch.delenv("TZ")
        time.tzset()
    assert found == "2024-02-01T00:00:00Z"


def _python_integer(value):
    try:
        number = None if "_" in value else int(value)
    except ValueError:
        return None
    return number if number is not None and -(2**63) <= number < 2**63 else None


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text("0123456789+-. _ex\t", max_size=22), min_size=40, max_size=80))
def test_contract_integer_reads_what_python_reads(spark, inputs):
    assert values(spark, inputs, casting.contract_integer("x")) == [_python_integer(v) for v in inputs]


def test_a_wide_amount_times_a_count_is_exact(spark):
    from decimal import Decimal, localcontext

    from relata.operators.curated import _times

    values_ = [("20000000000000000.123456789", 3), ("0.999999999", 7), ("-12.5", 2), ("999999999.999999999", 999_999), ("1234567890123456789012.123456789", 1000)]
    df = spark.createDataFrame([(Decimal(a), n) for a, n in values_], "a decimal(38,9), n long").withColumn("r", _times(F.col("a"), F.col("n")))
    with localcontext() as context:
        context.prec = 60
        assert all(row.r == row.a * row.n for row in df.collect())
