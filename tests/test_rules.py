"""One expectation per cleaning rule and odd input, under ANSI mode and without."""

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from sheetloom import functions as fn

CASES = [
    (fn.mixed_date, [
        ("46027", date(2026, 1, 5)), ("45000.75", date(2023, 3, 15)), (" 46027 ", date(2026, 1, 5)), ("2026", date(1905, 7, 18)),
        ("1/5/2026", date(2026, 1, 5)), ("01/05/2026", date(2026, 1, 5)), ("1/5/26", date(2026, 1, 5)), ("1/5/95", date(2095, 1, 5)),
        ("1/5/2026 0:00", date(2026, 1, 5)), ("2/29/2024", date(2024, 2, 29)), ("2/29/24", date(2024, 2, 29)),
        ("2026-01-05", date(2026, 1, 5)), ("2026-1-5", date(2026, 1, 5)), ("2026-01-05 00:00:00", date(2026, 1, 5)), ("0026-01-05", date(2026, 1, 5)),
        ("2/29/26", None), ("13/45/2026", None), ("1/5/126", None), ("-5", None), ("4.5E4", None), ("99999999999", None), ("2958466", None),
        ("2958465", date(9999, 12, 31)), ("abc", None), ("", None), (None, None),
    ]),
    (fn.calendar_date, [
        ("1/5/2026", date(2026, 1, 5)), ("1/5/26", date(2026, 1, 5)), ("46027", date(2026, 1, 5)), ("46027.0", date(2026, 1, 5)),
        ("2026-01-05", None), ("13/45/2026", None), ("x", None), (None, None),
    ]),
    (fn.serial_date, [("46027", date(2026, 1, 5)), ("0", date(1899, 12, 30)), ("1/5/26", None), ("", None), (None, None)]),
    (fn.clean_item, [
        ("1234", "1234"), ("1234.0", "1234"), (" 12.0 ", "12"), ("10.00", "10.00"), ("-3.0", "-3"), ("ABC-1", "ABC-1"),
        (" ABC ", "ABC"), ("ABC.0", "ABC.0"), ("", ""), (None, None),
    ]),
    (fn.clean_code, [("12", "12"), ("12.0", "12"), (" 12.0", " 12.0"), ("SK-1.0", "SK-1.0"), ("1.5", "1.5"), ("", ""), (None, None)]),
    (fn.trim_code, [(" 12.0 ", "12"), ("SK.0", "SK"), ("10.00", "10.00"), (None, None)]),
    (fn.signed_quantity, [
        ("12", 12.0), ("1,200", 1200.0), ("$5", 5.0), ("-3", -3.0), ("(5)", 5.0), ("1.5E3", 1.53), ("-0", 0.0),
        ("-", None), ("--", None), (" - ", None), ("1.2.3", None), ("5-3", None), ("", None), ("abc", None), (None, None),
    ]),
    (lambda c: fn.signed_quantity(c, paren_negative=True), [("(5)", -5.0), (" ($1,200) ", -1200.0), ("5", 5.0), ("-3", -3.0), (None, None)]),
    (fn.unsigned_quantity, [
        ("12", 12.0), ("-3", 3.0), ("(5)", 5.0), ("2.5", 3.0), ("2.4", 2.0), ("1.5E3", 2.0), ("5-3", 53.0),
        ("1.2.3", 0.0), ("--", 0.0), ("n/a", 0.0), ("", 0.0), (None, 0.0),
    ]),
    (fn.quantity_or_zero, [("-", 0.0), ("", 0.0), ("5", 5.0), ("1,200", None), ("x", None), (None, None)]),
    (lambda c: fn.quantity_or_zero(c, strip_commas=True), [("1,200", 1200.0), ("-", 0.0), ("x", None), (None, None)]),
    (fn.rounded_half_even, [("2.5", 2), ("3.5", 4), ("-2.5", -2), ("7", 7), ("x", 0), ("", 0), (None, 0)]),
    (fn.is_kept_item, [("0", False), ("0.0", False), (None, False), ("", True), ("00", True), ("7", True)]),
    (fn.is_kept_period, [
        ("F26-01", True), ("", False), (None, False), ("Cases / Pallet", False), ("case weight", False), ("2024.5", False), ("12", False), ("12x", True),
    ]),
    (fn.placeholder_to_zero, [("-", "0"), ("–", "0"), ("—", "0"), ("", "0"), (" ", "0"), ("- 0", "0"), ("0.0", "0"), ("0", "0"), ("x", "x"), (None, None)]),
    (fn.placeholder_to_null, [("-", None), (" - ", None), ("", None), ("  ", None), ("x", "x"), (None, None)]),
    (fn.parse_timestamp_utc, [
        ("2026-01-27T19:20:04Z", datetime(2026, 1, 27, 19, 20, 4)), ("2026-01-27T19:20:04", datetime(2026, 1, 27, 19, 20, 4)),
        ("2026-01-27 19:20:04.5", datetime(2026, 1, 27, 19, 20, 4, 500000)), ("2026-01-27T19:20:04+05:30", datetime(2026, 1, 27, 13, 50, 4)),
        ("2026-01-27T19:20:04-0800", datetime(2026, 1, 28, 3, 20, 4)), ("2026-01-27", datetime(2026, 1, 27)),
        ("20260127T192004", datetime(2026, 1, 27, 19, 20, 4)), ("20260127xyz", datetime(2026, 1, 27)), ("garbage", None), ("", None), (None, None),
    ]),
    (fn.plan_location, [("Vert_SAN_Plan_FY2026", "SAN"), ("Forecast_SAN_FY2026", "Unknown"), ("", "Unknown")]),
    (fn.forecast_location, [("Forecast_STER_FY2025", "STER"), ("Vert_SAN_Plan_FY2026", "Unknown")]),
    (fn.resource_name, [("Plan 26.xlsx", "Plan 26"), ("notes.txt", "notes.txt")]),
    (lambda c: fn.object_key(c, "landing"), [("Plan.xlsx", "landing/Plan/Plan.xlsx")]),
    (lambda c: fn.fill_item_prefix(F.lit(" "), c, "San Antonio"), [("7", "6007"), (None, None)]),
    (lambda c: fn.fill_item_prefix(c, F.lit("7"), "STER"), [(None, "2007"), ("", "2007"), ("x", "x")]),
    (lambda c: fn.fill_item_prefix(c, F.lit("7"), "Alexandria"), [(None, None), ("", "")]),
]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_rules(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for number, (rule, cases) in enumerate(CASES):
            df = spark.createDataFrame([(i, text) for i, (text, _) in enumerate(cases)], "i int, text string")
            got = {r["i"]: r["out"] for r in df.select("i", rule(F.col("text")).alias("out")).collect()}
            for i, (text, expected) in enumerate(cases):
                assert got[i] == expected, (number, text, got[i], expected)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_two_digit_year(spark):
    days = [date(26, 1, 5), date(99, 12, 31), date(2026, 1, 5)]
    df = spark.createDataFrame([(d,) for d in days], "d date")
    assert [r[0] for r in df.select(fn.widen_year(F.col("d"))).collect()] == [date(2026, 1, 5), date(2099, 12, 31), date(2026, 1, 5)]


def test_rules_do_not_depend_on_the_time_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    df = spark.createDataFrame([("2026-01-27T19:20:04Z", "46027")], "a string, b string")
    out = df.select(fn.parse_timestamp_utc(F.col("a")), fn.mixed_date(F.col("b")))
    try:
        for zone in ("UTC", "America/Los_Angeles", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            assert tuple(out.first()) == (datetime(2026, 1, 27, 19, 20, 4), date(2026, 1, 5))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_plan_key_leaves_out_missing_parts(spark):
    df = spark.createDataFrame([("F26-01", None, "7", "SAN")], "Period string, Date date, Item string, Location string")
    assert df.select(fn.plan_key()).first()[0] == "F26-01-7-SAN"
    assert df.select(fn.plan_key(null_token="?")).first()[0] == "F26-01-?-7-SAN"
    assert df.withColumn("Item", F.lit(None).cast("string")).select(fn.forecast_key()).first()[0] == "F26-01-NA-SAN"
