"""Date-shape and text operators."""

from conftest import one_col
from kiln.functions import dates, text


def test_mdy_to_iso(spark):
    got = one_col(spark, ["03/15/2024", "", "  ", None, "AB/cd/efgh", "2024-01-01", " 03/15/2024"], dates.mdy_to_iso)
    # shape-only reshaping; anything else passes through untrimmed
    assert got == ["2024-03-15", None, None, None, "efgh-AB-cd", "2024-01-01", " 03/15/2024"]


def test_slash_ymd_to_iso(spark):
    got = one_col(spark, ["2024/01/08", " 2024-01-08 ", "", None], dates.slash_ymd_to_iso)
    assert got == ["2024-01-08", "2024-01-08", None, None]


def test_timestamp_shape(spark):
    got = one_col(spark, ["2024-01-01 10:00", "2024-01-01 AB:CD", "2024/01/01 10:00", " 2024-01-01 10:00",
                          "2024-01-01 10:00:05 ", ""], dates.timestamp_shape)
    assert got == ["2024-01-01 10:00", "2024-01-01 AB:CD", None, None, "2024-01-01 10:00:05", None]


def test_day_diff_and_flags(spark):
    rows = [("2024-01-02", "2024-01-01"), ("2024-01-01", "2024-01-01"), (None, "2024-01-01"),
            ("2024-01-02 12:00", "2024-01-01"), ("2024-02-30", "2024-01-01"), ("2023-12-31", "2024-01-01"),
            ("2024/01/02", "2024-01-01")]
    df = spark.createDataFrame(rows, "b string, a string")
    got = df.select(dates.day_diff("b", "a").alias("d"), dates.before_flag("b", "a").alias("f")).collect()
    # day 30 of February is the first of March in a leap year, as in the source engine
    assert [r.d for r in got] == [1.0, 0.0, None, 1.5, 60.0, -1.0, None]
    assert [r.f for r in got] == [0, 0, 0, 0, 0, 1, 0]


def test_overdue_and_on_time(spark):
    df = spark.createDataFrame([("open", None, "2024-01-01"), ("open", "2024-01-05", "2024-01-01"),
                                ("closed", None, "2024-01-01"), ("open", None, "2030-01-01"),
                                ("open", None, None)], "s string, r string, q string")
    got = [r[0] for r in df.select(dates.overdue_flag("s", "r", "q", "2025-01-01 00:00:00")).collect()]
    assert got == [1, 0, 0, 0, 0]
    t = spark.createDataFrame([("2024-01-03", "2024-01-01", 3), ("2024-01-05", "2024-01-01", 3),
                               (None, "2024-01-01", 3), ("2024-01-03", "2024-01-01", None),
                               ("2023-12-31", "2024-01-01", 3), ("soon", "2024-01-01", 3)],
                              "d string, s string, c int")
    got = [r[0] for r in t.select(dates.on_time_flag("d", "s", "c")).collect()]
    # negative transit counts as on time; present-but-unreadable dates are not on time
    assert got == [1, 0, None, None, 1, 0]


def test_tier_warehouse_type_y_flag(spark):
    assert one_col(spark, ["tier-1", "Tier 2", "TIER3", "Strategic ", "", "Gold", None], text.tier) == \
        ["Tier 1", "Tier 2", "Tier 3", "Strategic", None, "Gold", None]
    assert one_col(spark, ["DC", "distribution center", "3pl", "unknown", "", " Cross-Dock "],
                   text.warehouse_type) == ["Distribution Center", "Distribution Center", "3PL", None, None,
                                            "Cross-Dock"]
    assert one_col(spark, ["y", " Y ", "N", "yes", None], text.y_flag) == [1, 1, 0, 0, 0]


def test_record_key_is_null_propagating(spark):
    df = spark.createDataFrame([("a", "b", "c"), ("a", None, "c")], "x string, y string, z string")
    assert [r[0] for r in df.select(text.record_key("x", "y", "z")).collect()] == ["a|b|c", None]
