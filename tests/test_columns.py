import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tidemark.functions import columns as C
from tidemark.functions.device_events import EVENT_SCHEMA, enriched
from tidemark.functions.numbers import exact_avg, exact_sum, exact_total
from tidemark.functions.times import time_range, within


def one(spark, *exprs):
    return tuple(spark.range(1).select(*exprs).first())


def test_mapping_renames_casts_and_drops(spark):
    df = spark.createDataFrame([("7", "x", 1.5, 9)], "a string, b string, `sum(c)` double, extra int")
    out = C.apply_mapping(
        df, [("a", "string", "n", "long"), ("b", "string", "bad", "int"), ("`sum(c)`", "double", "total", "double")]
    )
    assert out.dtypes == [("n", "bigint"), ("bad", "int"), ("total", "double")]
    assert tuple(out.first()) == (7, None, 1.5)


@pytest.mark.parametrize(
    "text, number",
    [("1000", 1000.0), (" 2.5 ", 2.5), ("-3", -3.0), ("1e3", 1000.0), ("abc", None), ("a1", None), (None, None), ("", None)],
)
def test_number_or_null(spark, text, number):
    assert one(spark, C.number_or_null(F.lit(text).cast("string"), "double")) == (number,)


@pytest.mark.parametrize(
    "status, kind, lat, lon, expected",
    [
        ("faulty", "heartbeat", 10.0, -20.0, ("Requires Maintenance", "E303", "High", "Northern Hemisphere, Western", "10.0|-20.0")),
        ("active", "alert", -1.0, 5.126, ("Operational", "E202", "High", "Southern Hemisphere, Eastern", "-1.0|5.13")),
        ("x", "y", 0.0, 0.0, ("Unknown", "E000", "Normal", "Southern Hemisphere, Western", "0.0|0.0")),
        (None, "sensor_reading", 1.0, 1.0, ("Unknown", "E101", "Normal", "Northern Hemisphere, Eastern", "1.0|1.0")),
    ],
)
def test_device_events(spark, status, kind, lat, lon, expected):
    df = spark.createDataFrame([(status, kind, (lat, lon))], EVENT_SCHEMA)
    r = enriched(df).first()
    place = r.location_transformed
    assert (r.status_transformed, r.event_type_transformed, r.priority_level, place.region, place.geohash) == expected
    assert r.location == place


@pytest.mark.parametrize(
    "name, today, first, last",
    [
        ("last month", "2024-04-15", "2024-03-01", "2024-03-31"),
        ("last month", "2024-01-31", "2023-12-01", "2023-12-31"),
        ("last month", "2024-03-31", "2024-02-01", "2024-02-29"),
        ("YTD", "2024-04-15", "2024-01-01", "2024-04-15"),
        ("last 7 days", "2024-03-03", "2024-02-25", "2024-03-03"),
        ("last quarter", "2024-04-15", "2024-01-01", "2024-03-31"),
        ("last quarter", "2024-02-15", "2023-10-01", "2023-12-31"),
        ("Q1 2024", "2030-01-01", "2024-01-01", "2024-03-31"),
        ("Q4 2023", "2030-01-01", "2023-10-01", "2023-12-31"),
    ],
)
def test_time_ranges(spark, name, today, first, last):
    a, b = time_range(name, F.lit(today).cast("date"))
    assert one(spark, a, b) == (dt.date.fromisoformat(first), dt.date.fromisoformat(last))


def test_range_keeps_late_timestamps_of_the_last_day(spark):
    df = spark.createDataFrame([("2024-03-31 23:59:59",), ("2024-04-01 00:00:00",)], "s string")
    df = df.select(F.col("s").cast("timestamp_ntz").alias("ts"))
    assert df.filter(within("ts", "Q1 2024", F.lit("2024-06-01").cast("date"))).count() == 1
    with pytest.raises(ValueError):
        time_range("someday", F.lit("2024-06-01").cast("date"))


def test_number_texts(spark):
    values = [4.2e6, 127000.0, 3.1e9, 45230.0, 999.0, -1500.0]
    shown = one(spark, *[C.compact_number(F.lit(v)) for v in values])
    assert shown == ("4.2M", "127K", "3.1B", "45.2K", "999", "-1.5K")
    assert one(spark, C.compact_number(F.lit(4.2e6), "$"), C.percent_text(F.lit(0.1234))) == ("$4.2M", "12.3%")
    assert one(spark, C.scale_suffixed(F.lit("100K"), 0.9), C.scale_suffixed(F.lit("xK"), 0.9)) == ("90.0K", None)


def test_times_and_text(spark):
    assert one(spark, C.iso_time(F.lit("nonsense")))[0] is None
    assert one(spark, C.epoch_time(F.lit(0)).cast("long")) == (0,)
    assert one(spark, C.contains_ignoring_case(F.lit("50% off"), "0% O")) == (True,)
    assert one(spark, C.contains_ignoring_case(F.lit("50x off"), "0% O")) == (False,)


def test_change_detection_and_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (None, 2), (1, None), (None, None)], "a int, b int")
    flag = lambda safe: [r[0] for r in df.select(C.any_difference([F.col("a")], [F.col("b")], safe)).collect()]
    assert flag(False) == [False, True, False, False, False]
    assert flag(True) == [False, True, True, True, False]


def test_exact_sums(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (-0.35,), (None,), (9e12,)], "x double")
    assert df.agg(exact_sum("x"), exact_avg("x")).first()[0] == 8999999999999.95
    huge = spark.range(1000).select(F.lit(9e13).alias("x"))
    assert huge.agg(exact_total("x").cast("string")).first()[0] == "90000000000000000.000000"
    assert huge.agg(exact_avg("x")).first()[0] == 9e13
    assert df.filter("x > 1e15").agg(exact_sum("x")).first()[0] is None


def test_exact_sums_on_both_sides_of_a_long(spark):
    values = [9e12, 1e13, -1e13, 9.3e12, -9.3e12, 0.25, 123456789012345680.0]
    df = spark.createDataFrame([(v,) for v in values] + [(None,), (float("nan"),), (float("inf"),)], "x double")
    want = sum(map(Decimal, values))
    assert df.agg(exact_total("x")).first()[0] == want
    assert df.agg(exact_avg("x")).first()[0] == float(want) / len(values)
