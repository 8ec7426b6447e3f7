from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from conftest import utc, wall
from parcelspark.functions import timeops as t


def test_as_of_gives_both_calendars():
    evening = t.AsOf(datetime(2024, 3, 31, 17, 0))
    assert (evening.utc_date, evening.local_date) == (date(2024, 3, 31), date(2024, 4, 1))
    earlier = t.AsOf(datetime(2024, 3, 31, 16, 59, 59, tzinfo=timezone.utc))
    assert (earlier.utc_date, earlier.local_date) == (date(2024, 3, 31), date(2024, 3, 31))
    assert evening.days_back(31) == date(2024, 2, 29)


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_local_midnight_on_both_timestamp_types(spark, kind):
    df = spark.createDataFrame([("2024-01-01 16:59:59",), ("2024-01-01 17:00:00",)], "s string")
    df = df.select(F.col("s").cast(kind).alias("ts"))
    rows = df.select(t.local_time(F.col("ts")).alias("at"), t.local_date(F.col("ts")).alias("day")).collect()
    assert [r.at for r in rows] == [wall("2024-01-01 23:59:59"), wall("2024-01-02 00:00:00")]
    assert [r.day for r in rows] == [date(2024, 1, 1), date(2024, 1, 2)]
    kept = t.rolling_window(df, "ts", 0, t.AsOf(datetime(2024, 1, 2)))
    assert kept.count() == 1


def test_zone_with_clock_changes_is_looked_up(spark):
    df = spark.createDataFrame([("2024-01-15 12:00:00",), ("2024-07-15 12:00:00",)], "s string")
    shown = df.select(t.local_time(F.col("s").cast("timestamp_ntz"), "Europe/Berlin").alias("at")).collect()
    assert [r.at.hour for r in shown] == [13, 14]
    assert t._constant_offset("Europe/Berlin") is None
    assert t._constant_offset("Asia/Jakarta") == 7 * 3600


def test_fixed_window_bounds_are_inclusive_days(spark):
    days = ["2023-06-30 23:59:59", "2023-07-01 00:00:00", "2023-07-31 23:59:59", "2023-08-01 00:00:00"]
    df = spark.createDataFrame([(d,) for d in days], "s string").select(F.col("s").cast("timestamp_ntz").alias("ts"))
    kept = t.fixed_window(df, "ts", date(2023, 7, 1), date(2023, 7, 31)).collect()
    assert [r.ts for r in kept] == [wall(days[1]), wall(days[2])]
    local = t.fixed_window(df, "ts", date(2023, 7, 1), date(2023, 7, 31), t.LOCAL_TZ).collect()
    assert [r.ts for r in local] == [wall(days[0]), wall(days[1])]


def test_sunday_week_at_every_year_end(spark):
    days = [date(2015, 1, 1) + timedelta(days=i) for i in range(5844)]
    rows = spark.createDataFrame([(d,) for d in days], "d date").select("d", t.sunday_week(F.col("d")).alias("w")).collect()
    assert all(r.w == int(r.d.strftime("%U")) for r in rows)


def test_labels_and_keys(spark):
    df = spark.createDataFrame([("03/09/2024", "a", None)], "s string, a string, b string")
    row = df.select(
        t.parse_us_date(F.col("s")).alias("d"),
        t.month_label(t.parse_us_date(F.col("s"))).alias("m"),
        t.joined_key(F.col("a"), F.col("a")).alias("k"),
        t.joined_key(F.col("a"), F.col("b")).alias("none"),
        t.day_start(F.lit("2024-03-09 11:12:13").cast("timestamp_ntz")).alias("start"),
    ).first()
    assert (row.d, row.m, row.k, row.none, row.start) == (date(2024, 3, 9), "Mar 2024", "a - a", None, wall("2024-03-09 00:00:00"))


def test_bad_us_date_raises(spark):
    from pyspark.errors import PySparkException

    with pytest.raises(PySparkException):
        spark.createDataFrame([("2024-03-09",)], "s string").select(t.parse_us_date(F.col("s"))).collect()


def test_look_back_is_pushed_to_parquet(spark, tmp_path, table):
    path = str(tmp_path / "w.parquet")
    table("waybill_waybill", {"waybill_no": "a", "shipping_time": utc("2024-01-01 00:00:00")}).write.parquet(path)
    df = t.rolling_window(spark.read.parquet(path), "shipping_time", 35, t.AsOf(datetime(2024, 1, 10)))
    plan = df.select("waybill_no")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(shipping_time" in plan
