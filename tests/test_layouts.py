"""Bucketed stage tables and logs laid out by day: same rows, no shuffle of the stage, no file of another day."""

from __future__ import annotations

import json
import time
from datetime import date, datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from parcelspark.functions.timeops import AsOf, fixed_window, rolling_window
from parcelspark.sources import daylogs, stages

ON = {"x": "k", "y": "m"}


@pytest.fixture(scope="module")
def rows(spark):
    i = F.col("id")
    return spark.range(0, 6_000, 1, 6).select(
        F.when(i % 3 == 0, "hot").when(i % 40 == 1, None).otherwise(F.concat(F.lit("k"), (i % 200).cast("string"))).alias("k"),
        F.when(i % 3 == 0, "h").otherwise((i % 2).cast("string")).alias("m"),
        i.alias("v"),
    )


@pytest.fixture(scope="module")
def left(spark):
    named = [(f"k{n}", str(n % 2), n) for n in range(300)] + [("hot", "h", 1), ("hot", "h", 2), ("hot", "0", 3), (None, "1", 4)]
    return spark.createDataFrame(named, "x string, y string, n int")


@pytest.fixture
def shuffled_joins(spark):
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def listed(df):
    return sorted(map(str, df.collect()))


def nodes(plan, name):
    """How many operators of the physical plan are called ``name``."""
    return sum(line.lstrip(" :+-").split("(")[0].strip().startswith(name) for line in plan.splitlines())


def plan_of(df):
    return df._jdf.queryExecution().sparkPlan().toString(), df._jdf.queryExecution().executedPlan().toString()


def totals(df):
    return df.groupBy("k", "m").agg(F.sum("v").alias("total"))


def plain(left, right):
    return left.join(right, [F.col(a) == F.col(b) for a, b in ON.items()], "left")


@pytest.mark.parametrize("hot_rows", [500, 10**9])
def test_stage_keeps_rows_and_joins_like_a_plain_table(spark, tmp_path, rows, left, hot_rows):
    stage = stages.write_stage(rows, f"file://{tmp_path}/s", ("k", "m"), 7, hot_rows)
    assert listed(stage.rows()) == listed(rows)
    assert {r[0] for r in stage.hot.select("k").distinct().collect()} == ({"hot"} if hot_rows == 500 else set())
    assert listed(stages.left_join(left, stage, ON)) == listed(plain(left, rows))
    assert listed(stages.left_join(left, stage, dict(reversed(ON.items())), totals)) == listed(plain(left, totals(rows)))
    assert listed(stages.left_join(left.where("n < 0"), stage, ON)) == []


def test_many_rows_without_a_key_are_hot_too(spark, tmp_path, rows, left):
    rows = rows.withColumn("k", F.when(F.col("k") == "hot", None).otherwise(F.col("k")))
    stage = stages.write_stage(rows, f"file://{tmp_path}/s", ("k", "m"), 4, 500)
    assert stage.hot.where("k IS NULL").count() > 2_000 and stage.usual.where("k IS NULL").count() == 0
    assert listed(stages.left_join(left, stage, ON)) == listed(plain(left, rows))


def test_stage_of_no_rows(spark, tmp_path, rows, left):
    stage = stages.write_stage(rows.where("v < 0"), f"file://{tmp_path}/s", ("k", "m"), 4)
    assert stage.rows().count() == 0 and stage.rows().dtypes == rows.dtypes
    assert listed(stages.left_join(left, stage, ON)) == listed(plain(left, rows.where("v < 0")))


def test_stage_side_has_no_exchange(spark, tmp_path, rows, left, shuffled_joins):
    """With shuffled joins only, the part of usual keys moves the left rows and nothing else, aggregate included."""
    stage = stages.write_stage(rows, f"file://{tmp_path}/s", ("k", "m"), 7, 500)
    for right in (stage.usual, totals(stage.usual)):
        _, text = plan_of(plain(left, right))
        assert "SelectedBucketsCount: 7 out of 7" in text or "Bucketed: true" in text
        assert nodes(text, "Exchange") == 1 and "hashpartitioning(x#" in text
    _, text = plan_of(plain(left, rows))
    assert nodes(text, "Exchange") == 2


def test_buckets_grow_with_the_rows(spark, tmp_path, rows, left):
    path = f"file://{tmp_path}/s"
    stage = stages.write_stage(rows, path, ("k", "m"), 4, 10**9, bucket_rows=500)
    assert json.loads(spark.read.text(f"{path}/layout").first()["value"])["buckets"] == 12
    assert listed(stage.rows()) == listed(rows)
    assert listed(stages.left_join(left, stage, ON)) == listed(plain(left, rows))


def shuffle_files(spark):
    manager = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {path for folder in manager.localDirsString() for path in Path(folder).rglob("shuffle_*.data")}


def test_a_written_stage_leaves_no_shuffle_files(spark, tmp_path, rows):
    """Those of the rows' own plan and of the buckets go when they are written, not when the driver collects garbage."""
    before = shuffle_files(spark)
    stage = stages.write_stage(rows.repartition(5, "v"), f"file://{tmp_path}/s", ("k", "m"), 4, 500)
    until = time.time() + 30
    while shuffle_files(spark) - before and time.time() < until:
        time.sleep(0.2)
    assert not shuffle_files(spark) - before
    assert listed(stage.rows()) == listed(rows)


def test_only_the_writing_of_a_stage_gives_up_shuffle_files(spark, tmp_path, rows):
    before = spark.conf.get(stages._RELEASES, None)
    stages.write_stage(rows, f"file://{tmp_path}/s", ("k", "m"), 4)
    assert spark.conf.get(stages._RELEASES, None) == before
    with pytest.raises(Exception):
        stages.write_stage(rows, f"file://{tmp_path}/s", ("k", "m"), 4)
    assert spark.conf.get(stages._RELEASES, None) == before


def test_rows_of_a_bucket_lie_in_order(spark, tmp_path, rows, left):
    shuffled = rows.withColumn("w", F.pmod(F.xxhash64("v"), F.lit(7)))
    path = f"file://{tmp_path}/s"
    stage = stages.write_stage(shuffled, path, ("k", "m"), 4, 500, order=("w", "v"))
    files = list((tmp_path / "s" / "usual").glob("*.parquet"))
    assert len(files) == 4
    for file in files:
        found = [(r.w, r.v) for r in spark.read.parquet(f"file://{file}").coalesce(1).collect()]
        assert found == sorted(found)
    assert listed(stage.rows()) == listed(shuffled) == listed(stages.read_stage(spark, path).rows())
    assert listed(stages.left_join(left, stage, ON)) == listed(plain(left, shuffled))


def test_stage_opens_in_another_session_and_only_when_finished(spark, tmp_path, rows):
    path = f"file://{tmp_path}/s"
    stages.write_stage(rows, path, ("k", "m"), 5, 500)
    other = spark.newSession()
    for table in other.catalog.listTables():
        if table.name.startswith("stage_"):
            other.sql(f"DROP TABLE {table.name}")
    opened = stages.read_stage(other, path)
    assert opened.keys == ("k", "m") and listed(opened.rows()) == listed(rows)
    with pytest.raises(Exception):
        stages.write_stage(rows, path, ("k", "m"), 5)
    rows.write.parquet(f"file://{tmp_path}/half/rows")
    with pytest.raises(Exception):
        stages.read_stage(spark, f"file://{tmp_path}/half")
    with pytest.raises(ValueError):
        stages.left_join(rows.select(F.col("k").alias("x")), opened, {"x": "k"})


# --- Logs by day ---------------------------------------------------------------------------------

NOON = datetime(2024, 3, 10, 12)


@pytest.fixture(scope="module")
def log(spark):
    """Forty days of a scan every two hours, the middle of a third of them on one day, and scans without a time."""
    times = [(n, NOON - timedelta(hours=2 * n)) for n in range(480)]
    times += [(1000 + n, NOON - timedelta(days=20, minutes=n % 300)) for n in range(240)] + [(2000, None), (2001, None)]
    return spark.createDataFrame(times, "id long, t timestamp_ntz")


def files_read(df):
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    return plan.collectLeaves().head().metrics().apply("numFiles").value()


def ids(df):
    return sorted(r.id for r in df.select("id").collect())


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
@pytest.mark.parametrize("unit", ["day", "month"])
def test_look_backs_give_the_rows_of_the_plain_log(spark, tmp_path, log, unit, kind):
    log = log.withColumn("t", F.col("t").cast(kind))
    daylogs.write_log(log, f"file://{tmp_path}/log", "t", unit)
    for shape in (None, log.schema):
        laid = daylogs.read_log(spark, f"file://{tmp_path}/log", "t", unit, shape)
        assert ids(laid) == ids(log)
        for hour in (0, 16, 17, 18, 23):
            as_of = AsOf(datetime(2024, 3, 10, hour))
            for tz in ("Asia/Jakarta", "America/New_York", None):
                assert ids(rolling_window(laid, "t", 3, as_of, tz)) == ids(rolling_window(log, "t", 3, as_of, tz))
        for tz in ("Asia/Jakarta", None):
            span = date(2024, 2, 18), date(2024, 2, 20)
            assert ids(fixed_window(laid, "t", *span, tz)) == ids(fixed_window(log, "t", *span, tz))


def test_only_files_of_the_looked_back_days_are_read(spark, tmp_path, log):
    daylogs.write_log(log, f"file://{tmp_path}/log", "t")
    laid = daylogs.read_log(spark, f"file://{tmp_path}/log", "t")
    as_of = AsOf(datetime(2024, 3, 10, 12))
    # From the local midnight that starts 7 March, which lies on 6 March in UTC: five UTC days.
    recent = rolling_window(laid, "t", 3, as_of).select("id")
    assert "PartitionFilters: [isnotnull(t_day" in recent._jdf.queryExecution().executedPlan().toString()
    assert files_read(recent) == 5
    assert files_read(fixed_window(laid, "t", date(2024, 3, 1), date(2024, 3, 2)).select("id")) == 2
    assert files_read(rolling_window(laid, "t", 3, as_of, tz=None).select("id")) == 4
    assert files_read(laid.select("id")) > 40


def test_late_rows_join_the_folder_of_their_day(spark, tmp_path, log):
    first, late = log.where("id % 3 <> 0"), log.where("id % 3 = 0")
    daylogs.write_log(first, f"file://{tmp_path}/log", "t")
    daylogs.write_log(late, f"file://{tmp_path}/log", "t", mode="append")
    laid = daylogs.read_log(spark, f"file://{tmp_path}/log", "t")
    as_of = AsOf(datetime(2024, 3, 10, 12))
    assert ids(laid) == ids(log) and ids(rolling_window(laid, "t", 25, as_of)) == ids(rolling_window(log, "t", 25, as_of))


def test_log_without_rows(spark, tmp_path, log):
    daylogs.write_log(log.where("id < 0"), f"file://{tmp_path}/log", "t")
    laid = daylogs.read_log(spark, f"file://{tmp_path}/log", "t", shape=log.schema)
    assert rolling_window(laid, "t", 3, AsOf(NOON)).count() == 0


def test_log_files_are_zstd(spark, tmp_path, log):
    daylogs.write_log(log, f"file://{tmp_path}/log", "t")
    names = [path.name for path in tmp_path.glob("log/*/part-*")]
    assert names and all(name.endswith(".zstd.parquet") for name in names)
