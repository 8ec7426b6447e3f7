"""Plan shapes and skew: what must hold when one key owns a third of the rows."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from parcelspark.operators import enrich, records, rollups


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    """300,000 scans over several files; a third belong to one parcel."""
    path = str(tmp_path_factory.mktemp("skew") / "scans.parquet")
    i = F.col("id")
    spark.range(0, 300_000, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (i * 7919 % 20_000).cast("string"))).alias("waybill_no"),
        F.timestamp_seconds(1_700_000_000 + i * 17).cast("timestamp_ntz").alias("record_time"),
        F.concat(F.lit("TH "), (i % 40).cast("string")).alias("stop"),
        (i % 5).cast("string").alias("kind"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_rows(df):
    """Rows written by each shuffle of an executed plan."""
    rows = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if name == "Exchange":
            rows.append(node.metrics().apply("shuffleRecordsWritten").value())
        children = node.children()
        for n in range(children.size()):
            walk(children.apply(n))

    walk(df._jdf.queryExecution().executedPlan())
    return rows


def test_picks_cut_hot_keys_before_the_shuffle(skewed):
    """The hot parcel sends at most one row per map task, so far fewer rows than the table has."""
    hot = skewed.where("waybill_no = 'hot'")
    for pick in (
        records.latest_record(hot, "waybill_no", "record_time"),
        records.earliest_record(hot, "waybill_no", "record_time"),
        records.one_record(hot, "waybill_no"),
        records.latest_values(hot, "waybill_no", "record_time", ["stop", "kind"]),
        records.first_values(hot, "waybill_no", "record_time", ["stop", "kind"]),
    ):
        assert len(pick.collect()) == 1
        (sent,) = shuffled_rows(pick)
        assert sent <= 16, sent


def test_window_group_limit_is_planned_twice(skewed):
    plan = plan_of(records.latest_record(skewed, "waybill_no", "record_time"))
    assert "WindowGroupLimit" in plan and "Partial" in plan and "Final" in plan
    assert plan.count("Exchange hashpartitioning") == 1


def test_attempts_send_few_rows_of_a_hot_key(skewed):
    same_instant = skewed.where("waybill_no = 'hot'").withColumn("record_time", F.date_trunc("month", "record_time"))
    pivot = records.attempt_pivot(same_instant, "waybill_no", "record_time", {"stop": "stop"}, 3)
    assert len(pivot.collect()) == 1
    assert max(shuffled_rows(pivot)) <= 100


def test_neighbours_spread_a_hot_key(spark, skewed):
    walked = records.scan_neighbours(skewed, "waybill_no", "record_time", "stop", "kind", hot_rows=50_000, slice_unit="hour")
    placed = walked.where("waybill_no = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in placed) == 100_000
    assert max(r["count"] for r in placed) < 40_000
    plain = records.scan_neighbours(skewed, "waybill_no", "record_time", "stop", "kind")
    digest = F.sum(F.xxhash64(*sorted(plain.columns)).cast("decimal(38,0)"))
    assert walked.agg(digest).first() == plain.agg(digest).first()


def test_neighbours_need_one_shuffle_of_the_log_without_hot_keys(skewed):
    walked = records.scan_neighbours(skewed, "waybill_no", "record_time", "stop", "kind")
    walked.toArrow()
    assert sum(shuffled_rows(walked)) < 1.4 * 300_000
    final = plan_of(walked).split("== Initial Plan ==")[0]
    assert "Union" not in final and final.count("Window ") == 1


def test_flags_and_rollups_combine_before_the_shuffle(skewed):
    problems = skewed.select("waybill_no", F.col("kind").alias("problem_reason"))
    spine = skewed.select("waybill_no").distinct()
    flagged = enrich.flag_exists(spine, problems, {"one": ("1",), "two": ("2", "3")})
    assert flagged.count() == spine.count()
    totals = rollups.task_counts(skewed, ["kind"], {"n": F.lit(1)})
    totals.collect()
    assert shuffled_rows(totals)[0] <= 5 * 16


def test_status_joins_on_one_key_shuffle_the_spine_once(spark, skewed):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        spine = skewed.select("waybill_no", "record_time").where("waybill_no <> 'hot'")
        sides = [
            records.latest_values(skewed, "waybill_no", "record_time", {f"v{n}": "stop"}) for n in range(3)
        ]
        plan = plan_of(enrich.latest_status_join(spine, *sides))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "64MB")
    initial = plan.split("== Initial Plan ==")[-1]
    assert len(re.findall(r"Exchange hashpartitioning", initial)) == 4


def test_no_report_uses_a_cross_join_or_a_python_worker(spark):
    import __spark_entry__ as driver

    for name, build in driver.queries().items():
        plan = plan_of(build(spark, "/root/testdata/sf0.001"))
        for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEval", "MapInPandas"):
            assert word not in plan, (name, word)


def test_return_lookup_leaves_a_hot_parcel_where_it_is(spark, skewed):
    returns = skewed.select("waybill_no", F.col("record_time").alias("return_confirm_record_time")).where("kind = '1'")
    plain = enrich.scans_before_return(skewed, returns)
    split = enrich.scans_before_return(skewed, returns, hot_rows=50_000)
    digest = F.sum(F.xxhash64(*sorted(plain.columns)).cast("decimal(38,0)"))
    assert split.agg(F.count(F.lit(1)), digest).first() == plain.agg(F.count(F.lit(1)), digest).first()
    placed = split.where("waybill_no = 'hot'").groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert max(r["count"] for r in placed) < 40_000


def test_adaptive_execution_can_split_a_hot_lane(spark, skewed):
    """With masters too large to broadcast, the promise join still spreads one client's parcels."""
    i = F.col("id")
    versions = spark.range(0, 40_000, 1, 4).select(
        (i % 20_000).alias("search_code"), F.concat(F.lit("w"), (i % 20_000).cast("string")).alias("shipping_client_id"),
        (i % 20_000 % 3).alias("sender_location_id"), F.lit(1).alias("recipient_location_id"), F.lit("E").alias("express_type"),
        F.lit(1).alias("min_sla"), i.alias("max_sla"),
    )
    tariffs = records.latest_record(versions, "search_code", "max_sla")
    parcels = skewed.select(
        F.col("waybill_no").alias("vip_customer_id"), (F.length("stop") % 3).alias("sender_city_id"), F.lit(1).alias("recipient_district_id"),
        F.lit("E").alias("express_type"), "record_time", "stop",
    )
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        joined = enrich.contract_sla_join(parcels, tariffs)
        joined.toArrow()
        assert "SortMergeJoin(skew=true)" in plan_of(joined)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
