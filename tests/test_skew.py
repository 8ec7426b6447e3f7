"""Joins with a hot right side, and the sketch that finds hot keys."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelspark.operators import enrich, records, skew


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.fixture(scope="module")
def sides(spark):
    i = F.col("id")
    left = spark.range(400).select(
        F.when(i % 100 == 7, "hot").when(i == 5, None).otherwise(F.concat(F.lit("w"), i.cast("string"))).alias("k"), i.alias("w")
    )
    right = spark.range(0, 30_000, 1, 6).select(
        F.when(i % 3 == 0, "hot").when(i % 50 == 1, None).otherwise(F.concat(F.lit("w"), (i % 900).cast("string"))).alias("k"),
        (i % 1000).alias("v"),
    )
    return left, right


def listed(spark, *keys):
    return spark.createDataFrame([(k,) for k in keys], "_hot_key string")


def test_any_list_gives_the_rows_of_a_plain_join(spark, sides):
    left, right = sides
    plain = rows(left.join(right, "k", "left"))
    assert rows(skew.left_join(left, right, "k", hot_rows=1000)) == plain
    for keys in ([], ["hot"], ["w3", "w8", "hot"], ["nobody", "w399", None]):
        assert rows(skew.left_join(left, right, "k", salts=5, hot=listed(spark, *keys))) == plain


def test_two_columns_of_other_names_and_empty_sides(spark, sides):
    left, right = sides
    left = left.withColumn("x", F.lit(1))
    right = right.withColumnsRenamed({"k": "rk"}).withColumn("rx", F.when(F.col("v") % 4 != 0, 1))
    on = {"k": "rk", "x": "rx"}
    plain = left.join(right, [F.col("k") == F.col("rk"), F.col("x") == F.col("rx")], "left")
    assert rows(skew.left_join(left, right, on, hot_rows=500)) == rows(plain)
    none = right.where("v < 0")
    assert rows(skew.left_join(left, none, on)) == rows(left.join(none, [F.col("k") == F.col("rk"), F.col("x") == F.col("rx")], "left"))
    assert skew.left_join(left.where("w < 0"), right, on).count() == 0


def test_hot_right_rows_are_spread(spark, sides):
    """No task of the join gets more than five times the median, though one key owns a third of the right rows."""
    _, right = sides
    left = spark.range(900).select(F.concat(F.lit("w"), F.col("id").cast("string")).alias("k")).union(
        spark.createDataFrame([("hot",)], "k string")
    )
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": "8"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = skew.left_join(left, right.where("k IS NOT NULL"), "k", hot=listed(spark, "hot"), salts=64)
        sizes = sorted(r["n"] for r in joined.groupBy(F.spark_partition_id().alias("p")).agg(F.count("*").alias("n")).collect())
        assert sum(sizes) == rows_of(left, right)
        assert sizes[-1] <= 5 * sizes[len(sizes) // 2]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def rows_of(left, right):
    return left.join(right, "k", "left").count()


def test_sketch_lists_hot_keys_and_missing_ones(spark, sides):
    _, right = sides
    found = lambda **how: {r[0] for r in skew.heavy_keys(right, "k", **how).collect()}
    assert found(hot_rows=5000) == {"hot"}
    assert found(hot_rows=300, nulls=True) == {"hot", None}
    assert found(hot_rows=10**6) == set()
    assert skew.heavy_keys(right.where("v < 0"), "k").collect() == []


def test_sketch_shuffles_a_row_per_task(spark, sides):
    """Not a row per key, as an exact count would."""
    _, right = sides
    hot = skew.heavy_keys(right, "k", hot_rows=5000)
    assert hot.count() == 1
    from test_scale import shuffled_rows

    hot = skew.heavy_keys(right, "k", hot_rows=5000)
    hot.collect()
    assert max(shuffled_rows(hot)) <= 6 + 1


def test_neighbours_are_the_same_whatever_is_listed(spark, sides, monkeypatch):
    _, right = sides
    scans = right.withColumns({"t": F.timestamp_seconds(F.col("v") * 60).cast("timestamp_ntz"), "s": F.col("v").cast("string")}).distinct()
    walk = lambda: rows(records.scan_neighbours(scans, "k", "t", "s", "s", hot_rows=10**9))
    plain = walk()
    for keys in (["hot"], ["hot", None, "w2", "nobody"]):
        monkeypatch.setattr(records, "heavy_keys", lambda *a, **b: listed(spark, *keys))
        assert walk() == plain


def test_confirmations_of_hot_parcels(spark, sides, monkeypatch):
    _, right = sides
    scans = right.select(F.col("k").alias("waybill_no"), F.timestamp_seconds("v").cast("timestamp_ntz").alias("record_time"))
    returns = spark.createDataFrame([("hot", 500), ("w4", 3), ("w4", 900), (None, 5)], "waybill_no string, c long").select(
        "waybill_no", F.timestamp_seconds("c").cast("timestamp_ntz").alias("return_confirm_record_time")
    )
    plain = rows(enrich.scans_before_return(scans, returns))
    monkeypatch.setattr(enrich, "heavy_keys", lambda *a, **b: listed(spark, "hot", "w4", None))
    assert rows(enrich.scans_before_return(scans, returns)) == plain


def test_sketch_where_adaptive_execution_is_off(spark, sides):
    """Tasks that get no sketch to merge are no trouble."""
    _, right = sides
    before = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        assert [r[0] for r in skew.heavy_keys(right, "k", hot_rows=5_000).collect()] == ["hot"]
        assert skew.heavy_keys(right.where("v < 0"), "k", hot_rows=5_000).collect() == []
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", before)
