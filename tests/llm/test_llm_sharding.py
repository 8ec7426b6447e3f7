from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from parcelspark.llm.sharding import Permutation, numbered, shuffled


@pytest.mark.parametrize("n", [1, 2, 3, 10, 97, 1000])
def test_permutation_is_one_to_one_and_can_be_undone(spark, n):
    p = Permutation(spark, n, seed=7)
    rows = spark.range(n).select("id", p.forth(F.col("id")).alias("to")).select("id", "to", p.back(F.col("to")).alias("back"))
    found = rows.collect()
    assert sorted(r.to for r in found) == list(range(n))
    assert all(r.back == r.id for r in found)


def test_row_numbers_do_not_depend_on_layout(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("x"))
    one = {r.id: r.row_number for r in numbered(df.repartition(1), ["id"], buckets=16).collect()}
    many = {r.id: r.row_number for r in numbered(df.repartition(13, "x"), ["id"], buckets=16).collect()}
    assert one == many and sorted(one.values()) == list(range(500))


def test_shards_are_even_and_slots_gapless(spark):
    df = spark.range(1003).withColumn("Shard", F.lit("old"))
    found = shuffled(df, ["id"], 24, seed=1).toPandas()
    assert list(found.columns) == ["id", "row_number", "position", "shard", "slot"]
    sizes = found.groupby("shard").slot.agg(["count", "min", "max", "nunique"])
    assert len(sizes) == 24 and sizes["count"].max() - sizes["count"].min() <= 1
    assert (sizes["min"] == 0).all() and (sizes["max"] + 1 == sizes["count"]).all() and (sizes["nunique"] == sizes["count"]).all()
    again = shuffled(df.repartition(5), ["id"], 24, seed=1).toPandas()
    key = ["id", "shard", "slot"]
    assert found[key].sort_values("id").values.tolist() == again[key].sort_values("id").values.tolist()


def test_nulls_repeats_and_empty(spark):
    rows = [(None, "a"), (None, "a"), (1, None), (1, None), (2, "")]
    df = spark.createDataFrame(rows, "k long, text string")
    found = shuffled(df, ["k", "text"], 3).collect()
    assert sorted(r.position for r in found) == list(range(5))
    assert shuffled(df.limit(0), ["k"], 3).count() == 0
    with pytest.raises(ValueError):
        shuffled(df, ["k"], 0)
