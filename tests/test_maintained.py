"""Maintained results against the same operator over all rows at once, batch after batch."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from parcelspark.operators import maintained, records
from parcelspark.sources.states import States

SHAPE = "k string, t timestamp_ntz, a string, fee decimal(18,2)"
START = datetime(2024, 1, 1)


def some_rows(seed, n=240):
    draw = random.Random(seed)
    rows = []
    for _ in range(n):
        time = None if draw.random() < 0.05 else START + timedelta(hours=draw.randrange(40))
        key = draw.choice([None, "hot", "hot", "hot", *"abcdefgh"])
        fee = None if draw.random() < 0.2 else Decimal(draw.randrange(1000)) / 100
        rows.append((key, time, draw.choice([None, "x", "y", "z"]), fee))
    return rows


def cut(spark, rows, n=2, seed=1):
    """Batches of rows in any order of time, one of them twice in a row and one empty."""
    order = rows[:]
    random.Random(seed).shuffle(order)
    step = len(order) // n
    parts = [order[i * step : (i + 1) * step if i < n - 1 else None] for i in range(n)]
    return [spark.createDataFrame(part, SHAPE).coalesce(2) for part in [*parts[:1], [], *parts[1:]]]


def same(a, b):
    assert sorted(map(str, a.select(*b.columns).collect())) == sorted(map(str, b.collect()))


@pytest.fixture(scope="module", autouse=True)
def few_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    yield
    spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.fixture
def states(spark, tmp_path):
    return States(spark, f"file://{tmp_path}/states")


@pytest.mark.parametrize(
    "fold, whole",
    [
        (lambda s, b: maintained.fold_latest(s, b, "k", "t"), lambda d: records.latest_record(d, "k", "t")),
        (lambda s, b: maintained.fold_earliest(s, b, "k", "t"), lambda d: records.earliest_record(d, "k", "t")),
        (lambda s, b: maintained.fold_one(s, b, ["k", "a"]), lambda d: records.one_record(d, ["k", "a"])),
    ],
)
def test_picks_equal_those_from_scratch_after_each_batch(spark, states, fold, whole):
    seen = None
    for n, batch in enumerate(cut(spark, some_rows(1)), 1):
        seen = batch if seen is None else seen.unionByName(batch)
        state = states.write("pick", fold(states.read("pick"), batch), n)
        same(state, whole(seen))
    same(fold(state, batch), state)


def test_values_equal_those_from_scratch_after_each_batch(spark, states):
    latest, first = {"last_a": "a", "last_fee": "fee"}, {"first_a": "a", "first_time": "t"}
    seen = None
    for n, batch in enumerate(cut(spark, some_rows(2)), 1):
        seen = batch if seen is None else seen.unionByName(batch)
        state = states.write("values", maintained.fold_values(states.read("values"), batch, "k", "t", latest, first), n)
        whole = records.latest_values(seen, "k", "t", latest).join(
            records.first_values(seen, "k", "t", first).withColumnRenamed("k", "k2"), F.col("k").eqNullSafe(F.col("k2"))
        )
        same(maintained.values_of(state, "k"), whole.drop("k2"))
    again = maintained.fold_values(state, batch, "k", "t", latest, first)
    same(again, state)


def count_all(seen):
    newest = records.latest_record(seen, "k", "t")
    return newest.groupBy("a", F.to_date("t").alias("day")).agg(F.count("k").alias("n"), F.sum("fee").alias("fee"))


def test_totals_equal_a_recount_after_each_batch(spark, states):
    seen, keys = None, ["a", "day"]
    for n, batch in enumerate(cut(spark, some_rows(3)), 1):
        seen = batch if seen is None else seen.unionByName(batch)
        newest, totals = states.read("newest"), states.read("totals")
        changes = maintained.record_changes(newest, batch, "k", "t").withColumn("day", F.to_date("t"))
        change = maintained.roll_up(changes, keys, {"n": "k"}, {"fee": "fee"})
        totals = states.write("totals", maintained.fold_totals(totals, change, keys), n)
        states.write("newest", maintained.fold_latest(newest, batch, "k", "t"), n)
        same(maintained.totals_of(totals, keys), count_all(seen))


def test_older_and_repeated_versions_change_nothing(spark):
    old = spark.createDataFrame([("p", START + timedelta(hours=5), "x", Decimal(3)), ("q", START, "x", None)], SHAPE)
    state = maintained.fold_latest(None, old, "k", "t")
    late = spark.createDataFrame([("p", START, "y", Decimal(9)), ("q", START, "x", None)], SHAPE)
    assert maintained.record_changes(state, late, "k", "t").collect() == []
    moved = spark.createDataFrame([("p", START + timedelta(hours=9), "y", Decimal(4))], SHAPE)
    assert sorted((r.a, r.fee, r["_sign"]) for r in maintained.record_changes(state, moved, "k", "t").collect()) == [
        ("x", Decimal(3), -1), ("y", Decimal(4), 1)
    ]
    totals = maintained.roll_up(state.withColumn("_sign", F.lit(1).cast("long")), ["a"], {"n": "k"}, {"fee": "fee"})
    change = maintained.roll_up(maintained.record_changes(state, moved, "k", "t"), ["a"], {"n": "k"}, {"fee": "fee"})
    shown = maintained.totals_of(maintained.fold_totals(totals, change, ["a"]), ["a"])
    assert sorted(map(tuple, shown.collect())) == [("x", 1, None), ("y", 1, Decimal(4))]


def test_floating_sums_are_refused(spark):
    df = spark.createDataFrame([("a", 0.1, 1)], "k string, x double, _sign long")
    with pytest.raises(TypeError):
        maintained.roll_up(df, ["k"], sums={"x": "x"})


SCANS = "k string, t timestamp_ntz, id long, stop string, kind string"


def some_scans(seed, n=300):
    draw = random.Random(seed)
    keys = [None, "hot", "hot", *"abcdefgh"]
    time = lambda: None if draw.random() < 0.04 else START + timedelta(minutes=draw.randrange(60))
    return [(draw.choice(keys), time(), i // 2 if i < 20 else i, f"s{i % 7}", str(i % 3)) for i in range(n)]


@pytest.mark.parametrize("by_time, hot_rows", [(True, 10**6), (False, 20)])
def test_neighbours_equal_one_window_after_each_batch(spark, states, by_time, hot_rows):
    rows = some_scans(4)
    if by_time:  # as they come in, but for a few late ones at the end
        rows = sorted(rows[:280], key=lambda r: (r[1] is not None, r[1] or START, r[2])) + rows[280:]
    tie = ["id", "stop", "kind"]
    seen, named = None, ("k", "t", tie)
    for n, start in enumerate(range(0, 300, 110), 1):
        batch = spark.createDataFrame(rows[start : start + 110], SCANS).coalesce(2)
        seen = batch if seen is None else seen.unionByName(batch)
        walked, ends = states.read("walked"), states.read("ends")
        changed = maintained.changed_neighbours(walked, ends, batch, "k", "t", "stop", "kind", tie, hot_rows=hot_rows)
        changed = states.write("changed", changed, n)
        states.write("ends", maintained.fold_boundary(ends, changed, *named), n)
        walked = states.write("walked", changed if walked is None else maintained.apply_changes(walked, changed, *named), n)
        same(walked, records.scan_neighbours(seen, "k", "t", "stop", "kind", tie=tie))


def test_keys_without_late_scans_are_continued_from_their_last_two(spark):
    tie = ["id", "stop", "kind"]
    old = spark.createDataFrame([("a", START + timedelta(minutes=i), i, f"s{i}", "0") for i in range(50)], SCANS)
    walked = records.scan_neighbours(old, "k", "t", "stop", "kind", tie=tie)
    ends = maintained.boundary(walked, "k", "t", tie)
    batch = spark.createDataFrame([("a", START + timedelta(hours=9), 90, "new", "1")], SCANS)
    changed = maintained.changed_neighbours(walked, ends, batch, "k", "t", "stop", "kind", tie)
    assert sorted((r.id, r.previous_branch_name, r.previous_branch_name_2, r.next_location_name) for r in changed.collect()) == [
        (49, "s48", "s47", "new"), (90, "s49", "s48", None)
    ]


def test_unfinished_versions_do_not_count_and_old_ones_go(spark, states, tmp_path):
    one = spark.range(3)
    for n in (1, 2, 3):
        states.write("s", one, n)
    assert states.version("s") == 3 and states.version("none") == 0 and states.read("none") is None
    assert sorted(p.name for p in (tmp_path / "states" / "s").iterdir()) == ["2", "3"]
    (tmp_path / "states" / "s" / "3" / "_SUCCESS").unlink()
    assert states.version("s") == 2
    assert states.write("s", spark.range(5), 3).count() == 5
