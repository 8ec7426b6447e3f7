"""Picks per key: ties, NULLs, rank gaps, and hot keys against brute force."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import types as T

from conftest import by, utc
from parcelspark.functions.timeops import AsOf
from parcelspark.operators import records as r


@pytest.fixture(scope="module")
def versions(spark):
    return spark.createDataFrame(
        [("a", 1, "x"), ("a", 3, "z"), ("a", 3, "y"), ("b", None, "n"), ("b", 1, "m"), (None, 5, "p"), (None, 6, "q")],
        "k string, t long, v string",
    )


def test_latest_breaks_ties_by_the_other_columns(versions):
    got = by(r.latest_record(versions, "k", "t"), "k")
    assert {k: (row.t, row.v) for k, row in got.items()} == {"a": (3, "y"), "b": (1, "m"), None: (6, "q")}


def test_earliest_puts_missing_times_first(versions):
    got = by(r.earliest_record(versions, "k", "t"), "k")
    assert {k: (row.t, row.v) for k, row in got.items()} == {"a": (1, "x"), "b": (None, "n"), None: (5, "p")}


def test_one_record_is_repeatable_and_honours_a_named_tie(versions):
    assert by(r.one_record(versions, "k"), "k")["a"].v == "x"
    assert by(r.one_record(versions, "k", tie=["v"]), "k")["b"].v == "m"
    doubled = versions.union(versions)
    assert r.one_record(doubled, ["k", "t", "v"]).count() == versions.count()


def test_values_at_the_newest_and_oldest_time(spark):
    df = spark.createDataFrame(
        [("a", 2, "p"), ("a", 2, None), ("a", 2, "q"), ("a", 1, "z"), ("b", 5, None), ("b", 4, "x"), ("c", 1, "s"), ("c", 1, "r")],
        "k string, t long, v string",
    )
    newest = by(r.latest_values(df, "k", "t", {"v": "v", "at": "t"}), "k")
    assert {k: (row.v, row["at"]) for k, row in newest.items()} == {"a": ("q", 2), "b": (None, 5), "c": ("s", 1)}
    oldest = by(r.first_values(df, "k", "t", ["v"]), "k")
    assert {k: row.v for k, row in oldest.items()} == {"a": "z", "b": "x", "c": "r"}
    same = df.where("k = 'a' and t = 2")
    assert r.first_values(same, "k", "t", ["v"]).first().v == "p"


def test_newest_value_equals_the_running_window(spark):
    random.seed(3)
    rows = [(random.randrange(40), random.randrange(5), random.choice("abc") if random.random() > 0.3 else None) for _ in range(800)]
    df = spark.createDataFrame(rows, "k long, t long, v string")
    got = {x.k: x.v for x in r.latest_values(df, "k", "t", ["v"]).collect()}
    first = {x.k: x.v for x in r.first_values(df, "k", "t", ["v"]).collect()}
    for key in {k for k, _, _ in rows}:
        newest = max(t for k, t, _ in rows if k == key)
        oldest = min(t for k, t, _ in rows if k == key)
        assert got[key] == max((v for k, t, v in rows if (k, t) == (key, newest) and v), default=None)
        assert first[key] == min((v for k, t, v in rows if (k, t) == (key, oldest) and v), default=None)


def brute_neighbours(rows):
    out = {}
    for key in {row[0] for row in rows}:
        own = sorted((row for row in rows if row[0] == key), key=lambda x: (x[1] is not None, x[1] or datetime.min, x[4]))
        for i, row in enumerate(own):
            back, back2 = own[i - 1] if i else None, own[i - 2] if i > 1 else None
            ahead = own[i + 1] if i + 1 < len(own) else None
            out[row[4]] = (
                back and back[2], back and back[1], back2 and back2[2], ahead and ahead[2], ahead and ahead[1], ahead and ahead[3],
            )
    return out


@pytest.mark.parametrize("hot_rows,unit", [(10**9, "minute"), (30, "hour"), (30, "minute"), (0, "day"), (0, "second")])
def test_neighbours_are_the_same_whichever_way_a_key_goes(spark, hot_rows, unit):
    random.seed(11)
    rows = []
    for i in range(900):
        key = "hot" if i % 3 == 0 else (None if i % 7 == 0 else f"k{random.randrange(60)}")
        at = None if i % 50 == 1 else datetime(2024, 1, random.randrange(1, 4), random.randrange(0, 5), random.randrange(0, 60), random.choice([0, 30]))
        stop = None if i % 13 == 0 else f"S{random.randrange(9)}"
        rows.append((key, at, stop, random.choice(["in", "out"]), i))
    shape = T.StructType.fromDDL("k string, t timestamp_ntz, stop string, kind string, id long")
    df = spark.createDataFrame(rows, shape)
    got = r.scan_neighbours(df, "k", "t", "stop", "kind", tie=["id"], hot_rows=hot_rows, slice_unit=unit).collect()
    assert len(got) == len(rows)
    assert {x.id: tuple(x[c] for c in r.NEIGHBOUR_COLUMNS) for x in got} == brute_neighbours(rows)


def test_scans_without_a_time_are_split_by_the_leading_text_of_the_tie_break(spark):
    random.seed(12)
    tags = random.sample(range(10_000), 300)
    rows = [("hot", None if i % 3 else datetime(2024, 1, 1 + i % 2), f"S{i % 9}", "in", f"{tag:05d}") for i, tag in enumerate(tags)]
    shape = T.StructType.fromDDL("k string, t timestamp_ntz, stop string, kind string, tag string")
    got = r.scan_neighbours(spark.createDataFrame(rows, shape), "k", "t", "stop", "kind", tie=["tag"], hot_rows=0).collect()
    assert {x.tag: tuple(x[c] for c in r.NEIGHBOUR_COLUMNS) for x in got} == brute_neighbours(rows)


def test_attempts_share_a_rank_and_leave_a_gap(spark):
    df = spark.createDataFrame(
        [("a", 1, "p"), ("a", 1, "q"), ("a", 5, "s"), ("a", 7, "t"), ("b", 2, None), ("c", 1, "x"), ("c", 2, "y"), ("c", 3, "z")],
        "k string, t long, v string",
    )
    got = by(r.attempt_pivot(df, "k", "t", {"v": "v"}, 3, time_name="t", firsts={"first_v": "v"}), "k")
    shown = {k: tuple(row[c] for c in ("v_1", "v_2", "v_3", "t_1", "t_2", "t_3", "first_v")) for k, row in got.items()}
    assert shown == {
        "a": ("q", None, "s", 1, None, 5, "p"), "b": (None, None, None, 2, None, None, None), "c": ("x", "y", "z", 1, 2, 3, "x"),
    }


def test_current_tariff(table):
    as_of = AsOf(datetime(2024, 1, 10, 16, 0))
    alive, over = utc("2024-01-10 17:00:00"), utc("2024-01-10 16:59:59")
    df = table(
        "standard_shipping_fee",
        {"search_code": "a", "end_expire_time": alive, "created_at": utc("2024-01-01 00:00:00"), "max_sla": 3, "deleted": "0"},
        {"search_code": "a", "end_expire_time": alive, "created_at": utc("2024-01-02 00:00:00"), "max_sla": 4, "deleted": "0"},
        {"search_code": "a", "end_expire_time": alive, "created_at": utc("2024-01-03 00:00:00"), "max_sla": 5, "deleted": "1"},
        {"search_code": "b", "end_expire_time": over, "created_at": utc("2024-01-03 00:00:00"), "max_sla": 6, "deleted": "0"},
    )
    assert [(x.search_code, x.max_sla) for x in r.current_tariff(df, as_of).collect()] == [("a", 4)]


def test_transport_label_keeps_one_row_without_a_label(spark):
    df = spark.createDataFrame(
        [("w1", "B1", "V1", 1), ("w1", "B2", "V2", 2), ("w2", None, "V1", 1), ("w3", "B1", None, 1), ("w4", "", "V1", 1)],
        "waybill_no string, bag_no string, vehicle_tag_no string, record_time long",
    )
    got = {x.waybill_no: x.vm_bm_awb for x in r.transport_label(df).collect()}
    # Any one row may stand for the NULL label; the smallest by column order is taken.
    assert got == {"w1": "V1 - B1 - w1", "w2": None, "w4": "V1 -  - w4"}
