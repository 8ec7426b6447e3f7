"""Facts of several logs in one pass: equal to the operators over each log, one exchange on the key, hot keys combined."""

from __future__ import annotations

import random
import re
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F
from test_scale import plan_of, shuffled_rows

from parcelspark.operators import records
from parcelspark.operators.facts import Log, assembled, attempt
from parcelspark.plans import claims
from conftest import utc
from test_jobs import AS_OF, option, problem, scan, waybill

A, B = Log("a"), Log("b")
LOG = "k string, t timestamp_ntz, v string, w string, n int"


def log(spark, seed, rows=300, keys=25):
    """Rows with ties, missing times, values and keys, and repeated rows."""
    draw = random.Random(seed)
    made = [
        (
            draw.choice([None, *(f"k{i}" for i in range(keys))]),
            draw.choice([None, *(datetime(2024, 1, 1) + timedelta(microseconds=i) for i in range(6))]),
            draw.choice([None, "", "x", "y", "z"]),
            draw.choice([None, "p", "q"]),
            draw.randrange(3),
        )
        for _ in range(rows)
    ]
    return spark.createDataFrame(made + made[:20], LOG)


def keyed(df, *cols):
    return {r.k: tuple(r[c] for c in cols) for r in df.collect() if r.k is not None}


@pytest.mark.parametrize("seed", range(3))
def test_facts_equal_the_operators_over_each_log(spark, seed):
    first, other = log(spark, seed), log(spark, seed + 100, keys=30)
    n, where = 3, F.col("n") < 2
    own = B.col("n") < 2
    got = assembled({"a": first, "b": other}, "k", {
        "record": A.newest_record("t", ["v", "w", "n"]),
        "last": B.newest("t", "v"), "first": B.oldest("t", "w", own),
        "newest": B.newest_time("t", own), "oldest": B.oldest_time("t"),
        "state": B.attempts("t", "v", n, own), "has": B.present(B.col("v") == "z"),
    })
    got = got.select("k", "record.*", "last", "first", "newest", "oldest", "has", *(
        col.alias(f"{name}_{i}") for i in range(1, n + 1)
        for name, col in (("at", attempt("state", i, "time")), ("v", attempt("state", i)))
    )).cache()
    assert got.groupBy("k").count().where("count > 1").count() == 0
    keys = set(keyed(first))
    assert set(keyed(got)) == keys
    assert keyed(got, "v", "w", "n") == keyed(records.latest_record(first, "k", "t"), "v", "w", "n")
    reduced = other.groupBy("k").agg(
        records.latest_value("t", "v").alias("last"), records.first_value("t", "w", where).alias("first"),
        F.max(F.when(where, F.col("t"))).alias("newest"), F.min("t").alias("oldest"), F.max(F.col("v") == "z").alias("has"),
    )
    wanted = keyed(reduced, "last", "first", "newest", "oldest", "has")
    for key, (*values, has) in keyed(got, "last", "first", "newest", "oldest", "has").items():
        *expected, flag = wanted.get(key, (None,) * 5)
        assert (values, has) == (expected, bool(flag))
    names = [f"{name}_{i}" for i in range(1, n + 1) for name in ("at", "v")]
    pivot = keyed(records.attempt_pivot(other.where(where), "k", "t", {"v": "v"}, n, time_name="at"), *names)
    assert keyed(got, *names) == {key: pivot.get(key, (None,) * len(names)) for key in keys}


def test_rows_without_a_key_and_empty_logs(spark):
    rows = spark.createDataFrame([(None, datetime(2024, 1, 1), "x", None, 1)], LOG)
    got = assembled({"a": rows, "b": rows}, "k", {"v": A.newest("t", "v"), "other": B.newest("t", "v"), "has": B.present()})
    assert [tuple(r) for r in got.collect()] == [(None, "x", None, False)]
    none = rows.where("n < 0")
    got = assembled({"a": none, "b": rows}, "k", {"other": B.newest("t", "v")})
    assert got.count() == 0
    (row,) = assembled({"a": rows.withColumn("k", F.lit("x")), "b": none}, "k", {
        "state": B.attempts("t", "v", 2), "other": B.newest("t", "v")}).withColumn("one", attempt("state", 1)).collect()
    assert (row.other, row.one) == (None, None)


def test_a_hot_key_sends_one_row_a_task(spark, tmp_path):
    path = str(tmp_path / "scans.parquet")
    i = F.col("id")
    spark.range(0, 60_000, 1, 6).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("w"), (i % 500).cast("string"))).alias("k"),
        F.timestamp_seconds(1_700_000_000 + i).alias("t"), F.concat(F.lit("v"), i.cast("string")).alias("v"),
    ).write.parquet(path)
    scans = spark.read.parquet(path)
    got = assembled({"a": scans.select("k", "t"), "b": scans}, "k", {
        "last": B.newest("t", "v"), "state": B.attempts("t", "v", 4)})
    got = got.withColumn("third", attempt("state", 3))
    assert {r.k: r.third for r in got.collect()}["hot"] == "v6"
    # Two logs of at most six tasks, 501 keys each.
    (sent,) = shuffled_rows(got)
    assert sent <= 2 * 6 * 501


@pytest.fixture(scope="module")
def on_disk(spark, table, tmp_path_factory):
    """Claim tables as files, so that Spark knows their sizes."""
    root = tmp_path_factory.mktemp("claims")
    tables = {
        "waybill_waybill": [waybill("a", waybill_source="E", recipient_district_id=4), waybill("b", waybill_source="753"),
                            waybill(None, waybill_source="E"), waybill("z", waybill_source="Z")],
        "system_option": [option("waybillSource", "E", "everpro"), option("operationType", "09", "Delivery scan")],
        "waybill_problem_piece": [problem("a", "2024-04-02 00:00:00", "r"), problem("z", "2024-04-02 00:00:00", "r"),
                                  problem(None, "2024-04-02 00:00:00", "Paket hilang ditemukan")],
        "waybill_waybill_line": [scan("a", "2024-04-03 01:00:00", "09", branch="TH 7"), scan("b", "2024-04-03 01:00:00", "09"),
                                 scan(None, "2024-04-03 01:00:00", "09", branch="TH NULL"), scan("z", "2024-04-03 01:00:00", "09")],
        "waybill_return_bill": [{"waybill_no": "a", "update_time": utc("2024-04-04 00:00:00")}],
        "masterdata_branch_coverage_th": [{"district_id": 4, "branch_name": "TH COVER"}],
    }
    for name, rows in tables.items():
        table(name, *rows).write.parquet(f"{root}/{name}")
    return {name: spark.read.parquet(f"{root}/{name}") for name in tables}


@pytest.mark.parametrize("report", [claims.everpro_claims, claims.mengantar_claims])
@pytest.mark.parametrize("cut_logs", [True, False])
def test_claims_have_one_exchange_on_the_parcel(on_disk, report, cut_logs):
    plan = plan_of(report(on_disk, AS_OF, cut_logs=cut_logs))
    assert len(re.findall(r"Exchange hashpartitioning\(waybill_no#", plan)) == 1
    assert plan.count("BroadcastHashJoin [waybill_no") == (plan.count("LeftSemi") if cut_logs else 0)
    assert "Window [" not in "\n".join(line for line in plan.splitlines() if "waybill_no" in line)


@pytest.mark.parametrize("report", [claims.everpro_claims, claims.mengantar_claims])
def test_cut_and_uncut_logs_give_the_same_claims(on_disk, report):
    cut = [tuple(r) for r in report(on_disk, AS_OF).collect()]
    assert sorted(map(str, cut)) == sorted(str(tuple(r)) for r in report(on_disk, AS_OF, cut_logs=False).collect())
    assert cut and "TH NULL" not in str(cut)
