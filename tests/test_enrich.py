from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from conftest import by, utc
from parcelspark.functions.timeops import AsOf
from parcelspark.operators import enrich as e
from parcelspark.operators import rollups as u


def rows(df, *cols):
    return sorted((tuple(x[c] for c in cols) for x in df.collect()), key=repr)


def test_decode_option_uses_only_its_own_type(spark, table):
    options = table(
        "system_option", {"type_option": "a", "option_value": "1", "option_name": "A1"},
        {"type_option": "b", "option_value": "1", "option_name": "B1"},
    )
    df = spark.createDataFrame([("1",), ("2",), (None,)], "code string")
    assert rows(e.decode_option(df, "code", options, "a", "label"), "code", "label") == [("1", "A1"), ("2", None), (None, None)]


def test_lookup_does_not_multiply_unless_asked(spark):
    df = spark.createDataFrame([("x",), ("y",)], "k string")
    master = spark.createDataFrame([("x", 2), ("x", 1)], "id string, v long")
    assert rows(e.lookup(df, master, {"k": "id"}, {"v": "v"}), "k", "v") == [("x", 1), ("y", None)]
    assert e.lookup(df, master, {"k": "id"}, {"v": "v"}, unique=False).count() == 3
    assert rows(e.lookup(df, master, {"k": "id"}, {"v": "v"}, how="inner"), "k", "v") == [("x", 1)]


def test_lookback_keeps_left_rows(spark, table):
    left = spark.createDataFrame([("a",), ("b",)], "k string")
    right = table(
        "waybill_problem_piece", {"waybill_no": "a", "operation_time": utc("2024-01-08 17:00:00"), "deleted": "0"},
        {"waybill_no": "b", "operation_time": utc("2024-01-08 16:59:59"), "deleted": "0"},
        {"waybill_no": "a", "operation_time": utc("2024-01-09 00:00:00"), "deleted": "1"},
    )
    got = e.lookback_left_join(left, right, {"k": "waybill_no"}, "operation_time", 1, AsOf(datetime(2024, 1, 10)), F.col("deleted") == "0")
    assert rows(got, "k", "waybill_no") == [("a", "a"), ("b", None)]


def test_scans_before_return_boundary(spark):
    scans = spark.createDataFrame([("w", 1), ("w", 2), ("w", 3), ("v", 1)], "waybill_no string, record_time long")
    returns = spark.createDataFrame([("w", 2), ("w", 1), ("v", None)], "waybill_no string, return_confirm_record_time long")
    cols = ("waybill_no", "record_time", "return_confirm_record_time")
    assert rows(e.scans_before_return(scans, returns), *cols) == [("v", 1, None), ("w", 1, 2), ("w", 2, None), ("w", 3, None)]
    assert rows(e.scans_before_return(scans, returns, inclusive=True), *cols)[2] == ("w", 2, 2)


def test_exclude_and_require(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "waybill_no string")
    other = spark.createDataFrame([("a", 1)], "waybill_no string, n long")
    assert rows(e.exclude_matched(df, other), "waybill_no") == [("b",), (None,)]
    assert rows(e.require_match(df, other), "waybill_no", "n") == [("a", 1)]


def test_flag_exists(spark):
    df = spark.createDataFrame([("a",), ("b",), ("c",)], "waybill_no string")
    problems = spark.createDataFrame([("a", "x"), ("a", "y"), ("b", "z"), ("b", None)], "waybill_no string, problem_reason string")
    got = e.flag_exists(df, problems, {"one": ("x", "q"), "two": ("y",)})
    assert rows(got, "waybill_no", "one", "two") == [("a", "Yes", "Yes"), ("b", "No", "No"), ("c", "No", "No")]


def test_hub_names_have_a_fixed_gateway(spark, table):
    hubs = table("a_mh_facility_name_rnd", {"mh_code": "SUB", "mh_name": "MH SURABAYA"}, {"mh_code": "CGK", "mh_name": "other"})
    sheet = spark.createDataFrame([("CGK", "SUB"), ("SUB", "XXX")], "origin string, destination_by_issued string")
    got = e.hub_names(sheet, hubs)
    assert rows(got, "mh_sending_join", "mh_arrival_join") == [("MH JAKARTA", "MH SURABAYA"), ("MH SURABAYA", None)]


def test_courier_profile(spark, table):
    users = table(
        "res_user", {"id": 1, "personnel_no": "P1", "enabled": "0", "deleted": "0"},
        {"id": 2, "personnel_no": "P2", "enabled": "1", "deleted": "0"}, {"id": 3, "personnel_no": "P3", "enabled": "1", "deleted": "1"},
    )
    df = spark.createDataFrame([(1, 2), (1, 1), (3, 3), (2, None)], "order_courier_id long, pickup_courier_id long")
    got = e.courier_profile(df, users)
    assert rows(got, "order_courier_id", "pickup_courier_id", "personnel_no", "courier_status") == [
        (1, 1, "P1", "inactive"), (1, 2, "P1", "active"), (2, None, "P2", "active"), (3, 3, None, "inactive"),
    ]


def test_branch_region_reads_one_province_per_city(spark, table):
    branches = table("res_branch", {"id": 1, "branch_no": "B1", "branch_level": "9", "city_id": 7})
    areas = table("res_area", {"city_id": 7, "province_name": "BANTEN"}, {"city_id": 7, "province_name": "BANTEN"})
    options = table("system_option", {"type_option": "branchLevel", "option_value": "9", "option_name": "TH"})
    offices = table("mapping_kanwil_area", {"province_name": "BANTEN", "kanwil_name": "JABODETABEK"})
    df = spark.createDataFrame([(1,), (2,)], "branch_id long")
    got = by(e.branch_region(df, "branch_id", branches, areas, options, offices), "branch_id")
    assert (got[1].branch_no, got[1].branch_level, got[1].province_name, got[1].kanwil_name) == ("B1", "TH", "BANTEN", "Tangerang")
    assert got[2].kanwil_name is None


def test_manifest_match_keeps_unmatched_sheet_rows(spark):
    sheet = spark.createDataFrame([("B1", "V1"), ("B2", "V1"), (None, "V1")], "bm_code string, vm_code string")
    bags = spark.createDataFrame([("B1", "V1", 2), (None, "V1", 3)], "bag_no string, vehicle_tag_no string, n long")
    assert rows(e.manifest_match(sheet, bags), "bm_code", "n") == [("B1", 2), ("B2", None), (None, None)]


def test_rollups(spark):
    df = spark.createDataFrame([("a", "w1", 1), ("a", None, 2), ("b", "w2", 3)], "k string, waybill_no string, fee long")
    assert rows(u.volume_by_period(df, ["k"], "waybill_no", "fee"), "k", "total_volume", "fee") == [("a", 1, 3), ("b", 1, 3)]
    assert rows(u.bag_totals(df, ["k"], ["fee"]), "k", "fee") == [("a", 3), ("b", 3)]
    tasks = spark.createDataFrame(
        [(1, "w1", "s", "e", 1, 0), (1, "w1", "s", "e", 1, 0)], "c long, waybill_no string, waybill_source string, express_type string, pickup long, pod long"
    )
    pods = spark.createDataFrame([(1, "w1", "s", "e", 0, 1)], tasks.schema)
    assert rows(u.courier_tasks(tasks, pods, ["c"]), "c", "pickup", "pod") == [(1, 2, 1)]
    listed = rows(u.courier_task_list(tasks, pods, ["c"]), "c", "waybill_no_pickup", "waybill_no_pod", "express_type_pod")
    assert listed == [(1, "w1", None, None), (1, None, "w1", "e")]
