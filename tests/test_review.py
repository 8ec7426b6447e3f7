"""Row counts, plans and fixed lists: one row per parcel, logs cut to the spine, sessions and sheets that are refused."""

from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from conftest import by, utc
from parcelspark.functions import rules
from parcelspark.operators.enrich import decode_option, of_spine
from parcelspark.operators.records import one_record, transport_label
from parcelspark.operators.rollups import TASK_FIELDS, courier_task_list
from parcelspark.plans import cargo, claims, leadtime
from parcelspark.sources.schemas import schema
from parcelspark.sources.tables import catalog_tables, parquet_tables, read_sheet, write_report
from test_jobs import AS_OF, option, scan, waybill


def test_claims_show_the_largest_label_of_the_newest_scan_and_one_row(carrier):
    tables = carrier(
        waybill_waybill=[waybill("a", waybill_source="E"), waybill("z", waybill_source="X")],
        waybill_waybill_line=[
            scan("a", "2024-04-05 10:00:00", "04"), scan("a", "2024-04-05 10:00:00", "18"), scan("a", "2024-04-05 10:00:00", "77"),
            scan("z", "2024-04-06 10:00:00", "04"),
        ],
        system_option=[
            option("waybillSource", "E", "everpro"), option("voidFlag", "0", "Not void"), option("voidFlag", "0", "Active"),
            option("operationType", "04", "Sending scan"), option("operationType", "18", "Problem scan"),
        ],
    )
    rows = by(claims.everpro_claims(tables, AS_OF), "waybill_no")
    assert set(rows) == {"a"}
    assert rows["a"].last_activity == "Sending scan" and rows["a"].void_status == "Not void"


def test_repeated_codes_multiply_rows_only_where_asked(spark):
    df = spark.createDataFrame([("0",), ("9",)], "code string")
    options = spark.createDataFrame([("k", "0", "a"), ("k", "0", "b")], "type_option string, option_value string, option_name string")
    assert sorted(map(tuple, decode_option(df, "code", options, "k", "out").collect()), key=str) == [("0", "b"), ("9", None)]
    assert decode_option(df, "code", options, "k", "out", unique=False).count() == 3


def test_any_record_prefers_filled_values(spark):
    df = spark.createDataFrame([("k", None, 1), ("k", "v", 2)], "k string, v string, n int")
    assert one_record(df, "k").first().v == "v"


def test_labels_survive_scans_without_a_bag(spark):
    rows = [("w1", None, None, 1), ("w1", "V", "B", 2), ("w2", None, "B", 1), ("w3", "V", None, 1)]
    df = spark.createDataFrame(rows, "waybill_no string, vehicle_tag_no string, bag_no string, n int")
    found = transport_label(df).collect()
    assert sorted(r.vm_bm_awb or "" for r in found) == ["", "V - B - w1"]


def test_task_list_has_no_exchange_of_its_own(spark):
    keys = ["courier_id"]
    cols = [*keys, *TASK_FIELDS]
    tasks = spark.range(10).select(*(F.col("id").cast("string").alias(c) for c in cols)).repartition(4, "waybill_no")
    plan = courier_task_list(tasks, tasks, keys)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == plan.count("REPARTITION_BY_NUM") == 2


def test_logs_are_cut_to_the_spine_before_they_travel(spark, tmp_path):
    log = spark.range(10_000).select((F.col("id") % 1000).cast("string").alias("waybill_no"), F.col("id").alias("n"))
    log.write.parquet(str(tmp_path / "log"))
    spine = spark.range(10).select(F.col("id").cast("string").alias("waybill_no"))
    cut = of_spine(spark.read.parquet(str(tmp_path / "log")), spine).groupBy("waybill_no").agg(F.collect_list("n").alias("n"))
    assert cut.count() == 10
    plan = cut._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Aggregate") < plan.index("LeftSemi")


def test_leadtime_leaves_return_bills_out(carrier):
    bills = [{"waybill_no": "a", "return_confirm_record_time": utc(f"2024-04-0{day} 00:00:00"), "deleted": "0"} for day in (8, 9)]
    parcels = [{"waybill_no": "a", "input_time": datetime(2024, 4, 1, 8)}]
    scans = [
        scan("a", "2024-04-01 10:00:00", "04", "TH A"), scan("a", "2024-04-01 12:00:00", "05", "MH B"),
        scan("b", "2024-04-01 12:00:00", "05", "MH C"),
    ]
    options = [option("operationType", "04", "Sending scan"), option("operationType", "05", "Arrival scan")]
    without, with_bills = (
        leadtime.tokopedia_leadtime(
            carrier(dashboard_tokopedia=parcels, dm_waybill_waybill_line=scans, system_option=options, waybill_return_bill=b), AS_OF
        ).collect()
        for b in ([], bills)
    )
    assert without == with_bills and len(without) == 1 and without[0].mh_ori_arrival == "MH B"


def test_stage_tables_are_written_and_read_again(carrier, spark, tmp_path):
    line = dict(report_date="04/02/2024", origin="CGK", destination_by_issued="SUB", bm_code="B1", vm_code="V1")
    tables = carrier(
        smu_template_2=[line], a_mh_facility_name_rnd=[{"mh_code": "SUB", "mh_name": "MH SURABAYA"}],
        waybill_waybill=[waybill("a")],
        waybill_waybill_line=[scan("a", "2024-04-02 10:00:00", "04", "MH JAKARTA", bag_no="B1", vehicle_tag_no="V1")],
    )
    first, last = date(2024, 1, 1), date(2024, 12, 31)
    dates = dict(scans_from=first, scans_to=last, sending_from=first, waybills_from=first, waybills_to=last)
    stages = {"hubs": cargo.smu_hub_names(tables), "system": cargo.smu_system(tables, AS_OF, **dates)}
    read = {}
    for name, df in stages.items():
        write_report(df, str(tmp_path / name))
        read[name] = spark.read.parquet(str(tmp_path / name))
        assert [(f.name, f.dataType) for f in read[name].schema] == [(f.name, f.dataType) for f in df.schema]
    bags = cargo.smu_bag_level(read["hubs"], read["system"]).collect()
    assert len(bags) == 1 and bags[0].bag_no == "B1" and bags[0].mh_arrival == "MH SURABAYA"
    assert cargo.smu_waybill_level(tables, read["system"]).collect()[0].waybill_no == "a"


def test_catalog_tables(spark):
    spark.createDataFrame([("0", "E")], "mh_code string, mh_name string").createOrReplaceTempView("hub_view")
    spark.sql("CREATE DATABASE IF NOT EXISTS carrier_marts")
    spark.sql("CREATE OR REPLACE VIEW carrier_marts.hubs AS SELECT 'H1' AS mh_code, 'MH 1' AS mh_name")
    try:
        assert catalog_tables(spark, "carrier_marts", ["hubs"])["hubs"].first().mh_name == "MH 1"
    finally:
        spark.sql("DROP VIEW carrier_marts.hubs")
        spark.sql("DROP DATABASE carrier_marts")


def test_sessions_that_are_not_utc_are_refused(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.session.timeZone", "Asia/Jakarta")
    with pytest.raises(ValueError):
        parquet_tables(other, str(tmp_path), ["order_order"])
    with pytest.raises(ValueError):
        catalog_tables(other, "x", ["order_order"])


@pytest.mark.parametrize("line", ["07/15/2023,CGK,SUB,DPS,three,12.5,BM1,VM1,JAWA,SMU1,100.25,FL1,AIR,V1", "07/15/2023,CGK,SUB"])
def test_malformed_sheets_are_refused(spark, tmp_path, line):
    (tmp_path / "sheet.csv").write_text(",".join(schema("smu_template_2").names) + "\n" + line + "\n")
    with pytest.raises(Exception):
        read_sheet(spark, str(tmp_path / "sheet.csv")).collect()


def test_fixed_lists_hold_what_they_should():
    lists = {
        "SENDER_SIDE_REASONS": (16, "Paket dikirim via ekspedisi lain"),
        "SENDER_SIDE_FACTOR_REASONS": (15, "Paket dikirim via ekspedisi lain"),
        "CARRIER_REASONS": (18, "Paket akan diproses dengan nomor resi yang baru"),
        "RECIPIENT_REASONS": (23, "Pengiriman akan menggunakan ekspedisi lain"),
        "EXTERNAL_REASONS": (11, "Paket ditolak oleh bea cukai (red line)"),
    }
    for name, (size, member) in lists.items():
        found = getattr(rules, name)
        assert len(found) == len(set(found)) == size and member in found, name
    assert rules.HUB_PREFIXES == ("MH", "DC") and rules.LAST_MILE_PREFIXES == ("TH", "VH", "VT", "PD")
    assert rules.LOST_REASONS == ("Paket hilang atau tidak ditemukan",) and rules.FOUND_REASONS == ("Paket hilang ditemukan",)
    assert rules.MENGANTAR_SOURCE_CODES == ("753", "796") and rules.BLIBLI_SOURCES == ("Blibli", "Blibli API")
    assert rules.ZALORA_SOURCES == ("pt fashion eservices indonesia", "pt fashion marketplace indonesia")
