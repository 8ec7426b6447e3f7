"""Bags and air cargo: waybill bag info, system bags, and the hand-kept consignment sheet against them."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import destination_branch
from parcelspark.functions.timeops import (
    AsOf, fixed_window, joined_key, local_date, local_time, parse_us_date, rolling_window, since,
)
from parcelspark.operators.enrich import decode_option, hub_names, manifest_match
from parcelspark.operators.records import latest_record, transport_label
from parcelspark.operators.rollups import bag_totals
from parcelspark.operators.skew import HOT_ROWS
from parcelspark.sources import stages
from parcelspark.sources.stages import Stage
from parcelspark.sources.tables import Tables

SHEET_COLUMNS = (
    "report_date", "origin", "destination_by_bagging", "destination_by_issued", "no_of_packages", "smu_weight",
    "bm_code", "vm_code", "area_pulau", "smu_booking_code", "total_smu_fee", "flight_no", "airlanes", "vendor",
)
# Keys of the stage table of system bags, and the sheet's names for them.
STAGE_KEYS = ("bag_no", "vehicle_tag_no")
_SHEET_KEYS = {"bm_code": "bag_no", "vm_code": "vehicle_tag_no"}
BAG_MEASURES = (
    "standard_shipping_fee", "handling_fee", "other_fee", "insurance_amount", "total_shipping_fee", "system_sf",
    "system_weight",
)


def waybill_bag_info(tables: Tables, as_of: AsOf, *, days: int = 35) -> DataFrame:
    """Bag and vehicle of each waybill with the order facts."""
    scans = rolling_window(tables["waybill_waybill_line"], "record_time", days, as_of)
    labels = transport_label(scans.select("vehicle_tag_no", "bag_no", "waybill_no", "record_time"))
    orders = tables["dashboard_bd_order_all_status"].select(
        "waybill_no", "kota_asal", "kec_asal", "kota_tujuan", "berat",
        F.col("biaya_standar_pengiriman").alias("standard_shipping_fee"),
        F.col("tipe_ekspress").alias("express_type"), "tujuan_kec", "order_no",
    )
    return labels.join(orders, "waybill_no", "left").select(
        local_time(F.col("record_time"), as_of.tz).alias("record_time"),
        "bag_no", "waybill_no", "kota_asal", "kec_asal", "kota_tujuan", "berat", "standard_shipping_fee",
        "express_type", "vehicle_tag_no", "tujuan_kec", "order_no", "vm_bm_awb",
    )


def _sheet(tables: Tables) -> DataFrame:
    sheet = tables["smu_template_2"].select(*SHEET_COLUMNS)
    return sheet.withColumns(
        {
            "report_date": parse_us_date(F.col("report_date")),
            "bm_vm_gsheet": joined_key(F.col("bm_code"), F.col("vm_code")),
        }
    )


def smu_hub_names(tables: Tables) -> DataFrame:
    """The consignment sheet with parsed dates and the hub names of both ends."""
    return hub_names(_sheet(tables), tables["a_mh_facility_name_rnd"])


# The report's columns in order. Rows of one lane share most of their texts, and most of all with its branches and days,
# so next to one another they compress best.
_SYSTEM_COLUMNS = (
    "bm_vm_awb", "bm_vm_concat", "bag_no", "vehicle_tag_no", "waybill_no", "shipping_time", "express_type", "record_time",
    "standard_shipping_fee", "handling_fee", "other_fee", "insurance_amount", "total_shipping_fee", "system_weight",
    "system_sf", "sender_province_name", "sender_city_name", "sender_district_name", "pickup_branch_name",
    "recipient_province_name", "recipient_city_name", "recipient_district_name", "pod_branch_name", "pod_record_time",
    "return_flag", "return_pod_record_time", "return_pod_branch_name", "pod_or_return_pod_branch", "mh_sending", "mh_arrival",
)
_LANE = (
    "sender_city_name", "sender_district_name", "recipient_city_name", "recipient_district_name", "pickup_branch_name",
    "pod_branch_name", "shipping_time",
)


def _derived() -> dict[str, Column]:
    """Columns of the report that others of the same row give. They are made after a shuffle, not moved by it."""
    bag, vehicle = F.col("bag_no"), F.col("vehicle_tag_no")
    pod, returned = F.col("pod_record_time").isNotNull(), F.col("return_pod_record_time").isNotNull()
    return {
        "bm_vm_awb": joined_key(bag, vehicle, F.col("waybill_no")),
        "bm_vm_concat": joined_key(bag, vehicle),
        "system_sf": F.col("standard_shipping_fee") + F.col("handling_fee"),
        "pod_or_return_pod_branch": destination_branch(
            (pod, F.col("pod_branch_name")), (returned, F.col("return_pod_branch_name"))
        ),
    }


def smu_system(
    tables: Tables,
    as_of: AsOf,
    *,
    scans_from: date = date(2023, 7, 1),
    scans_to: date = date(2023, 7, 31),
    sending_from: date = date(2023, 6, 1),
    waybills_from: date = date(2023, 4, 1),
    waybills_to: date = date(2023, 8, 16),
) -> DataFrame:
    """Parcels per bag and vehicle with fees, sending hub and arrival hub; one row per bag, vehicle, waybill.

    Membership, sending hub and arrival hub come from one aggregate over the scan log, where three joined
    copies of it would do the same. Where several scans qualify, the smallest date and hub names are taken.
    Scans are shuffled once, by the waybill: that serves the aggregate and the join with the waybills.
    """
    scans = tables["waybill_waybill_line"]
    scans = fixed_window(scans, "record_time", min(sending_from, scans_from), scans_to)
    scans = scans.where(F.col("bag_no").isNotNull() & F.col("vehicle_tag_no").isNotNull() & F.col("waybill_no").isNotNull())
    member = since(scans, "record_time", scans_from, None)
    at_hub = F.col("operation_branch_name").contains("MH")
    sent = at_hub & (F.col("operation_type") == rules.SCAN_SENDING) & since(scans, "record_time", sending_from, None)
    arrived = at_hub & (F.col("operation_type") == rules.SCAN_ARRIVAL) & member
    bags = (
        scans.where(F.col("bag_no") != "")
        .select(
            "bag_no", "vehicle_tag_no", "waybill_no",
            F.when(member, F.col("record_time")).alias("record_time"),
            F.when(sent, F.col("operation_branch_name")).alias("mh_sending"),
            F.when(arrived, F.col("operation_branch_name")).alias("mh_arrival"),
        )
        .repartition("waybill_no")
        .groupBy("bag_no", "vehicle_tag_no", "waybill_no")
        .agg(
            F.min("record_time").alias("record_time"),
            F.min("mh_sending").alias("mh_sending"),
            F.min("mh_arrival").alias("mh_arrival"),
        )
        .where(F.col("record_time").isNotNull())
    )

    options = tables["system_option"]
    waybills = fixed_window(tables["waybill_waybill"], "shipping_time", waybills_from, waybills_to)
    waybills = waybills.where((F.col("void_flag") == "0") & (F.col("deleted") == "0")).select(
        "waybill_no", "update_time", "shipping_time", F.col("express_type").alias("_express"),
        F.col("return_flag").alias("_return"), "standard_shipping_fee", "handling_fee", "other_fee",
        "insurance_amount", "total_shipping_fee", "item_calculated_weight", "sender_province_name",
        "sender_city_name", "sender_district_name", "pickup_branch_name", "recipient_province_name",
        "recipient_city_name", "recipient_district_name", "pod_branch_name", "pod_record_time",
        "return_pod_record_time", "return_pod_branch_name",
    )
    rows = bags.join(latest_record(waybills, "waybill_no", "update_time"), "waybill_no", "inner")
    rows = decode_option(rows, "_express", options, "expressType", "express_type")
    rows = decode_option(rows, "_return", options, "returnFlag", "return_flag")
    return rows.select(
        "bag_no", "vehicle_tag_no", "waybill_no",
        local_date(F.col("shipping_time"), as_of.tz).alias("shipping_time"),
        "express_type",
        local_date(F.col("record_time"), as_of.tz).alias("record_time"),
        "standard_shipping_fee", "handling_fee", "other_fee", "insurance_amount", "total_shipping_fee",
        F.col("item_calculated_weight").cast("decimal(38,9)").alias("system_weight"),
        "sender_province_name", "sender_city_name", "sender_district_name", "pickup_branch_name",
        "recipient_province_name", "recipient_city_name", "recipient_district_name", "pod_branch_name",
        local_date(F.col("pod_record_time"), as_of.tz).alias("pod_record_time"),
        "return_flag",
        local_date(F.col("return_pod_record_time"), as_of.tz).alias("return_pod_record_time"),
        "return_pod_branch_name", "mh_sending", "mh_arrival",
    ).withColumns(_derived()).select(*_SYSTEM_COLUMNS)


def stage_system(system: DataFrame, path: str, buckets: int, hot_rows: int = HOT_ROWS) -> Stage:
    """Writes the system bags as a stage bucketed by ``STAGE_KEYS`` and opens it. It holds the columns that the others do
    not give, each task's and each bucket's rows by lane."""
    own = system.drop(*_derived()).sortWithinPartitions(*_LANE)
    written = stages.write_stage(own, path, STAGE_KEYS, buckets, hot_rows, order=_LANE)
    return written.mapped(lambda rows: rows.withColumns(_derived()).select(*_SYSTEM_COLUMNS))


def smu_system_sorted(system: DataFrame) -> DataFrame:
    """The report order of the system bags. Stage tables skip the global sort."""
    ordered = system.drop(*_derived()).orderBy("bag_no", "waybill_no")
    return ordered.withColumns(_derived()).select(*system.columns)


def smu_bag_level(hub_sheet: DataFrame, system: DataFrame | Stage) -> DataFrame:
    """Consignment sheet with the fee and weight totals of its bag, from the two stage tables. A bucketed stage of system
    bags (by ``STAGE_KEYS``) is not shuffled."""

    def totals(rows: DataFrame) -> DataFrame:
        return bag_totals(rows, (*STAGE_KEYS, "bm_vm_concat"), BAG_MEASURES)

    sheet = hub_sheet.withColumnsRenamed({"mh_sending_join": "mh_sending", "mh_arrival_join": "mh_arrival"})
    if isinstance(system, Stage):
        return stages.left_join(sheet, system, _SHEET_KEYS, totals)
    return manifest_match(sheet, totals(system))


_ORIGIN = {"sender_province_name": "origin_province", "sender_city_name": "origin_city", "sender_district_name": "origin_district"}
_DESTINATION = {
    "recipient_province_name": "destination_province", "recipient_city_name": "destination_city",
    "recipient_district_name": "destination_district",
}
_WAYBILL_LEVEL = (
    "bag_no", "vehicle_tag_no", "bm_vm_concat", "waybill_no", "shipping_time", "express_type", "record_time",
    "standard_shipping_fee", "handling_fee", "other_fee", "insurance_amount", "total_shipping_fee", "system_sf",
    "system_weight", *_ORIGIN, "pickup_branch_name", *_DESTINATION, "pod_branch_name", "return_flag",
    "return_pod_branch_name", "pod_or_return_pod_branch",
)


def smu_waybill_level(tables: Tables, system: DataFrame | Stage, *, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Consignment sheet with every waybill of its bag, from the stage table of system bags. The waybills of a bag with
    more than ``hot_rows`` are spread over many tasks. A bucketed stage (by ``STAGE_KEYS``) is not shuffled, and its own
    list of hot bags counts."""

    later = {name: _derived()[name] for name in ("bm_vm_concat", "system_sf")}
    names = [{**_ORIGIN, **_DESTINATION}.get(name, name) for name in _WAYBILL_LEVEL]

    def waybills(rows: DataFrame) -> DataFrame:
        return rows.select(*(c for c in _WAYBILL_LEVEL if c not in later)).withColumnsRenamed({**_ORIGIN, **_DESTINATION})

    sheet = _sheet(tables)
    if isinstance(system, Stage):
        joined = stages.left_join(sheet, system.mapped(waybills), _SHEET_KEYS)
    else:
        joined = manifest_match(sheet, waybills(system), hot_rows=hot_rows)
    return joined.withColumns(later).select(*sheet.columns, *names)
