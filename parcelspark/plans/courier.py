"""Courier incentives: counts per courier and day, and the task list behind them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.classify import courier_fallback, courier_status, task_type
from parcelspark.functions.timeops import AsOf, day_start, joined_key, local_time, rolling_window
from parcelspark.operators.enrich import branch_region, decode_option, lookup
from parcelspark.operators.records import latest_record
from parcelspark.operators.rollups import courier_task_list, courier_tasks
from parcelspark.sources.tables import Tables

AGG_KEYS = (
    "personnel_no", "courier_id", "courier_name", "tgl_tugas", "branch_no", "branch_name", "kanwil_name",
    "work_location", "branch_level", "courier_status", "enabled", "waybill_source", "express_type",
)
LIST_KEYS = (
    "courier_id", "personnel_no", "courier_name", "courier_status", "branch_no", "branch_name",
    "district_name", "city_name", "province_name", "kanwil_name", "work_location", "enabled", "branch_level",
    "tgl_tugas",
)


def _described(tables: Tables, tasks: DataFrame, as_of: AsOf) -> DataFrame:
    """Labels, branch region and courier of tasks with courier_id, branch_id, task_time."""
    options = tables["system_option"]
    tasks = decode_option(tasks, "source_code", options, "waybillSource", "waybill_source")
    tasks = decode_option(tasks, "express_code", options, "expressType", "express_type")
    tasks = branch_region(
        tasks, "branch_id", tables["res_branch"], tables["res_area"], options, tables["mapping_kanwil_area"]
    )
    users = tables["res_user"].where(F.col("deleted") == "0")
    tasks = lookup(
        tasks, users, {"courier_id": "id"}, {"personnel_no": "personnel_no", "enabled": "enabled"}, unique=False
    )
    office = F.concat(F.col("kanwil_name"), F.lit(" "), F.col("branch_name"))
    return tasks.withColumns(
        {
            "courier_status": courier_status(F.col("enabled")),
            "work_location": joined_key(F.col("branch_no"), office),
            "tgl_tugas": day_start(local_time(F.col("task_time"), as_of.tz)),
        }
    )


def _pickups(tables: Tables, as_of: AsOf, days: int, order_days: int) -> DataFrame:
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = waybills.where((F.col("void_flag") == "0") & (F.col("deleted") == "0")).select(
        "waybill_no", "update_time", "pickup_courier_id", "pickup_courier_name",
        F.col("waybill_source").alias("source_code"), F.col("express_type").alias("express_code"),
        F.col("pickup_branch_id").alias("branch_id"), F.col("pickup_branch_name").alias("branch_name"),
        F.col("sender_district_name").alias("district_name"), F.col("sender_city_name").alias("city_name"),
        F.col("shipping_time").alias("task_time"),
    )
    newest = latest_record(waybills, "waybill_no", "update_time").drop("update_time")
    orders = rolling_window(tables["order_order"], "input_time", order_days, as_of).select(
        "waybill_no", "input_time", F.col("pickup_courier_id").alias("order_courier_id"),
        F.col("pickup_courier_name").alias("order_courier_name"),
    )
    orders = latest_record(orders, "waybill_no", "input_time").drop("input_time")
    courier = courier_fallback(
        F.col("pickup_courier_id"), F.col("pickup_courier_name"), F.col("order_courier_id"), F.col("order_courier_name")
    )
    tasks = newest.join(orders, "waybill_no", "left").withColumns(
        {
            **courier,
            "pickup": task_type(F.col("waybill_no"), "Pickup")["task_count"],
            "pod": F.when(F.col("waybill_no").isNotNull(), F.lit(0).cast("bigint")),
        }
    )
    return _described(tables, tasks, as_of)


def _deliveries(tables: Tables, as_of: AsOf, days: int) -> DataFrame:
    waybills = rolling_window(tables["dm_waybill_waybill"], "update_time", days, as_of)
    waybills = rolling_window(waybills, "pod_record_time", days, as_of)
    waybills = waybills.where(F.col("deleted") == "0").select(
        "waybill_no", "update_time", F.col("pod_courier_id").alias("courier_id"),
        F.col("pod_courier_name").alias("courier_name"), F.col("waybill_source").alias("source_code"),
        F.col("express_type").alias("express_code"), F.col("pod_branch_id").alias("branch_id"),
        F.col("pod_branch_name").alias("branch_name"), F.col("recipient_district_name").alias("district_name"),
        F.col("recipient_city_name").alias("city_name"), F.col("pod_record_time").alias("task_time"),
    )
    newest = latest_record(waybills, "waybill_no", "update_time").drop("update_time")
    tasks = newest.withColumns(
        {
            "pickup": F.when(F.col("waybill_no").isNotNull(), F.lit(0).cast("bigint")),
            "pod": task_type(F.col("task_time"), "POD")["task_count"],
        }
    )
    return _described(tables, tasks, as_of)


def courier_incentive_agg(tables: Tables, as_of: AsOf, *, days: int = 76, order_days: int = 186) -> DataFrame:
    """Pickups and deliveries per courier, day, branch, source and express type."""
    return courier_tasks(_pickups(tables, as_of, days, order_days), _deliveries(tables, as_of, days), AGG_KEYS)


def courier_incentive_raw(tables: Tables, as_of: AsOf, *, days: int = 35, order_days: int = 93) -> DataFrame:
    """One row per task, with the parcel in pickup or in delivery columns."""
    return courier_task_list(_pickups(tables, as_of, days, order_days), _deliveries(tables, as_of, days), LIST_KEYS)
