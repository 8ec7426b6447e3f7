"""Weekly volume: parcels and fees by pickup period, order period and source."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.classify import order_period_fallback
from parcelspark.functions.timeops import AsOf, fixed_window, local_date, month_label, since, sunday_week
from parcelspark.operators.enrich import decode_option
from parcelspark.operators.records import latest_record
from parcelspark.operators.rollups import volume_by_period
from parcelspark.sources.tables import Tables

PERIOD_KEYS = (
    "pickup_date", "month_pickup", "week_pickup", "input_date", "month_order_oo", "month_order",
    "week_order_oo", "week_order", "waybill_source",
)


def weekly_volume(
    tables: Tables, as_of: AsOf, *, start: date = date(2023, 1, 1), orders_start: date = date(2022, 9, 1)
) -> DataFrame:
    waybills = tables["waybill_waybill"].where(F.col("void_flag") == "0")
    waybills = fixed_window(waybills, "shipping_time", start, as_of.local_date, as_of.tz).select(
        "waybill_no", "waybill_source", "standard_shipping_fee", "shipping_time", "update_time"
    )
    newest = latest_record(waybills, "waybill_no", "update_time")

    orders = tables["order_order"]
    ordered = (
        orders.where(since(orders, "input_time", orders_start, as_of.tz))
        .groupBy("waybill_no")
        .agg(F.max("input_time").alias("input_time"))
    )
    day, order_day = local_date(F.col("shipping_time"), as_of.tz), local_date(F.col("input_time"), as_of.tz)
    periods = (
        decode_option(newest.drop("update_time"), "waybill_source", tables["system_option"], "waybillSource", "_label")
        .join(ordered, "waybill_no", "left")
        .select(
            "waybill_no",
            F.col("_label").alias("waybill_source"),
            "standard_shipping_fee",
            day.alias("pickup_date"),
            month_label(day).alias("month_pickup"),
            sunday_week(day).alias("week_pickup"),
            order_period_fallback(order_day, day).alias("input_date"),
            month_label(order_day).alias("month_order_oo"),
            order_period_fallback(month_label(order_day), month_label(day)).alias("month_order"),
            sunday_week(order_day).alias("week_order_oo"),
            order_period_fallback(sunday_week(order_day), sunday_week(day)).alias("week_order"),
        )
    )
    totals = volume_by_period(periods, PERIOD_KEYS, "waybill_no", "standard_shipping_fee")
    return totals.orderBy("pickup_date", "week_pickup", F.col("total_volume").desc())
