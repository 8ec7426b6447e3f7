"""Lead time by leg, and parcels handed to an outside carrier."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import (
    CLAMPED_LEGS, city_zone, first_mile_repair, is_hub, is_last_mile, leg_clamp, leg_leadtimes,
)
from parcelspark.functions.timeops import AsOf, local_time, rolling_window
from parcelspark.operators.enrich import decode_option, latest_status_join, of_spine
from parcelspark.operators.records import first_value, latest_value, scan_neighbours
from parcelspark.operators.skew import HOT_ROWS, left_join
from parcelspark.sources.tables import Tables


def tokopedia_leadtime(tables: Tables, as_of: AsOf, *, days: int = 35, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Seconds per leg from pickup request to delivery.

    Rows are not reduced: an order or last-mile record that occurs twice shows twice. The three picks
    from the scan log are one aggregate over the windowed scans, on the partitioning the window made.
    Return bills are not joined: reduced to one per parcel they add no row and no column, and unreduced they
    would put a scan in front of itself. Only scans of the shown parcels are windowed. Orders and last-mile records of
    a parcel with more than ``hot_rows`` of them are spread over many tasks.
    """
    options = tables["system_option"]
    parcels = rolling_window(tables["dashboard_tokopedia"], "input_time", days, as_of, tz=None)
    orders = rolling_window(tables["order_order"], "input_time", days, as_of).select(
        "waybill_no", F.col("order_source").alias("_source"), F.col("service_type").alias("_service"), "sender_name"
    )

    scans = rolling_window(tables["dm_waybill_waybill_line"], "record_time", days, as_of)
    scans = scans.where(F.col("deleted") == "0").select("waybill_no", "record_time", "operation_branch_name", "operation_type")
    scans = of_spine(scans, parcels)
    scans = decode_option(scans, "operation_type", options, "operationType", "scan_type", unique=False).drop("operation_type")
    walked = scan_neighbours(scans, "waybill_no", "record_time", "operation_branch_name", "scan_type", hot_rows=hot_rows)

    stop, before, after = (F.col(c) for c in ("operation_branch_name", "previous_branch_name", "next_location_name"))
    sending, arrival = F.col("scan_type") == rules.LABEL_SENDING, F.col("scan_type") == rules.LABEL_ARRIVAL
    to_hub = sending & is_hub(after)
    hub_in = arrival & is_hub(stop) & (is_last_mile(before) | F.col("previous_branch_name").startswith("MH"))
    hub_out = sending & is_hub(stop) & is_last_mile(after)
    picks = walked.where(to_hub | hub_in | hub_out).groupBy("waybill_no").agg(
        first_value("record_time", "operation_branch_name", to_hub).alias("sending_branch"),
        first_value("record_time", "record_time", to_hub).alias("sending_time"),
        first_value("record_time", "operation_branch_name", hub_in).alias("mh_arrival"),
        first_value("record_time", "record_time", hub_in).alias("mh_arrival_time"),
        first_value("record_time", "previous_branch_name", hub_in).alias("previous_branch_name_arr_fm"),
        first_value("record_time", "previous_scan_time", hub_in).alias("previous_scan_time_arr_fm"),
        latest_value("record_time", "operation_branch_name", hub_out).alias("mh_sending_branch"),
        latest_value("record_time", "record_time", hub_out).alias("sending_time_to_th_dest"),
    )
    last_mile = tables["dashboard_productivity_lm"].select(
        "waybill_no", F.col("arrival_time").alias("arrival_time_dest"), "th_arrival"
    )
    rows = first_mile_repair(latest_status_join(parcels, orders, last_mile, picks, unreduced=(0, 1), hot_rows=hot_rows))
    rows = decode_option(rows, "_source", options, "orderSource", "order_source", unique=False)
    rows = decode_option(rows, "_service", options, "serviceType", "service_type", unique=False)
    scan_times = ("fm_sending_time", "mh_ori_arrival_time", "sending_time_to_th_dest")
    rows = rows.withColumns({name: local_time(F.col(name), as_of.tz) for name in scan_times})
    legs = leg_leadtimes(
        *[F.col(c) for c in ("request_pickup_time", "pickup_record_time", *scan_times, "arrival_time_dest", "delivered_time")]
    )
    return rows.select(
        "waybill_no", "ecommerce_order_no", "order_no", "order_source", "sender_name", "input_time",
        "request_pickup_time", "service_type", "origin_province", "origin_city", "scheduling_or_pickup_branch",
        "pickup_record_time", "delivery_type", "role_miles", "destination_province", "destination_city",
        "route_category",
        city_zone(None, F.col("origin_city"), "leadtime").alias("origin_area"),
        city_zone(None, F.col("destination_city"), "leadtime").alias("destination_area"),
        "delivery_or_pod_branch", "waybill_status", "fm_sending_branch", "fm_sending_time", "mh_ori_arrival",
        "mh_ori_arrival_time", "mh_sending_branch", "sending_time_to_th_dest", "arrival_time_dest", "th_arrival",
        "delivered_time",
        *[(leg_clamp(leg) if name in CLAMPED_LEGS else leg).alias(name) for name, leg in legs.items()],
    )


def sent_to_3pl(
    tables: Tables, as_of: AsOf, *, days: int = 35, waybill_days: int = 65, hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Parcels handed to an outside carrier, with their last hub arrival and unloading.

    Hand-over, arrival and unloading come from one aggregate over the scan log. The waybill side keeps
    every version, so a parcel with two versions shows twice; one with more than ``hot_rows`` is spread over many tasks.
    """
    scans = rolling_window(tables["dm_waybill_waybill_line"], "record_time", days, as_of)
    scans = scans.where(F.col("deleted") == "0").select(
        "waybill_no", "record_time", "operation_branch_name", "operation_type", "next_location_name"
    )
    scans = decode_option(scans, "operation_type", tables["system_option"], "operationType", "scan_type", unique=False)
    handed = F.col("next_location_name") == rules.OUTSIDE_CARRIER
    at_hub = is_hub(F.col("operation_branch_name"))
    arrival = at_hub & (F.col("scan_type") == rules.LABEL_ARRIVAL)
    unloading = at_hub & (F.col("scan_type") == rules.LABEL_UNLOADING)
    handovers = (
        scans.where(handed | arrival | unloading)
        .groupBy("waybill_no")
        .agg(
            F.max(F.when(handed, F.col("record_time"))).alias("handed_time"),
            latest_value("record_time", "operation_branch_name", handed).alias("operation_branch_name"),
            latest_value("record_time", "next_location_name", handed).alias("next_location"),
            F.max(F.when(arrival, F.col("record_time"))).alias("arrived"),
            F.max(F.when(unloading, F.col("record_time"))).alias("unloaded"),
        )
        .where(F.col("next_location").isNotNull())
    )
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", waybill_days, as_of).select(
        "waybill_no", "order_no", "pickup_branch_name", "sender_district_name", "sender_city_name",
        "sender_province_name", "shipping_time", "recipient_district_name", "recipient_city_name",
        "recipient_province_name", "pod_record_time", "item_calculated_weight",
    )

    def local(name: str, out: str):
        return local_time(F.col(name), as_of.tz).alias(out)

    return left_join(handovers, waybills, "waybill_no", hot_rows).select(
        "waybill_no", "order_no", "operation_branch_name", "next_location",
        local("arrived", "arrival_time_branch"), local("unloaded", "unloading_time_branch"),
        local("handed_time", "sending_time_to_3pl"),
        "pickup_branch_name", "sender_district_name", "sender_city_name", "sender_province_name",
        local("shipping_time", "pickup_time"),
        "recipient_district_name", "recipient_city_name", "recipient_province_name",
        local("pod_record_time", "pod_record_time"),
        "item_calculated_weight",
    )
