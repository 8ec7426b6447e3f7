"""Open work: last-mile backlog and open returns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import (
    ageing_bucket, backlog_flags, days_between_events, return_flags, return_stage,
)
from parcelspark.functions.timeops import AsOf, local_time, rolling_window
from parcelspark.operators.enrich import (
    decode_option, exclude_matched, latest_status_join, lookup, of_spine, require_match,
)
from parcelspark.operators.records import first_values, latest_record, latest_values, one_record
from parcelspark.sources.tables import Tables


def backlog_ops(tables: Tables, as_of: AsOf, *, days: int = 62) -> DataFrame:
    """Parcels waiting at a last-mile branch for more than two days, one row per parcel.

    Parcels handed to an outside carrier, at VIP branches, lost, or without any problem scan are left
    out; the last because "last reason is not lost" is unknown without a reason.
    """
    waiting = tables["dashboard_productivity_lm"].where(F.col("aging_day") > 2).select(
        "waybill_no", "aging_day", "th_arrival", "arrival_time", "pod_time", "return_regist_time"
    )
    recent = rolling_window(waiting, "arrival_time", days, as_of, tz=None)

    scans = rolling_window(tables["waybill_waybill_line"], "record_time", days, as_of)
    deliveries = scans.where(F.col("operation_type") == rules.SCAN_DELIVERY).select(
        "waybill_no", F.col("operation_branch_name").alias("th_arrival"),
        local_time(F.col("record_time"), as_of.tz).alias("scan_time"),
    )
    tried = deliveries.join(recent.select("waybill_no", "th_arrival", "arrival_time"), ["waybill_no", "th_arrival"])
    first_delivery = first_values(
        tried.where(F.col("scan_time") > F.col("arrival_time")), "waybill_no", "scan_time",
        {"first_deliv_attempt": "scan_time"},
    )

    returns = rolling_window(tables["waybill_return_bill"], "return_record_time", days, as_of).select(
        "waybill_no", "update_time", "return_confirm_record_time", "return_pod_record_time"
    )
    newest_return = latest_record(of_spine(returns, recent), "waybill_no", "update_time").drop("update_time")

    outside = rolling_window(tables["dm_waybill_waybill_line"], "record_time", days, as_of).where(
        (F.col("deleted") == "0") & (F.col("next_location_name") == rules.OUTSIDE_CARRIER)
    )
    outside = of_spine(outside.select("waybill_no"), waiting)

    problems = rolling_window(tables["waybill_problem_piece"], "operation_time", days, as_of)
    problems = of_spine(problems.where(F.col("problem_type") != rules.PICKUP_PROBLEM_TYPE), waiting)
    last_problem = latest_values(
        problems, "waybill_no", "operation_time",
        {"last_pos_reason": "problem_reason", "last_pos_attempt": "operation_time"},
    ).where(~F.col("last_pos_reason").isin(*rules.LOST_REASONS))

    spine = one_record(waiting, "waybill_no")
    spine = spine.where(~F.substring("th_arrival", 1, len(rules.VIP_PREFIX)).isin(rules.VIP_PREFIX))
    spine = require_match(exclude_matched(spine, outside), last_problem)
    joined = latest_status_join(spine, first_delivery, newest_return)
    joined = lookup(
        joined, tables["masterdata_facility_to_kanwil"], {"th_arrival": "branch_name"},
        {"kanwil_name": "kanwil_name", "th_arrival_no": "branch_no", "city_name": "city_name",
         "province_name": "province_name"},
    )
    to_delivery = days_between_events(F.col("first_deliv_attempt"), F.col("arrival_time"))
    flags = backlog_flags(F.col("aging_day"), F.col("first_deliv_attempt"), to_delivery, F.col("return_regist_time"))
    return joined.select(
        "waybill_no", "aging_day", "kanwil_name", "th_arrival", "th_arrival_no", "arrival_time", "city_name",
        "province_name", "first_deliv_attempt", to_delivery.alias("arrival_to_deliv_day"), "pod_time",
        "return_regist_time",
        local_time(F.col("return_confirm_record_time"), as_of.tz).alias("return_confirm_record_time"),
        local_time(F.col("return_pod_record_time"), as_of.tz).alias("return_pod_record_time"),
        *[flag.alias(name) for name, flag in flags.items()],
        F.lit(None).cast("string").alias("sending_3pl_status"),
        "last_pos_reason",
        local_time(F.col("last_pos_attempt"), as_of.tz).alias("last_pos_attempt"),
    )


def return_monitoring(tables: Tables, as_of: AsOf, *, days: int = 62) -> DataFrame:
    """Registered returns that have not been handed back yet, with their age per open step."""
    options = tables["system_option"]
    waybills = rolling_window(tables["waybill_waybill"], "update_time", days, as_of)
    waybills = waybills.where((F.col("void_flag") == "0") & (F.col("deleted") == "0")).select(
        "waybill_no", "update_time", "shipping_time", F.col("waybill_source").alias("_source"),
        F.col("parent_shipping_cleint").alias("vip_username"), "sender_name", "sender_cellphone",
        "sender_province_name", "sender_city_name", "sender_district_name", "pickup_branch_name",
        "recipient_district_name", "recipient_city_name", "recipient_province_name",
        F.col("express_type").alias("_express"), F.col("service_type").alias("_service"),
    )
    parcels = latest_record(waybills, "waybill_no", "update_time")

    returns = rolling_window(tables["waybill_return_bill"], "update_time", days, as_of)
    returns = rolling_window(returns, "return_record_time", days, as_of).select(
        "waybill_no", F.col("update_time").alias("return_update"), "return_record_time",
        "return_confirm_record_time", F.col("return_pod_record_time").alias("return_pod"),
        "return_branch_name", "return_type_id", "return_confirm_status", "return_shipping_fee",
    )
    newest = latest_record(returns, "waybill_no", "return_update").where(
        F.col("return_record_time").isNotNull() & F.col("return_pod").isNull()
    )
    rows = require_match(parcels, newest)
    for code, kind, out in (
        ("_source", "waybillSource", "waybill_source"),
        ("_express", "expressType", "express_type"),
        ("_service", "serviceType", "service_type"),
        ("return_confirm_status", "returnConfirmStatus", "_confirm_label"),
    ):
        rows = decode_option(rows, code, options, kind, out)
    rows = lookup(
        rows, tables["mapping_kanwil_area"], {"recipient_province_name": "province_name"},
        {"kanwil_name_regist": "kanwil_name"},
    )
    kinds = tables["return_type"].where(F.col("deleted") == 0)
    rows = lookup(rows, kinds, {"return_type_id": "id"}, {"remarks_return": "return_type"})

    registered, confirmed = (
        local_time(F.col(name), as_of.tz) for name in ("return_record_time", "return_confirm_record_time")
    )
    pod = local_time(F.col("return_pod"), as_of.tz)
    flags = return_flags(registered, confirmed, pod)
    today = F.lit(as_of.utc_date)
    shown = rows.select(
        "waybill_no",
        F.when(F.col("waybill_no").isNotNull(), F.lit(1).cast("bigint")).alias("waybill_alias"),
        local_time(F.col("shipping_time"), as_of.tz).alias("shipping_time"),
        "waybill_source", "vip_username", "sender_name", "sender_cellphone", "sender_province_name",
        "sender_city_name", "sender_district_name", "pickup_branch_name", "recipient_district_name",
        "recipient_city_name", "recipient_province_name", "express_type", "service_type", "kanwil_name_regist",
        registered.alias("return_regist_time"),
        F.col("return_branch_name").alias("return_register_branch"),
        "remarks_return",
        confirmed.alias("return_confirm_time"),
        F.col("_confirm_label").alias("return_confirm_status"),
        "return_shipping_fee",
        pod.alias("return_pod_record_time"),
        local_time(F.col("return_update"), as_of.tz).alias("update_time_rr"),
        *[flag.alias(name) for name, flag in flags.items()],
        return_stage(registered, confirmed, pod).alias("backlog_return_flag"),
        days_between_events(today, registered).alias("aging_backlog_confirm"),
        days_between_events(today, confirmed).alias("aging_backlog_return"),
    )
    stage = F.col("backlog_return_flag")
    return shown.withColumns(
        {
            "backlog_confirm_category": F.when(
                stage == "Backlog Confirm Return", ageing_bucket(F.col("aging_backlog_confirm"))
            ),
            "backlog_return_category": F.when(stage == "Backlog Return", ageing_bucket(F.col("aging_backlog_return"))),
        }
    )
