"""Delivery-promise reports: Blibli delivery, Zalora daily and Zalora performance."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import (
    city_zone, due_date, late_category, late_factor, late_reason, late_reason_default, otd_status,
    parcel_status, pickup_verdict, sla_cutover, sla_verdict, status_relabel,
)
from parcelspark.functions.timeops import AsOf, joined_key, local_date, local_time, rolling_window
from parcelspark.operators.enrich import contract_sla_join, decode_option, lane_sla_join, lookup, of_spine
from parcelspark.operators.records import current_tariff, first_values, latest_record, latest_values
from parcelspark.sources.tables import Tables


def blibli_delivery(
    tables: Tables, as_of: AsOf, *, days: int = 76, cutover: date = date(2023, 11, 1)
) -> DataFrame:
    """Delivery against the old lane promise and the new contract promise, one row per parcel."""
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of).select(
        "waybill_no", "waybill_source", "express_type", "shipping_time", "update_time", "pod_record_time",
        "pod_branch_name", "sender_city_name", "sender_city_id", "recipient_province_name",
        "recipient_city_name", "recipient_district_name", "recipient_district_id", "vip_customer_id",
    )
    waybills = decode_option(waybills, "waybill_source", tables["system_option"], "orderSource", "order_source")
    waybills = waybills.where(F.col("order_source").isin(*rules.BLIBLI_SOURCES))
    problems = of_spine(tables["waybill_problem_piece"].where(F.col("deleted") == "0"), waybills)
    lane = {
        "recipient_city_name": "Destination_City",
        "sender_city_name": "Origin_City",
        "recipient_district_name": "Destination",
    }
    waybills = lane_sla_join(waybills, tables["sla_internal"], lane, "SLAinternal", "old_sla")
    waybills = contract_sla_join(waybills, current_tariff(tables["standard_shipping_fee"], as_of))
    # The one shuffle by parcel; every later join is on the parcel or to a small master.
    parcels = latest_record(waybills, "waybill_no", "update_time")

    parcels = parcels.join(latest_values(problems, "waybill_no", "operation_time", ["problem_reason"]), "waybill_no", "left")
    parcels = lookup(
        parcels, tables["mitra_late_reason_delivery"], {"waybill_no": "waybill_no"},
        {"late_delivery_reason": "late_delivery_reason"},
    )
    parcels = lookup(
        parcels, tables["masterdata_backlog_city_to_ma"],
        {"recipient_district_name": "destination", "recipient_city_name": "destination_city"},
        {"delivery_area": "mitra_by_area"},
    )
    parcels = lookup(
        parcels, tables["mapping_kanwil_area"], {"recipient_province_name": "province_name"}, {"office": "kanwil_name"}
    )

    shipped, pod = F.col("shipping_time"), F.col("pod_record_time")
    city, district, province = (F.col(f"recipient_{p}_name") for p in ("city", "district", "province"))
    new, old = F.col("max_sla"), F.col("old_sla")
    pod_day = local_date(pod, as_of.tz)
    facts = parcels.withColumns(
        {
            "ship_local": local_time(shipped, as_of.tz),
            "new_due": due_date(shipped, new),
            "old_due": due_date(shipped, old),
            "new_verdict": sla_verdict(pod_day, due_date(shipped, new), new, as_of.local_date),
            "old_verdict": sla_verdict(pod_day, due_date(shipped, old), old, as_of.local_date),
            "reason": late_reason(F.col("problem_reason"), F.col("late_delivery_reason")),
        }
    )
    ship, verdict, reason = F.col("ship_local"), F.col("new_verdict"), F.col("reason")

    def switch(new_col: str, old_col: str) -> Column:
        return sla_cutover(ship, F.col(new_col), F.col(old_col), cutover)

    return facts.select(
        F.col("waybill_no").alias("Waybill_No"),
        joined_key(F.col("sender_city_name"), city).alias("Origin_Dest_City"),
        joined_key(city, district).alias("Dest_City_District"),
        ship.alias("Shipping_Time"),
        province.alias("Destination_Province"),
        city.alias("Destination_City"),
        district.alias("Destination"),
        F.col("delivery_area").alias("Delivery_Area"),
        F.col("office").alias("Kanwil_Area_Deliv"),
        F.col("order_source").alias("Order_Source"),
        pod_day.alias("POD_Date"),
        local_time(pod, as_of.tz).alias("POD_Time"),
        F.col("pod_branch_name").alias("POD_Branch"),
        city_zone(province, city, "marketplace").alias("City_Category"),
        switch("max_sla", "old_sla").alias("SLA_Delivery"),
        switch("new_due", "old_due").alias("Due_Date_Delivery"),
        switch("new_verdict", "old_verdict").alias("Performance"),
        late_reason_default(verdict, reason).alias("Late_Delivery_Reason"),
        late_factor(verdict, reason).alias("Late_Delivery_Factor"),
        late_category(verdict, reason).alias("Late_Delivery_Category"),
        late_reason_default(F.col("old_verdict"), reason).alias("Late_Delivery_Reason_old"),
        F.col("min_sla").alias("min_SLA_Delivery"),
        old.alias("SLA_Delivery_Old"),
        F.col("old_due").alias("Due_Date_Delivery_Old"),
        F.col("old_verdict").alias("Performance_Old"),
    )


FASHION_LANE = {"recipient_city_name": "destination_city", "sender_city_name": "origin_city"}


def _newest_return(tables: Tables, spine: DataFrame) -> DataFrame:
    """Newest return record per parcel of the spine; any one record is a valid choice for these reports."""
    returns = of_spine(tables["waybill_return_bill"].where(F.col("deleted") == "0"), spine)
    cols = ["return_confirm_record_time", "return_pod_record_time", "return_signer"]
    return latest_record(returns.select("waybill_no", "update_time", *cols), "waybill_no", "update_time").drop("update_time")


def zalora_daily(tables: Tables, as_of: AsOf, *, days: int = 35) -> DataFrame:
    """Daily delivery report for the fashion clients, one row per parcel on a promised lane."""
    orders = rolling_window(tables["order_order"], "input_time", days, as_of)
    orders = decode_option(orders, "order_source", tables["system_option"], "orderSource", "source_label")
    orders = orders.where(F.col("source_label").isin(*rules.ZALORA_SOURCES)).select(
        "waybill_no", "order_no", "input_time", "order_status", "source_label", "sender_name", "recipient_name",
        "recipient_address", "recipient_city_name", "recipient_cellphone", "recipient_province_name",
        "sender_city_name",
    )
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = waybills.where(F.col("deleted") == "0").select(
        "waybill_no", "shipping_time", "update_time", "pod_record_time", "signer", "item_calculated_weight",
        "sender_city_name", "recipient_city_name", "recipient_province_name",
    )
    waybills = lane_sla_join(of_spine(waybills, orders), tables["masterdata_sla_shopee"], FASHION_LANE, "sla", "sla")
    parcels = latest_record(waybills, "waybill_no", "update_time").select(
        "waybill_no", "shipping_time", "pod_record_time", "signer", "item_calculated_weight",
        F.col("recipient_city_name").alias("dest_city"),
        F.col("recipient_province_name").alias("dest_prov"),
        F.col("sla").cast("bigint").alias("sla"),
    )

    spine = orders
    orders = latest_record(orders, "waybill_no", "input_time")
    orders = decode_option(orders, "order_status", tables["system_option"], "orderStatus", "status_label")

    problems = rolling_window(tables["waybill_problem_piece"], "operation_time", days, as_of)
    problems = of_spine(problems.where(F.col("problem_type") != rules.PICKUP_PROBLEM_TYPE), spine)
    last_problem = latest_values(
        problems, "waybill_no", "operation_time", {"pos_time": "operation_time", "pos_reason": "problem_reason"}
    )
    joined = (
        parcels.join(orders, "waybill_no", "inner")
        .join(last_problem, "waybill_no", "left")
        .join(_newest_return(tables, spine), "waybill_no", "left")
    )
    shipped, pod = F.col("shipping_time"), F.col("pod_record_time")
    confirm, return_pod = F.col("return_confirm_record_time"), F.col("return_pod_record_time")
    sla = F.col("sla")
    due, pod_local = due_date(shipped, sla), local_time(pod, as_of.tz)
    status = parcel_status(shipped, pod, confirm, return_pod, F.col("status_label"))
    weight = F.col("item_calculated_weight")
    return joined.select(
        "waybill_no",
        F.col("order_no").alias("package_number"),
        F.col("order_no").alias("no_order"),
        F.col("sender_name").alias("seller_name"),
        F.col("recipient_name").alias("customer_name"),
        F.col("recipient_address").alias("customer_address"),
        F.col("recipient_city_name").alias("shipping_city"),
        F.col("recipient_cellphone").alias("cust_phone_no"),
        F.col("recipient_province_name").alias("region"),
        F.col("sender_city_name").alias("origin_city"),
        weight.alias("chargeable_weight_by_3PL"),
        weight.alias("real_weight"),
        weight.alias("volumetric_kg"),
        local_time(shipped, as_of.tz).alias("shipping_time"),
        sla.alias("SLA_Delivery"),
        due.alias("Due_Date_Delivery"),
        sla_verdict(F.to_date(pod_local), due, sla, as_of.local_date, missing=None, pending_ok="Not Late").alias(
            "Deliv_Performance"
        ),
        otd_status(pod_local, due, as_of.local_date).alias("OTD_Status"),
        status.alias("pod_status"),
        pod_local.alias("pod_date"),
        F.col("signer").alias("receiver"),
        local_time(F.col("pos_time"), as_of.tz).alias("POS_attempt"),
        F.col("pos_reason").alias("problem_reason_remarks"),
        local_time(confirm, as_of.tz).alias("return_start_date"),
        local_time(return_pod, as_of.tz).alias("return_pod_date"),
        F.col("return_signer").alias("penerima_return"),
        status_relabel(status).alias("status_sistem"),
        F.col("source_label").alias("order_source"),
        city_zone(F.col("dest_prov"), F.col("dest_city"), "fashion").alias("city_category"),
        "dest_city",
        "dest_prov",
        local_time(F.col("input_time"), as_of.tz).alias("input_time"),
    )


def zalora_performance(tables: Tables, as_of: AsOf, *, days: int = 65) -> DataFrame:
    """Pickup and delivery performance for the fashion clients.

    The old due date shows the new promise, while the old verdict uses the old one; both are kept.
    """
    pickups = rolling_window(tables["dashboard_bd_kpi_monthly"], "input_time", days, as_of, tz=None)
    pickups = pickups.where(F.col("Order_Source").isin(*rules.ZALORA_SOURCES)).select(
        "waybill_no", "order_no", "input_time", "Pickup_Time", "pickup_failure_time", "update_time_oo",
        "Order_Status", "Order_Source", "Pickup_Failure_Reason", "Sender_Name", "scheduling_or_pickup_branch",
        "sender_district_name", "sender_city_name", "sender_province_name", "Pickup_Category_everpro",
        "Pickup_Performance_everpro", "Pickup_Status", "Late_Pickup_Factor", "Late_Pickup_Category",
    )
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = waybills.where(F.col("deleted") == "0").select(
        "waybill_no", "shipping_time", "update_time", "pod_record_time", "express_type", "vip_customer_id",
        "sender_city_id", "recipient_district_id", F.col("sender_city_name").alias("lane_from"),
        F.col("recipient_city_name").alias("dest_city"),
        F.col("recipient_province_name").alias("dest_province"),
        F.col("recipient_district_name").alias("dest_district"),
    )
    lane = {"dest_city": "destination_city", "lane_from": "origin_city"}
    waybills = lane_sla_join(of_spine(waybills, pickups), tables["masterdata_sla_shopee"], lane, "sla", "old_sla")
    waybills = contract_sla_join(waybills, current_tariff(tables["standard_shipping_fee"], as_of))
    parcels = latest_record(waybills, "waybill_no", "update_time").withColumn("old_sla", F.col("old_sla").cast("bigint"))

    spine = pickups
    pickups = latest_record(pickups, "waybill_no", "update_time_oo")
    pickups = decode_option(pickups, "Order_Status", tables["system_option"], "orderStatus", "status_label")

    problems = rolling_window(tables["waybill_problem_piece"], "operation_time", days, as_of)
    problems = of_spine(problems.where(F.col("problem_type") != rules.PICKUP_PROBLEM_TYPE), spine)
    first_problem = first_values(
        problems, "waybill_no", "operation_time", {"pos_time": "operation_time", "pos_reason": "problem_reason"}
    )
    joined = (
        pickups.join(parcels, "waybill_no", "inner")
        .join(first_problem, "waybill_no", "left")
        .join(_newest_return(tables, spine), "waybill_no", "left")
        .join(tables["mitra_late_reason_delivery"].select("waybill_no", "late_delivery_reason"), "waybill_no", "left")
    )
    shipped, pod = F.col("shipping_time"), F.col("pod_record_time")
    new, old = F.col("max_sla"), F.col("old_sla")
    pod_day = local_date(pod, as_of.tz)
    facts = joined.withColumns(
        {
            "verdict": sla_verdict(pod_day, due_date(shipped, new), new, as_of.local_date, None, "Not Late"),
            "old_verdict": sla_verdict(pod_day, due_date(shipped, old), old, as_of.local_date, None, "Not Late"),
            "reason": late_reason(F.col("pos_reason"), F.col("late_delivery_reason"), suppress=()),
            "status": parcel_status(
                shipped, pod, F.col("return_confirm_record_time"), F.col("return_pod_record_time"), F.col("status_label")
            ),
        }
    )
    verdict, reason, city = F.col("verdict"), F.col("reason"), F.col("dest_city")
    return facts.select(
        "waybill_no",
        F.col("order_no").alias("package_number"),
        F.col("order_no").alias("no_order"),
        F.col("input_time").alias("Waktu_Input"),
        local_time(shipped, as_of.tz).alias("shipping_time"),
        F.col("Order_Source").alias("order_source"),
        F.col("Sender_Name").alias("seller_name"),
        "Pickup_Time",
        "Order_Status",
        "Pickup_Failure_Reason",
        F.col("pickup_failure_time").alias("Pickup_Failure_Attempt"),
        F.col("scheduling_or_pickup_branch").alias("Origin_Branch"),
        F.col("sender_district_name").alias("Origin_District"),
        F.col("sender_city_name").alias("Origin_City"),
        F.col("sender_province_name").alias("Origin_Province"),
        joined_key(F.col("sender_city_name"), F.col("sender_district_name")).alias("Origin_City_District"),
        joined_key(city, F.col("dest_district")).alias("Dest_City_District"),
        F.col("Pickup_Category_everpro").alias("Pickup_Category"),
        pickup_verdict(F.col("Pickup_Performance_everpro")).alias("Pickup_Performance"),
        "Pickup_Status",
        "Late_Pickup_Factor",
        "Late_Pickup_Category",
        F.col("min_sla").alias("min_SLA_Delivery"),
        new.alias("SLA_Delivery"),
        old.alias("SLA_Delivery_old"),
        due_date(shipped, new).alias("due_date_delivery"),
        verdict.alias("Deliv_Performance"),
        due_date(shipped, new).alias("Due_Date_Delivery_old"),
        F.col("old_verdict").alias("Deliv_Performance_old"),
        F.col("status").alias("pod_status"),
        local_time(pod, as_of.tz).alias("pod_date"),
        local_time(F.col("pos_time"), as_of.tz).alias("POS_attempt"),
        late_reason_default(verdict, reason, default=None).alias("problem_reason_remarks"),
        status_relabel(F.col("status")).alias("status_sistem"),
        city_zone(F.col("dest_province"), city, "fashion").alias("city_category"),
        "dest_city",
        "dest_province",
        "dest_district",
        late_factor(verdict, reason, rules.FASHION_FACTOR_RULES).alias("Late_Deliv_Factor"),
        late_category(verdict, reason, rules.FASHION_CATEGORY_RULES).alias("Late_Deliv_Category"),
    )
