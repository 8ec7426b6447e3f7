"""One registered query per operator: records (L), joins (J) and roll-ups (A)."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import task_type
from parcelspark.functions.timeops import local_date, month_label, sunday_week
from parcelspark.operators import enrich, records, rollups
from registry.base import (
    AS_OF, TODAY, case, in_list, label, local, local_day, newest,
)

col = F.col

# --- L: records ----------------------------------------------------------------------------------

_EVENT = "event_id, ts, user_id, event_type, value"


@case("l1_latest_record", [], f"""
SELECT {_EVENT} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id) = 1""")
def _(s):
    return records.latest_record(s["events"].select(*_EVENT.split(", ")), "user_id", "ts")


@case("l2_earliest_record", [], f"""
SELECT {_EVENT} FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id) = 1""")
def _(s):
    return records.earliest_record(s["events"].select(*_EVENT.split(", ")), "user_id", "ts")


@case("l3_one_record", [], """
SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice,
       l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity,
    l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate) = 1""")
def _(s):
    return records.one_record(s["lineitem"], ["l_orderkey", "l_linenumber"])


@case("l4_latest_values", ["waybill_problem_piece"], """
SELECT waybill_no, max(problem_reason) FILTER (t = operation_time) AS last_reason,
       max(operation_branch_name) FILTER (t = operation_time) AS last_branch, max(t) AS last_time
FROM (SELECT *, max(operation_time) OVER (PARTITION BY waybill_no) AS t FROM waybill_problem_piece)
GROUP BY waybill_no""")
def _(s):
    return records.latest_values(
        s["waybill_problem_piece"], "waybill_no", "operation_time",
        {"last_reason": "problem_reason", "last_branch": "operation_branch_name", "last_time": "operation_time"},
    )


@case("l5_first_values", ["waybill_problem_piece"], """
SELECT waybill_no, min(problem_reason) FILTER (t = operation_time) AS first_reason,
       min(operation_branch_name) FILTER (t = operation_time) AS first_branch, min(t) AS first_time
FROM (SELECT *, min(operation_time) OVER (PARTITION BY waybill_no) AS t FROM waybill_problem_piece)
GROUP BY waybill_no""")
def _(s):
    return records.first_values(
        s["waybill_problem_piece"], "waybill_no", "operation_time",
        {"first_reason": "problem_reason", "first_branch": "operation_branch_name", "first_time": "operation_time"},
    )


@case("l6_scan_neighbours", [], """
SELECT event_id, user_id, lag(event_type) OVER w AS previous_branch_name, lag(ts) OVER w AS previous_scan_time,
       lag(event_type, 2) OVER w AS previous_branch_name_2, lead(event_type) OVER w AS next_location_name,
       lead(ts) OVER w AS next_scan_time, lead(props) OVER w AS next_scan_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(s):
    # A low hot-key bound, so that users on both sides of it are compared.
    walked = records.scan_neighbours(
        s["events"], "user_id", "ts", "event_type", "props", tie=["event_id"], hot_rows=66, slice_unit="day"
    )
    return walked.select("event_id", "user_id", *records.NEIGHBOUR_COLUMNS)


@case("l7_attempt_pivot", ["waybill_problem_piece"], """
SELECT waybill_no, """ + ", ".join(
    f"max(operation_time) FILTER (n = {i}) AS pos_attempt_{i}, max(problem_reason) FILTER (n = {i}) AS pos_reason_{i}"
    for i in (1, 2, 3)
) + """
FROM (SELECT *, rank() OVER (PARTITION BY waybill_no ORDER BY operation_time) AS n FROM waybill_problem_piece)
GROUP BY waybill_no""")
def _(s):
    return records.attempt_pivot(
        s["waybill_problem_piece"], "waybill_no", "operation_time", {"pos_reason": "problem_reason"}, 3, "pos_attempt"
    )


@case("l7_attempt_pivot_ties", [], """
SELECT user_id, """ + ", ".join(
    f"max(event_type) FILTER (n = {i}) AS kind_{i}, max(value) FILTER (n = {i}) AS value_{i}" for i in (1, 2, 3, 4)
) + """
FROM (SELECT *, rank() OVER (PARTITION BY user_id ORDER BY date_trunc('day', ts)) AS n FROM events)
GROUP BY user_id""")
def _(s):
    daily = s["events"].withColumn("day", F.to_date("ts"))
    return records.attempt_pivot(daily, "user_id", "day", {"kind": "event_type", "value": "value"}, 4)


@case("l8_current_tariff", ["standard_shipping_fee"], f"""
SELECT search_code, min_sla, max_sla, created_at, end_expire_time FROM standard_shipping_fee
WHERE {local_day('end_expire_time')} > {TODAY} AND deleted = '0'
QUALIFY row_number() OVER (PARTITION BY search_code ORDER BY created_at DESC, min_sla NULLS FIRST,
    max_sla NULLS FIRST, end_expire_time) = 1""")
def _(s):
    tariffs = s["standard_shipping_fee"].select(
        "search_code", "min_sla", "max_sla", "created_at", "end_expire_time", "deleted"
    )
    return records.current_tariff(tariffs, AS_OF).drop("deleted")


@case("l9_transport_label", ["waybill_waybill_line"], """
WITH per_waybill AS (
  SELECT waybill_no, record_time, bag_no, vehicle_tag_no,
         vehicle_tag_no || ' - ' || bag_no || ' - ' || waybill_no AS vm_bm_awb
  FROM waybill_waybill_line
  QUALIFY row_number() OVER (PARTITION BY waybill_no
      ORDER BY vm_bm_awb IS NULL, record_time, bag_no NULLS LAST, vehicle_tag_no NULLS LAST) = 1)
SELECT * FROM per_waybill
QUALIFY vm_bm_awb IS NOT NULL OR waybill_no = min(waybill_no) OVER (PARTITION BY vm_bm_awb)""")
def _(s):
    scans = s["waybill_waybill_line"].select("waybill_no", "record_time", "bag_no", "vehicle_tag_no")
    return records.transport_label(scans, tie=["record_time", "bag_no", "vehicle_tag_no"])


# --- J: joins ------------------------------------------------------------------------------------


@case("j1_decode_option", ["waybill_waybill", "system_option"], f"""
SELECT waybill_no, update_time, {label('waybill_source', 'waybillSource')} AS source,
       {label('express_type', 'expressType')} AS express, {label('void_flag', 'voidFlag')} AS void_status
FROM waybill_waybill""")
def _(s):
    df, options = s["waybill_waybill"], s["system_option"]
    df = enrich.decode_option(df, "waybill_source", options, "waybillSource", "source")
    df = enrich.decode_option(df, "express_type", options, "expressType", "express")
    df = enrich.decode_option(df, "void_flag", options, "voidFlag", "void_status")
    return df.select("waybill_no", "update_time", "source", "express", "void_status")


@case("j2_lookback_left_join", [], """
SELECT c_custkey, c_name, o_orderkey, o_orderdate FROM customer
LEFT JOIN orders ON o_custkey = c_custkey AND o_orderstatus = 'F'
     AND CAST(o_orderdate + INTERVAL 7 HOUR AS DATE) >= DATE '2001-08-01' - 400""")
def _(s):
    joined = enrich.lookback_left_join(
        s["customer"], s["orders"], {"c_custkey": "o_custkey"}, "o_orderdate", 400, AS_OF, col("o_orderstatus") == "F"
    )
    return joined.select("c_custkey", "c_name", "o_orderkey", "o_orderdate")


@case("j3_lane_sla_join", ["waybill_waybill", "sla_internal"], """
SELECT w.waybill_no, w.update_time, l.SLAinternal AS sla FROM waybill_waybill w
JOIN sla_internal l ON l.Origin_City = w.sender_city_name AND l.Destination_City = w.recipient_city_name
     AND l.Destination = w.recipient_district_name""")
def _(s):
    lane = {
        "sender_city_name": "Origin_City", "recipient_city_name": "Destination_City",
        "recipient_district_name": "Destination",
    }
    joined = enrich.lane_sla_join(s["waybill_waybill"], s["sla_internal"], lane, "SLAinternal", "sla")
    return joined.select("waybill_no", "update_time", "sla")


TARIFF_CTE = f"""tariff AS (
  SELECT shipping_client_id AS c, sender_location_id AS s, recipient_location_id AS r, express_type AS e, min_sla, max_sla
  FROM ({newest('standard_shipping_fee', 'search_code', 'created_at',
                local_day('end_expire_time') + f" > {TODAY} AND deleted = '0'")})
  QUALIFY row_number() OVER (PARTITION BY c, s, r, e ORDER BY min_sla NULLS FIRST, max_sla NULLS FIRST) = 1)"""


@case("j4_contract_sla_join", ["waybill_waybill", "standard_shipping_fee"], f"""
WITH {TARIFF_CTE}
SELECT w.waybill_no, w.update_time, x.min_sla, x.max_sla FROM waybill_waybill w
LEFT JOIN tariff x ON x.c = w.vip_customer_id AND x.s = w.sender_city_id AND x.r = w.recipient_district_id
     AND x.e = w.express_type""")
def _(s):
    tariffs = records.current_tariff(s["standard_shipping_fee"], AS_OF)
    joined = enrich.contract_sla_join(s["waybill_waybill"], tariffs)
    return joined.select("waybill_no", "update_time", "min_sla", "max_sla")


@case("j5_scans_before_return", ["waybill_waybill_line", "waybill_return_bill"], """
SELECT s.waybill_no, s.record_time, s.operation_branch_name,
       CASE WHEN s.record_time < c.t THEN c.t END AS return_confirm_record_time
FROM waybill_waybill_line s
LEFT JOIN (SELECT waybill_no, max(return_confirm_record_time) AS t FROM waybill_return_bill GROUP BY 1) c
     USING (waybill_no)""")
def _(s):
    joined = enrich.scans_before_return(s["waybill_waybill_line"], s["waybill_return_bill"])
    return joined.select("waybill_no", "record_time", "operation_branch_name", "return_confirm_record_time")


@case("j6_exclude_matched", [], """
SELECT o_orderkey, o_custkey, o_orderstatus FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""")
def _(s):
    lines = s["lineitem"].select(col("l_orderkey").alias("o_orderkey"))
    return enrich.exclude_matched(s["orders"], lines, "o_orderkey").select("o_orderkey", "o_custkey", "o_orderstatus")


@case("j7_require_match", [], """
SELECT o_orderkey, o_custkey, l.lines, l.last_ship FROM orders,
       (SELECT l_orderkey, count(*) AS lines, max(l_shipdate) AS last_ship FROM lineitem GROUP BY 1) l
WHERE l.l_orderkey = o_orderkey""")
def _(s):
    lines = s["lineitem"].groupBy(col("l_orderkey").alias("o_orderkey")).agg(
        F.count(F.lit(1)).alias("lines"), F.max("l_shipdate").alias("last_ship")
    )
    return enrich.require_match(s["orders"].select("o_orderkey", "o_custkey"), lines, "o_orderkey")


@case("j8_flag_exists", ["waybill_waybill", "waybill_problem_piece"], "SELECT waybill_no, update_time, " + ", ".join(
    f"CASE WHEN waybill_no IN (SELECT waybill_no FROM waybill_problem_piece WHERE problem_reason IN {in_list(r)}) "
    f"THEN 'Yes' ELSE 'No' END AS {n}"
    for n, r in (("bad_address", rules.BAD_ADDRESS_REASONS), ("lost", rules.LOST_REASONS), ("found", rules.FOUND_REASONS))
) + " FROM waybill_waybill")
def _(s):
    return enrich.flag_exists(
        s["waybill_waybill"].select("waybill_no", "update_time"), s["waybill_problem_piece"],
        {"bad_address": rules.BAD_ADDRESS_REASONS, "lost": rules.LOST_REASONS, "found": rules.FOUND_REASONS},
    )


@case("j9_hub_names", ["smu_template_2", "a_mh_facility_name_rnd"], """
WITH hub AS (SELECT mh_code, min(mh_name) AS n FROM a_mh_facility_name_rnd GROUP BY 1)
SELECT smu_booking_code, origin, destination_by_issued, if(origin = 'CGK', 'MH JAKARTA', a.n) AS mh_sending_join,
       if(destination_by_issued = 'CGK', 'MH JAKARTA', b.n) AS mh_arrival_join
FROM smu_template_2 LEFT JOIN hub a ON a.mh_code = origin LEFT JOIN hub b ON b.mh_code = destination_by_issued""")
def _(s):
    sheet = s["smu_template_2"].select("smu_booking_code", "origin", "destination_by_issued")
    return enrich.hub_names(sheet, s["a_mh_facility_name_rnd"])


@case("j10_courier_profile", ["waybill_waybill", "order_order", "res_user"], """
WITH kept AS (SELECT * FROM res_user WHERE deleted = '0')
SELECT w.waybill_no, w.update_time, u.personnel_no, u.enabled,
       CASE WHEN '1' IN (coalesce(u.enabled, ''), coalesce(v.enabled, '')) THEN 'active' ELSE 'inactive' END AS courier_status
FROM waybill_waybill w LEFT JOIN order_order o USING (waybill_no)
LEFT JOIN kept u ON u.id = o.pickup_courier_id LEFT JOIN kept v ON v.id = w.pickup_courier_id""")
def _(s):
    orders = s["order_order"].select("waybill_no", col("pickup_courier_id").alias("order_courier_id"))
    pickups = s["waybill_waybill"].select("waybill_no", "update_time", "pickup_courier_id")
    profiles = enrich.courier_profile(pickups.join(orders, "waybill_no", "left"), s["res_user"])
    return profiles.select("waybill_no", "update_time", "personnel_no", "enabled", "courier_status")


def office_sql(level: str, office: str, province: str) -> str:
    """Regional office of a field branch: the first line of the table that fits its office or province."""
    lines = " ".join(
        f"WHEN {office if side == 'office' else province} = '{name}' THEN '{short}'" for side, name, short in rules.OFFICE_RULES
    )
    return (
        f"CASE WHEN {level} IN {in_list(rules.FIELD_LEVELS)} THEN CASE {lines} END "
        f"WHEN {level} IN {in_list(rules.OTHER_LEVELS)} THEN {level} END"
    )


REGION_CTES = f"""area AS (SELECT city_id, min(province_name) AS province FROM res_area GROUP BY 1),
region_of AS (
  SELECT b.id, b.branch_no, {label('b.branch_level', 'branchLevel')} AS branch_level, a.province, k.kanwil_name AS office
  FROM (SELECT * FROM res_branch QUALIFY row_number() OVER (PARTITION BY id ORDER BY branch_no, branch_level, city_id) = 1) b
  LEFT JOIN area a USING (city_id) LEFT JOIN mapping_kanwil_area k ON k.province_name = a.province)"""
REGION_NEEDS = ["res_branch", "res_area", "system_option", "mapping_kanwil_area"]


@case("j11_branch_region", ["waybill_waybill", *REGION_NEEDS], f"""
WITH {REGION_CTES}
SELECT w.waybill_no, w.update_time, r.branch_no, r.branch_level, r.province AS province_name,
       {office_sql('r.branch_level', 'r.office', 'r.province')} AS kanwil_name
FROM waybill_waybill w LEFT JOIN region_of r ON r.id = w.pickup_branch_id""")
def _(s):
    return enrich.branch_region(
        s["waybill_waybill"].select("waybill_no", "update_time", "pickup_branch_id"), "pickup_branch_id",
        s["res_branch"], s["res_area"], s["system_option"], s["mapping_kanwil_area"],
    ).drop("pickup_branch_id")


@case("j12_manifest_match", ["smu_template_2", "waybill_waybill_line"], """
SELECT g.smu_booking_code, g.bm_code, g.vm_code, q.bag_no, q.vehicle_tag_no, q.parcels
FROM smu_template_2 g LEFT JOIN (
  SELECT bag_no, vehicle_tag_no, bag_no || ' - ' || vehicle_tag_no AS pair, count(*) AS parcels
  FROM waybill_waybill_line GROUP BY ALL) q ON q.pair = g.bm_code || ' - ' || g.vm_code""")
def _(s):
    bags = s["waybill_waybill_line"].groupBy("bag_no", "vehicle_tag_no").agg(F.count(F.lit(1)).alias("parcels"))
    return enrich.manifest_match(s["smu_template_2"].select("smu_booking_code", "bm_code", "vm_code"), bags)


@case("j13_latest_status_join", ["dashboard_productivity_lm", "waybill_waybill_line", "waybill_problem_piece",
                                 "waybill_return_bill"], """
SELECT m.waybill_no, m.th_arrival,
       (SELECT max(record_time) FROM waybill_waybill_line s WHERE s.waybill_no = m.waybill_no) AS last_scan,
       (SELECT min(operation_time) FROM waybill_problem_piece p WHERE p.waybill_no = m.waybill_no) AS first_problem,
       (SELECT max(update_time) FROM waybill_return_bill r WHERE r.waybill_no = m.waybill_no) AS last_return
FROM dashboard_productivity_lm m""")
def _(s):
    return enrich.latest_status_join(
        s["dashboard_productivity_lm"].select("waybill_no", "th_arrival"),
        records.latest_values(s["waybill_waybill_line"], "waybill_no", "record_time", {"last_scan": "record_time"}),
        records.first_values(
            s["waybill_problem_piece"], "waybill_no", "operation_time", {"first_problem": "operation_time"}
        ),
        records.latest_values(s["waybill_return_bill"], "waybill_no", "update_time", {"last_return": "update_time"}),
    )


# --- A: roll-ups ---------------------------------------------------------------------------------


@case("a1_volume_by_period", ["waybill_waybill"], f"""
SELECT {local_day('shipping_time')} AS pickup_date, strftime({local('shipping_time')}, '%b %Y') AS month_pickup,
       CAST(strftime({local('shipping_time')}, '%U') AS BIGINT) AS week_pickup, waybill_source,
       count(waybill_no) AS total_volume, CAST(sum(standard_shipping_fee) AS DOUBLE) AS standard_shipping_fee
FROM waybill_waybill GROUP BY ALL""")
def _(s):
    shipped = local_date(col("shipping_time"))
    periods = s["waybill_waybill"].select(
        "waybill_no", "waybill_source", "standard_shipping_fee", shipped.alias("pickup_date"),
        month_label(shipped).alias("month_pickup"), sunday_week(shipped).alias("week_pickup"),
    )
    keys = ["pickup_date", "month_pickup", "week_pickup", "waybill_source"]
    return rollups.volume_by_period(periods, keys, "waybill_no", "standard_shipping_fee")


def _task_sides(s):
    w = s["waybill_waybill"]
    shared = ["waybill_no", "waybill_source", "express_type"]
    pickups = w.select(
        *shared, col("pickup_courier_id").alias("courier_id"), local_date(col("shipping_time")).alias("day"),
        task_type(col("shipping_time"), "Pickup")["task_count"].alias("pickup"), F.lit(0).cast("bigint").alias("pod"),
    )
    pods = w.where(col("pod_record_time").isNotNull()).select(
        *shared, col("pod_courier_id").alias("courier_id"), local_date(col("pod_record_time")).alias("day"),
        F.lit(0).cast("bigint").alias("pickup"), task_type(col("pod_record_time"), "POD")["task_count"].alias("pod"),
    )
    return pickups, pods


@case("a2_courier_tasks", ["waybill_waybill"], f"""
SELECT courier_id, day, waybill_source, CAST(sum(p) AS BIGINT) AS pickup, CAST(sum(d) AS BIGINT) AS pod FROM (
  SELECT pickup_courier_id AS courier_id, {local_day('shipping_time')} AS day, waybill_source, 1 AS p, 0 AS d
  FROM waybill_waybill
  UNION ALL SELECT pod_courier_id, {local_day('pod_record_time')}, waybill_source, 0, 1 FROM waybill_waybill
  WHERE pod_record_time IS NOT NULL)
GROUP BY courier_id, day, waybill_source""")
def _(s):
    return rollups.courier_tasks(*_task_sides(s), ["courier_id", "day", "waybill_source"])


@case("a3_courier_task_list", ["waybill_waybill"], f"""
SELECT DISTINCT courier_id, day, CASE side WHEN 1 THEN waybill_no END AS waybill_no_pickup,
       CASE side WHEN 1 THEN waybill_source END AS waybill_source_pickup,
       CASE side WHEN 1 THEN express_type END AS express_type_pickup,
       CASE side WHEN 2 THEN waybill_no END AS waybill_no_pod, CASE side WHEN 2 THEN waybill_source END AS waybill_source_pod,
       CASE side WHEN 2 THEN express_type END AS express_type_pod
FROM (SELECT 1 AS side, pickup_courier_id AS courier_id, {local_day('shipping_time')} AS day, waybill_no, waybill_source,
             express_type FROM waybill_waybill
      UNION ALL
      SELECT 2, pod_courier_id, {local_day('pod_record_time')}, waybill_no, waybill_source, express_type
      FROM waybill_waybill WHERE pod_record_time IS NOT NULL)""")
def _(s):
    return rollups.courier_task_list(*_task_sides(s), ["courier_id", "day"])


@case("a4_bag_totals", [], """
SELECT l_suppkey, l_partkey, CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) AS fee,
       CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS weight
FROM lineitem GROUP BY l_suppkey, l_partkey""")
def _(s):
    lines = s["lineitem"].select(
        "l_suppkey", "l_partkey", col("l_extendedprice").cast("decimal(18,2)").alias("fee"),
        col("l_quantity").cast("decimal(18,2)").alias("weight"),
    )
    return rollups.bag_totals(lines, ["l_suppkey", "l_partkey"], ["fee", "weight"])


@case("a5_task_counts", [], """
SELECT o_custkey, o_orderpriority, count(*) AS pickup, count(*) FILTER (o_orderstatus = 'F') AS pod
FROM orders GROUP BY ALL""")
def _(s):
    flags = {"pickup": F.lit(1).cast("bigint"), "pod": (col("o_orderstatus") == "F").cast("bigint")}
    return rollups.task_counts(s["orders"], ["o_custkey", "o_orderpriority"], flags)
