"""One registered query per report. Look-backs are widened to the whole tables."""

from __future__ import annotations

from datetime import date

from parcelspark.functions import rules
from parcelspark.functions.classify import CLAMPED_LEGS, LEG_NAMES
from parcelspark.plans import backlog, cargo, claims, courier, leadtime, orders, sla, volume
from registry.base import (
    ALL_DAYS, AS_OF, LONG_DAYS, SHORT_DAYS, TODAY, UTC_TODAY, at_first, at_last, back, case, day, due, in_list, label, local,
    local_day, money, newest, verdict,
)
from registry.classify_cases import REMARKS_SQL, ZONE_SQL, differences, rule_lookup
from registry.operator_cases import REGION_CTES, REGION_NEEDS, TARIFF_CTE, office_sql

_NO_PICKUP_PROBLEM = "problem_type <> '02'"


def _last_problem(where: str) -> str:
    return (
        f"SELECT waybill_no, {at_last('problem_reason', 'operation_time')} AS pos_reason, max(operation_time) AS pos_time "
        f"FROM waybill_problem_piece WHERE {where} GROUP BY waybill_no"
    )


# --- D1 ------------------------------------------------------------------------------------------


@case("d1_blibli_delivery", [
    "waybill_waybill", "waybill_problem_piece", "system_option", "sla_internal", "masterdata_backlog_city_to_ma",
    "mitra_late_reason_delivery", "mapping_kanwil_area", "standard_shipping_fee",
], f"""
WITH {TARIFF_CTE},
pos AS ({_last_problem("deleted = '0'")}),
parcel_now AS (
  SELECT w.*, l.SLAinternal AS old, {label('w.waybill_source', 'orderSource')} AS src
  FROM waybill_waybill w JOIN sla_internal l ON l.Destination = w.recipient_district_name
       AND l.Origin_City = w.sender_city_name AND l.Destination_City = w.recipient_city_name
  WHERE {back('w.shipping_time')} AND src IN ('Blibli', 'Blibli API')
  QUALIFY row_number() OVER (PARTITION BY w.waybill_no ORDER BY w.update_time DESC) = 1),
fact AS (
  SELECT p.*, t.min_sla, t.max_sla AS new, m.mitra_by_area, k.kanwil_name,
         CASE WHEN pos.pos_reason IS NULL THEN r.late_delivery_reason
              WHEN pos.pos_reason NOT IN {in_list(rules.SENDER_SIDE_REASONS)} THEN pos.pos_reason END AS why,
         {due('p.shipping_time', 't.max_sla')} AS new_due, {due('p.shipping_time', 'p.old')} AS old_due,
         {verdict('p.pod_record_time', due('p.shipping_time', 't.max_sla'), 't.max_sla', "'Not Late'", 'NULL')} AS new_v,
         {verdict('p.pod_record_time', due('p.shipping_time', 'p.old'), 'p.old', "'Not Late'", 'NULL')} AS old_v,
         {local_day('p.shipping_time')} >= DATE '1998-11-01' AS is_new
  FROM parcel_now p LEFT JOIN pos USING (waybill_no) LEFT JOIN mitra_late_reason_delivery r USING (waybill_no)
  LEFT JOIN masterdata_backlog_city_to_ma m ON m.destination = p.recipient_district_name AND m.destination_city = p.recipient_city_name
  LEFT JOIN mapping_kanwil_area k ON k.province_name = p.recipient_province_name
  LEFT JOIN tariff t ON t.c = p.vip_customer_id AND t.s = p.sender_city_id AND t.r = p.recipient_district_id
       AND t.e = p.express_type)
SELECT waybill_no AS Waybill_No, sender_city_name || ' - ' || recipient_city_name AS Origin_Dest_City,
       recipient_city_name || ' - ' || recipient_district_name AS Dest_City_District, {local('shipping_time')} AS Shipping_Time,
       recipient_province_name AS Destination_Province, recipient_city_name AS Destination_City,
       recipient_district_name AS Destination, mitra_by_area AS Delivery_Area, kanwil_name AS Kanwil_Area_Deliv,
       src AS Order_Source, {local_day('pod_record_time')} AS POD_Date, {local('pod_record_time')} AS POD_Time,
       pod_branch_name AS POD_Branch, {ZONE_SQL['marketplace']('recipient_province_name', 'recipient_city_name')} AS City_Category,
       if(is_new, new, old) AS SLA_Delivery, if(is_new, new_due, old_due) AS Due_Date_Delivery,
       if(is_new, new_v, old_v) AS Performance,
       if(why IS NULL AND new_v = 'Late', 'Kurir tidak available', why) AS Late_Delivery_Reason,
       {rule_lookup('new_v', 'why', rules.MARKETPLACE_FACTOR_RULES)} AS Late_Delivery_Factor,
       {rule_lookup('new_v', 'why', rules.MARKETPLACE_CATEGORY_RULES)} AS Late_Delivery_Category,
       if(why IS NULL AND old_v = 'Late', 'Kurir tidak available', why) AS Late_Delivery_Reason_old,
       min_sla AS min_SLA_Delivery, old AS SLA_Delivery_Old, old_due AS Due_Date_Delivery_Old, old_v AS Performance_Old
FROM fact""")
def _(s):
    return sla.blibli_delivery(s, AS_OF, days=ALL_DAYS, cutover=date(1998, 11, 1))


# --- D2 ------------------------------------------------------------------------------------------


@case("d2_backlog_ops", [
    "dashboard_productivity_lm", "waybill_waybill_line", "dm_waybill_waybill_line", "waybill_return_bill",
    "waybill_problem_piece", "masterdata_facility_to_kanwil",
], f"""
WITH facility AS (
  SELECT * FROM masterdata_facility_to_kanwil
  QUALIFY row_number() OVER (PARTITION BY branch_name ORDER BY kanwil_name NULLS LAST, branch_no NULLS LAST) = 1),
lm AS (SELECT *, CAST(arrival_time AS DATE) >= {UTC_TODAY} - {ALL_DAYS} AS recent FROM dashboard_productivity_lm WHERE aging_day > 2),
tried AS (
  SELECT lm.waybill_no, min({local('s.record_time')}) AS t FROM lm JOIN waybill_waybill_line s
    ON s.waybill_no = lm.waybill_no AND s.operation_branch_name = lm.th_arrival
  WHERE recent AND s.operation_type = '09' AND {back('s.record_time')} AND {local('s.record_time')} > lm.arrival_time
  GROUP BY 1),
ret AS ({newest('waybill_return_bill', 'waybill_no', 'update_time', back('return_record_time'))}),
pos AS ({_last_problem(_NO_PICKUP_PROBLEM + ' AND ' + back('operation_time'))})
SELECT lm.waybill_no, lm.aging_day, f.kanwil_name, lm.th_arrival, f.branch_no AS th_arrival_no, lm.arrival_time,
       f.city_name, f.province_name, tried.t AS first_deliv_attempt,
       date_diff('day', lm.arrival_time, tried.t) AS arrival_to_deliv_day, lm.pod_time, lm.return_regist_time,
       {local('ret.return_confirm_record_time')} AS return_confirm_record_time,
       {local('ret.return_pod_record_time')} AS return_pod_record_time,
       CAST(coalesce(date_diff('day', lm.arrival_time, tried.t), 3) > 2 AS BIGINT) AS more_4_days,
       CAST(lm.aging_day > 14 AND lm.return_regist_time IS NULL AS BIGINT) AS more_14_days,
       CAST(NULL AS VARCHAR) AS sending_3pl_status, pos.pos_reason AS last_pos_reason, {local('pos.pos_time')} AS last_pos_attempt
FROM lm LEFT JOIN facility f ON f.branch_name = lm.th_arrival LEFT JOIN tried USING (waybill_no)
LEFT JOIN ret ON ret.waybill_no = lm.waybill_no AND lm.recent LEFT JOIN pos ON pos.waybill_no = lm.waybill_no
WHERE pos.pos_reason <> 'Paket hilang atau tidak ditemukan' AND lm.th_arrival NOT LIKE 'TH VIP%'
  AND NOT EXISTS (SELECT 1 FROM dm_waybill_waybill_line d WHERE d.waybill_no = lm.waybill_no AND d.deleted = '0'
                  AND d.next_location_name = '3PL' AND {back('d.record_time')})""")
def _(s):
    return backlog.backlog_ops(s, AS_OF, days=ALL_DAYS)


# --- D3, D4 --------------------------------------------------------------------------------------


def _task_ctes(days: int, order_days: int) -> str:
    def described(source: str, courier: str) -> str:
        return f"""SELECT n.*, u.personnel_no, u.enabled,
         CASE u.enabled WHEN '0' THEN 'inactive' WHEN '1' THEN 'active' END AS courier_status,
         g.branch_no, g.branch_level, g.province AS province_name, {office_sql('g.branch_level', 'g.office', 'g.province')} AS kanwil_name,
         g.branch_no || ' - ' || kanwil_name || ' ' || n.branch_name AS work_location,
         {label('n.waybill_source', 'waybillSource')} AS src, {label('n.express_type', 'expressType')} AS express,
         date_trunc('day', {local('n.task_time')})::TIMESTAMP AS tgl_tugas
  FROM ({source}) n LEFT JOIN region_of g ON g.id = n.branch_id
  LEFT JOIN res_user u ON u.deleted = '0' AND u.id = n.{courier}"""

    pickups = f"""SELECT w.*, w.pickup_branch_id AS branch_id, w.pickup_branch_name AS branch_name,
         w.sender_district_name AS district_name, w.sender_city_name AS city_name, w.shipping_time AS task_time,
         if(w.pickup_courier_id = 0, o.pickup_courier_id, w.pickup_courier_id) AS courier_id,
         if(w.pickup_courier_name = '', o.pickup_courier_name, w.pickup_courier_name) AS courier_name
  FROM ({newest('waybill_waybill', 'waybill_no', 'update_time', back('shipping_time', days) + " AND void_flag = '0' AND deleted = '0'")}) w
  LEFT JOIN (SELECT * FROM order_order WHERE {back('input_time', order_days)}) o USING (waybill_no)"""
    pods = f"""SELECT *, pod_branch_id AS branch_id, pod_branch_name AS branch_name, recipient_district_name AS district_name,
         recipient_city_name AS city_name, pod_record_time AS task_time, pod_courier_id AS courier_id, pod_courier_name AS courier_name
  FROM ({newest('dm_waybill_waybill', 'waybill_no', 'update_time',
                back('update_time', days) + ' AND ' + back('pod_record_time', days) + " AND deleted = '0'")})"""
    return f"""{REGION_CTES},
p AS ({described(pickups, 'courier_id')}),
d AS ({described(pods, 'courier_id')})"""


_COURIER_NEEDS = ["waybill_waybill", "dm_waybill_waybill", "order_order", "res_user", *REGION_NEEDS]
_AGG_PLAIN = (
    "personnel_no, courier_id, courier_name, tgl_tugas, branch_no, branch_name, kanwil_name, work_location, branch_level, "
    "courier_status, enabled"
)
_AGG = _AGG_PLAIN + ", src, express"


@case("d3_courier_incentive_agg", _COURIER_NEEDS, f"""
WITH {_task_ctes(ALL_DAYS, LONG_DAYS)}
SELECT {_AGG_PLAIN}, src AS waybill_source, express AS express_type, count(*) FILTER (side = 'p') AS pickup,
       count(*) FILTER (side = 'd') AS pod
FROM (SELECT {_AGG}, 'p' AS side FROM p UNION ALL SELECT {_AGG}, 'd' FROM d)
GROUP BY {_AGG}""")
def _(s):
    return courier.courier_incentive_agg(s, AS_OF, days=ALL_DAYS, order_days=LONG_DAYS)


_LIST = ", ".join(courier.LIST_KEYS)


@case("d4_courier_incentive_raw", _COURIER_NEEDS, f"""
WITH {_task_ctes(ALL_DAYS, LONG_DAYS)}
SELECT {_LIST}, waybill_no AS waybill_no_pickup, src AS waybill_source_pickup, express AS express_type_pickup,
       NULL::VARCHAR AS waybill_no_pod, NULL::VARCHAR AS waybill_source_pod, NULL::VARCHAR AS express_type_pod FROM p
UNION
SELECT {_LIST}, NULL, NULL, NULL, waybill_no, src, express FROM d""")
def _(s):
    return courier.courier_incentive_raw(s, AS_OF, days=ALL_DAYS, order_days=LONG_DAYS)


# --- D5 ------------------------------------------------------------------------------------------

_BOTH = [
    ("sender_city_name", "sender_city_name"), ("sender_district_name", "sender_district_name"),
    ("recipient_city_name", "recipient_city_name"), ("recipient_district_name", "recipient_district_name"),
]
_NUMBERS = {
    "item_calculated_weight": "item_calculated_weight", "item_volume_weight": "item_volume_weight",
    "insurance_amount": "insurance", "standard_shipping_fee": "std_shipping_fee", "handling_fee": "handling_fee",
    "other_fee": "other_fee", "total_shipping_fee": "total_shipping_fee",
}


@case("d5_shipping_fee_check", ["order_order", "waybill_waybill", "system_option"], f"""
WITH d AS (
  SELECT o.waybill_no, {label('o.order_source', 'orderSource')} AS order_source, {local('o.input_time')} AS input_time,
         {local('w.shipping_time')} AS shipping_time, w.sender_name AS order_sender_name, w.sender_address AS order_sender_address,
         w.recipient_address, w.pod_photo_url, {label('o.express_type', 'expressType')} AS order_express_type,
         {label('w.express_type', 'expressType')} AS waybill_express_type,
         {', '.join(f'o.{a} AS order_{b}, w.{a} AS waybill_{b}' for a, b in _BOTH)},
         {', '.join(f'CAST(o.{a} AS DOUBLE) AS order_{b}, CAST(w.{a} AS DOUBLE) AS waybill_{b}' for a, b in _NUMBERS.items())},
         {differences(label('o.express_type', 'expressType') + ' <> ' + label('w.express_type', 'expressType'))}
  FROM order_order o LEFT JOIN waybill_waybill w ON w.waybill_no = o.waybill_no AND w.deleted = '0'
       AND {back('w.shipping_time')}
  WHERE contains(o.waybill_no, 'IDE') AND {back('o.input_time')})
SELECT * EXCLUDE (dsc, dsd, drc, drd, dcw, dvw, daw, din, dex), {REMARKS_SQL} FROM d""")
def _(s):
    return orders.shipping_fee_check(s, AS_OF, days=ALL_DAYS)


# --- D6, D7 --------------------------------------------------------------------------------------

_PROBLEM_SCAN = "operation_type = '18' AND problem_type <> '02'"
_CLAIM_NEEDS = [
    "waybill_waybill", "waybill_waybill_line", "waybill_problem_piece", "waybill_return_bill", "system_option",
    "masterdata_branch_coverage_th",
]


def _ranked(table: str, time: str, where: str, cols: dict[str, str], n: int) -> str:
    shown = ", ".join(
        f"max({value}) FILTER (nr = {i}) AS {name}_{i}" for name, value in cols.items() for i in range(1, n + 1)
    )
    return (
        f"SELECT waybill_no, {shown} FROM (SELECT *, rank() OVER (PARTITION BY waybill_no ORDER BY {time}) AS nr "
        f"FROM {table} WHERE {where}) GROUP BY waybill_no"
    )


_FEES = ("standard_shipping_fee", "total_shipping_fee", "cod_amount", "item_value", "insurance_amount", "handling_fee", "other_fee")


@case("d6_everpro_claims", _CLAIM_NEEDS, f"""
WITH w AS ({newest('waybill_waybill', 'waybill_no', 'update_time',
                   back('shipping_time') + ' AND ' + label('waybill_source', 'waybillSource') + " = 'everpro'")}),
r AS (SELECT waybill_no, max(return_record_time) AS a, {at_last('return_confirm_record_time', 'return_record_time')} AS b,
             {at_last('return_pod_record_time', 'return_record_time')} AS c
      FROM waybill_return_bill WHERE {back('update_time')} GROUP BY 1),
fp AS (SELECT waybill_no, min(operation_time) AS t, {at_first('problem_reason', 'operation_time')} AS why,
              {at_first('operation_branch_name', 'operation_time')} AS place
       FROM waybill_problem_piece WHERE {_NO_PICKUP_PROBLEM} AND {back('operation_time')} GROUP BY 1),
pr AS ({_ranked('waybill_problem_piece', 'operation_time', _NO_PICKUP_PROBLEM + ' AND ' + back('operation_time'),
                {'at': 'operation_time', 'why': 'problem_reason'}, 3)}),
ph AS ({_ranked('waybill_waybill_line', 'record_time', _PROBLEM_SCAN + ' AND ' + back('record_time'), {'url': 'photo_url'}, 3)}),
f1 AS (SELECT waybill_no, {at_first('photo_url', 'record_time')} AS url FROM waybill_waybill_line
       WHERE {_PROBLEM_SCAN} AND {back('record_time')} GROUP BY 1),
fd AS (SELECT waybill_no, min(record_time) AS t FROM waybill_waybill_line
       WHERE operation_type = '09' AND {back('record_time', SHORT_DAYS)} GROUP BY 1),
ll AS (SELECT waybill_no, max(record_time) AS t, {at_last('operation_branch_name', 'record_time')} AS place,
              {at_last('activity', 'record_time')} AS activity
       FROM (SELECT *, {label('operation_type', 'operationType')} AS activity FROM waybill_waybill_line
             WHERE {back('record_time', SHORT_DAYS)}) GROUP BY 1)
SELECT w.waybill_no, {local('w.shipping_time')} AS shipping_time, w.sender_city_name, w.recipient_city_name,
       {label('w.void_flag', 'voidFlag')} AS void_status, {local('r.a')} AS return_regist_time,
       {local('r.b')} AS return_confirm_time, {local('r.c')} AS return_pod_record_time, {local('fp.t')} AS first_pos_attempt,
       {local('w.pod_record_time')} AS pod_record_time, CASE WHEN fp.t IS NOT NULL THEN f1.url END AS first_pos_photo_url,
       w.pod_photo_url, fp.why AS first_pos_reason, fp.place AS first_pos_location,
       {label('w.waybill_source', 'waybillSource')} AS waybill_source, w.parent_shipping_cleint AS vip_username,
       w.vip_customer_name AS sub_account, {local('fd.t')} AS first_deliv_attempt, w.pickup_branch_name,
       coalesce(w.pod_branch_name, (SELECT c.branch_name FROM masterdata_branch_coverage_th c
                                    WHERE c.district_id = w.recipient_district_id)) AS th_destination,
       {', '.join(f"{local(f'pr.at_{i}')} AS pos_attempt_{i}, pr.why_{i} AS pos_reason_{i}, ph.url_{i} AS pos_photo_url_{i}" for i in (2, 3))},
       {money(*_FEES, of='w.')}, ll.place AS last_location, ll.activity AS last_activity,
       {local('ll.t')} AS last_scan_time
FROM w LEFT JOIN r USING (waybill_no) LEFT JOIN fp USING (waybill_no) LEFT JOIN pr USING (waybill_no)
LEFT JOIN ph USING (waybill_no) LEFT JOIN f1 USING (waybill_no) LEFT JOIN fd USING (waybill_no) LEFT JOIN ll USING (waybill_no)""")
def _(s):
    return claims.everpro_claims(s, AS_OF, days=ALL_DAYS, scan_days=SHORT_DAYS)


def _has(reasons) -> str:
    return (
        f"if(EXISTS (SELECT 1 FROM waybill_problem_piece p WHERE p.waybill_no = w.waybill_no AND {_NO_PICKUP_PROBLEM} "
        f"AND {back('operation_time')} AND problem_reason IN {in_list(reasons)}), 'Yes', 'No')"
    )


def _first_scan(code: str) -> str:
    return (
        f"SELECT waybill_no, min({local('record_time')}) AS t, {at_first('operation_branch_name', 'record_time')} AS place "
        f"FROM waybill_waybill_line WHERE operation_type = '{code}' AND {back('record_time')} GROUP BY 1"
    )


@case("d7_mengantar_claims", _CLAIM_NEEDS, f"""
WITH w AS ({newest('waybill_waybill', 'waybill_no', 'update_time', back('shipping_time') + " AND waybill_source IN ('753', '796')")}),
fd AS ({_first_scan('09')}), fr AS ({_first_scan('19')}),
ps AS ({_ranked('waybill_waybill_line', 'record_time', _PROBLEM_SCAN + ' AND ' + back('record_time'),
                {'pos_reason': 'register_reason_bahasa', 'pos_photo_url': 'photo_url'}, 4)})
SELECT w.waybill_no, w.order_no, {local('w.shipping_time')} AS shipping_time, {label('w.waybill_source', 'waybillSource')} AS waybill_source,
       {label('w.void_flag', 'voidFlag')} AS void_status, w.recipient_address,
       if(w.pod_record_time IS NULL, if(fd.t IS NULL, (SELECT c.branch_name FROM masterdata_branch_coverage_th c
          WHERE c.district_id = w.recipient_district_id), fd.place), w.pod_branch_name) AS destination_branch_name,
       fd.t AS first_deliv_attempt, fd.place AS first_deliv_branch, fr.t AS first_regist_return_time,
       fr.place AS first_regist_return_branch, date_diff('day', fd.t, fr.t) AS diff_first_regist_and_deliv_day,
       {_has(rules.BAD_ADDRESS_REASONS)} AS apakah_ada_pos_alamat_penerima_tidak_jelas_tidak_dapat_ditemukan,
       {_has(rules.LOST_REASONS)} AS apakah_ada_POS_paket_hilang, {_has(rules.FOUND_REASONS)} AS apakah_ada_POS_paket_hilang_ditemukan,
       if(w.pod_record_time IS NULL, 'No', 'Yes') AS apakah_paket_sudah_pod, ps.* EXCLUDE (waybill_no),
       {local('w.pod_record_time')} AS pod_record_time, w.pod_photo_url
FROM w LEFT JOIN fd USING (waybill_no) LEFT JOIN fr USING (waybill_no) LEFT JOIN ps USING (waybill_no)""")
def _(s):
    return claims.mengantar_claims(s, AS_OF, days=ALL_DAYS)


# --- D8 to D12 -----------------------------------------------------------------------------------


@case("d8_waybill_bag_info", ["waybill_waybill_line", "dashboard_bd_order_all_status"], f"""
WITH one AS (
  SELECT waybill_no, bag_no, vehicle_tag_no, record_time, vehicle_tag_no || ' - ' || bag_no || ' - ' || waybill_no AS vm_bm_awb
  FROM waybill_waybill_line WHERE {back('record_time')}
  QUALIFY row_number() OVER (PARTITION BY waybill_no
      ORDER BY vm_bm_awb IS NULL, vehicle_tag_no NULLS LAST, bag_no NULLS LAST, record_time) = 1),
kept AS (
  SELECT *, row_number() OVER (PARTITION BY vm_bm_awb ORDER BY vehicle_tag_no NULLS LAST, bag_no NULLS LAST, waybill_no) AS nr
  FROM one)
SELECT {local('k.record_time')} AS record_time, k.bag_no, k.waybill_no, o.kota_asal, o.kec_asal, o.kota_tujuan,
       CAST(o.berat AS DOUBLE) AS berat, CAST(o.biaya_standar_pengiriman AS DOUBLE) AS standard_shipping_fee,
       o.tipe_ekspress AS express_type, k.vehicle_tag_no, o.tujuan_kec, o.order_no, k.vm_bm_awb
FROM kept k LEFT JOIN dashboard_bd_order_all_status o USING (waybill_no) WHERE k.nr = 1""")
def _(s):
    return cargo.waybill_bag_info(s, AS_OF, days=ALL_DAYS)


_SHEET_SQL = """sheet AS (
  SELECT * EXCLUDE (report_date, smu_weight, total_smu_fee), CAST(smu_weight AS DOUBLE) AS smu_weight,
         CAST(total_smu_fee AS DOUBLE) AS total_smu_fee, CAST(strptime(report_date, '%m/%d/%Y') AS DATE) AS report_date,
         bm_code || ' - ' || vm_code AS bm_vm_gsheet FROM smu_template_2)"""
_HUB_SQL = """hub AS (SELECT mh_code, min(mh_name) AS n FROM a_mh_facility_name_rnd GROUP BY 1),
hub_sheet AS (
  SELECT sheet.*, if(origin = 'CGK', 'MH JAKARTA', a.n) AS mh_sending_join,
         if(destination_by_issued = 'CGK', 'MH JAKARTA', b.n) AS mh_arrival_join
  FROM sheet LEFT JOIN hub a ON a.mh_code = sheet.origin LEFT JOIN hub b ON b.mh_code = sheet.destination_by_issued)"""
_HUB_NEEDS = ["smu_template_2", "a_mh_facility_name_rnd"]
_SYSTEM_DATES = dict(
    scans_from=date(1995, 2, 1), scans_to=date(2001, 12, 31), sending_from=date(1995, 1, 1),
    waybills_from=date(1995, 1, 1), waybills_to=date(2001, 12, 31),
)
_SYSTEM_NEEDS = ["waybill_waybill_line", "waybill_waybill", "system_option"]


def _hub_scan(code: str, start: str) -> str:
    return (
        f"SELECT bag_no, vehicle_tag_no, waybill_no, min(operation_branch_name) AS hub FROM waybill_waybill_line "
        f"WHERE operation_type = '{code}' AND operation_branch_name LIKE '%MH%' AND {day('record_time')} >= DATE '{start}' "
        f"AND {day('record_time')} <= DATE '2001-12-31' GROUP BY ALL"
    )


_SYSTEM_FEES = ("standard_shipping_fee", "handling_fee", "other_fee", "insurance_amount", "total_shipping_fee")
_SYSTEM_SQL = f"""sent AS ({_hub_scan('04', '1995-01-01')}), arrived AS ({_hub_scan('05', '1995-02-01')}),
bag AS (SELECT bag_no, vehicle_tag_no, waybill_no, min(record_time) AS t FROM waybill_waybill_line
        WHERE bag_no <> '' AND vehicle_tag_no IS NOT NULL AND {day('record_time')} BETWEEN DATE '1995-02-01' AND DATE '2001-12-31'
        GROUP BY ALL),
system AS (
  SELECT bag_no || ' - ' || vehicle_tag_no || ' - ' || waybill_no AS bm_vm_awb, bag_no || ' - ' || vehicle_tag_no AS bm_vm_concat,
         bag_no, vehicle_tag_no, waybill_no, {local_day('w.shipping_time')} AS shipping_time,
         {label('w.express_type', 'expressType')} AS express_type, {local_day('bag.t')} AS record_time,
         {money(*_SYSTEM_FEES, of='w.')}, CAST(w.item_calculated_weight AS DOUBLE) AS system_weight,
         CAST(w.standard_shipping_fee + w.handling_fee AS DOUBLE) AS system_sf, w.sender_province_name, w.sender_city_name,
         w.sender_district_name, w.pickup_branch_name, w.recipient_province_name, w.recipient_city_name, w.recipient_district_name,
         w.pod_branch_name, {local_day('w.pod_record_time')} AS pod_record_time, {label('w.return_flag', 'returnFlag')} AS return_flag,
         {local_day('w.return_pod_record_time')} AS return_pod_record_time, w.return_pod_branch_name,
         if(w.pod_record_time IS NULL, if(w.return_pod_record_time IS NULL, NULL, w.return_pod_branch_name), w.pod_branch_name)
             AS pod_or_return_pod_branch, sent.hub AS mh_sending, arrived.hub AS mh_arrival
  FROM bag JOIN ({newest('waybill_waybill', 'waybill_no', 'update_time',
                         day('shipping_time') + " >= DATE '1995-01-01' AND " + day('shipping_time')
                         + " <= DATE '2001-12-31' AND void_flag = '0' AND deleted = '0'")}) w USING (waybill_no)
  LEFT JOIN sent USING (bag_no, vehicle_tag_no, waybill_no) LEFT JOIN arrived USING (bag_no, vehicle_tag_no, waybill_no))"""


@case("d9_smu_bag_level", [*_HUB_NEEDS, *_SYSTEM_NEEDS], f"""
WITH {_SHEET_SQL}, {_HUB_SQL}, {_SYSTEM_SQL},
total AS (SELECT bag_no, vehicle_tag_no, bm_vm_concat, {', '.join(
    f'CAST(sum(CAST({m} AS DECIMAL(18,2))) AS DOUBLE) AS {m}' for m in cargo.BAG_MEASURES)} FROM system GROUP BY 1, 2, 3)
SELECT g.* EXCLUDE (mh_sending_join, mh_arrival_join), g.mh_sending_join AS mh_sending, g.mh_arrival_join AS mh_arrival, t.*
FROM hub_sheet g LEFT JOIN total t ON t.bm_vm_concat = g.bm_vm_gsheet""")
def _(s):
    return cargo.smu_bag_level(cargo.smu_hub_names(s), cargo.smu_system(s, AS_OF, **_SYSTEM_DATES))


@case("d10_smu_hub_names", _HUB_NEEDS, f"WITH {_SHEET_SQL}, {_HUB_SQL} SELECT * FROM hub_sheet")
def _(s):
    return cargo.smu_hub_names(s)


@case("d11_smu_system", _SYSTEM_NEEDS, f"WITH {_SYSTEM_SQL} SELECT * FROM system ORDER BY bag_no, waybill_no")
def _(s):
    return cargo.smu_system_sorted(cargo.smu_system(s, AS_OF, **_SYSTEM_DATES))


@case("d12_smu_waybill_level", ["smu_template_2", *_SYSTEM_NEEDS], f"""
WITH {_SHEET_SQL}, {_SYSTEM_SQL}
SELECT g.*, q.bag_no, q.vehicle_tag_no, q.bm_vm_concat, q.waybill_no, q.shipping_time, q.express_type, q.record_time,
       q.standard_shipping_fee, q.handling_fee, q.other_fee, q.insurance_amount, q.total_shipping_fee, q.system_sf, q.system_weight,
       q.sender_province_name AS origin_province, q.sender_city_name AS origin_city, q.sender_district_name AS origin_district,
       q.pickup_branch_name, q.recipient_province_name AS destination_province, q.recipient_city_name AS destination_city,
       q.recipient_district_name AS destination_district, q.pod_branch_name, q.return_flag, q.return_pod_branch_name,
       q.pod_or_return_pod_branch
FROM sheet g LEFT JOIN system q ON q.bm_vm_concat = g.bm_vm_gsheet""")
def _(s):
    return cargo.smu_waybill_level(s, cargo.smu_system(s, AS_OF, **_SYSTEM_DATES))


# --- D13, D15 ------------------------------------------------------------------------------------

_LEG_TIMES = ("request_pickup_time", "pickup_record_time", "fm_sending_time", "mh_ori_arrival_time", "sending_time_to_th_dest",
              "arrival_time_dest", "delivered_time")


def _leg(name: str, start: str, end: str) -> str:
    seconds = f"date_diff('second', {start}, {end})"
    if name in CLAMPED_LEGS:
        seconds = f"CASE WHEN {start} IS NOT NULL AND {end} IS NOT NULL THEN greatest({seconds}, 0) END"
    return f"{seconds} AS {name}"


_TO_HUB = "kind = 'Sending scan' AND after[1:2] IN ('MH', 'DC')"
_HUB_IN = "kind = 'Arrival scan' AND stop[1:2] IN ('MH', 'DC') AND before[1:2] IN ('TH', 'VH', 'VT', 'PD', 'MH')"
_HUB_OUT = "kind = 'Sending scan' AND stop[1:2] IN ('MH', 'DC') AND after[1:2] IN ('TH', 'VH', 'VT', 'PD')"


@case("d13_tokopedia_leadtime", [
    "dashboard_tokopedia", "order_order", "dm_waybill_waybill_line", "dashboard_productivity_lm", "system_option",
], f"""
WITH log AS (
  SELECT waybill_no, {local('record_time')} AS t, operation_branch_name AS stop, {label('operation_type', 'operationType')} AS kind
  FROM dm_waybill_waybill_line WHERE deleted = '0' AND {back('record_time')}),
walk AS (
  SELECT *, lag(stop) OVER seq AS before, lag(t) OVER seq AS before_t, lead(stop) OVER seq AS after
  FROM log WINDOW seq AS (PARTITION BY waybill_no ORDER BY t, stop NULLS FIRST, kind NULLS FIRST)),
pick AS (
  SELECT waybill_no, {at_first('stop', 't', _TO_HUB)} AS sb, min(t) FILTER ({_TO_HUB}) AS st,
         {at_first('stop', 't', _HUB_IN)} AS ab, min(t) FILTER ({_HUB_IN}) AS at_,
         {at_first('before', 't', _HUB_IN)} AS pb, {at_first('before_t', 't', _HUB_IN)} AS pt,
         {at_last('stop', 't', _HUB_OUT)} AS mh_sending_branch, max(t) FILTER ({_HUB_OUT}) AS sending_time_to_th_dest
  FROM walk GROUP BY waybill_no),
fact AS (
  SELECT t.*, {label('o.order_source', 'orderSource')} AS order_source, {label('o.service_type', 'serviceType')} AS service_type,
         o.sender_name, m.arrival_time AS arrival_time_dest, m.th_arrival, mh_sending_branch, sending_time_to_th_dest,
         if(coalesce(st > at_, FALSE), pb, sb) AS fm_sending_branch, if(coalesce(st > at_, FALSE), pt, st) AS fm_sending_time,
         if(coalesce(t.scheduling_or_pickup_branch LIKE '%TH VIP%', FALSE), pb, ab) AS mh_ori_arrival,
         if(coalesce(t.scheduling_or_pickup_branch LIKE '%TH VIP%', FALSE), pt, at_) AS mh_ori_arrival_time
  FROM dashboard_tokopedia t LEFT JOIN order_order o ON o.waybill_no = t.waybill_no AND {back('o.input_time')}
  LEFT JOIN dashboard_productivity_lm m ON m.waybill_no = t.waybill_no LEFT JOIN pick ON pick.waybill_no = t.waybill_no
  WHERE CAST(t.input_time AS DATE) >= {UTC_TODAY} - {ALL_DAYS})
SELECT *, {ZONE_SQL['leadtime']('', 'origin_city')} AS origin_area,
       {ZONE_SQL['leadtime']('', 'destination_city')} AS destination_area,
       {', '.join(_leg(n, a, b) for n, a, b in zip(LEG_NAMES, _LEG_TIMES, _LEG_TIMES[1:]))}
FROM fact""")
def _(s):
    return leadtime.tokopedia_leadtime(s, AS_OF, days=ALL_DAYS)


@case("d15_sent_to_3pl", ["dm_waybill_waybill_line", "waybill_waybill", "system_option"], f"""
WITH log AS (
  SELECT *, {label('operation_type', 'operationType')} AS kind, operation_branch_name[1:2] IN ('MH', 'DC') AS hub
  FROM dm_waybill_waybill_line WHERE deleted = '0' AND {back('record_time')}),
out AS (
  SELECT * FROM log WHERE next_location_name = '3PL'
  QUALIFY row_number() OVER (PARTITION BY waybill_no ORDER BY record_time DESC, operation_branch_name DESC) = 1)
SELECT out.waybill_no, w.order_no, out.operation_branch_name, out.next_location_name AS next_location,
       {local("(SELECT max(record_time) FROM log l WHERE l.waybill_no = out.waybill_no AND hub AND kind = 'Arrival scan')")} AS arrival_time_branch,
       {local("(SELECT max(record_time) FROM log l WHERE l.waybill_no = out.waybill_no AND hub AND kind = 'Unloading scan')")} AS unloading_time_branch,
       {local('out.record_time')} AS sending_time_to_3pl, w.pickup_branch_name, w.sender_district_name, w.sender_city_name,
       w.sender_province_name, {local('w.shipping_time')} AS pickup_time, w.recipient_district_name, w.recipient_city_name,
       w.recipient_province_name, {local('w.pod_record_time')} AS pod_record_time, w.item_calculated_weight
FROM out LEFT JOIN waybill_waybill w ON w.waybill_no = out.waybill_no AND {back('w.shipping_time', LONG_DAYS)}""")
def _(s):
    return leadtime.sent_to_3pl(s, AS_OF, days=ALL_DAYS, waybill_days=LONG_DAYS)


# --- D14 -----------------------------------------------------------------------------------------


def _week(ts: str) -> str:
    return f"CAST(strftime({local(ts)}, '%U') AS BIGINT)"


def _month(ts: str) -> str:
    return f"strftime({local(ts)}, '%b %Y')"


@case("d14_weekly_volume", ["waybill_waybill", "order_order", "system_option"], f"""
WITH w AS ({newest('waybill_waybill', 'waybill_no', 'update_time',
                   f"void_flag = '0' AND {local_day('shipping_time')} BETWEEN DATE '1995-01-01' AND {TODAY}")}),
p AS (
  SELECT w.waybill_no, w.shipping_time AS s, w.standard_shipping_fee AS fee, {label('w.waybill_source', 'waybillSource')} AS waybill_source,
         o.input_time AS i, ifnull(o.input_time, w.shipping_time) AS e
  FROM w LEFT JOIN order_order o ON o.waybill_no = w.waybill_no AND {local_day('o.input_time')} >= DATE '1994-09-01')
SELECT {local_day('s')} AS pickup_date, {_month('s')} AS month_pickup, {_week('s')} AS week_pickup, {local_day('e')} AS input_date,
       {_month('i')} AS month_order_oo, {_month('e')} AS month_order, {_week('i')} AS week_order_oo, {_week('e')} AS week_order,
       waybill_source, count(waybill_no) AS total_volume, CAST(sum(fee) AS DOUBLE) AS standard_shipping_fee
FROM p GROUP BY ALL ORDER BY pickup_date, week_pickup, total_volume DESC""")
def _(s):
    return volume.weekly_volume(s, AS_OF, start=date(1995, 1, 1), orders_start=date(1994, 9, 1))


# --- D16, D18 ------------------------------------------------------------------------------------

_LANES = "masterdata_sla_shopee"
_RETURN_NOW = "ret AS (" + newest("waybill_return_bill", "waybill_no", "update_time", "deleted = '0'") + ")"
_FASHION = in_list(rules.ZALORA_SOURCES)


def _lane_parcels(days: int) -> str:
    """Newest waybill version on a promised lane; a lane listed twice keeps its smallest promise."""
    return f"""lanes AS (SELECT * FROM masterdata_sla_shopee
    QUALIFY row_number() OVER (PARTITION BY origin_city, destination_city ORDER BY sla NULLS FIRST) = 1),
ship AS (
  SELECT w.*, CAST(l.sla AS BIGINT) AS lane_days FROM waybill_waybill w JOIN lanes l
    ON l.origin_city = w.sender_city_name AND l.destination_city = w.recipient_city_name
  WHERE w.deleted = '0' AND {back('w.shipping_time', days)}
  QUALIFY row_number() OVER (PARTITION BY w.waybill_no ORDER BY w.update_time DESC) = 1)"""


_STATUS = (
    "CASE WHEN ship.pod_record_time IS NOT NULL THEN 'Delivered' "
    "WHEN ret.return_confirm_record_time IS NOT NULL THEN if(ret.return_pod_record_time IS NULL, 'Return Process', 'Returned') "
    "WHEN ret.return_pod_record_time IS NULL THEN 'Delivery Process' END"
)


@case("d16_zalora_daily", [
    "order_order", "waybill_waybill", "waybill_problem_piece", "waybill_return_bill", "system_option", _LANES,
], f"""
WITH {_lane_parcels(ALL_DAYS)}, {_RETURN_NOW},
pos AS ({_last_problem(_NO_PICKUP_PROBLEM + ' AND ' + back('operation_time'))}),
fact AS (
  SELECT o.*, {label('o.order_source', 'orderSource')} AS src, {_STATUS} AS pod_status, ship.shipping_time AS shipped,
         ship.pod_record_time AS pod, ship.signer, ship.item_calculated_weight AS kg, ship.recipient_city_name AS dest_city,
         ship.recipient_province_name AS dest_prov, ship.lane_days, {due('ship.shipping_time', 'ship.lane_days')} AS due_day,
         pos.pos_time, pos.pos_reason, ret.return_confirm_record_time AS rc, ret.return_pod_record_time AS rp, ret.return_signer
  FROM order_order o JOIN ship USING (waybill_no) LEFT JOIN pos USING (waybill_no) LEFT JOIN ret USING (waybill_no)
  WHERE {back('o.input_time')} AND src IN {_FASHION})
SELECT waybill_no, order_no AS package_number, order_no AS no_order, sender_name AS seller_name, recipient_name AS customer_name,
       recipient_address AS customer_address, recipient_city_name AS shipping_city, recipient_cellphone AS cust_phone_no,
       recipient_province_name AS region, sender_city_name AS origin_city, kg AS chargeable_weight_by_3PL, kg AS real_weight,
       kg AS volumetric_kg, {local('shipped')} AS shipping_time, lane_days AS SLA_Delivery, due_day AS Due_Date_Delivery,
       {verdict('pod', 'due_day', 'lane_days', 'NULL', "'Not Late'")} AS Deliv_Performance,
       if(due_day IS NULL, NULL, if(coalesce({local_day('pod')}, {TODAY}) > due_day, 'Late', 'Not Late')) AS OTD_Status,
       pod_status, {local('pod')} AS pod_date, signer AS receiver, {local('pos_time')} AS POS_attempt,
       pos_reason AS problem_reason_remarks, {local('rc')} AS return_start_date, {local('rp')} AS return_pod_date,
       return_signer AS penerima_return, if(pod_status = 'Delivered', 'POD', pod_status) AS status_sistem, src AS order_source,
       {ZONE_SQL['fashion']('dest_prov', 'dest_city')} AS city_category, dest_city, dest_prov, {local('input_time')} AS input_time
FROM fact""")
def _(s):
    return sla.zalora_daily(s, AS_OF, days=ALL_DAYS)


@case("d18_zalora_performance", [
    "dashboard_bd_kpi_monthly", "waybill_waybill", "waybill_problem_piece", "waybill_return_bill", "system_option",
    _LANES, "standard_shipping_fee", "mitra_late_reason_delivery",
], f"""
WITH {_lane_parcels(ALL_DAYS)}, {_RETURN_NOW}, {TARIFF_CTE},
pos AS (SELECT waybill_no, min(operation_time) AS pos_time, {at_first('problem_reason', 'operation_time')} AS pos_reason
        FROM waybill_problem_piece WHERE {_NO_PICKUP_PROBLEM} AND {back('operation_time')} GROUP BY 1),
fact AS (
  SELECT k.*, {_STATUS} AS status, ship.shipping_time AS shipped, ship.pod_record_time AS pod,
         ship.recipient_city_name AS dest_city, ship.recipient_province_name AS dest_province,
         ship.recipient_district_name AS dest_district, ship.lane_days AS old, t.min_sla, t.max_sla AS new,
         {due('ship.shipping_time', 't.max_sla')} AS new_due, {due('ship.shipping_time', 'ship.lane_days')} AS old_due,
         pos.pos_time, coalesce(pos.pos_reason, m.late_delivery_reason) AS why
  FROM dashboard_bd_kpi_monthly k JOIN ship USING (waybill_no) LEFT JOIN pos USING (waybill_no) LEFT JOIN ret USING (waybill_no)
  LEFT JOIN mitra_late_reason_delivery m USING (waybill_no)
  LEFT JOIN tariff t ON t.c = ship.vip_customer_id AND t.s = ship.sender_city_id AND t.r = ship.recipient_district_id
       AND t.e = ship.express_type
  WHERE CAST(k.input_time AS DATE) >= {UTC_TODAY} - {ALL_DAYS} AND k.Order_Source IN {_FASHION}),
judged AS (SELECT *, {verdict('pod', 'new_due', 'new', 'NULL', "'Not Late'")} AS v,
                  {verdict('pod', 'old_due', 'old', 'NULL', "'Not Late'")} AS old_v FROM fact)
SELECT waybill_no, order_no AS package_number, order_no AS no_order, input_time AS Waktu_Input, {local('shipped')} AS shipping_time,
       Order_Source AS order_source, Sender_Name AS seller_name, Pickup_Time, Order_Status, Pickup_Failure_Reason,
       pickup_failure_time AS Pickup_Failure_Attempt, scheduling_or_pickup_branch AS Origin_Branch,
       sender_district_name AS Origin_District, sender_city_name AS Origin_City, sender_province_name AS Origin_Province,
       sender_city_name || ' - ' || sender_district_name AS Origin_City_District, dest_city || ' - ' || dest_district AS Dest_City_District,
       Pickup_Category_everpro AS Pickup_Category,
       CASE WHEN Pickup_Performance_everpro = 'Late' THEN 'Late' WHEN Pickup_Performance_everpro IS NOT NULL THEN 'Not Late' END AS Pickup_Performance,
       Pickup_Status, Late_Pickup_Factor, Late_Pickup_Category, min_sla AS min_SLA_Delivery, new AS SLA_Delivery,
       old AS SLA_Delivery_old, new_due AS due_date_delivery, v AS Deliv_Performance, new_due AS Due_Date_Delivery_old,
       old_v AS Deliv_Performance_old, status AS pod_status, {local('pod')} AS pod_date, {local('pos_time')} AS POS_attempt,
       why AS problem_reason_remarks, if(status = 'Delivered', 'POD', status) AS status_sistem,
       {ZONE_SQL['fashion']('dest_province', 'dest_city')} AS city_category, dest_city, dest_province, dest_district,
       {rule_lookup('v', 'why', rules.FASHION_FACTOR_RULES)} AS Late_Deliv_Factor,
       {rule_lookup('v', 'why', rules.FASHION_CATEGORY_RULES)} AS Late_Deliv_Category
FROM judged""")
def _(s):
    return sla.zalora_performance(s, AS_OF, days=ALL_DAYS)


# --- D17 -----------------------------------------------------------------------------------------


def _bucket(stage: str, days: str) -> str:
    return (
        f"CASE WHEN backlog_return_flag = '{stage}' THEN (SELECT b.label FROM (VALUES (-100000, 2, '<3 Days'), (3, 7, '3-7 Days'), "
        f"(8, 14, '8-14 Days'), (15, 30, '15-30 Days'), (31, 100000, '>30 Days')) AS b(lo, hi, label) WHERE {days} BETWEEN b.lo AND b.hi) END"
    )


@case("d17_return_monitoring", [
    "waybill_waybill", "waybill_return_bill", "system_option", "mapping_kanwil_area", "return_type",
], f"""
WITH w AS ({newest('waybill_waybill', 'waybill_no', 'update_time', back('update_time') + " AND void_flag = '0' AND deleted = '0'")}),
r AS ({newest('waybill_return_bill', 'waybill_no', 'update_time', back('update_time') + ' AND ' + back('return_record_time'))}),
shown AS (
  SELECT w.waybill_no, CAST(1 AS BIGINT) AS waybill_alias, {local('w.shipping_time')} AS shipping_time,
         {label('w.waybill_source', 'waybillSource')} AS waybill_source, w.parent_shipping_cleint AS vip_username, w.sender_name,
         w.sender_cellphone, w.sender_province_name, w.sender_city_name, w.sender_district_name, w.pickup_branch_name,
         w.recipient_district_name, w.recipient_city_name, w.recipient_province_name,
         {label('w.express_type', 'expressType')} AS express_type, {label('w.service_type', 'serviceType')} AS service_type,
         k.kanwil_name AS kanwil_name_regist, {local('r.return_record_time')} AS return_regist_time,
         r.return_branch_name AS return_register_branch, t.return_type AS remarks_return,
         {local('r.return_confirm_record_time')} AS return_confirm_time,
         {label('r.return_confirm_status', 'returnConfirmStatus')} AS return_confirm_status,
         CAST(r.return_shipping_fee AS DOUBLE) AS return_shipping_fee, {local('r.return_pod_record_time')} AS return_pod_record_time,
         {local('r.update_time')} AS update_time_rr, CAST(1 AS BIGINT) AS return_regist_alias,
         CAST(r.return_confirm_record_time IS NOT NULL AS BIGINT) AS return_confirm_alias, CAST(0 AS BIGINT) AS return_pod_alias,
         CAST(r.return_confirm_record_time IS NULL AS BIGINT) AS backlog_confirm_alias,
         if(r.return_confirm_record_time IS NULL, 'Backlog Confirm Return', 'Backlog Return') AS backlog_return_flag,
         date_diff('day', {local_day('r.return_record_time')}, {UTC_TODAY}) AS aging_backlog_confirm,
         date_diff('day', {local_day('r.return_confirm_record_time')}, {UTC_TODAY}) AS aging_backlog_return
  FROM w JOIN r ON r.waybill_no = w.waybill_no AND r.return_record_time IS NOT NULL AND r.return_pod_record_time IS NULL
  LEFT JOIN mapping_kanwil_area k ON k.province_name = w.recipient_province_name
  LEFT JOIN return_type t ON t.id = r.return_type_id AND t.deleted = 0)
SELECT *, {_bucket('Backlog Confirm Return', 'aging_backlog_confirm')} AS backlog_confirm_category,
       {_bucket('Backlog Return', 'aging_backlog_return')} AS backlog_return_category FROM shown""")
def _(s):
    return backlog.return_monitoring(s, AS_OF, days=ALL_DAYS)
