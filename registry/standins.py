"""Carrier tables derived from the given star schema.

The given data has no parcels, so orders stand in for waybills, line items for scans, suppliers for
branches and couriers, nations for places. Each view is plain SQL that Spark and DuckDB read alike and
keeps every row of its source; the same text goes in front of the DuckDB statement, so both engines
start from the same rows. Second versions, NULLs, ties, VIP branches and codes without a label are in.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# A place per nation.
PLACES = [
    ("JAKARTA BARAT", "DKI JAKARTA"), ("BEKASI", "JAWA BARAT"), ("KOTA BOGOR", "JAWA BARAT"),
    ("BANDUNG", "JAWA BARAT"), ("SEMARANG", "JAWA TENGAH"), ("SURABAYA", "JAWA TIMUR"),
    ("TANGERANG", "BANTEN"), ("TANGERANG SELATAN", "BANTEN"), ("MEDAN", "SUMATERA UTARA"),
    ("PALEMBANG", "SUMATERA SELATAN"), ("JAKARTA TIMUR", "DKI JAKARTA"), ("KOTA DEPOK", "JAWA BARAT"),
    ("SLEMAN", "DI YOGYAKARTA"), ("DENPASAR", "BALI"), ("PONTIANAK", "KALIMANTAN BARAT"),
    ("MAKASSAR", "SULAWESI SELATAN"), (None, "PAPUA"), ("AMBON", "MALUKU"), ("BOGOR", "JAWA BARAT"),
    ("KOTA BEKASI", "JAWA BARAT"), ("PADANG", "SUMATERA BARAT"), ("KOTA TANGERANG", "BANTEN"),
    ("SORONG", None), ("MALANG", "JAWA TIMUR"), ("SAMARINDA", "KALIMANTAN TIMUR"),
]
OFFICES = {
    "SUMATERA UTARA": "SUMATERA BAGIAN UTARA", "SUMATERA BARAT": "SUMATERA BAGIAN UTARA",
    "SUMATERA SELATAN": "SUMATERA BAGIAN SELATAN", "DKI JAKARTA": "JABODETABEK", "BANTEN": "JABODETABEK",
    "JAWA BARAT": "JAWA BARAT", "JAWA TENGAH": "JAWA TENGAH", "DI YOGYAKARTA": "JAWA TENGAH",
    "JAWA TIMUR": "JAWA TIMUR", "BALI": "JAWA TIMUR", "KALIMANTAN BARAT": "KALIMANTAN",
    "KALIMANTAN TIMUR": "KALIMANTAN", "SULAWESI SELATAN": "SULAWESI", "PAPUA": "3PL", "MALUKU": "3PL",
}
REASONS = [
    "Paket hilang atau tidak ditemukan", "Paket hilang ditemukan", "Alamat tidak lengkap",
    "Cuaca buruk / Hujan", "Alamat pelanggan salah/sudah pindah alamat", "Pengirim tidak di tempat",
    None, "Kurir tidak available", "Late Delivery", "Pengirim tidak dapat dihubungi", "Reason in no list",
]
OPTIONS = [
    ("waybillSource", "10", "Blibli"), ("waybillSource", "20", "everpro"), ("waybillSource", "753", "Mengantar"),
    ("waybillSource", "40", "pt fashion eservices indonesia"),
    ("orderSource", "10", "Blibli"), ("orderSource", "20", "Blibli API"), ("orderSource", "753", "Mengantar"),
    ("orderSource", "40", "pt fashion eservices indonesia"),
    ("expressType", "0", "Reguler"), ("expressType", "1", "Same Day"),
    ("serviceType", "0", "Pickup"), ("serviceType", "1", "Drop Off"),
    ("operationType", "04", "Sending scan"), ("operationType", "05", "Arrival scan"),
    ("operationType", "06", "Unloading scan"), ("operationType", "09", "Delivery scan"),
    ("operationType", "18", "Problem scan"), ("operationType", "19", "Return register"),
    ("problemType", "01", "Delivery problem"), ("problemType", "02", "Pickup problem"),
    ("branchLevel", "1", "TH"), ("branchLevel", "2", "MH"), ("branchLevel", "3", "PDB"),
    ("branchLevel", "4", "Agent"), ("branchLevel", "5", "Outlet"),
    ("voidFlag", "0", "Not void"), ("voidFlag", "0", "Active"), ("voidFlag", "1", "Void"),
    ("returnFlag", "0", "No return"), ("returnFlag", "1", "Return"),
    ("returnConfirmStatus", "0", "Open"), ("returnConfirmStatus", "1", "Confirmed"),
    ("orderStatus", "P", "Picked Up"), ("orderStatus", "O", "Cancel Order"), ("orderStatus", "F", "Done"),
]


def _sql(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def _pick(expr: str, values: list[str | None]) -> str:
    whens = " ".join(f"WHEN {i} THEN {_sql(v)}" for i, v in enumerate(values) if v is not None)
    return f"CASE {expr} {whens} END"


def _number(key: str) -> str:
    return f"CASE WHEN {key} % 5 = 4 THEN 'IDS' ELSE 'IDE' END || CAST({key} AS STRING)"


def _hours(expr: str) -> str:
    return f"INTERVAL '1' HOUR * CAST({expr} AS INT)"


def _branch(key: str) -> str:
    prefix = _pick(f"{key} % 7", ["MH ", "DC ", "TH ", "TH VIP ", "VH ", "MH ", "PD "])
    return f"({prefix}) || CAST({key} % 25 AS STRING)"


_REASON = _pick("l_suppkey % 11", REASONS)
_MONEY = "CAST({} AS DECIMAL(18,2))"

VIEWS: dict[str, str] = {}

VIEWS["place"] = f"""
SELECT CAST(n_nationkey AS BIGINT) AS place_id, {_pick('n_nationkey', [c for c, _ in PLACES])} AS city,
       {_pick('n_nationkey', [p for _, p in PLACES])} AS province, 'KEC ' || CAST(n_nationkey AS STRING) AS district
FROM nation"""

VIEWS["system_option"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_sql(a)}, {_sql(b)}, {_sql(c)})" for a, b, c in OPTIONS
) + ") AS t(type_option, option_value, option_name)"

VIEWS["parcel"] = f"""
SELECT o_orderkey AS k, o_custkey AS client, o_orderstatus AS status, {_number('o_orderkey')} AS waybill_no,
       o_orderdate AS day, {_MONEY.format('o_totalprice')} AS fee, {_branch('o_orderkey')} AS branch,
       {_branch('o_custkey')} AS pickup_branch,
       CASE o_orderpriority WHEN '1-URGENT' THEN '10' WHEN '2-HIGH' THEN '20' WHEN '3-MEDIUM' THEN '753'
            WHEN '4-NOT SPECIFIED' THEN '40' ELSE '99' END AS source,
       CAST(o_orderkey % 3 AS STRING) AS express,
       CAST(o_custkey % 25 AS BIGINT) AS s_id, s.city AS s_city, s.province AS s_province, s.district AS s_district,
       CAST((o_custkey + o_orderkey) % 25 AS BIGINT) AS r_id, r.city AS r_city, r.province AS r_province,
       r.district AS r_district
FROM orders LEFT JOIN place s ON s.place_id = o_custkey % 25
     LEFT JOIN place r ON r.place_id = (o_custkey + o_orderkey) % 25"""

# Two versions of a parcel: at shipping, and (unless still open) after delivery or return.
_WAYBILL_COLS = f"""
waybill_no, 'ORD' || CAST(k AS STRING) AS order_no, 'EC' || CAST(k AS STRING) AS ecommerce_order_no,
source AS waybill_source, express AS express_type, CAST(k % 2 AS STRING) AS service_type,
CASE WHEN k % 17 = 0 THEN '1' ELSE '0' END AS void_flag, CASE WHEN k % 31 = 0 THEN '1' ELSE '0' END AS deleted,
CASE WHEN status = 'P' THEN '1' ELSE '0' END AS return_flag,
day + {_hours('k % 24')} AS shipping_time,
'Sender ' || CAST(client AS STRING) AS sender_name, 'Sender street ' || CAST(client AS STRING) AS sender_address,
'0812' || CAST(client AS STRING) AS sender_cellphone, s_province AS sender_province_name,
s_city AS sender_city_name, s_district AS sender_district_name, s_id AS sender_city_id,
'Street ' || CAST(k % 100 AS STRING) AS recipient_address, r_province AS recipient_province_name,
r_city AS recipient_city_name, r_district AS recipient_district_name, r_id AS recipient_district_id,
CAST(k % 40 AS BIGINT) AS pickup_branch_id, pickup_branch AS pickup_branch_name,
CAST(CASE WHEN k % 6 = 0 THEN 0 ELSE k % 60 END AS BIGINT) AS pickup_courier_id,
CASE WHEN k % 6 = 0 THEN '' ELSE 'Courier ' || CAST(k % 60 AS STRING) END AS pickup_courier_name,
branch AS delivery_branch_name, client AS vip_customer_id, 'Client ' || CAST(client AS STRING) AS vip_customer_name,
'Parent ' || CAST(client % 20 AS STRING) AS parent_shipping_cleint,
CAST(k % 7 AS STRING) || '.5' AS item_calculated_weight, CAST(k % 4 AS STRING) || '.25' AS item_volume_weight,
CAST(k % 5 AS STRING) AS item_actual_weight, fee AS item_value, CAST(fee - 5 AS DECIMAL(18,2)) AS cod_amount"""


def _version(update: str, pod: str, returned: str, extra: str, where: str) -> str:
    done = f"({pod}) IS NOT NULL"
    return f"""
SELECT {_WAYBILL_COLS},
       day + {_hours(update)} AS update_time, {pod} AS pod_record_time, {returned} AS return_pod_record_time,
       CASE WHEN {done} THEN CAST(k % 30 AS BIGINT) END AS pod_branch_id,
       CASE WHEN {done} THEN branch END AS pod_branch_name,
       CASE WHEN {done} THEN CAST(k % 50 AS BIGINT) END AS pod_courier_id,
       CASE WHEN {done} THEN 'Courier ' || CAST(k % 50 AS STRING) END AS pod_courier_name,
       CASE WHEN {done} THEN 'photo/pod/' || CAST(k AS STRING) END AS pod_photo_url,
       CASE WHEN {done} THEN 'Signer ' || CAST(k % 9 AS STRING) END AS signer,
       CASE WHEN ({returned}) IS NOT NULL THEN pickup_branch END AS return_pod_branch_name,
       fee + {extra} AS standard_shipping_fee, CAST(k % 11 AS DECIMAL(18,2)) AS handling_fee,
       CAST(k % 3 AS DECIMAL(18,2)) AS other_fee, CAST(k % 8 AS DECIMAL(18,2)) AS insurance_amount,
       fee + {extra} + 10 AS total_shipping_fee
FROM parcel {where}"""


VIEWS["waybill_waybill"] = (
    _version("k % 24 + 1", "CASE WHEN status = 'X' THEN day END", "CASE WHEN status = 'X' THEN day END", "0", "")
    + "\nUNION ALL"
    + _version(
        "k % 24 + 200",
        f"CASE WHEN status = 'F' THEN day + {_hours('k % 200')} END",
        f"CASE WHEN status = 'P' AND k % 4 = 0 THEN day + {_hours('k % 24 + 240')} END",
        "1",
        "WHERE status <> 'O'",
    )
)
VIEWS["dm_waybill_waybill"] = "SELECT * FROM waybill_waybill"

VIEWS["order_order"] = f"""
SELECT waybill_no, 'ORD' || CAST(k AS STRING) AS order_no, day + {_hours('k % 24 - 30')} AS input_time,
       source AS order_source, status AS order_status, CAST(k % 3 AS STRING) AS service_type,
       CASE WHEN k % 10 = 0 THEN '1' ELSE express END AS express_type, CAST(k % 2 AS STRING) AS payment_type,
       CAST(k % 45 AS BIGINT) AS pickup_courier_id, 'Order courier ' || CAST(k % 45 AS STRING) AS pickup_courier_name,
       'Sender ' || CAST(client AS STRING) AS sender_name,
       CASE WHEN k % 7 = 0 THEN 'OTHER CITY' ELSE s_city END AS sender_city_name,
       CASE WHEN k % 9 = 0 THEN 'OTHER DISTRICT' ELSE s_district END AS sender_district_name,
       'Recipient ' || CAST(k % 77 AS STRING) AS recipient_name, 'Street ' || CAST(k % 100 AS STRING) AS recipient_address,
       CASE WHEN k % 8 = 0 THEN 'OTHER CITY' ELSE r_city END AS recipient_city_name,
       CASE WHEN k % 11 = 0 THEN 'OTHER DISTRICT' ELSE r_district END AS recipient_district_name,
       r_province AS recipient_province_name, '0813' || CAST(k AS STRING) AS recipient_cellphone,
       CAST(k % 14 AS STRING) || '.5' AS item_calculated_weight, CAST(k % 6 AS STRING) || '.25' AS item_volume_weight,
       CAST(k % 10 AS STRING) AS item_weight, fee AS standard_shipping_fee, CAST(k % 11 AS DECIMAL(18,2)) AS handling_fee,
       CAST(k % 4 AS DECIMAL(18,2)) AS other_fee, CAST(k % 5 AS DECIMAL(18,2)) AS insurance_amount,
       fee + 10 AS total_shipping_fee
FROM parcel WHERE source <> '99'"""

VIEWS["waybill_waybill_line"] = f"""
SELECT {_number('l_orderkey')} AS waybill_no, l_shipdate + {_hours('l_linenumber')} AS record_time,
       {_pick('l_linenumber', [None, '04', '05', '09', '18', '19', '06', '04'])} AS operation_type,
       {_branch('l_suppkey')} AS operation_branch_name,
       CASE WHEN l_partkey % 13 = 0 THEN '' WHEN l_partkey % 17 <> 0 THEN 'BM' || CAST(l_suppkey AS STRING) END AS bag_no,
       CASE WHEN l_partkey % 9 <> 0 THEN 'VM' || CAST(l_partkey % 50 AS STRING) END AS vehicle_tag_no,
       CASE WHEN l_partkey % 10 <> 0 THEN 'photo/' || CAST(l_partkey AS STRING) END AS photo_url,
       CASE WHEN l_linestatus = 'O' THEN '01' ELSE '02' END AS problem_type, CAST(l_suppkey % 11 AS STRING) AS problem_code,
       {_REASON} AS register_reason_bahasa,
       CASE WHEN l_partkey % 6 = 0 THEN '3PL' ELSE 'TH ' || CAST(l_partkey % 25 AS STRING) END AS next_location_name,
       CASE WHEN l_tax > 0.07 THEN '1' ELSE '0' END AS deleted
FROM lineitem
UNION ALL
SELECT {_number('l_orderkey')}, l_shipdate + {_hours('l_linenumber')},
       CASE l_suppkey % 3 WHEN 0 THEN '77' WHEN 1 THEN '04' ELSE '18' END, {_branch('l_suppkey')},
       'BM' || CAST(l_suppkey AS STRING), NULL, NULL, '01', CAST(l_suppkey % 11 AS STRING), {_REASON},
       'TH ' || CAST(l_partkey % 25 AS STRING), '0'
FROM lineitem WHERE l_partkey % 12 = 0"""
VIEWS["dm_waybill_waybill_line"] = "SELECT * FROM waybill_waybill_line"

VIEWS["waybill_problem_piece"] = f"""
SELECT {_number('l_orderkey')} AS waybill_no,
       l_shipdate - INTERVAL '1' DAY * CAST(extract(day FROM l_shipdate) AS INT) + {_hours('l_linenumber')} AS operation_time,
       CASE WHEN l_linestatus = 'O' THEN '01' ELSE '02' END AS problem_type, {_REASON} AS problem_reason,
       {_branch('l_suppkey')} AS operation_branch_name, CASE WHEN l_tax > 0.07 THEN '1' ELSE '0' END AS deleted
FROM lineitem WHERE l_returnflag <> 'N'"""

_RETURN_COLS = """CAST(k % 5 AS BIGINT) AS return_type_id, pickup_branch AS return_branch_name,
       CAST(k % 6 AS DECIMAL(18,2)) AS return_shipping_fee, 'Return signer ' || CAST(k % 5 AS STRING) AS return_signer,
       s_city AS recipient_city_name, s_province AS recipient_province_name"""
VIEWS["waybill_return_bill"] = f"""
SELECT waybill_no, day + {_hours('k % 24 + 120')} AS update_time, day + {_hours('k % 24 + 120')} AS return_record_time,
       CASE WHEN status = 'X' THEN day END AS return_confirm_record_time,
       CASE WHEN status = 'X' THEN day END AS return_pod_record_time, '0' AS return_confirm_status, {_RETURN_COLS},
       '0' AS deleted
FROM parcel WHERE status = 'P'
UNION ALL
SELECT waybill_no, day + {_hours('k % 24 + 180')}, day + {_hours('k % 24 + 130')},
       CASE WHEN k % 2 = 0 THEN day + {_hours('k % 24 + 170')} END,
       CASE WHEN k % 4 = 0 THEN day + {_hours('k % 24 + 240')} END, CAST(1 - k % 2 AS STRING), {_RETURN_COLS},
       CASE WHEN k % 23 = 0 THEN '1' ELSE '0' END
FROM parcel WHERE status = 'P' AND source <> '99'"""

VIEWS["standard_shipping_fee"] = f"""
SELECT CAST(client AS STRING) || '-' || CAST(r_id AS STRING) || '-' || express AS search_code, s_id AS sender_location_id,
       r_id AS recipient_location_id, express AS express_type, client AS shipping_client_id,
       CAST(k % 4 AS BIGINT) AS min_sla,
       CAST(CASE k % 9 WHEN 0 THEN 998 WHEN 1 THEN 999 WHEN 2 THEN NULL ELSE k % 9 END AS BIGINT) AS max_sla,
       day + {_hours('24 * 365 * (k % 12)')} AS end_expire_time, day + {_hours('k % 1000')} AS created_at,
       CASE WHEN k % 29 = 0 THEN '1' ELSE '0' END AS deleted
FROM parcel WHERE status <> 'O'"""

VIEWS["lane"] = """
SELECT s_city, r_city, r_district, min(s_id) AS s_id, min(r_id) AS r_id
FROM parcel WHERE status <> 'P' GROUP BY s_city, r_city, r_district"""
VIEWS["sla_internal"] = """
SELECT s_city AS Origin_City, r_city AS Destination_City, r_district AS Destination,
       CAST(CASE (s_id + r_id) % 10 WHEN 0 THEN 998 WHEN 1 THEN 999 WHEN 2 THEN NULL ELSE (s_id + r_id) % 10 END AS BIGINT)
           AS SLAinternal
FROM lane WHERE s_id <> r_id"""
VIEWS["masterdata_sla_shopee"] = """
SELECT s_city AS origin_city, r_city AS destination_city,
       CASE (s_id + r_id) % 10 WHEN 1 THEN '999' WHEN 2 THEN NULL ELSE CAST((s_id + r_id) % 10 AS STRING) END AS sla
FROM lane"""

VIEWS["mapping_kanwil_area"] = (
    "SELECT DISTINCT province AS province_name, CASE province "
    + " ".join(f"WHEN {_sql(p)} THEN {_sql(o)}" for p, o in OFFICES.items())
    + " END AS kanwil_name FROM place WHERE province IS NOT NULL"
)
VIEWS["branch"] = f"""
SELECT s_suppkey, {_branch('s_suppkey')} AS branch_name, 'B' || CAST(s_suppkey AS STRING) AS branch_no,
       city, province, place_id
FROM supplier LEFT JOIN place ON place_id = s_nationkey"""
VIEWS["masterdata_facility_to_kanwil"] = """
SELECT b.branch_name, b.branch_no, m.kanwil_name, b.city AS city_name, b.province AS province_name
FROM branch b LEFT JOIN mapping_kanwil_area m ON m.province_name = b.province"""
VIEWS["masterdata_backlog_city_to_ma"] = """
SELECT district AS destination, city AS destination_city, 'Area ' || CAST(place_id % 6 AS STRING) AS mitra_by_area
FROM place"""
VIEWS["mitra_late_reason_delivery"] = f"""
SELECT waybill_no, {_pick('k % 11', REASONS)} AS late_delivery_reason FROM parcel WHERE status = 'F'"""
VIEWS["masterdata_mapping_problem_factor"] = "SELECT * FROM (VALUES " + ", ".join(
    f"({_sql(r)}, {_sql('Partner: ' + r)}, {_sql(f'Factor {i % 3}')}, {_sql(f'Category {i % 2}')}), "
    f"({_sql('x' + r)}, {_sql(r)}, {_sql(f'Factor {i % 2}')}, {_sql(f'Category {i % 3}')})"
    for i, r in enumerate(REASONS) if r
) + ") AS t(code, register_reason_bahasa, problem_factor, problem_category)"
VIEWS["masterdata_branch_coverage_th"] = """
SELECT place_id AS district_id, 'TH ' || CAST(place_id AS STRING) AS branch_name FROM place WHERE city IS NOT NULL"""
VIEWS["res_user"] = """
SELECT s_suppkey AS id, 'P' || CAST(s_suppkey AS STRING) AS personnel_no,
       CASE s_suppkey % 3 WHEN 0 THEN '0' ELSE '1' END AS enabled, CASE WHEN s_suppkey % 8 = 5 THEN '1' ELSE '0' END AS deleted
FROM supplier"""
VIEWS["res_branch"] = """
SELECT s_suppkey AS id, 'B' || CAST(s_suppkey AS STRING) AS branch_no, CAST(s_suppkey % 6 AS STRING) AS branch_level,
       CAST(s_nationkey AS BIGINT) AS city_id FROM supplier
UNION ALL
SELECT s_suppkey, 'B' || CAST(s_suppkey AS STRING) || ' closed', CAST(s_suppkey % 5 AS STRING), CAST(s_nationkey AS BIGINT)
FROM supplier WHERE s_suppkey % 7 = 0"""
VIEWS["res_area"] = """
SELECT CAST(c_nationkey AS BIGINT) AS city_id, province AS province_name
FROM customer LEFT JOIN place ON place_id = c_nationkey"""
VIEWS["return_type"] = """
SELECT CAST(r_regionkey AS BIGINT) AS id, 'Return: ' || r_name AS return_type,
       CAST(CASE r_name WHEN 'ASIA' THEN 1 ELSE 0 END AS BIGINT) AS deleted FROM region"""
VIEWS["a_mh_facility_name_rnd"] = """
SELECT CASE s_nationkey WHEN 0 THEN 'CGK' ELSE 'H' || CAST(s_nationkey AS STRING) END AS mh_code,
       'MH ' || CAST(s_nationkey AS STRING) AS mh_name FROM supplier WHERE s_nationkey <> 3"""

VIEWS["smu_template_2"] = """
SELECT date_part_text AS report_date, CASE n % 5 WHEN 0 THEN 'CGK' ELSE 'H' || CAST(n % 25 AS STRING) END AS origin,
       'H' || CAST((n + 3) % 25 AS STRING) AS destination_by_bagging,
       CASE n % 7 WHEN 0 THEN 'CGK' ELSE 'H' || CAST((n + 4) % 25 AS STRING) END AS destination_by_issued,
       parcels AS no_of_packages, CAST(parcels AS DECIMAL(18,2)) AS smu_weight,
       CASE WHEN n % 19 <> 0 THEN 'BM' || CAST(l_suppkey AS STRING) END AS bm_code, 'VM' || CAST(vehicle AS STRING) AS vm_code,
       'Island ' || CAST(n % 4 AS STRING) AS area_pulau, 'SMU' || CAST(n AS STRING) AS smu_booking_code,
       CAST(parcels * 3 AS DECIMAL(18,2)) AS total_smu_fee, 'FL' || CAST(n % 12 AS STRING) AS flight_no,
       'Air ' || CAST(n % 3 AS STRING) AS airlanes, 'Vendor ' || CAST(n % 2 AS STRING) AS vendor
FROM (SELECT l_suppkey, l_partkey % 50 AS vehicle, l_suppkey * 50 + l_partkey % 50 AS n, count(*) AS parcels,
             '0' || CAST(1 + l_suppkey % 9 AS STRING) || '/1' || CAST(l_partkey % 50 % 10 AS STRING) || '/1999' AS date_part_text
      FROM lineitem GROUP BY l_suppkey, l_partkey % 50) t"""

VIEWS["dashboard_productivity_lm"] = f"""
SELECT waybill_no, source AS waybill_source, CAST(k % 20 AS BIGINT) AS aging_day, branch AS th_arrival,
       day + {_hours('k % 96')} AS arrival_time,
       CASE WHEN status = 'F' THEN day + {_hours('k % 200 + 7')} END AS pod_time,
       CASE WHEN status = 'P' AND k % 3 = 0 THEN day + {_hours('k % 24 + 127')} END AS return_regist_time
FROM parcel"""
VIEWS["dashboard_tokopedia"] = f"""
SELECT waybill_no, 'EC' || CAST(k AS STRING) AS ecommerce_order_no, 'ORD' || CAST(k AS STRING) AS order_no,
       day + {_hours('k % 24 - 23')} AS input_time, day + {_hours('k % 24 - 20')} AS request_pickup_time,
       CASE WHEN k % 13 <> 0 THEN day + {_hours('k % 24 + 7')} END AS pickup_record_time,
       CASE WHEN status = 'F' THEN day + {_hours('k % 200 + 7')} END AS delivered_time,
       CASE k % 2 WHEN 0 THEN 'Pickup' ELSE 'Drop Off' END AS delivery_type, 'Role ' || CAST(k % 3 AS STRING) AS role_miles,
       s_province AS origin_province, s_city AS origin_city, pickup_branch AS scheduling_or_pickup_branch,
       r_province AS destination_province, r_city AS destination_city, branch AS delivery_or_pod_branch,
       status AS waybill_status, 'Route ' || CAST(r_id % 4 AS STRING) AS route_category
FROM parcel"""
VIEWS["dashboard_bd_kpi_monthly"] = f"""
SELECT waybill_no, 'ORD' || CAST(k AS STRING) AS order_no, day + {_hours('k % 24 - 23')} AS input_time,
       day + {_hours('k % 24 + 7')} AS Pickup_Time, CASE WHEN k % 6 = 0 THEN day + {_hours('k % 24 + 3')} END AS pickup_failure_time,
       day + {_hours('k % 24 + 30')} AS update_time_oo, status AS Order_Status,
       CASE source WHEN '40' THEN 'pt fashion eservices indonesia' WHEN '20' THEN 'pt fashion marketplace indonesia'
            ELSE 'Other' END AS Order_Source,
       CASE WHEN k % 6 = 0 THEN 'Pengirim tidak di tempat' END AS Pickup_Failure_Reason,
       'Sender ' || CAST(client AS STRING) AS Sender_Name, pickup_branch AS scheduling_or_pickup_branch,
       s_district AS sender_district_name, s_city AS sender_city_name, s_province AS sender_province_name,
       'Category ' || CAST(k % 3 AS STRING) AS Pickup_Category_everpro,
       CASE k % 4 WHEN 0 THEN 'On Time' WHEN 1 THEN 'Late' WHEN 2 THEN 'Not Picked Up' END AS Pickup_Performance_everpro,
       'Status ' || CAST(k % 2 AS STRING) AS Pickup_Status, CASE WHEN k % 4 = 1 THEN 'IDE' END AS Late_Pickup_Factor,
       CASE WHEN k % 4 = 1 THEN 'Controllable' END AS Late_Pickup_Category
FROM parcel"""
VIEWS["dashboard_bd_order_all_status"] = """
SELECT waybill_no, 'ORD' || CAST(k AS STRING) AS order_no, s_city AS kota_asal, s_district AS kec_asal, r_city AS kota_tujuan,
       r_district AS tujuan_kec, express AS tipe_ekspress, CAST(k % 7 AS DECIMAL(18,2)) AS berat,
       fee AS biaya_standar_pengiriman
FROM parcel"""


_SOURCE = re.compile(r"\b(FROM|JOIN) (\w+)")


def _needs(name: str) -> list[str]:
    return list(dict.fromkeys(source for _, source in _SOURCE.findall(VIEWS[name]) if source in VIEWS or source in BASE))


def closure(names: list[str]) -> list[str]:
    """Views needed for ``names``, in the order they must be defined."""
    wanted: list[str] = []

    def add(name: str) -> None:
        for other in _needs(name):
            if other in VIEWS and other not in wanted:
                add(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        add(name)
    return wanted


def ctes(names: list[str]) -> str:
    return ",\n".join(f"{name} AS ({VIEWS[name]})" for name in closure(names))


class Standins(dict):
    """Lazy mapping of carrier table name to DataFrame over one data folder. Holds plans, no data."""

    _open: dict[tuple[str, str], Standins] = {}

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    @classmethod
    def at(cls, spark: SparkSession, sf_dir: str) -> Standins:
        """The mapping of this application and folder, so file footers are read once per table."""
        key = (spark.sparkContext.applicationId, sf_dir)
        known = cls._open.get(key)
        if known is None or known.spark is not spark:
            known = cls._open[key] = cls(spark, sf_dir)
        return known

    def __missing__(self, name: str) -> DataFrame:
        if name in BASE:
            frame = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        else:
            sources = {source: self[source] for source in _needs(name)}
            text = _SOURCE.sub(lambda m: f"{m[1]} {{{m[2]}}}" if m[2] in sources else m[0], VIEWS[name])
            frame = self.spark.sql(text, **sources)
        self[name] = frame
        return frame
