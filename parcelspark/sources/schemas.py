"""Input table schemas, as DDL, under the names the reports read them by.

Operational times are stored as UTC; ``timestamp_ntz`` and ``timestamp`` columns both work (keep
``spark.sql.session.timeZone`` at UTC for the latter). Marts hold local wall clock times.
"""

from __future__ import annotations

from pyspark.sql import types as T

_MONEY = "decimal(38,9)"

_WAYBILL = f"""
waybill_no string, order_no string, ecommerce_order_no string, waybill_source string, express_type string,
service_type string, waybill_status string, return_flag string, void_flag string, deleted string,
shipping_time timestamp, update_time timestamp, pod_record_time timestamp, return_pod_record_time timestamp,
sender_name string, sender_address string, sender_cellphone string, sender_province_name string,
sender_city_name string, sender_district_name string, sender_city_id bigint, recipient_address string,
recipient_province_name string, recipient_city_name string, recipient_district_name string,
recipient_district_id bigint, pickup_branch_id bigint, pickup_branch_name string, pickup_courier_id bigint,
pickup_courier_name string, delivery_branch_name string, pod_branch_id bigint, pod_branch_name string,
pod_courier_id bigint, pod_courier_name string, pod_photo_url string, signer string,
return_pod_branch_name string, vip_customer_id bigint, vip_customer_name string, parent_shipping_cleint string,
item_calculated_weight string, item_volume_weight string, item_actual_weight string, item_value {_MONEY},
cod_amount {_MONEY}, standard_shipping_fee {_MONEY}, handling_fee {_MONEY}, other_fee {_MONEY},
insurance_amount {_MONEY}, total_shipping_fee {_MONEY}
"""

_SCAN = """
waybill_no string, record_time timestamp, operation_type string, operation_branch_name string, bag_no string,
vehicle_tag_no string, photo_url string, problem_type string, problem_code string,
register_reason_bahasa string, next_location_name string, recipient_city_name string, deleted string
"""

_SHEET = f"""
report_date string, origin string, destination_by_bagging string, destination_by_issued string,
no_of_packages bigint, smu_weight {_MONEY}, bm_code string, vm_code string, area_pulau string,
smu_booking_code string, total_smu_fee {_MONEY}, flight_no string, airlanes string, vendor string
"""

DDL = {
    "waybill_waybill": _WAYBILL,
    "dm_waybill_waybill": _WAYBILL,
    "waybill_waybill_line": _SCAN,
    "dm_waybill_waybill_line": _SCAN,
    "waybill_problem_piece": """waybill_no string, operation_time timestamp, problem_type string,
        problem_reason string, operation_branch_name string, deleted string""",
    "waybill_return_bill": f"""waybill_no string, update_time timestamp, return_record_time timestamp,
        return_confirm_record_time timestamp, return_pod_record_time timestamp, return_confirm_status string,
        return_branch_name string, return_type_id bigint, return_shipping_fee {_MONEY},
        return_pod_photo_url string, return_signer string, recipient_city_name string,
        recipient_province_name string, deleted string""",
    "order_order": f"""waybill_no string, order_no string, input_time timestamp, order_source string,
        order_status string, service_type string, express_type string, payment_type string,
        pickup_courier_id bigint, pickup_courier_name string, sender_name string, sender_city_name string,
        sender_district_name string, recipient_name string, recipient_address string,
        recipient_city_name string, recipient_district_name string, recipient_province_name string,
        recipient_cellphone string, item_calculated_weight string, item_volume_weight string,
        item_weight string, standard_shipping_fee {_MONEY}, handling_fee {_MONEY}, other_fee {_MONEY},
        insurance_amount {_MONEY}, total_shipping_fee {_MONEY}""",
    "system_option": "type_option string, option_value string, option_name string",
    "standard_shipping_fee": """search_code string, sender_location_id bigint, recipient_location_id bigint,
        express_type string, shipping_client_id bigint, discount_rate decimal(38,9), min_sla bigint,
        max_sla bigint, end_expire_time timestamp, created_at timestamp, deleted string""",
    "res_user": "id bigint, personnel_no string, enabled string, deleted string",
    "res_branch": "id bigint, branch_no string, branch_level string, city_id bigint",
    "res_area": "city_id bigint, province_name string",
    "return_type": "id bigint, return_type string, deleted bigint",
    "sla_internal": "Origin_City string, Destination_City string, Destination string, SLAinternal bigint",
    "masterdata_sla_shopee": "origin_city string, destination_city string, sla string",
    "mapping_kanwil_area": "province_name string, kanwil_name string",
    "masterdata_facility_to_kanwil": """branch_name string, branch_no string, kanwil_name string,
        city_name string, province_name string""",
    "masterdata_backlog_city_to_ma": "destination string, destination_city string, mitra_by_area string",
    "mitra_late_reason_delivery": "waybill_no string, late_delivery_reason string",
    "masterdata_mapping_problem_factor": """code string, register_reason_bahasa string,
        problem_factor string, problem_category string""",
    "masterdata_branch_coverage_th": "district_id bigint, branch_name string",
    "a_mh_facility_name_rnd": "mh_code string, mh_name string",
    "smu_template_2": _SHEET,
    "dashboard_productivity_lm": """waybill_no string, waybill_source string, aging_day bigint,
        th_arrival string, arrival_time timestamp_ntz, pod_time timestamp_ntz, return_regist_time timestamp_ntz""",
    "dashboard_tokopedia": """waybill_no string, ecommerce_order_no string, order_no string,
        input_time timestamp_ntz, request_pickup_time timestamp_ntz, pickup_record_time timestamp_ntz,
        delivered_time timestamp_ntz, delivery_type string, role_miles string, origin_province string,
        origin_city string, scheduling_or_pickup_branch string, destination_province string,
        destination_city string, delivery_or_pod_branch string, waybill_status string, route_category string""",
    "dashboard_bd_kpi_monthly": """waybill_no string, order_no string, input_time timestamp_ntz,
        Pickup_Time timestamp_ntz, pickup_failure_time timestamp_ntz, update_time_oo timestamp_ntz,
        Order_Status string, Order_Source string, Pickup_Failure_Reason string, Sender_Name string,
        scheduling_or_pickup_branch string, sender_district_name string, sender_city_name string,
        sender_province_name string, Pickup_Category_everpro string, Pickup_Performance_everpro string,
        Pickup_Status string, Late_Pickup_Factor string, Late_Pickup_Category string""",
    "dashboard_bd_order_all_status": f"""waybill_no string, order_no string, kota_asal string,
        kec_asal string, kota_tujuan string, tujuan_kec string, tipe_ekspress string, berat {_MONEY},
        biaya_standar_pengiriman {_MONEY}""",
}


def schema(name: str) -> T.StructType:
    return T.StructType.fromDDL(DDL[name])
