"""Reports over tiny hand-made tables with hand-worked results."""

from __future__ import annotations

from datetime import date, datetime
from decimal import Decimal


from conftest import by, utc, wall
from parcelspark.functions.timeops import AsOf
from parcelspark.plans import backlog, cargo, claims, courier, leadtime, orders, sla, volume

AS_OF = AsOf(datetime(2024, 4, 10, 20, 0))  # local date 2024-04-11, UTC date 2024-04-10


def option(kind, value, name):
    return {"type_option": kind, "option_value": value, "option_name": name}


def waybill(no, update="2024-04-02 00:00:00", ship="2024-04-01 10:00:00", **more):
    base = {"waybill_no": no, "update_time": utc(update), "shipping_time": ship and utc(ship), "void_flag": "0", "deleted": "0"}
    return {**base, **more}


def scan(no, at, code, branch="TH 1", **more):
    base = {"waybill_no": no, "record_time": utc(at), "operation_type": code, "operation_branch_name": branch, "deleted": "0"}
    return {**base, **more}


def problem(no, at, reason, kind="01", **more):
    base = {"waybill_no": no, "operation_time": utc(at), "problem_type": kind, "problem_reason": reason, "deleted": "0"}
    return {**base, **more}


def test_weekly_volume_newest_version_and_missing_order(carrier):
    tables = carrier(
        waybill_waybill=[
            waybill("a", waybill_source="1", standard_shipping_fee=Decimal(5)),
            waybill("a", update="2024-04-03 00:00:00", waybill_source="1", standard_shipping_fee=Decimal(7)),
            waybill("b", waybill_source="1", standard_shipping_fee=Decimal(1), ship="2024-04-01 17:00:00"),
            waybill("void", waybill_source="1", void_flag="1"),
            waybill("future", ship="2024-04-11 17:00:00"),
        ],
        order_order=[{"waybill_no": "a", "input_time": utc("2024-03-30 18:00:00")}, {"waybill_no": "b", "input_time": utc("2022-08-31 16:00:00")}],
        system_option=[option("waybillSource", "1", "S")],
    )
    got = [tuple(r) for r in volume.weekly_volume(tables, AS_OF).collect()]
    assert got == [
        (date(2024, 4, 1), "Apr 2024", 13, date(2024, 3, 31), "Mar 2024", "Mar 2024", 13, 13, "S", 1, Decimal(7)),
        (date(2024, 4, 2), "Apr 2024", 13, date(2024, 4, 2), None, "Apr 2024", None, 13, "S", 1, Decimal(1)),
    ]


LANE = {"Origin_City": "BANDUNG", "Destination_City": "BEKASI", "Destination": "D", "SLAinternal": 3}
PLACE = dict(sender_city_name="BANDUNG", recipient_city_name="BEKASI", recipient_district_name="D", recipient_province_name="JAWA BARAT",
             vip_customer_id=1, sender_city_id=2, recipient_district_id=3, express_type="E", waybill_source="B")
TARIFF = dict(shipping_client_id=1, sender_location_id=2, recipient_location_id=3, express_type="E", deleted="0", min_sla=1,
              end_expire_time=utc("2030-01-01 00:00:00"), created_at=utc("2024-01-01 00:00:00"))


def test_blibli_two_clocks_and_cutover(carrier):
    tables = carrier(
        waybill_waybill=[
            # Due date is the UTC date 2024-04-02; delivered 2024-04-03 local time although still 2024-04-02 in UTC.
            waybill("late", pod_record_time=utc("2024-04-02 17:30:00"), **PLACE),
            waybill("late", update="2024-03-01 00:00:00", pod_record_time=None, **PLACE),
            waybill("open", ship="2024-04-09 20:00:00", **PLACE),
            waybill("lane", **{**PLACE, "recipient_district_name": "no promise"}),
            waybill("other", **{**PLACE, "waybill_source": "X"}),
        ],
        sla_internal=[LANE, LANE],
        standard_shipping_fee=[{**TARIFF, "search_code": "s", "max_sla": 1}],
        system_option=[option("orderSource", "B", "Blibli"), option("orderSource", "X", "Else")],
        waybill_problem_piece=[problem("late", "2024-04-01 12:00:00", "Alamat tidak lengkap"), problem("late", "2024-04-02 12:00:00", None)],
        mitra_late_reason_delivery=[{"waybill_no": "late", "late_delivery_reason": "Late Arrival"}],
    )
    got = by(sla.blibli_delivery(tables, AS_OF), "Waybill_No")
    assert set(got) == {"late", "open"}
    late = got["late"]
    assert (late.POD_Date, late.Due_Date_Delivery, late.Performance) == (date(2024, 4, 3), date(2024, 4, 2), "Late")
    assert (late.SLA_Delivery, late.SLA_Delivery_Old, late.Performance_Old) == (1, 3, "Not Late")
    # The newest problem has no reason, so the partner's own reason shows.
    assert (late.Late_Delivery_Reason, late.Late_Delivery_Factor, late.Late_Delivery_Category) == ("Late Arrival", "IDE", "Controllable")
    assert (late.City_Category, late.Origin_Dest_City) == ("BODETABEK", "BANDUNG - BEKASI")
    # Shipped 2024-04-10 03:00 local; due UTC 2024-04-10, today local is 2024-04-11.
    assert (got["open"].Performance, got["open"].Performance_Old, got["open"].Late_Delivery_Reason) == ("Late", None, "Kurir tidak available")
    before = by(sla.blibli_delivery(tables, AS_OF, cutover=date(2024, 5, 1)), "Waybill_No")["late"]
    assert (before.SLA_Delivery, before.Performance, before.Late_Delivery_Factor) == (3, "Not Late", "IDE")


FASHION = "pt fashion eservices indonesia"


def test_zalora_daily(carrier):
    tables = carrier(
        order_order=[
            {"waybill_no": "a", "order_no": "O1", "input_time": utc("2024-04-01 00:00:00"), "order_source": "F", "order_status": "x"},
            {"waybill_no": "b", "order_no": "O2", "input_time": utc("2024-04-01 00:00:00"), "order_source": "F", "order_status": "x"},
            {"waybill_no": "none", "order_no": "O3", "input_time": utc("2024-04-01 00:00:00"), "order_source": "F", "order_status": "x"},
            {"waybill_no": "z", "order_no": "O4", "input_time": utc("2024-04-01 00:00:00"), "order_source": "other"},
        ],
        waybill_waybill=[waybill("a", pod_record_time=utc("2024-04-04 00:00:00"), **PLACE), waybill("b", **PLACE), waybill("z", **PLACE)],
        masterdata_sla_shopee=[{"origin_city": "BANDUNG", "destination_city": "BEKASI", "sla": "999"}],
        system_option=[option("orderSource", "F", FASHION), option("orderSource", "other", "other")],
        waybill_return_bill=[
            {"waybill_no": "b", "update_time": utc("2024-04-05 00:00:00"), "return_confirm_record_time": utc("2024-04-05 00:00:00"), "deleted": "0"},
            {"waybill_no": "a", "update_time": utc("2024-04-05 00:00:00"), "return_confirm_record_time": utc("2024-04-05 00:00:00"), "deleted": "1"},
        ],
        waybill_problem_piece=[problem("a", "2024-04-03 00:00:00", "p1"), problem("a", "2024-04-04 00:00:00", "pickup", kind="02")],
    )
    got = by(sla.zalora_daily(tables, AS_OF), "waybill_no")
    assert set(got) == {"a", "b"}
    # Out of coverage in one column, judged against the far due date in the other.
    assert (got["a"].Deliv_Performance, got["a"].OTD_Status, got["a"].SLA_Delivery) == ("No SLA (OoC)", "Not Late", 999)
    assert (got["a"].pod_status, got["a"].status_sistem, got["a"].problem_reason_remarks) == ("Delivered", "POD", "p1")
    assert (got["a"].return_start_date, got["a"].city_category) == (None, "JABODETABEK")
    assert (got["b"].pod_status, got["b"].return_start_date) == ("Return Process", wall("2024-04-05 07:00:00"))


def test_zalora_performance_old_due_date_uses_the_new_promise(carrier):
    tables = carrier(
        dashboard_bd_kpi_monthly=[
            {"waybill_no": "a", "order_no": "O", "input_time": wall("2024-04-01 08:00:00"), "update_time_oo": wall("2024-04-02 00:00:00"),
             "Order_Source": FASHION, "Order_Status": "s", "Pickup_Performance_everpro": "Not Picked Up"},
            {"waybill_no": "a", "order_no": "old", "input_time": wall("2024-04-01 08:00:00"), "update_time_oo": wall("2024-04-01 00:00:00"),
             "Order_Source": FASHION},
        ],
        waybill_waybill=[waybill("a", pod_record_time=utc("2024-04-04 00:00:00"), **PLACE)],
        masterdata_sla_shopee=[{"origin_city": "BANDUNG", "destination_city": "BEKASI", "sla": "5"}],
        standard_shipping_fee=[{**TARIFF, "search_code": "s", "max_sla": 1}],
        mitra_late_reason_delivery=[{"waybill_no": "a", "late_delivery_reason": "Kurir tidak available"}],
    )
    row = by(sla.zalora_performance(tables, AS_OF), "waybill_no")["a"]
    assert row.package_number == "O" and row.Pickup_Performance == "Not Late"
    assert row.due_date_delivery == row.Due_Date_Delivery_old == date(2024, 4, 2)
    assert (row.Deliv_Performance, row.Deliv_Performance_old, row.SLA_Delivery_old) == ("Late", "Not Late", 5)
    assert (row.problem_reason_remarks, row.Late_Deliv_Factor, row.Late_Deliv_Category) == ("Kurir tidak available", "IDE", None)


def lm(no, aging=5, branch="TH 1", arrival="2024-04-01 08:00:00", **more):
    return {"waybill_no": no, "aging_day": aging, "th_arrival": branch, "arrival_time": wall(arrival), **more}


def test_backlog_leaves_out_parcels_without_a_reason(carrier):
    tables = carrier(
        dashboard_productivity_lm=[lm("a"), lm("none"), lm("lost"), lm("vip", branch="TH VIP 2"), lm("3pl"), lm("young", aging=2), lm("b", aging=20)],
        waybill_problem_piece=[problem(n, "2024-04-02 00:00:00", "Alamat tidak lengkap") for n in ("a", "vip", "3pl", "young", "b")]
        + [problem("lost", "2024-04-02 00:00:00", "Paket hilang atau tidak ditemukan"), problem("none", "2024-04-02 00:00:00", None),
           problem("a", "2024-04-03 00:00:00", "pickup", kind="02")],
        dm_waybill_waybill_line=[scan("3pl", "2024-04-02 00:00:00", "04", next_location_name="3PL"),
                                 scan("a", "2024-04-02 00:00:00", "04", next_location_name="3PL", deleted="1")],
        waybill_waybill_line=[
            scan("a", "2024-04-01 00:30:00", "09"),  # 07:30 local, before the arrival
            scan("a", "2024-04-02 00:00:00", "09", branch="TH 2"),  # another branch
            scan("a", "2024-04-03 18:00:00", "09"), scan("a", "2024-04-05 18:00:00", "09"),
        ],
        waybill_return_bill=[
            {"waybill_no": "b", "update_time": utc("2024-04-05 00:00:00"), "return_record_time": utc("2024-04-05 00:00:00"),
             "return_confirm_record_time": utc("2024-04-06 00:00:00")}],
        masterdata_facility_to_kanwil=[{"branch_name": "TH 1", "branch_no": "N1", "kanwil_name": "K"}] * 2,
    )
    got = by(backlog.backlog_ops(tables, AS_OF), "waybill_no")
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.first_deliv_attempt, a.arrival_to_deliv_day, a.more_4_days, a.more_14_days) == (wall("2024-04-04 01:00:00"), 3, 1, 0)
    assert (a.th_arrival_no, a.kanwil_name, a.last_pos_reason) == ("N1", "K", "Alamat tidak lengkap")
    assert (b.more_4_days, b.more_14_days, b.return_confirm_record_time) == (1, 1, wall("2024-04-06 07:00:00"))


def test_open_returns(carrier):
    def ret(no, registered, confirmed=None, pod=None):
        return {"waybill_no": no, "update_time": utc("2024-04-09 00:00:00"), "return_record_time": utc(registered),
                "return_confirm_record_time": confirmed and utc(confirmed), "return_pod_record_time": pod and utc(pod), "return_type_id": 1}

    tables = carrier(
        waybill_waybill=[waybill(n) for n in ("new", "old", "done", "none")],
        waybill_return_bill=[ret("new", "2024-04-07 18:00:00"), ret("old", "2024-03-01 00:00:00", "2024-03-27 00:00:00"),
                             ret("done", "2024-04-01 00:00:00", "2024-04-02 00:00:00", "2024-04-03 00:00:00")],
        return_type=[{"id": 1, "return_type": "T", "deleted": 0}],
    )
    got = by(backlog.return_monitoring(tables, AS_OF), "waybill_no")
    assert set(got) == {"new", "old"}
    new, old = got["new"], got["old"]
    # Registered 2024-04-08 01:00 local, two days before the UTC date of the report.
    assert (new.aging_backlog_confirm, new.backlog_confirm_category, new.backlog_return_category) == (2, "<3 Days", None)
    assert (old.backlog_return_flag, old.aging_backlog_return, old.backlog_return_category) == ("Backlog Return", 14, "8-14 Days")
    assert (old.backlog_confirm_category, old.backlog_confirm_alias, old.remarks_return) == (None, 0, "T")


def courier_tables(carrier):
    shared = dict(pickup_branch_id=1, pod_branch_id=1, pickup_branch_name="TH A", pod_branch_name="TH A", waybill_source="S", express_type="E")
    parcels = [
        waybill("a", pickup_courier_id=0, pickup_courier_name="", pod_courier_id=2, pod_courier_name="Two",
                pod_record_time=utc("2024-04-02 17:30:00"), **shared),
        waybill("b", pickup_courier_id=2, pickup_courier_name="Two", **shared),
        waybill("c", pickup_courier_id=2, pickup_courier_name="Two", ship="2024-04-01 16:00:00", **shared),
    ]
    return carrier(
        waybill_waybill=parcels, dm_waybill_waybill=parcels,
        order_order=[{"waybill_no": "a", "input_time": utc("2024-03-31 00:00:00"), "pickup_courier_id": 1, "pickup_courier_name": "One"}],
        res_user=[{"id": 1, "personnel_no": "P1", "enabled": "0", "deleted": "0"}, {"id": 2, "personnel_no": "P2", "enabled": "1", "deleted": "0"}],
        res_branch=[{"id": 1, "branch_no": "B1", "branch_level": "1", "city_id": 5}],
        res_area=[{"city_id": 5, "province_name": "DKI JAKARTA"}] * 3,
        mapping_kanwil_area=[{"province_name": "DKI JAKARTA", "kanwil_name": "JABODETABEK"}],
        system_option=[option("branchLevel", "1", "TH"), option("waybillSource", "S", "Source"), option("expressType", "E", "Express")],
    )


def test_courier_counts(carrier):
    got = by(courier.courier_incentive_agg(courier_tables(carrier), AS_OF), "courier_id", "tgl_tugas")
    assert {k: (v.pickup, v.pod) for k, v in got.items()} == {
        (1, wall("2024-04-01 00:00:00")): (1, 0), (2, wall("2024-04-01 00:00:00")): (2, 0), (2, wall("2024-04-03 00:00:00")): (0, 1),
    }
    one = got[(1, wall("2024-04-01 00:00:00"))]
    assert (one.courier_name, one.personnel_no, one.courier_status, one.work_location) == ("One", "P1", "inactive", "B1 - Jakarta TH A")


def test_courier_task_list(carrier):
    got = courier.courier_incentive_raw(courier_tables(carrier), AS_OF).collect()
    assert sorted((r.waybill_no_pickup, r.waybill_no_pod) for r in got if r.waybill_no_pickup) == [("a", None), ("b", None), ("c", None)]
    (pod,) = [r for r in got if r.waybill_no_pod]
    assert (pod.waybill_no_pod, pod.express_type_pod, pod.courier_id, pod.kanwil_name) == ("a", "Express", 2, "Jakarta")


def test_fee_check_shows_every_version(carrier):
    order = {"input_time": utc("2024-04-01 00:00:00"), "item_calculated_weight": "1.5", "item_weight": "1", "sender_city_name": "X"}
    tables = carrier(
        order_order=[{"waybill_no": "IDE1", **order}, {"waybill_no": "IDE2", **order}, {"waybill_no": "ID3", **order}],
        waybill_waybill=[
            waybill("IDE1", item_calculated_weight="1.50", item_actual_weight="2", sender_city_name="Y"),
            waybill("IDE1", item_calculated_weight="2", item_actual_weight="2", sender_city_name="X"),
        ],
    )
    got = sorted((r.waybill_no, r.remark_weight, r.remark_origin) for r in orders.shipping_fee_check(tables, AS_OF).collect())
    assert got == [
        ("IDE1", "Change in Weight (re-weigh)", "No Issue"), ("IDE1", "No Issue", "Different Origin City"), ("IDE2", "No Issue", "No Issue"),
    ]


def test_everpro_attempt_two_can_be_missing(carrier):
    tables = carrier(
        waybill_waybill=[waybill("a", waybill_source="E", recipient_district_id=4, cod_amount=Decimal(3)), waybill("x", waybill_source="Z")],
        system_option=[option("waybillSource", "E", "everpro"), option("operationType", "09", "Delivery scan")],
        waybill_problem_piece=[
            problem("a", "2024-04-02 00:00:00", "r1", operation_branch_name="TH 2"), problem("a", "2024-04-02 00:00:00", "r0", operation_branch_name="TH 3"),
            problem("a", "2024-04-03 00:00:00", "r3"), problem("a", "2024-04-01 00:00:00", "pickup", kind="02"),
        ],
        waybill_waybill_line=[
            scan("a", "2024-04-02 01:00:00", "18", problem_type="01", photo_url="ph1"), scan("a", "2024-04-03 01:00:00", "18", problem_type="01", photo_url="ph2"),
            scan("a", "2024-04-03 02:00:00", "09", branch="TH 7"),
        ],
        waybill_return_bill=[
            {"waybill_no": "a", "update_time": utc("2024-04-04 00:00:00"), "return_record_time": utc("2024-04-04 00:00:00")},
            {"waybill_no": "a", "update_time": utc("2024-04-06 00:00:00"), "return_record_time": utc("2024-04-05 00:00:00"),
             "return_confirm_record_time": utc("2024-04-05 12:00:00")}],
        masterdata_branch_coverage_th=[{"district_id": 4, "branch_name": "TH COVER"}] * 2,
    )
    got = by(claims.everpro_claims(tables, AS_OF), "waybill_no")
    assert set(got) == {"a"}
    a = got["a"]
    assert (a.first_pos_reason, a.first_pos_location, a.first_pos_photo_url) == ("r0", "TH 2", "ph1")
    assert (a.pos_attempt_2, a.pos_reason_2, a.pos_reason_3, a.pos_photo_url_2, a.pos_photo_url_3) == (None, None, "r3", "ph2", None)
    assert (a.return_regist_time, a.return_confirm_time) == (wall("2024-04-05 07:00:00"), wall("2024-04-05 19:00:00"))
    assert (a.th_destination, a.last_location, a.last_activity) == ("TH COVER", "TH 7", "Delivery scan")
    assert a.first_deliv_attempt == a.last_scan_time == wall("2024-04-03 09:00:00")


def test_mengantar_flags_and_branch(carrier):
    tables = carrier(
        waybill_waybill=[
            waybill("a", waybill_source="753", recipient_district_id=4), waybill("b", waybill_source="796", recipient_district_id=4),
            waybill("c", waybill_source="753", pod_record_time=utc("2024-04-03 00:00:00"), pod_branch_name="TH POD"), waybill("d", waybill_source="7"),
        ],
        waybill_waybill_line=[
            scan("a", "2024-04-02 00:00:00", "09", branch="TH D"), scan("a", "2024-04-04 18:00:00", "19", branch="TH R"),
            scan("a", "2024-04-03 00:00:00", "18", problem_type="01", register_reason_bahasa="why", photo_url="p"),
        ],
        waybill_problem_piece=[problem("a", "2024-04-02 00:00:00", "Paket hilang ditemukan"),
                               problem("b", "2024-04-02 00:00:00", "Paket hilang atau tidak ditemukan", kind="02")],
        masterdata_branch_coverage_th=[{"district_id": 4, "branch_name": "TH COVER"}],
    )
    got = by(claims.mengantar_claims(tables, AS_OF), "waybill_no")
    assert {k: v.destination_branch_name for k, v in got.items()} == {"a": "TH D", "b": "TH COVER", "c": "TH POD"}
    a = got["a"]
    assert (a.apakah_ada_POS_paket_hilang, a.apakah_ada_POS_paket_hilang_ditemukan, got["b"].apakah_ada_POS_paket_hilang) == ("No", "Yes", "No")
    assert (a.diff_first_regist_and_deliv_day, a.pos_reason_1, a.pos_photo_url_1, a.pos_reason_2) == (3, "why", "p", None)
    assert (a.apakah_paket_sudah_pod, got["c"].apakah_paket_sudah_pod) == ("No", "Yes")


def test_bag_info(carrier):
    tables = carrier(
        waybill_waybill_line=[scan("a", "2024-04-02 00:00:00", "04", bag_no="B2", vehicle_tag_no="V2"),
                              scan("a", "2024-04-03 00:00:00", "04", bag_no="B1", vehicle_tag_no="V1"), scan("old", "2024-01-01 00:00:00", "04")],
        dashboard_bd_order_all_status=[{"waybill_no": "a", "order_no": "O", "berat": Decimal(2)}],
    )
    (row,) = cargo.waybill_bag_info(tables, AS_OF).collect()
    assert (row.vm_bm_awb, row.order_no, row.berat, row.record_time) == ("V1 - B1 - a", "O", Decimal(2), wall("2024-04-03 07:00:00"))


def test_cargo_chain(carrier):
    fees = dict(standard_shipping_fee=Decimal(10), handling_fee=Decimal(1), item_calculated_weight="2.5")
    july = dict(bag_no="B1", vehicle_tag_no="V1")
    sheet = dict(report_date="07/15/2023", origin="CGK", destination_by_issued="SUB", vm_code="V1")
    tables = carrier(
        waybill_waybill_line=[
            scan("a", "2023-07-01 00:00:00", "04", "MH ONE", **july), scan("a", "2023-06-15 00:00:00", "04", "MH EARLY", **july),
            scan("a", "2023-07-02 00:00:00", "05", "MH TWO", **july), scan("b", "2023-07-03 00:00:00", "05", "TH 1", **july),
            scan("c", "2023-07-03 00:00:00", "04", "MH ONE", bag_no="", vehicle_tag_no="V1"), scan("d", "2023-07-03 00:00:00", "04", "MH ONE", bag_no="B1"),
            scan("june", "2023-06-20 00:00:00", "04", "MH ONE", **july), scan("nowaybill", "2023-07-03 00:00:00", "04", "MH ONE", **july),
        ],
        waybill_waybill=[waybill(n, ship="2023-06-30 20:00:00", **fees) for n in ("a", "b", "c", "d", "june")]
        + [waybill("a", update="2024-04-01 00:00:00", ship="2023-06-30 20:00:00", standard_shipping_fee=Decimal(99))],
        smu_template_2=[{**sheet, "bm_code": "B1"}, {**sheet, "bm_code": "B9"}, {**sheet, "bm_code": None}],
        a_mh_facility_name_rnd=[{"mh_code": "SUB", "mh_name": "MH SURABAYA"}] * 2,
    )
    system = cargo.smu_system(tables, AS_OF)
    got = by(system, "waybill_no")
    assert set(got) == {"a", "b"}
    a = got["a"]
    assert (a.bm_vm_awb, a.shipping_time, a.record_time, a.system_sf) == ("B1 - V1 - a", date(2023, 7, 1), date(2023, 7, 1), Decimal(11))
    assert (a.mh_sending, a.mh_arrival, got["b"].mh_arrival) == ("MH EARLY", "MH TWO", None)
    assert [r.waybill_no for r in cargo.smu_system_sorted(system).collect()] == ["a", "b"]

    hub_sheet = cargo.smu_hub_names(tables)
    assert {(r.report_date, r.mh_sending_join, r.mh_arrival_join) for r in hub_sheet.collect()} == {(date(2023, 7, 15), "MH JAKARTA", "MH SURABAYA")}
    bags = by(cargo.smu_bag_level(hub_sheet, system), "bm_code")
    assert (bags["B1"].standard_shipping_fee, bags["B1"].system_weight, bags["B1"].mh_sending) == (Decimal(20), Decimal(5), "MH JAKARTA")
    assert bags["B9"].bag_no is None and bags[None].bm_vm_gsheet is None
    level = cargo.smu_waybill_level(tables, system).collect()
    assert sorted((r.bm_code or "", r.waybill_no or "") for r in level) == [("", ""), ("B1", "a"), ("B1", "b"), ("B9", "")]


def exchanges(df):
    """(partitioning, columns) of each shuffle of a plan without adaptive execution."""
    found = []

    def walk(node):
        if node.nodeName() == "Exchange":
            found.append((node.outputPartitioning().toString(), node.output().toString()))
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_system_bags_move_their_own_columns_only(carrier, spark):
    """Scans are shuffled once, by the waybill; neither the sort nor the join with the sheet moves derived columns."""
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tables = carrier(waybill_waybill_line=[], waybill_waybill=[], smu_template_2=[])
        system = cargo.smu_system(tables, AS_OF)
        assert not any("bag_no" in how for how, _ in exchanges(system))
        assert sum("waybill_no" in how for how, _ in exchanges(system)) == 2
        (columns,) = [columns for how, columns in exchanges(cargo.smu_system_sorted(system)) if "range" in how]
        assert "bm_vm" not in columns and "system_sf" not in columns
        joined = [columns for how, columns in exchanges(cargo.smu_waybill_level(tables, system)) if "vehicle_tag_no" in how]
        assert joined and not any("bm_vm_concat" in columns or "system_sf" in columns for columns in joined)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


OPS = [option("operationType", "04", "Sending scan"), option("operationType", "05", "Arrival scan"), option("operationType", "06", "Unloading scan")]


def test_leadtime_legs_and_fan_out(carrier):
    tables = carrier(
        dashboard_tokopedia=[{
            "waybill_no": "a", "input_time": wall("2024-04-01 08:00:00"), "request_pickup_time": wall("2024-04-01 09:00:00"),
            "pickup_record_time": wall("2024-04-01 10:00:00"), "delivered_time": wall("2024-04-04 10:00:00"),
            "origin_city": "BEKASI", "destination_city": "MEDAN", "scheduling_or_pickup_branch": "TH 1"}],
        order_order=[{"waybill_no": "a", "input_time": utc("2024-04-01 00:00:00"), "sender_name": n} for n in ("x", "y")],
        dm_waybill_waybill_line=[
            scan("a", "2024-04-01 05:00:00", "04", "TH 1"), scan("a", "2024-04-01 08:00:00", "05", "MH 1"),
            scan("a", "2024-04-01 07:00:00", "04", "MH 9"), scan("a", "2024-04-01 06:30:00", "04", "MH 1", deleted="1"),
            scan("a", "2024-04-02 08:00:00", "05", "TH 9"),
        ],
        dashboard_productivity_lm=[lm("a", arrival="2024-04-02 15:00:00", branch="TH 9")],
        system_option=OPS,
    )
    got = leadtime.tokopedia_leadtime(tables, AS_OF).collect()
    assert sorted(r.sender_name for r in got) == ["x", "y"]
    r = got[0]
    assert (r.origin_area, r.destination_area) == ("Jabodetabek", "Non Jabodetabek")
    # Walk: TH 1 (sent 12:00) -> MH 9 (sent 14:00) -> MH 1 (arrived 15:00) -> TH 9.
    assert (r.fm_sending_branch, r.fm_sending_time, r.mh_ori_arrival, r.mh_ori_arrival_time) == (
        "TH 1", wall("2024-04-01 12:00:00"), "MH 1", wall("2024-04-01 15:00:00"))
    assert (r.mh_sending_branch, r.sending_time_to_th_dest) == (None, None)
    assert (r.leadtime_rpu_to_pickup, r.leadtime_pickup_to_sending_fm, r.leadtime_fm_to_arr_mh_ori) == (3600, 7200, 10800)
    assert (r.leadtime_arr_mh_ori_to_sending_to_th_dest, r.leadtime_arr_dest_to_pod) == (None, 154800)


def test_handed_to_outside_carrier_fans_out_by_version(carrier):
    tables = carrier(
        dm_waybill_waybill_line=[
            scan("a", "2024-04-02 00:00:00", "04", "DC 1", next_location_name="3PL"), scan("a", "2024-04-03 00:00:00", "04", "DC 2", next_location_name="3PL"),
            scan("a", "2024-04-01 00:00:00", "05", "DC 1"), scan("a", "2024-04-01 02:00:00", "06", "DC 1"), scan("a", "2024-04-05 00:00:00", "05", "TH 1"),
            scan("b", "2024-04-01 00:00:00", "05", "MH 1"),
        ],
        waybill_waybill=[waybill("a", order_no="O1"), waybill("a", order_no="O2"), waybill("a", order_no="old", ship="2023-01-01 00:00:00")],
        system_option=OPS,
    )
    got = leadtime.sent_to_3pl(tables, AS_OF).collect()
    assert sorted(r.order_no for r in got) == ["O1", "O2"]
    assert {(r.operation_branch_name, r.sending_time_to_3pl, r.arrival_time_branch, r.unloading_time_branch) for r in got} == {
        ("DC 2", wall("2024-04-03 07:00:00"), wall("2024-04-01 07:00:00"), wall("2024-04-01 09:00:00"))}


def test_jobs_never_ask_for_the_current_date():
    import pathlib

    root = pathlib.Path(__file__).parents[1] / "parcelspark"
    text = "".join(p.read_text() for p in root.rglob("*.py"))
    assert "current_date" not in text and "current_timestamp" not in text and "localCheckpoint" not in text
