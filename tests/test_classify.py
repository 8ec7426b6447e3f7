"""Truth tables, boundaries and the report quirks that are kept."""

from __future__ import annotations

from datetime import date

import pytest
from pyspark.sql import functions as F

from parcelspark.functions import classify as c
from parcelspark.functions import rules

D = date
TODAY = D(2024, 1, 10)


def table_of(spark, ddl, rows, **exprs):
    df = spark.createDataFrame(rows, ddl)
    return [tuple(r) for r in df.select(*[e.alias(n) for n, e in exprs.items()]).collect()]


def test_sla_verdict(spark):
    rows = [
        (D(2024, 1, 5), D(2024, 1, 5), 998), (D(2024, 1, 6), D(2024, 1, 5), 3), (D(2024, 1, 6), D(2024, 1, 5), 999),
        (D(2024, 1, 6), None, None), (None, D(2024, 1, 10), 2), (None, D(2024, 1, 9), 2), (None, None, 1000),
    ]
    pod, due, sla = F.col("pod"), F.col("due"), F.col("sla")
    got = table_of(
        spark, "pod date, due date, sla long", rows,
        market=c.sla_verdict(pod, due, sla, TODAY),
        fashion=c.sla_verdict(pod, due, sla, TODAY, missing=None, pending_ok="Not Late"),
    )
    assert got == [
        ("Not Late", "Not Late"), ("Late", "Late"), ("No SLA (OoC)", "No SLA (OoC)"), ("Not Late", None),
        (None, "Not Late"), ("Late", "Late"), ("No SLA (OoC)", "No SLA (OoC)"),
    ]


def test_due_date_is_a_utc_date(spark):
    got = table_of(
        spark, "s string, n long", [("2024-01-01 16:59:59", 2), ("2024-01-01 23:59:59", 0), ("2024-01-01 01:00:00", None)],
        due=c.due_date(F.col("s").cast("timestamp_ntz"), F.col("n")),
    )
    assert got == [(D(2024, 1, 3),), (D(2024, 1, 1),), (None,)]


def test_otd_status_ignores_out_of_coverage(spark):
    rows = [("2024-01-05 23:00:00", D(2024, 1, 5)), ("2024-01-06 00:00:00", D(2024, 1, 5)), (None, TODAY), (None, D(2024, 1, 9)), (None, None)]
    got = table_of(spark, "p string, due date", rows, v=c.otd_status(F.col("p").cast("timestamp_ntz"), F.col("due"), TODAY))
    assert [v for v, in got] == ["Not Late", "Late", "Not Late", "Late", None]


def test_sla_cutover_day(spark):
    got = table_of(
        spark, "s string", [("2023-10-31 23:59:59",), ("2023-11-01 00:00:00",), (None,)],
        v=c.sla_cutover(F.col("s").cast("timestamp_ntz"), F.lit("new"), F.lit("old")),
    )
    assert [v for v, in got] == ["old", "new", "old"]


def test_late_reason_and_default(spark):
    rows = [("Pengirim sedang libur", "x"), (None, "x"), ("Alamat tidak lengkap", "x"), (None, None)]
    reason = c.late_reason(F.col("p"), F.col("m"))
    got = table_of(
        spark, "p string, m string", rows, r=reason, late=c.late_reason_default(F.lit("Late"), reason),
        fine=c.late_reason_default(F.lit("Not Late"), reason), fashion=c.late_reason_default(F.lit("Late"), reason, None),
    )
    assert got == [
        (None, "Kurir tidak available", None, None), ("x", "x", "x", "x"),
        ("Alamat tidak lengkap", "Alamat tidak lengkap", "Alamat tidak lengkap", "Alamat tidak lengkap"),
        (None, "Kurir tidak available", None, None),
    ]


def test_late_factor_and_category(spark):
    rows = [("Late", r) for r in ("Paket crosslabel", "Penerima pindah alamat", "bencana alam", None, "in no list")] + [("Not Late", "bencana alam")]
    v, r = F.col("v"), F.col("r")
    got = table_of(spark, "v string, r string", rows, f=c.late_factor(v, r), k=c.late_category(v, r))
    assert got == [
        ("IDE", "Controllable"), ("Penerima", "Uncontrollable"), ("External", "Uncontrollable"),
        ("IDE", "Controllable"), (None, None), (None, None),
    ]


def test_fashion_category_list_lacks_a_reason_its_factor_list_has(spark):
    v, r = F.lit("Late"), F.col("r")
    got = table_of(
        spark, "r string", [(rules.NO_COURIER,), (rules.LATE_DELIVERY,)],
        f=c.late_factor(v, r, rules.FASHION_FACTOR_RULES), k=c.late_category(v, r, rules.FASHION_CATEGORY_RULES),
        mf=c.late_factor(v, r), mk=c.late_category(v, r),
    )
    assert got == [("IDE", None, "IDE", "Controllable"), (None, None, "IDE", "Controllable")]


def test_problem_factor_does_not_multiply_rows(spark):
    facts = spark.createDataFrame(
        [(1, "A", "p"), (2, None, "p"), (3, "Paket pre order", "p"), (4, None, None), (5, "unknown", None)],
        "id long, problem_reason string, late_delivery_reason string",
    )
    factors = spark.createDataFrame(
        [("A", "p", "F1", "C1"), ("A", "q", "F2", "C2"), ("B", "p", "F0", "C0")],
        "code string, register_reason_bahasa string, problem_factor string, problem_category string",
    )
    got = {r.id: (r.late_delivery_factor, r.late_delivery_category) for r in c.problem_factor(facts, factors).collect()}
    assert got == {1: ("F1", "C1"), 2: ("F0", "C0"), 3: (None, None), 4: (None, None), 5: (None, None)}


def test_city_zones(spark):
    rows = [
        ("DKI JAKARTA", "JAKARTA BARAT"), ("JAWA BARAT", "BEKASI"), ("BALI", "DENPASAR"), ("PAPUA", None),
        ("JAWA TENGAH", None), (None, "BEKASI"), (None, None),
    ]
    p, city = F.col("p"), F.col("c")
    got = table_of(
        spark, "p string, c string", rows, m=c.city_zone(p, city, "marketplace"), f=c.city_zone(p, city, "fashion"),
        t=c.city_zone(None, city, "leadtime"),
    )
    assert got == [
        ("JAKARTA", "JABODETABEK", "Jabodetabek"), ("BODETABEK", "JABODETABEK", "Jabodetabek"),
        ("NON-JABODETABEK", "JAWA NON-JABODETABEK", "Non Jabodetabek"), (None, "LUAR JAWA", "Non Jabodetabek"),
        (None, "JAWA NON-JABODETABEK", "Non Jabodetabek"), (None, None, "Jabodetabek"), (None, None, "Non Jabodetabek"),
    ]
    with pytest.raises(ValueError):
        c.city_zone(p, city, "other")


def test_outer_island_city_reads_as_java_in_the_fashion_scheme(spark):
    got = table_of(spark, "c string", [("MEDAN",)], z=c.city_zone(F.lit("SUMATERA UTARA"), F.col("c"), "fashion"))
    assert got == [("JAWA NON-JABODETABEK",)]


def test_regional_office_order(spark):
    rows = [
        ("TH", "SUMATERA BAGIAN UTARA", "DKI JAKARTA"), ("PDB", "JAWA BARAT", "DKI JAKARTA"), ("TH", "JAWA BARAT", "BANTEN"),
        ("TH", "JAWA BARAT", "JAWA BARAT"), ("TH", "3PL", None), ("MH", "JAWA BARAT", "BANTEN"), ("Agent", None, None),
        ("XX", "JAWA BARAT", "BANTEN"), (None, "JAWA BARAT", "BANTEN"), ("TH", "OTHER", "RIAU"),
    ]
    got = table_of(spark, "l string, o string, p string", rows, n=c.regional_office(F.col("l"), F.col("o"), F.col("p")))
    assert [n for n, in got] == ["Sumbagut", "Jakarta", "Tangerang", "Jabar", "3PL", "MH", "Agent", None, None, None]


def test_parcel_status(spark):
    t = "2024-01-01 00:00:00"
    rows = [
        (None, None, None, None, "Done"), (None, None, None, None, "Picked Up"), (None, None, None, None, "Cancel Order"),
        (None, None, None, None, None), (t, t, t, t, "x"), (t, None, None, None, "x"), (t, None, t, None, "x"),
        (t, None, t, t, "x"), (t, None, None, t, "x"),
    ]
    got = table_of(spark, "s string, p string, c string, r string, o string", rows, v=c.parcel_status(*map(F.col, "spcro")))
    assert [v for v, in got] == [
        "Not Picked Up Yet", None, "Cancel Order", None, "Delivered", "Delivery Process", "Return Process", "Returned", None,
    ]


def test_small_labels(spark):
    got = table_of(
        spark, "x string", [("Delivered",), ("Late",), ("On Time",), ("Not Picked Up",), (None,)],
        s=c.status_relabel(F.col("x")), p=c.pickup_verdict(F.col("x")),
    )
    assert got == [("POD", None), ("Late", "Late"), ("On Time", "Not Late"), ("Not Picked Up", "Not Late"), (None, None)]


def test_return_steps(spark):
    rows = [("a", None, None), ("a", "b", None), ("a", "b", "c"), (None, "b", None)]
    cols = [F.col(n) for n in "abc"]
    got = table_of(spark, "a string, b string, c string", rows, stage=c.return_stage(*cols), **c.return_flags(*cols))
    assert got == [
        ("Backlog Confirm Return", 1, 0, 0, 1), ("Backlog Return", 1, 1, 0, 0), ("POD Return", 1, 1, 1, 0), (None, 0, 1, 0, -1),
    ]


def test_ageing_edges(spark):
    days = [-1, 2, 3, 7, 8, 14, 15, 30, 31, None]
    got = table_of(spark, "d long", [(d,) for d in days], b=c.ageing_bucket(F.col("d")))
    assert [b for b, in got] == [
        "<3 Days", "<3 Days", "3-7 Days", "3-7 Days", "8-14 Days", "8-14 Days", "15-30 Days", "15-30 Days", ">30 Days", None,
    ]


def test_backlog_flags(spark):
    rows = [(3, None, None, None), (3, "t", 2, None), (3, "t", 3, None), (2, None, None, None), (15, "t", 0, None), (15, "t", 0, "r")]
    flags = c.backlog_flags(*[F.col(n) for n in ("a", "f", "d", "r")])
    assert table_of(spark, "a long, f string, d long, r string", rows, **flags) == [(1, 0), (0, 0), (1, 0), (0, 0), (0, 1), (0, 0)]


def test_order_vs_waybill_combined_destination_never_shows(spark):
    fields = ("sender_city", "sender_district", "recipient_city", "recipient_district", "calculated_weight", "volume_weight",
              "actual_weight", "insurance", "express_type")
    ddl = ", ".join(f"o_{f} string, w_{f} string" for f in fields)
    same = {f: ("1", "1") for f in fields}

    def row(**changes):
        return tuple(v for f in fields for v in changes.get(f, same[f]))

    ab = ("1", "2")
    rows = [
        row(), row(sender_city=ab, sender_district=ab), row(sender_district=ab), row(sender_city=ab),
        row(recipient_city=ab, recipient_district=ab), row(recipient_district=ab),
        row(calculated_weight=ab, actual_weight=ab, volume_weight=ab), row(calculated_weight=ab, volume_weight=ab),
        row(calculated_weight=ab), row(insurance=ab, express_type=ab), row(sender_city=("1", None)),
    ]
    sides = [{f: F.col(f"{s}_{f}") for f in fields} for s in "ow"]
    got = table_of(spark, ddl, rows, **c.order_vs_waybill(*sides))
    no = "No Issue"
    assert got == [
        (no,) * 5, ("Different Origin City & District", no, no, no, no), ("Different Origin District", no, no, no, no),
        ("Different Origin City", no, no, no, no), (no, "Different Destination City", no, no, no),
        (no, "Different Destination District", no, no, no), (no, no, "Change in Weight (re-weigh)", no, no),
        (no, no, "Volumetric Weight", no, no), (no,) * 5,
        (no, no, no, "Different Insurance Amount", "Different Express Type"), (no,) * 5,
    ]


def test_courier_rules(spark):
    rows = [("1", "0", None, None), ("0", "0", "1", "0"), ("1", "1", None, None), (None, None, None, None), ("0", "0", None, None)]
    e, d, e2, d2 = (F.col(n) for n in ("e", "d", "f", "g"))
    got = table_of(
        spark, "e string, d string, f string, g string", rows, flag=c.courier_status(e), one=c.courier_status(e, d, "single"),
        two=c.courier_status(e, d, "either", (e2, d2)),
    )
    assert got == [
        ("active", "active", "active"), ("inactive", "inactive", "active"), ("active", "inactive", "inactive"),
        (None, "inactive", "inactive"), ("inactive", "inactive", "inactive"),
    ]
    with pytest.raises(ValueError):
        c.courier_status(e, d, "other")


def test_courier_fallback_and_task(spark):
    rows = [(0, "", 5, "o"), (7, "w", 5, "o"), (None, None, 5, "o"), (0, "w", None, None)]
    picked = c.courier_fallback(F.col("i"), F.col("n"), F.col("j"), F.col("m"))
    got = table_of(spark, "i long, n string, j long, m string", rows, **picked, **c.task_type(F.col("n"), "POD"))
    assert got == [(5, "o", "POD", 1), (7, "w", "POD", 1), (None, None, None, 0), (None, "w", "POD", 1)]


def test_branch_types(spark):
    names = ["MH CGK", "DC 1", "TH VIP 3", "TH 3", "VH 1", "VT 1", "PD 1", "XX", None]
    got = table_of(spark, "n string", [(n,) for n in names], t=c.branch_type(F.col("n")))
    assert [t for t, in got] == ["Hub", "Hub", "VIP", "Last mile", "Last mile", "Last mile", "Last mile", None, None]


def test_first_mile_repair(spark):
    df = spark.createDataFrame(
        [("late", "TH 1", "2024-01-02", "MH 1", "2024-01-01", "TH 9", "2023-12-31"),
         ("vip TH VIP", "TH 1", "2024-01-01", "MH 1", "2024-01-02", "TH 9", "2023-12-31"),
         (None, None, None, "MH 1", "2024-01-02", "TH 9", "2023-12-31")],
        "scheduling_or_pickup_branch string, sending_branch string, sending_time string, mh_arrival string, "
        "mh_arrival_time string, previous_branch_name_arr_fm string, previous_scan_time_arr_fm string",
    )
    cols = ("fm_sending_branch", "fm_sending_time", "mh_ori_arrival", "mh_ori_arrival_time")
    assert [tuple(r) for r in c.first_mile_repair(df).select(*cols).collect()] == [
        ("TH 9", "2023-12-31", "MH 1", "2024-01-01"), ("TH 1", "2024-01-01", "TH 9", "2023-12-31"),
        (None, None, "MH 1", "2024-01-02"),
    ]


def test_legs_count_second_boundaries_and_only_two_are_clamped(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:00.900", "2024-01-01 00:00:01.100")], "a string, b string")
    df = df.select(*[F.col(n).cast("timestamp_ntz").alias(n) for n in "ab"])
    legs = c.leg_leadtimes(*[F.col(n) for n in "ababbaa"])
    row = df.select(*[v.alias(k) for k, v in legs.items()], c.leg_clamp(F.lit(-5).cast("bigint")).alias("zero"),
                    c.leg_clamp(F.lit(None).cast("bigint")).alias("none")).first()
    assert [row[n] for n in c.LEG_NAMES] == [1, -1, 1, 0, -1, 0]
    assert (row.zero, row.none) == (0, None)
    assert c.CLAMPED_LEGS == ("leadtime_fm_to_arr_mh_ori", "leadtime_arr_mh_ori_to_sending_to_th_dest")


def test_destination_branch_and_fallback(spark):
    rows = [("p", "f", "c"), (None, "f", "c"), (None, None, "c"), (None, None, None)]
    p, f, k = (F.col(n) for n in "pfk")
    got = table_of(
        spark, "p string, f string, k string", rows,
        b=c.destination_branch((p.isNotNull(), p), (f.isNotNull(), f), (f.isNull(), k)), o=c.order_period_fallback(p, f),
    )
    assert got == [("p", "p"), ("f", "f"), ("c", None), (None, None)]


def test_days_between(spark):
    got = table_of(
        spark, "a string, b string", [("2024-03-01 00:00:00", "2024-02-28 23:59:59"), (None, "2024-02-28 23:59:59")],
        d=c.days_between_events(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")),
    )
    assert got == [(2,), (None,)]
