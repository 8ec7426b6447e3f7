"""Claim files: Everpro and Mengantar.

All facts come from one conditional aggregate over a tagged union of waybills, returns, problems and scans
(``operators.facts``): one exchange on the parcel key for all of them.

``cut_logs`` cuts each log to the claimed parcels first. That is right while Spark broadcasts their numbers; with more
parcels than that, the cut is a shuffle of each log of its own, and without it the logs travel once, partly aggregated.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import days_between_events, destination_branch
from parcelspark.functions.timeops import AsOf, local_time, rolling_window, since
from parcelspark.operators.enrich import decode_option, lookup, of_spine
from parcelspark.operators.facts import Log, assembled, attempt
from parcelspark.sources.tables import Tables


W, R, P, S = Log("_waybill"), Log("_return"), Log("_problem"), Log("_scan")


def _is_problem_scan() -> Column:
    return (S.col("operation_type") == rules.SCAN_PROBLEM) & (S.col("problem_type") != rules.PICKUP_PROBLEM_TYPE)


def _facts(tables_of: dict[Log, DataFrame], cut_logs: bool, facts: dict[str, Column]) -> DataFrame:
    """Newest waybill of each parcel and ``facts`` of its logs; waybills are the first of ``tables_of``."""
    waybills = tables_of[W]
    logs = {log.name: of_spine(rows, waybills) if cut_logs and log is not W else rows for log, rows in tables_of.items()}
    kept = [c for c in waybills.columns if c not in ("waybill_no", "update_time")]
    rows = assembled(logs, "waybill_no", {"_parcel": W.newest_record("update_time", kept), **facts})
    return rows.select("waybill_no", *(F.col(f"_parcel.{c}").alias(c) for c in kept), *facts)


def _local(name: str, as_of: AsOf) -> Column:
    return local_time(F.col(name), as_of.tz)


def everpro_claims(
    tables: Tables, as_of: AsOf, *, days: int = 186, scan_days: int = 93, cut_logs: bool = True
) -> DataFrame:
    """Claim file of one source: returns, problem attempts with photos, first delivery and last location."""
    options = tables["system_option"]
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = decode_option(waybills, "waybill_source", options, "waybillSource", "source_label")
    waybills = waybills.where(F.col("source_label").isin(*rules.EVERPRO_SOURCES)).select(
        "waybill_no", "update_time", "shipping_time", "pod_record_time", "pod_branch_name", "void_flag",
        F.col("source_label").alias("waybill_source"), F.col("parent_shipping_cleint").alias("vip_username"),
        F.col("vip_customer_name").alias("sub_account"), "sender_city_name", "recipient_city_name",
        "recipient_district_id", "pod_photo_url", "pickup_branch_name", "standard_shipping_fee",
        "total_shipping_fee", "cod_amount", "item_value", "insurance_amount", "handling_fee", "other_fee",
    )
    returns = rolling_window(tables["waybill_return_bill"], "update_time", days, as_of).select(
        "waybill_no", "return_record_time", "return_confirm_record_time", "return_pod_record_time"
    )
    problems = rolling_window(tables["waybill_problem_piece"], "operation_time", days, as_of)
    problems = problems.where(F.col("problem_type") != rules.PICKUP_PROBLEM_TYPE).select(
        "waybill_no", "operation_time", "problem_reason", "operation_branch_name"
    )
    scans = rolling_window(tables["waybill_waybill_line"], "record_time", max(days, scan_days), as_of).select(
        "waybill_no", "record_time", "operation_type", "problem_type", "operation_branch_name", "photo_url"
    )
    scans = scans.withColumns({
        "in_long": since(scans, "record_time", as_of.days_back(days), as_of.tz),
        "in_short": since(scans, "record_time", as_of.days_back(scan_days), as_of.tz),
    })
    scans = decode_option(scans, "operation_type", options, "operationType", "activity")

    delivery, short = S.col("operation_type") == rules.SCAN_DELIVERY, S.col("in_short")
    photographed = S.col("in_long") & _is_problem_scan()
    rows = _facts({W: waybills, R: returns, P: problems, S: scans}, cut_logs, {
        "return_regist": R.newest("return_record_time", "return_record_time"),
        "return_confirm": R.newest("return_record_time", "return_confirm_record_time"),
        "return_pod": R.newest("return_record_time", "return_pod_record_time"),
        "_reasons": P.attempts("operation_time", "problem_reason", 3),
        "first_pos_reason": P.oldest("operation_time", "problem_reason"),
        "first_pos_location": P.oldest("operation_time", "operation_branch_name"),
        "first_deliv_attempt": S.oldest_time("record_time", short & delivery),
        "last_location": S.newest("record_time", "operation_branch_name", short),
        "last_activity": S.newest("record_time", "activity", short),
        "last_scan_time": S.newest_time("record_time", short),
        "_photos": S.attempts("record_time", "photo_url", 3, photographed),
        "first_pos_photo_url": S.oldest("record_time", "photo_url", photographed),
    })
    rows = rows.withColumns({
        **{f"pos_attempt_{i}": attempt("_reasons", i, "time") for i in (1, 2, 3)},
        **{f"pos_reason_{i}": attempt("_reasons", i) for i in (2, 3)},
        **{f"pos_photo_url_{i}": attempt("_photos", i) for i in (2, 3)},
    })
    rows = decode_option(rows, "void_flag", options, "voidFlag", "void_status")
    rows = lookup(
        rows, tables["masterdata_branch_coverage_th"], {"recipient_district_id": "district_id"},
        {"covered_branch": "branch_name"},
    )
    # A first problem photo belongs to a parcel with a recorded problem.
    first_photo = F.when(F.col("pos_attempt_1").isNotNull(), F.col("first_pos_photo_url"))
    th_destination = destination_branch(
        (F.col("pod_branch_name").isNotNull(), F.col("pod_branch_name")),
        (F.col("pod_branch_name").isNull(), F.col("covered_branch")),
    )
    return rows.select(
        "waybill_no",
        _local("shipping_time", as_of).alias("shipping_time"),
        "sender_city_name", "recipient_city_name", "void_status",
        _local("return_regist", as_of).alias("return_regist_time"),
        _local("return_confirm", as_of).alias("return_confirm_time"),
        _local("return_pod", as_of).alias("return_pod_record_time"),
        _local("pos_attempt_1", as_of).alias("first_pos_attempt"),
        _local("pod_record_time", as_of).alias("pod_record_time"),
        first_photo.alias("first_pos_photo_url"),
        "pod_photo_url", "first_pos_reason", "first_pos_location", "waybill_source", "vip_username", "sub_account",
        _local("first_deliv_attempt", as_of).alias("first_deliv_attempt"),
        "pickup_branch_name",
        th_destination.alias("th_destination"),
        *[col for i in (2, 3) for col in (
            _local(f"pos_attempt_{i}", as_of).alias(f"pos_attempt_{i}"),
            F.col(f"pos_reason_{i}"),
            F.col(f"pos_photo_url_{i}"),
        )],
        "standard_shipping_fee", "total_shipping_fee", "cod_amount", "item_value", "insurance_amount",
        "handling_fee", "other_fee", "last_location", "last_activity",
        _local("last_scan_time", as_of).alias("last_scan_time"),
    )


def mengantar_claims(tables: Tables, as_of: AsOf, *, days: int = 93, cut_logs: bool = True) -> DataFrame:
    """Claim file of two source codes: problem flags, four attempts, first delivery and return scans."""
    options = tables["system_option"]
    waybills = rolling_window(tables["waybill_waybill"], "shipping_time", days, as_of)
    waybills = waybills.where(F.col("waybill_source").isin(*rules.MENGANTAR_SOURCE_CODES)).select(
        "waybill_no", "update_time", "order_no", "shipping_time", "pod_record_time", "pod_branch_name",
        "pod_photo_url", F.col("waybill_source").alias("_source"), "void_flag", "recipient_address",
        "recipient_district_id",
    )
    problems = rolling_window(tables["waybill_problem_piece"], "operation_time", days, as_of)
    problems = problems.where(F.col("problem_type") != rules.PICKUP_PROBLEM_TYPE).select("waybill_no", "problem_reason")
    scans = rolling_window(tables["waybill_waybill_line"], "record_time", days, as_of).select(
        "waybill_no", "record_time", "operation_type", "problem_type", "operation_branch_name",
        "register_reason_bahasa", "photo_url",
    )

    delivery = S.col("operation_type") == rules.SCAN_DELIVERY
    returned = S.col("operation_type") == rules.SCAN_RETURN
    flags = {
        "apakah_ada_pos_alamat_penerima_tidak_jelas_tidak_dapat_ditemukan": rules.BAD_ADDRESS_REASONS,
        "apakah_ada_POS_paket_hilang": rules.LOST_REASONS,
        "apakah_ada_POS_paket_hilang_ditemukan": rules.FOUND_REASONS,
    }
    rows = _facts({W: waybills, P: problems, S: scans}, cut_logs, {
        "first_delivery": S.oldest_time("record_time", delivery),
        "first_deliv_branch": S.oldest("record_time", "operation_branch_name", delivery),
        "first_return": S.oldest_time("record_time", returned),
        "first_regist_return_branch": S.oldest("record_time", "operation_branch_name", returned),
        "_reasons": S.attempts("record_time", "register_reason_bahasa", 4, _is_problem_scan()),
        "_photos": S.attempts("record_time", "photo_url", 4, _is_problem_scan()),
        **{name: P.present(P.col("problem_reason").isin(*reasons)) for name, reasons in flags.items()},
    })
    rows = rows.withColumns({
        **{f"pos_reason_{i}": attempt("_reasons", i) for i in range(1, 5)},
        **{f"pos_photo_url_{i}": attempt("_photos", i) for i in range(1, 5)},
        **{name: F.when(F.col(name), "Yes").otherwise("No") for name in flags},
    })
    rows = decode_option(rows, "_source", options, "waybillSource", "waybill_source")
    rows = decode_option(rows, "void_flag", options, "voidFlag", "void_status")
    rows = lookup(
        rows, tables["masterdata_branch_coverage_th"], {"recipient_district_id": "district_id"},
        {"covered_branch": "branch_name"},
    )
    pod, tried = F.col("pod_record_time").isNotNull(), F.col("first_delivery").isNotNull()
    branch = destination_branch(
        (pod, F.col("pod_branch_name")), (tried, F.col("first_deliv_branch")), (~tried, F.col("covered_branch"))
    )
    delivered_at, returned_at = _local("first_delivery", as_of), _local("first_return", as_of)
    return rows.select(
        "waybill_no", "order_no",
        _local("shipping_time", as_of).alias("shipping_time"),
        "waybill_source", "void_status", "recipient_address",
        branch.alias("destination_branch_name"),
        delivered_at.alias("first_deliv_attempt"),
        "first_deliv_branch",
        returned_at.alias("first_regist_return_time"),
        "first_regist_return_branch",
        days_between_events(returned_at, delivered_at).alias("diff_first_regist_and_deliv_day"),
        "apakah_ada_pos_alamat_penerima_tidak_jelas_tidak_dapat_ditemukan",
        "apakah_ada_POS_paket_hilang",
        "apakah_ada_POS_paket_hilang_ditemukan",
        F.when(pod, "Yes").otherwise("No").alias("apakah_paket_sudah_pod"),
        *[f"{name}_{i}" for i in range(1, 5) for name in ("pos_reason", "pos_photo_url")],
        _local("pod_record_time", as_of).alias("pod_record_time"),
        "pod_photo_url",
    )
