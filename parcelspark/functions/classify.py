"""Classification: column expressions that turn facts about a parcel into report labels.

Everything here stays inside the JVM (``when`` chains and literal lists), so a report's labels
add no stage and no Python worker to its plan.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules


def _flag(condition: Column) -> Column:
    """1 where the condition holds, else 0 (also where it is unknown)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0)).cast("bigint")


def _has_prefix(name: Column, prefixes: Sequence[str]) -> Column:
    return F.substring(name, 1, 2).isin(*prefixes)


# --- promised days -----------------------------------------------------------------------------


def due_date(shipping_time: Column, sla_days: Column) -> Column:
    """UTC date of shipping plus the promised days. Deliberately not a local date."""
    return F.date_add(F.to_date(shipping_time), sla_days.cast("int"))


def sla_verdict(
    pod_local_date: Column,
    due: Column,
    sla_days: Column,
    today: date,
    missing: str | None = "Not Late",
    pending_ok: str | None = None,
) -> Column:
    """Late or not: a delivered parcel against its due date, a pending one against ``today``.

    ``missing`` is the label without a promise (None lets the verdict fall through to NULL),
    ``pending_ok`` the label of a parcel still on the way and in time.
    """
    reached = F.coalesce(pod_local_date, F.lit(today))
    in_time = F.when(pod_local_date.isNull(), F.lit(pending_ok).cast("string")).otherwise("Not Late")
    return (
        F.when(sla_days >= rules.NO_SLA_DAYS, "No SLA (OoC)")
        .when(sla_days.isNull(), F.lit(missing).cast("string"))
        .when(reached > due, "Late")
        .when(reached <= due, in_time)
    )


def otd_status(pod_time: Column, due: Column, today: date) -> Column:
    """On-time verdict from the due date alone, without the out-of-coverage rule."""
    reached = F.coalesce(F.to_date(pod_time), F.lit(today))
    return F.when(reached <= due, "Not Late").when(reached > due, "Late")


def sla_cutover(shipping_time: Column, new: Column, old: Column, cut: date = date(2023, 11, 1)) -> Column:
    """The new promise for parcels shipped (local date) from ``cut`` on, the old one before."""
    return F.when(F.to_date(shipping_time) >= F.lit(cut), new).otherwise(old)


# --- late reasons ------------------------------------------------------------------------------


def late_reason(
    problem_reason: Column,
    partner_reason: Column,
    suppress: Sequence[str] = rules.SENDER_SIDE_REASONS,
) -> Column:
    """Last problem, or the partner's own reason when there was none; sender-side problems give NULL."""
    excused = problem_reason.isin(*suppress) if suppress else F.lit(False)
    return F.when(problem_reason.isNull(), partner_reason).when(~excused, problem_reason)


def late_reason_default(verdict: Column, reason: Column, default: str | None = rules.NO_COURIER) -> Column:
    """A late parcel without a reason gets ``default``."""
    return F.coalesce(reason, F.when(verdict == "Late", F.lit(default).cast("string")))


def _label_late(verdict: Column, reason: Column, labels: Mapping[str | None, object]) -> Column:
    unknown = labels.get(None)
    lookup = F.when(reason.isNull(), F.lit(unknown).cast("string"))
    for label, reasons in labels.items():
        if label is not None:
            lookup = lookup.when(reason.isin(*reasons), label)
    return F.when(verdict == "Late", lookup)


def late_factor(verdict: Column, reason: Column, labels: Mapping = rules.MARKETPLACE_FACTOR_RULES) -> Column:
    """Who answers for a late delivery; a reason in no list gives NULL."""
    return _label_late(verdict, reason, labels)


def late_category(verdict: Column, reason: Column, labels: Mapping = rules.MARKETPLACE_CATEGORY_RULES) -> Column:
    """Controllable or not, for late deliveries."""
    return _label_late(verdict, reason, labels)


def problem_factor(
    df: DataFrame,
    factors: DataFrame,
    problem: str = "problem_reason",
    partner: str = "late_delivery_reason",
    suppress: Sequence[str] = rules.SENDER_SIDE_FACTOR_REASONS,
) -> DataFrame:
    """Adds factor and category from the master table: by problem, or by partner reason without one.

    ``factors`` holds (code, register_reason_bahasa, problem_factor, problem_category). Both
    look-ups are reduced to one row per key first, so no parcel is counted twice.
    """

    def side(key: str, tag: str) -> DataFrame:
        picked = F.min(F.struct("problem_factor", "problem_category")).alias(tag)
        return factors.where(F.col(key).isNotNull()).groupBy(F.col(key).alias(f"{tag}_key")).agg(picked)

    joined = df.join(side("code", "_by_problem"), F.col(problem) == F.col("_by_problem_key"), "left")
    joined = joined.join(
        side("register_reason_bahasa", "_by_partner"), F.col(partner) == F.col("_by_partner_key"), "left"
    )

    def pick(field: str) -> Column:
        return F.when(F.col(problem).isNull(), F.col("_by_partner")[field]).when(
            ~F.col(problem).isin(*suppress), F.col("_by_problem")[field]
        )

    return joined.select(
        *[F.col(name) for name in df.columns],
        pick("problem_factor").alias("late_delivery_factor"),
        pick("problem_category").alias("late_delivery_category"),
    )


# --- places ------------------------------------------------------------------------------------


def city_zone(province: Column | None, city: Column, scheme: str) -> Column:
    """Zone of a destination.

    ``marketplace``: JAKARTA / BODETABEK / NON-JABODETABEK. ``fashion``: JABODETABEK /
    JAWA NON-JABODETABEK / LUAR JAWA. ``leadtime``: Jabodetabek / Non Jabodetabek, by city alone.
    In the fashion scheme a known city outside the suburbs is "JAWA NON-JABODETABEK" on any island;
    "LUAR JAWA" is only reached without a city. That is how the reports read, so it is kept.
    """
    suburb = city.isin(*rules.CAPITAL_SUBURBS)
    if scheme == "leadtime":
        return F.when(suburb | city.isin(*rules.CAPITAL_CITIES), "Jabodetabek").otherwise("Non Jabodetabek")
    capital = province == rules.CAPITAL_PROVINCE
    if scheme == "marketplace":
        return (
            F.when(capital, "JAKARTA")
            .when(province.isNotNull() & suburb, "BODETABEK")
            .when(province.isNotNull() & ~suburb, "NON-JABODETABEK")
        )
    if scheme == "fashion":
        return (
            F.when(capital | (province.isNotNull() & suburb), "JABODETABEK")
            .when(province.isNotNull() & (~suburb | province.isin(*rules.JAVA_PROVINCES)), "JAWA NON-JABODETABEK")
            .when(province.isin(*rules.OUTER_PROVINCES), "LUAR JAWA")
        )
    raise ValueError(f"unknown zone scheme {scheme!r}")


def regional_office(branch_level: Column, office: Column, province: Column) -> Column:
    """Short office name of a branch. Field branches go by office or province, the others by level."""
    in_field = branch_level.isin(*rules.FIELD_LEVELS)
    sides = {"office": office, "province": province}
    chain = F.when(branch_level.isin(*rules.OTHER_LEVELS), branch_level)
    for side, name, short in rules.OFFICE_RULES:
        chain = chain.when(in_field & (sides[side] == name), short)
    return chain


def branch_type(name: Column) -> Column:
    """Hub, VIP, Last mile, or NULL, by the branch name's prefix."""
    return (
        F.when(_has_prefix(name, rules.HUB_PREFIXES), "Hub")
        .when(F.substring(name, 1, len(rules.VIP_PREFIX)) == rules.VIP_PREFIX, "VIP")
        .when(_has_prefix(name, rules.LAST_MILE_PREFIXES), "Last mile")
    )


def is_hub(name: Column) -> Column:
    return _has_prefix(name, rules.HUB_PREFIXES)


def is_last_mile(name: Column) -> Column:
    return _has_prefix(name, rules.LAST_MILE_PREFIXES)


def destination_branch(*choices: tuple[Column, Column]) -> Column:
    """First branch whose condition holds."""
    chain = F.when(choices[0][0], choices[0][1])
    for condition, branch in choices[1:]:
        chain = chain.when(condition, branch)
    return chain


# --- parcel and return state -------------------------------------------------------------------


def parcel_status(
    shipping: Column, pod: Column, return_confirm: Column, return_pod: Column, order_status: Column
) -> Column:
    """Where a parcel stands. Delivery wins over any return record."""
    shipped, delivered = shipping.isNotNull(), pod.isNotNull()
    open_parcel = shipped & ~delivered
    return (
        F.when(shipped & delivered, "Delivered")
        .when(~shipped & ~order_status.isin("Cancel Order", "Picked Up"), "Not Picked Up Yet")
        .when(~shipped & (order_status == "Cancel Order"), "Cancel Order")
        .when(open_parcel & return_confirm.isNull() & return_pod.isNull(), "Delivery Process")
        .when(open_parcel & return_confirm.isNotNull() & return_pod.isNull(), "Return Process")
        .when(open_parcel & return_confirm.isNotNull() & return_pod.isNotNull(), "Returned")
    )


def status_relabel(status: Column) -> Column:
    return F.when(status == "Delivered", "POD").otherwise(status)


def pickup_verdict(label: Column) -> Column:
    return F.when(label.isin("On Time", "Not Picked Up"), "Not Late").when(label == "Late", "Late")


def return_stage(registered: Column, confirmed: Column, pod: Column) -> Column:
    """Open step of a registered return."""
    after_confirm = F.when(pod.isNull(), "Backlog Return").otherwise("POD Return")
    return F.when(
        registered.isNotNull(),
        F.when(confirmed.isNull(), "Backlog Confirm Return").otherwise(after_confirm),
    )


def return_flags(registered: Column, confirmed: Column, pod: Column) -> dict[str, Column]:
    """0/1 columns per return step, and the open confirmations as their difference."""
    steps = {
        "return_regist_alias": _flag(registered.isNotNull()),
        "return_confirm_alias": _flag(confirmed.isNotNull()),
        "return_pod_alias": _flag(pod.isNotNull()),
    }
    steps["backlog_confirm_alias"] = steps["return_regist_alias"] - steps["return_confirm_alias"]
    return steps


def ageing_bucket(days: Column) -> Column:
    return (
        F.when(days < 3, "<3 Days")
        .when(days <= 7, "3-7 Days")
        .when(days <= 14, "8-14 Days")
        .when(days <= 30, "15-30 Days")
        .when(days > 30, ">30 Days")
    )


def backlog_flags(
    aging: Column, first_delivery: Column, days_to_delivery: Column, return_registered: Column
) -> dict[str, Column]:
    """No first delivery within two days of arrival; and two weeks old without a return."""
    not_tried = first_delivery.isNull() | (days_to_delivery > 2)
    return {
        "more_4_days": _flag((aging > 2) & not_tried),
        "more_14_days": _flag((aging > 14) & return_registered.isNull()),
    }


def days_between_events(later: Column, earlier: Column) -> Column:
    """Calendar days between two wall clock values."""
    return F.datediff(F.to_date(later), F.to_date(earlier)).cast("bigint")


# --- order against waybill ---------------------------------------------------------------------


def order_vs_waybill(order: Mapping[str, Column], waybill: Mapping[str, Column]) -> dict[str, Column]:
    """Five remarks on what changed between order and waybill.

    Keys: sender_city, sender_district, recipient_city, recipient_district, calculated_weight,
    volume_weight, actual_weight, insurance, express_type. The combined destination remark never
    appears: its rule compares the order's district with itself, so a changed city always reads
    'Different Destination City'.
    """

    def differs(field: str) -> Column:
        return order[field] != waybill[field]

    city, district = differs("sender_city"), differs("sender_district")
    weight = differs("calculated_weight")
    return {
        "remark_origin": F.when(city & district, "Different Origin City & District")
        .when(district, "Different Origin District")
        .when(city, "Different Origin City")
        .otherwise("No Issue"),
        "remark_destination": F.when(differs("recipient_city"), "Different Destination City")
        .when(differs("recipient_district"), "Different Destination District")
        .otherwise("No Issue"),
        "remark_weight": F.when(weight & differs("actual_weight"), "Change in Weight (re-weigh)")
        .when(weight & differs("volume_weight"), "Volumetric Weight")
        .otherwise("No Issue"),
        "remark_insurance": F.when(differs("insurance"), "Different Insurance Amount").otherwise("No Issue"),
        "remark_express_type": F.when(differs("express_type"), "Different Express Type").otherwise("No Issue"),
    }


# --- couriers ----------------------------------------------------------------------------------


def courier_status(
    enabled: Column, deleted: Column | None = None, rule: str = "enabled", other: tuple[Column, Column] | None = None
) -> Column:
    """active / inactive.

    ``either``: one of two users is enabled and one of them not deleted. ``single``: one user
    enabled and not deleted. ``enabled``: by the flag alone, NULL for any other value.
    """
    if rule == "enabled":
        return F.when(enabled == "1", "active").when(enabled == "0", "inactive")
    if rule == "single":
        return F.when((enabled == "1") & (deleted == "0"), "active").otherwise("inactive")
    if rule == "either":
        enabled2, deleted2 = other
        on = (enabled == "1") | (enabled2 == "1")
        kept = (deleted == "0") | (deleted2 == "0")
        return F.when(on & kept, "active").otherwise("inactive")
    raise ValueError(f"unknown courier rule {rule!r}")


def courier_fallback(
    waybill_id: Column, waybill_name: Column, order_id: Column, order_name: Column
) -> dict[str, Column]:
    """The order's courier where the waybill's is the placeholder 0 or ''."""
    return {
        "courier_id": F.when(waybill_id == 0, order_id).otherwise(waybill_id),
        "courier_name": F.when(waybill_name == "", order_name).otherwise(waybill_name),
    }


def task_type(time: Column, label: str) -> dict[str, Column]:
    """Task label and its 0/1 counter."""
    return {"task_type": F.when(time.isNotNull(), label), "task_count": _flag(time.isNotNull())}


# --- lead time ---------------------------------------------------------------------------------


def order_period_fallback(order_value: Column, pickup_value: Column) -> Column:
    return F.coalesce(order_value, pickup_value)


def first_mile_repair(df: DataFrame) -> DataFrame:
    """First-mile sending and hub arrival with the two known scan faults repaired.

    A sending scanned after the hub arrival is replaced by the stop before that arrival. For
    parcels picked up at a VIP branch the hub arrival itself is replaced by that stop.
    Reads sending_branch, sending_time, mh_arrival, mh_arrival_time, previous_branch_name_arr_fm,
    previous_scan_time_arr_fm, scheduling_or_pickup_branch.
    """
    sent_late = F.col("sending_time") > F.col("mh_arrival_time")
    vip = F.col("scheduling_or_pickup_branch").contains(rules.VIP_PREFIX)
    before, before_time = F.col("previous_branch_name_arr_fm"), F.col("previous_scan_time_arr_fm")
    return df.withColumns(
        {
            "fm_sending_branch": F.when(sent_late, before).otherwise(F.col("sending_branch")),
            "fm_sending_time": F.when(sent_late, before_time).otherwise(F.col("sending_time")),
            "mh_ori_arrival": F.when(vip, before).otherwise(F.col("mh_arrival")),
            "mh_ori_arrival_time": F.when(vip, before_time).otherwise(F.col("mh_arrival_time")),
        }
    )


LEG_NAMES = (
    "leadtime_rpu_to_pickup",
    "leadtime_pickup_to_sending_fm",
    "leadtime_fm_to_arr_mh_ori",
    "leadtime_arr_mh_ori_to_sending_to_th_dest",
    "leadtime_sending_mh_dest_to_arr_th_dest",
    "leadtime_arr_dest_to_pod",
)
CLAMPED_LEGS = LEG_NAMES[2:4]


def _seconds(later: Column, earlier: Column) -> Column:
    return F.unix_timestamp(later) - F.unix_timestamp(earlier)


def leg_leadtimes(*times: Column) -> dict[str, Column]:
    """Seconds of the six legs between seven times: request, pickup, first-mile sending, hub in, hub out,
    last-mile arrival, delivery. Counts second boundaries, so fractions are cut before subtracting."""
    return {name: _seconds(times[i + 1], times[i]) for i, name in enumerate(LEG_NAMES)}


def leg_clamp(seconds: Column) -> Column:
    """Negative legs count as 0; a missing leg stays NULL."""
    return F.when(seconds < 0, F.lit(0).cast("bigint")).otherwise(seconds)
