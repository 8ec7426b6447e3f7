"""Enrichment joins.

No join here forces a broadcast: Spark's own size checks (statistics when planning, measured sizes
under AQE) pick a broadcast for small masters and a shuffled join with skew splitting for masters that
have outgrown it. Look-up sides are cut to the needed columns, and to one row per key where the report
keeps one row per parcel anyway.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelspark.functions import rules
from parcelspark.functions.classify import courier_status, regional_office
from parcelspark.functions.timeops import AsOf, rolling_window
from parcelspark.operators import skew
from parcelspark.operators.records import one_record
from parcelspark.operators.skew import HOT_ROWS, heavy_keys, parted


def lookup(
    df: DataFrame, master: DataFrame, on: Mapping[str, str], take: Mapping[str, str], unique: bool = True,
    how: str = "left",
) -> DataFrame:
    """Joins ``take`` (output name -> master column) on ``on`` (column of df -> master column).

    ``unique`` first reduces the master to one row per key, so the join cannot multiply rows.
    """
    keys = {left: f"_k{i}" for i, left in enumerate(on)}
    side = master.select(
        *[F.col(on[left]).alias(name) for left, name in keys.items()],
        *[F.col(col).alias(out) for out, col in take.items()],
    )
    if unique:
        side = one_record(side, list(keys.values()))
    condition = [F.col(left) == F.col(name) for left, name in keys.items()]
    return df.join(side, condition, how).drop(*keys.values())


def of_spine(df: DataFrame, spine: DataFrame, key: str = "waybill_no") -> DataFrame:
    """Rows of a log whose key occurs in ``spine``.

    Cuts a log to a report's parcels before it is windowed or aggregated. Every later step groups by the same
    key, so nothing changes but the rows that travel; Spark broadcasts a small key set by its own size check.
    """
    return df.join(spine.select(key), key, "left_semi")


def decode_option(
    df: DataFrame, code: str, options: DataFrame, type_option: str, out: str, unique: bool = True
) -> DataFrame:
    """Adds the label of a code from the shared option table; unknown codes give NULL.

    A code that is listed twice gives its largest label; with ``unique=False`` it multiplies rows instead.
    """
    labels = options.where(F.col("type_option") == type_option).select(
        F.col("option_value").alias("_code"), F.col("option_name").alias(out)
    )
    if unique:
        labels = labels.groupBy("_code").agg(F.max(out).alias(out))
    return df.join(labels, F.col(code) == F.col("_code"), "left").drop("_code")


def lookback_left_join(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    time: str,
    days: int,
    as_of: AsOf,
    where: Column | None = None,
) -> DataFrame:
    """Left join to the right side's last ``days`` days; left rows without a recent match stay."""
    recent = rolling_window(right, time, days, as_of)
    if where is not None:
        recent = recent.where(where)
    condition = [left[lk] == recent[rk] for lk, rk in on.items()]
    return left.join(recent, condition, "left")


def lane_sla_join(
    df: DataFrame, lanes: DataFrame, on: Mapping[str, str], sla: str, out: str, unique: bool = False
) -> DataFrame:
    """Promised days of a lane; parcels on a lane without a promise drop out.

    A plain join by default: with the lanes straight from their exchange AQE can split a lane that owns a
    large share of the parcels. Reports join first and pick one row per parcel afterwards.
    """
    return lookup(df, lanes, on, {out: sla}, unique=unique, how="inner")


CONTRACT_KEYS = {
    "vip_customer_id": "shipping_client_id",
    "sender_city_id": "sender_location_id",
    "recipient_district_id": "recipient_location_id",
    "express_type": "express_type",
}


def contract_sla_join(
    df: DataFrame,
    tariffs: DataFrame,
    take: Mapping[str, str] | None = None,
    on: Mapping[str, str] = CONTRACT_KEYS,
    unique: bool = False,
) -> DataFrame:
    """Contract promise by client, origin city, destination district and express type.

    A plain join by default, for the same reason as ``lane_sla_join``.
    """
    return lookup(df, tariffs, on, take or {"min_sla": "min_sla", "max_sla": "max_sla"}, unique=unique)


def scans_before_return(
    scans: DataFrame,
    returns: DataFrame,
    key: str = "waybill_no",
    scan_time: str = "record_time",
    confirm_time: str = "return_confirm_record_time",
    inclusive: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds the return confirmation a scan came before, NULL for later scans and parcels not returned.

    Returns are reduced to the newest confirmation per parcel first, so scans are not multiplied. AQE
    cannot split a skewed join whose other side is such a reduction, so scans of parcels with more than
    ``hot_rows`` scans stay where they are and meet a broadcast of those parcels' confirmations, of which there are at
    most as many as the sketch lists.
    """
    confirmed = returns.groupBy(F.col(key).alias("_return_key")).agg(F.max(confirm_time).alias(confirm_time))
    before = F.col(scan_time) <= F.col(confirm_time) if inclusive else F.col(scan_time) < F.col(confirm_time)
    match = (F.col(key) == F.col("_return_key")) & before
    listed = heavy_keys(scans, key, hot_rows=hot_rows, nulls=True)
    ordinary, hot = parted(scans, listed, key)
    few = parted(confirmed, listed, "_return_key")[1]
    joined = ordinary.join(confirmed, match, "left").unionByName(hot.join(F.broadcast(few), match, "left"))
    return joined.drop("_return_key")


def exclude_matched(df: DataFrame, other: DataFrame, key: str = "waybill_no") -> DataFrame:
    """Rows of ``df`` whose key does not occur in ``other``."""
    return df.join(other.select(key), key, "left_anti")


def require_match(df: DataFrame, other: DataFrame, key: str = "waybill_no") -> DataFrame:
    """Rows of ``df`` with a match in ``other`` (one row per key), and its columns."""
    return df.join(other, key, "inner")


def flag_exists(
    df: DataFrame,
    events: DataFrame,
    sets: Mapping[str, Sequence[str]],
    key: str = "waybill_no",
    value: str = "problem_reason",
) -> DataFrame:
    """One Yes/No column per named value set: does the key have an event with a value of the set?

    All sets are answered by one aggregate and one join.
    """
    wanted = sorted({v for values in sets.values() for v in values})
    seen = (
        events.where(F.col(value).isin(*wanted))
        .groupBy(key)
        .agg(*[F.max(F.col(value).isin(*values)).alias(f"_has_{name}") for name, values in sets.items()])
    )
    joined = df.join(seen, key, "left")
    flags = {name: F.when(F.col(f"_has_{name}"), "Yes").otherwise("No") for name in sets}
    return joined.withColumns(flags).drop(*[f"_has_{name}" for name in sets])


def hub_names(
    df: DataFrame,
    hubs: DataFrame,
    origin: str = "origin",
    destination: str = "destination_by_issued",
    origin_out: str = "mh_sending_join",
    destination_out: str = "mh_arrival_join",
) -> DataFrame:
    """Hub names of both ends from one hub table; the gateway code has a fixed hub."""
    for code, out in ((origin, origin_out), (destination, destination_out)):
        df = lookup(df, hubs, {code: "mh_code"}, {"_hub": "mh_name"})
        named = F.when(F.col(code) == rules.GATEWAY_CODE, rules.GATEWAY_HUB).otherwise(F.col("_hub"))
        df = df.withColumn(out, named).drop("_hub")
    return df


def courier_profile(
    df: DataFrame, users: DataFrame, order_courier: str = "order_courier_id", waybill_courier: str = "pickup_courier_id"
) -> DataFrame:
    """Personnel number and status of a pickup; active when the order's or the waybill's courier is."""
    kept = users.where(F.col("deleted") == "0")
    df = lookup(
        df, kept, {order_courier: "id"},
        {"personnel_no": "personnel_no", "enabled": "enabled", "_deleted": "deleted"}, unique=False,
    )
    df = lookup(df, kept, {waybill_courier: "id"}, {"_enabled2": "enabled", "_deleted2": "deleted"}, unique=False)
    status = courier_status(
        F.col("enabled"), F.col("_deleted"), rule="either", other=(F.col("_enabled2"), F.col("_deleted2"))
    )
    return df.withColumn("courier_status", status).drop("_deleted", "_enabled2", "_deleted2")


def branch_region(
    df: DataFrame, branch_id: str, branches: DataFrame, areas: DataFrame, options: DataFrame, offices: DataFrame
) -> DataFrame:
    """Branch number, level label, province of the branch's city and regional office short name."""
    df = lookup(
        df, branches, {branch_id: "id"}, {"branch_no": "branch_no", "_level": "branch_level", "_city": "city_id"}
    )
    df = decode_option(df, "_level", options, "branchLevel", "branch_level")
    province = areas.groupBy("city_id").agg(F.min("province_name").alias("province_name"))
    df = lookup(df, province, {"_city": "city_id"}, {"province_name": "province_name"}, unique=False)
    df = lookup(df, offices, {"province_name": "province_name"}, {"_office": "kanwil_name"})
    name = regional_office(F.col("branch_level"), F.col("_office"), F.col("province_name"))
    return df.withColumn("kanwil_name", name).drop("_level", "_city", "_office")


def manifest_match(
    sheet: DataFrame, system: DataFrame, on: Mapping[str, str] | None = None, hot_rows: int | None = None
) -> DataFrame:
    """Consignment sheet rows with the system rows of the same bag and vehicle; unmatched sheet rows stay.

    A bag with more than ``hot_rows`` system rows is spread over many tasks; without ``hot_rows`` the join is a plain one.
    """
    on = on or {"bm_code": "bag_no", "vm_code": "vehicle_tag_no"}
    if hot_rows is not None:
        return skew.left_join(sheet, system, on, hot_rows)
    return sheet.join(system, [F.col(s) == F.col(b) for s, b in on.items()], "left")


def latest_status_join(
    spine: DataFrame, *sides: DataFrame, key: str = "waybill_no", unreduced: Sequence[int] = (), hot_rows: int = HOT_ROWS
) -> DataFrame:
    """Spine with several one-row-per-key results; all joins share the key, so the spine is shuffled once.

    ``unreduced`` names the places of sides that may hold a key many times; those of more than ``hot_rows`` rows are
    spread over many tasks.
    """
    rows = spine
    for place, side in enumerate(sides):
        rows = skew.left_join(rows, side, key, hot_rows) if place in unreduced else rows.join(side, key, "left")
    return rows


