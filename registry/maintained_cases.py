"""Maintained results: rows arrive in batches, late ones among them, and the statement counts from scratch."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.functions.classify import task_type
from parcelspark.functions.timeops import local_date, month_label, sunday_week
from parcelspark.operators import maintained, records
from parcelspark.sources.states import States
from registry.base import at_first, at_last, case, local, local_day

col = F.col
BATCHES = 4


def batches(df: DataFrame, *by: str) -> list[DataFrame]:
    """All rows in four parts by a hash, so each part has rows older than what came before."""
    part = F.pmod(F.xxhash64(*by), F.lit(BATCHES))
    return [df.where(part == n) for n in range(BATCHES)]


_WAYBILL = (
    "waybill_no", "update_time", "shipping_time", "pod_record_time", "waybill_source", "express_type",
    "pickup_courier_id", "pod_courier_id", "standard_shipping_fee",
)
_TIE = [c for c in _WAYBILL if c not in ("waybill_no", "update_time")]
_NEWEST = f"""newest AS (
  SELECT {', '.join(_WAYBILL)} FROM waybill_waybill
  QUALIFY row_number() OVER (PARTITION BY waybill_no ORDER BY update_time DESC NULLS LAST, {', '.join(f'{c} NULLS FIRST' for c in _TIE)}) = 1)"""


def _waybills(s) -> list[DataFrame]:
    return batches(s["waybill_waybill"].select(*_WAYBILL), "waybill_no", "update_time", "standard_shipping_fee")


@case("l1_maintained", ["waybill_waybill"], f"""
WITH {_NEWEST} SELECT * REPLACE (CAST(standard_shipping_fee AS DOUBLE) AS standard_shipping_fee) FROM newest""")
def _(s):
    states, parts = States(s.spark), _waybills(s)
    for n, batch in enumerate(parts, 1):
        newest = states.write("newest", maintained.fold_latest(states.read("newest"), batch, "waybill_no", "update_time"), n)
    return newest


@case("l4_l5_maintained", ["waybill_problem_piece"], f"""
SELECT waybill_no, {at_last('problem_reason', 'operation_time')} AS last_reason, max(operation_time) AS last_time,
       {at_first('operation_branch_name', 'operation_time')} AS first_branch, min(operation_time) AS first_time
FROM waybill_problem_piece GROUP BY waybill_no""")
def _(s):
    states = States(s.spark)
    problems = s["waybill_problem_piece"].select("waybill_no", "operation_time", "problem_reason", "operation_branch_name")
    latest = {"last_reason": "problem_reason", "last_time": "operation_time"}
    first = {"first_branch": "operation_branch_name", "first_time": "operation_time"}
    for n, batch in enumerate(batches(problems, *problems.columns), 1):
        state = maintained.fold_values(states.read("values"), batch, "waybill_no", "operation_time", latest, first)
        state = states.write("values", state, n)
    return maintained.values_of(state, "waybill_no")


@case("l6_batches", [], """
SELECT event_id, user_id, lag(event_type) OVER w AS previous_branch_name, lag(ts) OVER w AS previous_scan_time,
       lag(event_type, 2) OVER w AS previous_branch_name_2, lead(event_type) OVER w AS next_location_name,
       lead(ts) OVER w AS next_scan_time, lead(props) OVER w AS next_scan_type
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def _(s):
    # Three batches by time, as scans come in, and a last one of late scans.
    events = s["events"].select("event_id", "ts", "user_id", "event_type", "props")
    late = F.pmod(F.xxhash64("event_id"), F.lit(20)) == 0
    day = F.datediff("ts", F.lit("1970-01-01"))
    days = events.agg(F.min(day).alias("low"), F.max(day).alias("high")).first()
    span = ((days["high"] or 0) - (days["low"] or 0)) // 3 + 1
    parts = [events.where(~late & (F.floor((day - F.lit(days["low"] or 0)) / span) == n)) for n in range(3)] + [events.where(late)]
    states, named = States(s.spark), ("user_id", "ts", ["event_id"])
    for n, batch in enumerate(parts, 1):
        walked, ends = states.read("walked"), states.read("ends")
        changed = maintained.changed_neighbours(walked, ends, batch, "user_id", "ts", "event_type", "props", ["event_id"])
        changed = states.write("changed", changed, n)
        states.write("ends", maintained.fold_boundary(ends, changed, *named), n)
        walked = states.write("walked", changed if walked is None else maintained.apply_changes(walked, changed, *named), n)
    return walked.select("event_id", "user_id", *records.NEIGHBOUR_COLUMNS)


def _totals(s, parts: list[DataFrame], rows, keys: list[str], counts: dict, sums: dict) -> DataFrame:
    """Newest versions and totals over them, both after each batch; ``rows`` makes the counted rows of changed parcels."""
    states = States(s.spark)
    for n, batch in enumerate(parts, 1):
        newest, totals = states.read("newest"), states.read("totals")
        changes = states.write("changes", maintained.record_changes(newest, batch, "waybill_no", "update_time"), n)
        change = maintained.roll_up(rows(changes), keys, counts, sums)
        totals = states.write("totals", maintained.fold_totals(totals, change, keys), n)
        states.write("newest", maintained.fold_latest(newest, batch, "waybill_no", "update_time"), n)
    return maintained.totals_of(totals, keys)


@case("a1_retraction", ["waybill_waybill"], f"""
WITH {_NEWEST}
SELECT {local_day('shipping_time')} AS pickup_date, strftime({local('shipping_time')}, '%b %Y') AS month_pickup,
       CAST(strftime({local('shipping_time')}, '%U') AS BIGINT) AS week_pickup, waybill_source,
       count(waybill_no) AS total_volume, CAST(sum(standard_shipping_fee) AS DOUBLE) AS standard_shipping_fee
FROM newest GROUP BY ALL""")
def _(s):
    def rows(changes):
        shipped = local_date(col("shipping_time"))
        return changes.select(
            "waybill_no", "waybill_source", "standard_shipping_fee", "_sign", shipped.alias("pickup_date"),
            month_label(shipped).alias("month_pickup"), sunday_week(shipped).alias("week_pickup"),
        )

    keys = ["pickup_date", "month_pickup", "week_pickup", "waybill_source"]
    return _totals(s, _waybills(s), rows, keys, {"total_volume": "waybill_no"}, {"standard_shipping_fee": "standard_shipping_fee"})


@case("a2_retraction", ["waybill_waybill"], f"""
WITH {_NEWEST}
SELECT courier_id, day, waybill_source, CAST(sum(p) AS BIGINT) AS pickup, CAST(sum(d) AS BIGINT) AS pod FROM (
  SELECT pickup_courier_id AS courier_id, {local_day('shipping_time')} AS day, waybill_source, 1 AS p, 0 AS d FROM newest
  UNION ALL SELECT pod_courier_id, {local_day('pod_record_time')}, waybill_source, 0, 1 FROM newest
  WHERE pod_record_time IS NOT NULL)
GROUP BY courier_id, day, waybill_source""")
def _(s):
    def rows(changes):
        side = lambda who, when, pickup, pod: changes.select(
            col(who).alias("courier_id"), local_date(col(when)).alias("day"), "waybill_source", "_sign",
            pickup.alias("pickup"), pod.alias("pod"), col(when).alias("_when"),
        )
        none = F.lit(0).cast("long")
        pickups = side("pickup_courier_id", "shipping_time", task_type(col("shipping_time"), "Pickup")["task_count"], none)
        pods = side("pod_courier_id", "pod_record_time", none, task_type(col("pod_record_time"), "POD")["task_count"])
        return pickups.unionByName(pods.where("_when IS NOT NULL"))

    return _totals(s, _waybills(s), rows, ["courier_id", "day", "waybill_source"], {}, {"pickup": "pickup", "pod": "pod"})
