"""Newest / oldest / neighbouring records per key.

All picks are made repeatable: where the rule leaves several rows equal, the remaining columns in
ascending order decide (or the columns the caller names). Spark cuts each map task's output to the
wanted rows before the shuffle (window group limit, partial aggregation), so a key that owns a large
share of the table never travels or sits in one task whole. The one operator that needs every row of
a key, ``scan_neighbours``, splits such keys by time.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.functions.timeops import AsOf, joined_key, since
from parcelspark.operators.skew import HOT_ROWS, heavy_keys, parted


def _list(names: str | Sequence[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def _tie_break(df: DataFrame, used: Sequence[str], tie: Sequence[str] | None) -> list[Column]:
    if tie is None:
        tie = [f.name for f in df.schema if f.name not in used and not isinstance(f.dataType, T.MapType)]
    return [F.col(name).asc_nulls_first() for name in tie]


def _filled_first(df: DataFrame, used: Sequence[str], tie: Sequence[str] | None) -> list[Column]:
    if tie is None:
        tie = [f.name for f in df.schema if f.name not in used and not isinstance(f.dataType, T.MapType)]
    return [F.col(name).asc_nulls_last() for name in tie]


def _first_row(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    window = Window.partitionBy(*keys).orderBy(*(order or [F.lit(1)]))
    return df.withColumn("_pick", F.row_number().over(window)).where(F.col("_pick") == 1).drop("_pick")


def latest_record(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], tie: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the newest by ``order`` (NULL times last)."""
    keys, order = _list(keys), _list(order)
    newest = [F.col(name).desc_nulls_last() for name in order]
    return _first_row(df, keys, newest + _tie_break(df, keys + order, tie))


def earliest_record(
    df: DataFrame, keys: str | Sequence[str], order: str | Sequence[str], tie: Sequence[str] | None = None
) -> DataFrame:
    """One row per key: the oldest by ``order`` (NULL times first)."""
    keys, order = _list(keys), _list(order)
    oldest = [F.col(name).asc_nulls_first() for name in order]
    return _first_row(df, keys, oldest + _tie_break(df, keys + order, tie))


def one_record(df: DataFrame, keys: str | Sequence[str], tie: Sequence[str] | None = None) -> DataFrame:
    """One row per key where any row will do; the smallest by the remaining columns is taken, missing values last."""
    keys = _list(keys)
    return _first_row(df, keys, _filled_first(df, keys, tie))


# --- values at the newest / oldest time ----------------------------------------------------------


def latest_value(time: str, col: str, where: Column | None = None) -> Column:
    """Aggregate: ``col`` at the newest ``time``; at equal times the largest non-NULL value."""
    pair = F.struct(F.col(time).alias("t"), F.col(col).alias("v"))
    return F.max(pair if where is None else F.when(where, pair))["v"]


def first_value(time: str, col: str, where: Column | None = None) -> Column:
    """Aggregate: ``col`` at the oldest ``time``; at equal times the smallest non-NULL value."""
    pair = F.struct(F.col(time).alias("t"), F.col(col).isNull().alias("n"), F.col(col).alias("v"))
    return F.min(pair if where is None else F.when(where, pair))["v"]


def latest_values(
    df: DataFrame, keys: str | Sequence[str], time: str, cols: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Per key, each column's value at the newest time. ``cols`` maps output name to input column."""
    cols = cols if isinstance(cols, Mapping) else {name: name for name in cols}
    return df.groupBy(*_list(keys)).agg(*[latest_value(time, col).alias(out) for out, col in cols.items()])


def first_values(
    df: DataFrame, keys: str | Sequence[str], time: str, cols: Mapping[str, str] | Sequence[str]
) -> DataFrame:
    """Per key, each column's value at the oldest time. ``cols`` maps output name to input column."""
    cols = cols if isinstance(cols, Mapping) else {name: name for name in cols}
    return df.groupBy(*_list(keys)).agg(*[first_value(time, col).alias(out) for out, col in cols.items()])


# --- neighbours ----------------------------------------------------------------------------------

NEIGHBOUR_COLUMNS = (
    "previous_branch_name", "previous_scan_time", "previous_branch_name_2",
    "next_location_name", "next_scan_time", "next_scan_type",
)


def split_hot_keys(df: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> tuple[DataFrame, DataFrame]:
    """Rows of ordinary keys, and rows of hot keys. AQE drops the second side when no key is hot."""
    return parted(df, heavy_keys(df, key, hot_rows=hot_rows, nulls=True), key)


# Leading characters of "2024-01-31 12:34:56" that name a time slice; they sort as the times do.
SLICE_LENGTHS = {"day": 10, "hour": 13, "minute": 16, "second": 19}


def _neighbours(df: DataFrame, window, stop: str, time: str, kind: str) -> DataFrame:
    return df.withColumns(
        {
            "previous_branch_name": F.lag(stop, 1).over(window),
            "previous_scan_time": F.lag(time, 1).over(window),
            "previous_branch_name_2": F.lag(stop, 2).over(window),
            "next_location_name": F.lead(stop).over(window),
            "next_scan_time": F.lead(time).over(window),
            "next_scan_type": F.lead(kind).over(window),
        }
    )


def scan_neighbours(
    scans: DataFrame,
    key: str,
    time: str,
    stop: str,
    kind: str,
    tie: Sequence[str] | None = None,
    hot_rows: int = HOT_ROWS,
    slice_unit: str = "minute",
) -> DataFrame:
    """Adds the previous stop and time, the stop before it, and the next stop, time and scan type.

    Ordinary keys go through one window per key. A key with more than ``hot_rows`` rows would be one
    task, so its rows are windowed per (key, time slice) instead; only the first and last scans of each
    slice are then passed between neighbouring slices of the key. Both ways give the same rows.
    ``slice_unit`` should leave no slice of a hot key near ``hot_rows`` rows.
    """
    tie = _list(tie) if tie is not None else [c for c in scans.columns if c not in (key, time)]
    order = [time, *tie]
    ascending = [F.col(name).asc_nulls_first() for name in order]

    ordinary, hot = split_hot_keys(scans, key, hot_rows)
    ordinary = _neighbours(ordinary, Window.partitionBy(key).orderBy(*ascending), stop, time, kind)

    # Scans without a time come first and are in the order of the tie-break, so its leading text names their slices,
    # behind a character that sorts before any digit; a missing text comes before all.
    timeless = F.lit("")
    if tie and isinstance(scans.schema[tie[0]].dataType, T.StringType):
        timeless = F.coalesce(F.concat(F.lit("\u0001"), F.substring(tie[0], 1, 12)), F.lit(""))

    # NULL keys and times get stand-in values here, so window and join share one hash partitioning.
    slice_cols = ["_key_text", "_key_null", "_slice"]
    sliced = hot.withColumns(
        {
            "_key_text": F.coalesce(F.col(key).cast("string"), F.lit("")),
            "_key_null": F.col(key).isNull(),
            "_slice": F.coalesce(F.substring(F.col(time).cast("string"), 1, SLICE_LENGTHS[slice_unit]), timeless),
        }
    )
    in_slice = Window.partitionBy(*slice_cols).orderBy(*ascending)
    sliced = _neighbours(sliced, in_slice, stop, time, kind).withColumn("_row", F.row_number().over(in_slice))
    edge = F.struct(
        F.col("_row"), F.col(stop).alias("stop"), F.col(time).alias("time"), F.col(kind).alias("kind"),
        F.col("previous_branch_name").alias("before"),
    )
    across = Window.partitionBy("_key_text", "_key_null").orderBy("_slice")
    edges = (
        sliced.groupBy(*slice_cols)
        .agg(F.min(edge).alias("_first"), F.max(edge).alias("_last"))
        .select(
            *slice_cols,
            F.col("_last")["_row"].alias("_rows"),
            F.lag("_last", 1).over(across).alias("_prev"),
            F.lag("_last", 2).over(across).alias("_prev2"),
            F.lead("_first").over(across).alias("_next"),
        )
    )
    opens, second, closes = F.col("_row") == 1, F.col("_row") == 2, F.col("_row") == F.col("_rows")
    before_prev = F.when(F.col("_prev")["_row"] > 1, F.col("_prev")["before"]).otherwise(F.col("_prev2")["stop"])

    def fill(name: str, *cases: tuple[Column, Column]) -> Column:
        chain = F.when(*cases[0])
        for case in cases[1:]:
            chain = chain.when(*case)
        return chain.otherwise(F.col(name))

    repaired = sliced.join(edges, slice_cols, "left").withColumns(
        {
            "previous_branch_name": fill("previous_branch_name", (opens, F.col("_prev")["stop"])),
            "previous_scan_time": fill("previous_scan_time", (opens, F.col("_prev")["time"])),
            "previous_branch_name_2": fill(
                "previous_branch_name_2", (opens, before_prev), (second, F.col("_prev")["stop"])
            ),
            "next_location_name": fill("next_location_name", (closes, F.col("_next")["stop"])),
            "next_scan_time": fill("next_scan_time", (closes, F.col("_next")["time"])),
            "next_scan_type": fill("next_scan_type", (closes, F.col("_next")["kind"])),
        }
    )
    return ordinary.unionByName(repaired.select(*ordinary.columns))


# --- numbered attempts ---------------------------------------------------------------------------


def attempt_pivot(
    df: DataFrame,
    key: str,
    time: str,
    cols: Mapping[str, str],
    n: int,
    time_name: str | None = None,
    firsts: Mapping[str, str] | None = None,
) -> DataFrame:
    """One row per key with the values of attempts 1..n: columns ``{name}_1`` .. ``{name}_n``.

    Attempts are numbered by RANK of their time: equal times share a number and leave a gap after it,
    so attempt 2 can be missing while attempt 3 is there; within a shared number the largest value shows.
    ``time_name`` adds the times themselves; ``firsts`` adds values of the oldest time as ``first_values``
    would, from the same pass. Rows at one instant are merged before ranking, so at most n rows per key
    reach the ranking task.
    """
    firsts = firsts or {}
    instants = df.groupBy(key, time).agg(
        F.count(F.lit(1)).alias("_n"),
        *[F.max(col).alias(f"_v_{out}") for out, col in cols.items()],
        *[F.min(col).alias(f"_f_{out}") for out, col in firsts.items()],
    )
    by_time = Window.partitionBy(key).orderBy(F.col(time).asc_nulls_first())
    early = instants.withColumn("_pos", F.row_number().over(by_time)).where(F.col("_pos") <= n)
    earlier = F.sum("_n").over(by_time.rowsBetween(Window.unboundedPreceding, -1))
    ranked = early.withColumn("_rank", F.coalesce(earlier, F.lit(0)) + 1)
    shown = {out: f"_v_{out}" for out in cols}
    if time_name is not None:
        shown = {time_name: time, **shown}
    return ranked.groupBy(key).agg(
        *[
            F.max(F.when(F.col("_rank") == i, F.col(source))).alias(f"{out}_{i}")
            for out, source in shown.items()
            for i in range(1, n + 1)
        ],
        *[F.max(F.when(F.col("_rank") == 1, F.col(f"_f_{out}"))).alias(out) for out in firsts],
    )


# --- tariffs and transport labels ----------------------------------------------------------------


def current_tariff(tariffs: DataFrame, as_of: AsOf) -> DataFrame:
    """Tariffs that are neither expired (local date) nor deleted, newest version per search code."""
    alive = tariffs.where(
        since(tariffs, "end_expire_time", as_of.local_date + timedelta(days=1), as_of.tz)
        & (F.col("deleted") == "0")
    )
    return latest_record(alive, "search_code", "created_at")


def transport_label(
    scans: DataFrame,
    vehicle: str = "vehicle_tag_no",
    bag: str = "bag_no",
    waybill: str = "waybill_no",
    label: str = "vm_bm_awb",
    tie: Sequence[str] | None = None,
) -> DataFrame:
    """One scan per waybill with its vehicle - bag - waybill label, then one row per label.

    A scan with a complete label is preferred. Such labels hold the waybill and are unique already, so only waybills
    without one are reduced again: they share the NULL label, of which one row is kept.
    """
    labelled = scans.withColumn(label, joined_key(F.col(vehicle), F.col(bag), F.col(waybill)))
    order = [F.col(label).isNull(), *_filled_first(scans, [waybill], tie)]
    per_waybill = _first_row(labelled, [waybill], order)
    missing = per_waybill.where(F.col(label).isNull())
    return per_waybill.where(F.col(label).isNotNull()).unionByName(
        one_record(missing, label, None if tie is None else [waybill, *tie])
    )
