"""Results that follow a day's new rows instead of a look-back read again.

A state is a table with a row per key (or per roll-up key). States merge: folding a batch into the state of all batches
before it gives what the operator gives on all rows at once, whatever the order in which rows arrive, so late rows need
no care. Each function takes and returns DataFrames; ``sources.states`` keeps the versions of a state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.operators.records import _list, earliest_record, latest_record, one_record, scan_neighbours

# --- picks of whole records ----------------------------------------------------------------------


def fold_latest(state: DataFrame | None, batch: DataFrame, keys, order, tie: Sequence[str] | None = None) -> DataFrame:
    """``latest_record`` of all batches so far: the newest of the state's row and the batch's rows of a key.

    The pick is the first row of a total order, so the state needs no more than the row picked. A batch that is folded
    in twice changes nothing.
    """
    return latest_record(batch if state is None else state.unionByName(batch), keys, order, tie)


def fold_earliest(state: DataFrame | None, batch: DataFrame, keys, order, tie: Sequence[str] | None = None) -> DataFrame:
    """``earliest_record`` of all batches so far."""
    return earliest_record(batch if state is None else state.unionByName(batch), keys, order, tie)


def fold_one(state: DataFrame | None, batch: DataFrame, keys, tie: Sequence[str] | None = None) -> DataFrame:
    """``one_record`` of all batches so far."""
    return one_record(batch if state is None else state.unionByName(batch), keys, tie)


# --- values at the newest / oldest time ----------------------------------------------------------


def _pair(time: str, col: str, newest: bool) -> Column:
    """What ``latest_value`` and ``first_value`` compare, with missing values last in both."""
    parts = [F.col(time).alias("t"), F.col(col).alias("v")]
    return F.struct(*parts) if newest else F.struct(parts[0], F.col(col).isNull().alias("n"), parts[1])


def value_state(
    batch: DataFrame, keys, time: str, latest: Mapping[str, str] | None = None, first: Mapping[str, str] | None = None
) -> DataFrame:
    """Per key a (time, value) pair for each wanted value, which ``fold_values`` merges. Names map to input columns."""
    picks = [F.max(_pair(time, col, True)).alias(name) for name, col in (latest or {}).items()]
    picks += [F.min(_pair(time, col, False)).alias(name) for name, col in (first or {}).items()]
    return batch.groupBy(*_list(keys)).agg(*picks)


def fold_values(
    state: DataFrame | None, batch: DataFrame, keys, time: str, latest: Mapping[str, str] | None = None,
    first: Mapping[str, str] | None = None,
) -> DataFrame:
    """The state after ``batch``. Pairs are compared by time and then by value, as ``latest_values`` and
    ``first_values`` compare them, so a batch that is folded in twice changes nothing."""
    new = value_state(batch, keys, time, latest, first)
    if state is None:
        return new
    merges = [F.max(name).alias(name) for name in latest or {}] + [F.min(name).alias(name) for name in first or {}]
    return state.unionByName(new).groupBy(*_list(keys)).agg(*merges)


def values_of(state: DataFrame, keys) -> DataFrame:
    """The values of a state, without their times."""
    keys = _list(keys)
    return state.select(*keys, *(F.col(name)["v"].alias(name) for name in state.columns if name not in keys))


# --- roll-ups with retraction --------------------------------------------------------------------


def record_changes(state: DataFrame | None, batch: DataFrame, keys, order, tie: Sequence[str] | None = None) -> DataFrame:
    """What a batch does to ``fold_latest``'s state: the rows that leave it with ``_sign`` -1, those that come with 1.

    Only keys of the batch are compared. A key whose row stays, because the batch is older or the same again, has no
    row here.
    """
    keys = _list(keys)
    if state is None:
        return fold_latest(None, batch, keys, order, tie).withColumn("_sign", F.lit(1).cast("long"))
    met = batch.select(*(F.col(k).alias(f"_met_{k}") for k in keys)).distinct()
    same = reduce(lambda a, b: a & b, (F.col(k).eqNullSafe(F.col(f"_met_{k}")) for k in keys))
    before = state.join(met, same, "left_semi")
    after = fold_latest(before, batch, keys, order, tie)
    signed = before.withColumn("_sign", F.lit(-1).cast("long")).unionByName(after.withColumn("_sign", F.lit(1).cast("long")))
    # Rows that leave and come again cancel each other.
    columns = state.columns
    return signed.groupBy(*columns).agg(F.sum("_sign").alias("_sign")).where("_sign <> 0").select(*columns, "_sign")


def _exact(df: DataFrame, names: Sequence[str]) -> None:
    for name in names:
        if isinstance(df.schema[name].dataType, (T.FloatType, T.DoubleType)):
            raise TypeError(f"{name} is a floating-point number: what is added and taken away again would leave a rest")


def roll_up(changes: DataFrame, keys: Sequence[str], counts: Mapping[str, str] | None = None, sums: Mapping[str, str] | None = None) -> DataFrame:
    """(keys, ``_rows``, counts, sums and ``_n_`` counts of what was summed) over rows with ``_sign`` 1 or -1. ``counts``
    maps a name to the column whose values are counted, ``sums`` to the one whose values are added."""
    counts, sums = counts or {}, sums or {}
    _exact(changes, list(sums.values()))
    present = lambda col: F.when(F.col(col).isNotNull(), F.col("_sign")).otherwise(F.lit(0).cast("long"))
    zero = lambda col: F.lit(0).cast(changes.schema[col].dataType)
    return changes.groupBy(*keys).agg(
        F.sum("_sign").alias("_rows"),
        *(F.sum(present(col)).alias(name) for name, col in counts.items()),
        *(F.sum(F.when(F.col("_sign") > 0, F.coalesce(col, zero(col))).otherwise(-F.coalesce(col, zero(col)))).alias(name) for name, col in sums.items()),
        *(F.sum(present(col)).alias(f"_n_{name}") for name, col in sums.items()),
    )


def fold_totals(totals: DataFrame | None, change: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals after a change, both made by ``roll_up``; groups that have lost their last row are gone. Unlike a pick a
    change counts each time it is folded in, so a state and its totals advance together, one version each."""
    if totals is None:
        return change.where("_rows > 0")
    measures = [name for name in totals.columns if name not in keys]
    types = {f.name: f.dataType for f in totals.schema}
    both = totals.unionByName(change).groupBy(*keys).agg(*(F.sum(name).cast(types[name]).alias(name) for name in measures))
    return both.where("_rows > 0")


def totals_of(totals: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The totals as a count from scratch shows them: a sum of nothing is NULL."""
    shown = [name for name in totals.columns if name not in keys and not name.startswith("_")]
    summed = {name[3:] for name in totals.columns if name.startswith("_n_")}
    return totals.select(
        *keys, *(F.when(F.col(f"_n_{name}") > 0, F.col(name)).alias(name) if name in summed else F.col(name) for name in shown)
    )


# --- neighbours across batches -------------------------------------------------------------------


def _place(time: str, tie: Sequence[str]) -> Column:
    """Where a scan stands among those of its key; missing values come first, as in ``scan_neighbours``."""
    return F.struct(*(F.col(c) for c in (time, *tie)))


def boundary(walked: DataFrame, key: str, time: str, tie: Sequence[str]) -> DataFrame:
    """The last two scans of each key, with their neighbours: all that scans behind them need."""
    last = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in (time, *tie)))
    return walked.withColumn("_back", F.row_number().over(last)).where("_back <= 2").drop("_back")


def changed_neighbours(
    walked: DataFrame | None, ends: DataFrame | None, batch: DataFrame, key: str, time: str, stop: str, kind: str,
    tie: Sequence[str], **split,
) -> DataFrame:
    """The scans whose neighbours a batch makes or changes, with the new ones.

    ``walked`` has the scans so far with their neighbours, ``ends`` their ``boundary``; ``tie`` orders scans at one
    time and, with key and time, tells scans apart (scans that are equal in all of it change together). Keys whose
    new scans all lie behind their last one are continued from the boundary, of which only the last scan changes; this
    reads no older scan. Keys with late scans are walked again as a whole, and only their rows are read. New keys need
    neither. Write the result, then put it in place with ``apply_changes`` and ``fold_boundary``.
    """
    walk = lambda scans: scan_neighbours(scans, key, time, stop, kind, tie=tie, **split)
    if walked is None:
        return walk(batch)
    plain = batch.columns
    known = ends.groupBy(F.col(key).alias("_key")).agg(F.max(_place(time, tie)).alias("_last"))
    first = batch.groupBy(F.col(key).alias("_new_key")).agg(F.min(_place(time, tie)).alias("_first"))
    met = first.join(known, F.col("_new_key").eqNullSafe(F.col("_key")), "left")
    late = met.where(F.col("_last").isNotNull() & ~(F.col("_first") > F.col("_last"))).select(F.col("_new_key").alias("_late"))
    is_late = F.col(key).eqNullSafe(F.col("_late"))

    # Behind the last scan: the two last scans go in front of the new ones and lend them what is before them.
    next_batch = batch.join(late, is_late, "left_anti")
    touched = first.join(late, F.col("_new_key").eqNullSafe(F.col("_late")), "left_anti").select("_new_key")
    lent = ends.join(touched, F.col(key).eqNullSafe(F.col("_new_key")), "left_semi")
    back = ("previous_branch_name", "previous_scan_time", "previous_branch_name_2")
    rank = Window.partitionBy(key).orderBy(*(F.col(c).desc_nulls_last() for c in (time, *tie)))
    old = lent.withColumn("_back", F.row_number().over(rank)).select(*plain, "_back", *(F.col(c).alias(f"_old_{c}") for c in back))
    unknown = [F.lit(None).cast(ends.schema[c].dataType).alias(f"_old_{c}") for c in back]
    new = next_batch.select(*plain, F.lit(0).alias("_back"), *unknown)
    continued = walk(old.unionByName(new)).where("_back <= 1")  # the last but one keeps its neighbours
    for name in back:
        continued = continued.withColumn(name, F.when(F.col("_back") == 1, F.col(f"_old_{name}")).otherwise(F.col(name)))
    continued = continued.select(*walked.columns)

    again = walk(walked.join(late, is_late, "left_semi").select(*plain).unionByName(batch.join(late, is_late, "left_semi")))
    return continued.unionByName(again.select(*walked.columns))


def fold_boundary(ends: DataFrame | None, changed: DataFrame, key: str, time: str, tie: Sequence[str]) -> DataFrame:
    """The boundary after a batch, from the one before and the changed scans."""
    return boundary(changed if ends is None else apply_changes(ends, changed, key, time, tie), key, time, tie)


def apply_changes(walked: DataFrame, changed: DataFrame, key: str, time: str, tie: Sequence[str]) -> DataFrame:
    """``walked`` with the scans of ``changed`` in place of those with the same key, time and ``tie``, or added."""
    named = [key, time, *tie]
    gone = changed.select(*(F.col(c).alias(f"_gone_{i}") for i, c in enumerate(named))).distinct()
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(f"_gone_{i}")) for i, c in enumerate(named)))
    return walked.join(gone, same, "left_anti").unionByName(changed)
