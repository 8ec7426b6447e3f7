"""Hot keys: which ones there are, from a sketch, and joins whose right side they would pile up in one task.

The sketch is Spark's mergeable frequent-items one: a task sends one row, whatever its keys. It lists at most ``LISTED``
keys, so the list may be broadcast at any table size. What it lists decides only which way a key takes, never a result.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

HOT_ROWS = 2_000_000
LISTED, TRACKED = 1_000, 10_000
# Tasks' sketches meet in so many tasks first, so that no task merges those of all.
_MERGERS = 64


def key_text(*keys: str) -> Column:
    """One text for the values of ``keys``; NULL where one of them is NULL, since such a key joins with nothing."""
    texts = [F.col(key).cast("string") for key in keys]
    if len(texts) == 1:
        return texts[0]
    missing = F.array_contains(F.array(*(text.isNull() for text in texts)), True)
    return F.when(~missing, F.to_json(F.array(*texts)))


def heavy_keys(df: DataFrame, *keys: str, hot_rows: int = HOT_ROWS, nulls: bool = False) -> DataFrame:
    """(_hot_key): the ``key_text`` of keys with more than ``hot_rows`` rows, as far as the sketch sees them.

    A key with more than about a two-thousandth of all rows is always seen; counts are estimates. With ``nulls`` rows
    without a key are one key, listed as NULL.
    """
    text = df.select(key_text(*keys).alias("_text"))
    if not nulls:
        text = text.where("_text IS NOT NULL")
    # Sketches cannot be combined if there is none, so a row without a key makes sure of one.
    one = df.sparkSession.range(1).select(F.lit(None).cast("string").alias("_text"))
    held = text.union(one).groupBy((F.spark_partition_id() % _MERGERS).alias("_merger")).agg(
        F.expr(f"approx_top_k_accumulate(_text, {TRACKED})").alias("_sketch")
    )
    # Grouped by a constant, because a task without rows cannot write the sketch of an ungrouped aggregate.
    merged = held.groupBy(F.lit(0).alias("_all")).agg(F.expr(f"approx_top_k_combine(_sketch, {TRACKED})").alias("_sketch"))
    top = merged.select(F.explode(F.expr(f"approx_top_k_estimate(_sketch, {LISTED})")).alias("_top"))
    return top.where(F.col("_top.count") > hot_rows).select(F.col("_top.item").alias("_hot_key"))


def parted(df: DataFrame, hot: DataFrame, *keys: str) -> tuple[DataFrame, DataFrame]:
    """Rows of the keys that ``hot`` does not list, and those of the keys that it lists. AQE drops the second side
    where the list is empty. ``hot`` has at most ``LISTED`` rows."""
    listed = key_text(*keys).eqNullSafe(F.col("_hot_key"))
    return df.join(F.broadcast(hot), listed, "left_anti"), df.join(F.broadcast(hot), listed, "left_semi")


def left_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Mapping[str, str],
    hot_rows: int = HOT_ROWS,
    salts: int | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``left.join(right, on, "left")`` for a right side in which one key may own a large share of the rows.

    AQE splits a skewed left side of a left join, never its right side. So right rows of hot keys get one of ``salts``
    numbers and the left rows of these keys are repeated once per number; all other keys take a plain join. ``on`` is a
    shared column, or left names to right ones. ``hot`` (``_hot_key``) replaces the list of the sketch. Listed keys
    that the right side does not have take the plain join, so any list gives the same rows. NULL keys match nothing.
    ``salts`` is the number of shuffle partitions if not given.
    """
    shared = isinstance(on, str)
    names = {on: on} if shared else dict(on)
    ours, theirs = list(names), list(names.values())
    salts = salts or int(left.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    condition = on if shared else [F.col(a) == F.col(b) for a, b in names.items()]
    listed = heavy_keys(right, *theirs, hot_rows=hot_rows) if hot is None else hot.where("_hot_key IS NOT NULL")

    usual_right, hot_right = parted(right, listed, *theirs)
    present = hot_right.select(key_text(*theirs).alias("_hot_key")).distinct()
    usual_left, hot_left = parted(left, present, *ours)
    usual = usual_left.join(usual_right, condition, "left")

    # A row's number depends on its values and its partition alone, so a task that runs again gives the same ones.
    salted = hot_right.withColumn("_right_salt", F.pmod(F.xxhash64(*right.columns, F.spark_partition_id()), F.lit(salts)))
    repeated = hot_left.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(salts - 1).cast("long"))))
    matched = repeated.join(
        salted.withColumnsRenamed({b: f"_right_{b}" for b in theirs}),
        [*(F.col(a) == F.col(f"_right_{b}") for a, b in names.items()), F.col("_salt") == F.col("_right_salt")],
    ).drop("_salt", "_right_salt")
    if shared:
        matched = matched.drop(*(f"_right_{b}" for b in theirs))
    else:
        matched = matched.withColumnsRenamed({f"_right_{b}": b for b in theirs})
    return usual.unionByName(matched.select(*usual.columns))
