"""Roll-ups. Sums and counts combine on the map side, so a dominant source or courier costs one row per task."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def volume_by_period(
    df: DataFrame, keys: Sequence[str], count_col: str, fee_col: str,
    count_name: str = "total_volume", fee_name: str | None = None,
) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(count_col).alias(count_name), F.sum(fee_col).alias(fee_name or fee_col)
    )


def task_counts(df: DataFrame, keys: Sequence[str], flags: Mapping[str, Column]) -> DataFrame:
    """Sums of 0/1 task flags."""
    return df.groupBy(*keys).agg(*[F.sum(flag).alias(name) for name, flag in flags.items()])


def courier_tasks(pickups: DataFrame, pods: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Pickup and delivery counts over both task lists. One aggregate: sums of sums collapse."""
    cols = [*keys, "pickup", "pod"]
    tasks = pickups.select(*cols).unionByName(pods.select(*cols))
    return task_counts(tasks, keys, {"pickup": F.col("pickup"), "pod": F.col("pod")})


TASK_FIELDS = ("waybill_no", "waybill_source", "express_type")


def courier_task_list(pickups: DataFrame, pods: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct tasks, with the parcel's columns on the pickup side or on the delivery side.

    A pickup and a delivery are never equal, so each side is made distinct where its rows already are by parcel.
    """

    def spread(tasks: DataFrame, side: str, other: str) -> DataFrame:
        return tasks.distinct().select(
            *keys,
            *[F.col(field).alias(f"{field}_{side}") for field in TASK_FIELDS],
            *[F.lit(None).cast("string").alias(f"{field}_{other}") for field in TASK_FIELDS],
        )

    cols = [*keys, *TASK_FIELDS]
    return spread(pickups.select(*cols), "pickup", "pod").unionByName(spread(pods.select(*cols), "pod", "pickup"))


def bag_totals(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(*[F.sum(name).alias(name) for name in measures])
