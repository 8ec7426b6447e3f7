"""A reproducible shuffle into shards: global row numbers, permuted by a Feistel network with cycle walking."""

from __future__ import annotations

import random
from collections.abc import Sequence
from math import isqrt

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import cols, others, quoted

_PRIME = 2147483647
_ROUNDS = 4


def _div(value: Column, by: Column) -> Column:
    """Whole-number division, exact below 2**53."""
    return ((value - value % by) / by).cast("long")


class Permutation:
    """A permutation of 0 .. n-1 that is fixed by ``n`` and ``seed``.

    A value is split over a grid of about sqrt(n) by sqrt(n) cells, whose two coordinates take turns in being
    shifted by a hash of the other (a Feistel network over two moduli, so it can be inverted). The grid has
    fewer than sqrt(n) cells too many; a value that falls on one is permuted again until it is below ``n``.
    How often that can happen follows from the surplus cells alone: ``walk`` is measured over all of them.
    """

    def __init__(self, spark: SparkSession, n: int, seed: int):
        if n > 1 << 50:
            raise ValueError("more than 2**50 rows")
        self.n = n
        self.high = max(1, isqrt(max(n - 1, 0)) + 1)
        self.low = max(1, -(-n // self.high))
        draw = random.Random(seed)
        self.salts = [tuple(draw.randrange(1, _PRIME) for _ in range(4)) for _ in range(_ROUNDS)]
        self.walk = self._longest_walk(spark)

    def _mixed(self, value: Column, factor: Column, shift: Column) -> Column:
        once = (value % F.lit(_PRIME) * factor + shift) % F.lit(_PRIME)
        twice = once.bitwiseXOR(F.shiftright(once, 13)) * F.lit(1103515245) + shift
        return twice % F.lit(_PRIME)

    def _once(self, value: Column, back: bool = False) -> Column:
        salts = F.array(
            *(
                F.struct(*(F.lit(s).cast("long").alias(k) for k, s in zip("abcd", row)))
                for row in (reversed(self.salts) if back else self.salts)
            )
        )
        high, low = F.lit(self.high).cast("long"), F.lit(self.low).cast("long")

        def forth_step(at: Column, salt: Column) -> Column:
            left = (at["left"] + self._mixed(at["right"], salt["a"], salt["b"])) % high
            right = (at["right"] + self._mixed(left, salt["c"], salt["d"])) % low
            return F.struct(left.alias("left"), right.alias("right"))

        def back_step(at: Column, salt: Column) -> Column:
            right = F.pmod(at["right"] - self._mixed(at["left"], salt["c"], salt["d"]), low)
            left = F.pmod(at["left"] - self._mixed(right, salt["a"], salt["b"]), high)
            return F.struct(left.alias("left"), right.alias("right"))

        start = F.struct(_div(value, low).alias("left"), (value % low).alias("right"))
        return F.aggregate(salts, start, back_step if back else forth_step, lambda at: at["left"] * low + at["right"])

    def _longest_walk(self, spark: SparkSession) -> int:
        """Steps after which every value that started below ``n`` is below it again.

        All surplus cells take 16 steps. Should k of them still be outside, a walk into them has at most k further
        steps: each of its first cells is one of these k. (Cells that circle among themselves are never reached.)
        """
        if self.high * self.low <= self.n:
            return 0
        walked = F.aggregate(
            F.sequence(F.lit(1), F.lit(16)),
            F.struct(F.col("id").alias("at"), F.lit(1).alias("steps")),
            lambda s, _: F.when(s["at"] < self.n, s).otherwise(
                F.struct(self._once(s["at"]).alias("at"), (s["steps"] + 1).alias("steps"))
            ),
        )
        longest, outside = (
            spark.range(self.n, self.high * self.low)
            .select(walked.alias("s"))
            .agg(F.max("s.steps"), F.count(F.when(F.col("s.at") >= self.n, 1)))
            .first()
        )
        return longest + outside

    def _walked(self, value: Column, back: bool) -> Column:
        first = self._once(value, back)
        if not self.walk:
            return first
        return F.aggregate(
            F.sequence(F.lit(1), F.lit(self.walk)),
            first,
            lambda at, _: F.when(at < self.n, at).otherwise(self._once(at, back)),
        )

    def forth(self, value: Column) -> Column:
        """Where row number ``value`` goes."""
        return self._walked(value, back=False)

    def back(self, value: Column) -> Column:
        """Which row number went to ``value``."""
        return self._walked(value, back=True)


def numbered(df: DataFrame, keys: Sequence[str], buckets: int = 4096) -> DataFrame:
    """``df`` with ``row_number``, gapless from 0 over all rows, fixed by the values of ``keys`` alone.

    Rows are dealt to ``buckets`` by a hash of all keys, counted per bucket (reduced on the map side), and ranked
    within their bucket; a bucket starts where those before it end. The table of starts has ``buckets`` rows, so
    it is broadcast. No task sees more than its buckets, and no input layout or partition count changes a number.
    Rows that agree in all keys are interchangeable and stand next to each other.
    """
    kept = others(df, "row_number")
    dealt = df.select(
        F.struct(*cols(kept)).alias("row"),
        F.pmod(F.xxhash64(*cols(keys)), F.lit(buckets)).alias("bucket"),
    )
    starts = (
        dealt.groupBy("bucket")
        .count()
        .select("bucket", (F.sum("count").over(Window.orderBy("bucket")) - F.col("count")).alias("start"))
    )
    order = [F.col(f"row.{quoted(k)}").asc_nulls_first() for k in keys]
    ranked = dealt.withColumn("rank", F.row_number().over(Window.partitionBy("bucket").orderBy(*order)))
    return ranked.join(F.broadcast(starts), "bucket").select(
        *(F.col(f"row.{quoted(c)}").alias(c) for c in kept),
        (F.col("start") + F.col("rank") - 1).cast("long").alias("row_number"),
    )


def shuffled(df: DataFrame, keys: Sequence[str], n_shards: int, seed: int = 42, buckets: int = 4096) -> DataFrame:
    """``df`` with ``row_number``, ``position``, ``shard`` and ``slot``.

    The position is the permuted row number; row p goes to shard p mod ``n_shards`` at slot p div ``n_shards``, so
    shard sizes differ by one at most and slots have no gap. ``keys`` should tell rows apart and must be sortable;
    nulls count as a value of their own. Input columns with an added column's name are replaced. An empty table
    stays empty, and shards beyond the row count stay empty.
    """
    if n_shards < 1:
        raise ValueError("n_shards must be positive")
    slim = others(df, "row_number", "position", "shard", "slot")
    base = df.select(*cols(slim))
    permutation = Permutation(df.sparkSession, base.count(), seed)
    return numbered(base, keys, buckets).select(
        *cols(slim), "row_number", permutation.forth(F.col("row_number")).alias("position")
    ).select(
        *cols(slim),
        "row_number",
        "position",
        (F.col("position") % n_shards).cast("int").alias("shard"),
        _div(F.col("position"), F.lit(n_shards)).alias("slot"),
    )
