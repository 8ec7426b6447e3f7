"""Facts of several logs per key, from one tagged union and one conditional aggregate.

A report that asks a parcel's masters, returns, problems and scans for a few values each would otherwise shuffle every
log on the parcel key, reduce it, and join the results. Here the logs are put under each other, each row with its
columns in one struct named after its log, and every value is an aggregate that looks at one struct only. All states
have a fixed size and are combined before the shuffle, so there is one exchange on the key, and a key that owns a large
share of a log sends one row per task.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.internal import InternalFunction

from parcelspark.operators.records import first_value, latest_value

_LAST = 2**63 - 1


class Log:
    """Aggregates over the rows of one log of a tagged union.

    ``name`` is the log's struct column. Each aggregate equals an operator of ``records`` over the log alone, for keys
    that have a row there; other keys get NULL.
    """

    def __init__(self, name: str):
        self.name = name

    def col(self, name: str) -> Column:
        return F.col(f"{self.name}.{name}")

    def _rows(self, where: Column | None) -> Column:
        here = F.col(self.name).isNotNull()
        return here if where is None else here & where

    def present(self, where: Column | None = None) -> Column:
        """Whether there is a row (for which ``where`` holds); false, never NULL."""
        return F.coalesce(F.max(self._rows(where)), F.lit(False))

    def oldest_time(self, time: str, where: Column | None = None) -> Column:
        return F.min(F.when(self._rows(where), self.col(time)))

    def newest_time(self, time: str, where: Column | None = None) -> Column:
        return F.max(F.when(self._rows(where), self.col(time)))

    def newest(self, time: str, col: str, where: Column | None = None) -> Column:
        """``col`` at the newest time, as ``latest_value``."""
        return latest_value(f"{self.name}.{time}", f"{self.name}.{col}", self._rows(where))

    def oldest(self, time: str, col: str, where: Column | None = None) -> Column:
        """``col`` at the oldest time, as ``first_value``."""
        return first_value(f"{self.name}.{time}", f"{self.name}.{col}", self._rows(where))

    def newest_record(self, time: str, cols: Sequence[str]) -> Column:
        """A struct with ``cols`` of the row that ``latest_record`` picks if ``cols`` are its remaining columns."""
        row = F.struct(_negative(self.col(time)).alias("_order"), *(self.col(c).alias(c) for c in cols))
        return F.min(F.when(self._rows(None), row))

    def attempts(self, time: str, col: str, n: int, where: Column | None = None) -> Column:
        """The state of ``attempt``: the n oldest rows, of rows at one instant those with the largest values."""
        row = F.struct(
            F.coalesce(_early(self.col(time)), F.lit(_LAST)).alias("order"),
            self.col(col).alias("value"),
            self.col(time).alias("time"),
        )
        return InternalFunction.collect_top_k(F.when(self._rows(where), row), n, False)


def _early(time: Column) -> Column:
    """Larger the earlier; NULL without a time. Exact to the microsecond, for both timestamp types (session in UTC)."""
    return -F.unix_micros(time.cast("timestamp"))


def _negative(time: Column) -> Column:
    """Smallest for the newest time, a missing time last."""
    return F.coalesce(_early(time), F.lit(_LAST))


def attempt(state: str, i: int, field: str = "value") -> Column:
    """Attempt number ``i`` as ``attempt_pivot`` shows it: numbered by RANK, the largest value of a shared number.

    The rows before an instant are all among the n oldest, so a row's place is its rank if it is the first of its
    instant. ``field`` is "value" or "time".
    """
    own = F.get(state, F.lit(i - 1))
    if i == 1:
        return own[field]
    return F.when(F.get(state, F.lit(i - 2))["order"] != own["order"], own[field])


def assembled(logs: Mapping[str, DataFrame], key: str, facts: Mapping[str, Column]) -> DataFrame:
    """One row per key of the first log, with ``facts``: output names and aggregates of ``Log``.

    Logs may share column names. Only columns in ``logs`` travel, so cut each to what the facts ask. A row without a key
    has its log's facts only if it is of the first log (as after a join, NULL matches nothing). Empty logs give NULLs.
    """
    spine = next(iter(logs))
    tagged = [
        (rows if name == spine else rows.where(F.col(key).isNotNull())).select(
            key, F.struct(*(F.col(c) for c in rows.columns if c != key)).alias(name)
        )
        for name, rows in logs.items()
    ]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tagged)
    grouped = union.groupBy(key).agg(Log(spine).present().alias("_in_spine"), *(agg.alias(out) for out, agg in facts.items()))
    return grouped.where("_in_spine").drop("_in_spine")
