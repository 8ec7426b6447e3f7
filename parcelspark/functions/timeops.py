"""Time and key helpers.

Stored instants are UTC. Reports show carrier-local wall clock time, but several due dates and
look-back bounds are UTC dates, so every job derives both calendars from one ``as_of`` instant
instead of asking the cluster for the current date. Results therefore repeat.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date, datetime, time, timedelta, timezone
from functools import cache
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LOCAL_TZ = "Asia/Jakarta"


@dataclass(frozen=True)
class AsOf:
    """The instant a report is made for. A naive datetime is read as UTC."""

    instant: datetime
    tz: str = LOCAL_TZ

    def _utc(self) -> datetime:
        if self.instant.tzinfo is None:
            return self.instant.replace(tzinfo=timezone.utc)
        return self.instant.astimezone(timezone.utc)

    @property
    def utc_date(self) -> date:
        return self._utc().date()

    @property
    def local_date(self) -> date:
        return self._utc().astimezone(ZoneInfo(self.tz)).date()

    def days_back(self, days: int) -> date:
        """First date of a look-back of ``days`` days, counted from the UTC date."""
        return self.utc_date - timedelta(days=days)


@cache
def _constant_offset(tz: str) -> int | None:
    """Seconds ahead of UTC when the zone kept one offset in every month from 1970 to 2037, else None."""
    months = (datetime(year, month, 1, tzinfo=timezone.utc) for year in range(1970, 2038) for month in range(1, 13))
    offsets = {int(month.astimezone(ZoneInfo(tz)).utcoffset().total_seconds()) for month in months}
    return offsets.pop() if len(offsets) == 1 else None


def local_time(ts: Column, tz: str = LOCAL_TZ) -> Column:
    """Wall clock time in ``tz`` as TIMESTAMP_NTZ, whatever the input timestamp flavour.

    A zone with one offset since 1970 is plain interval arithmetic, which costs a small part of the
    zone look-up that ``convert_timezone`` does per row; zones that change their clocks use the latter.
    """
    offset = _constant_offset(tz)
    if offset is None:
        return F.convert_timezone(F.lit("UTC"), F.lit(tz), ts)
    return (ts + F.expr(f"INTERVAL '{offset}' SECOND")).cast("timestamp_ntz")


def local_date(ts: Column, tz: str = LOCAL_TZ) -> Column:
    return F.to_date(local_time(ts, tz))


def start_of_day_utc(day: date, tz: str | None) -> datetime:
    """Naive UTC instant at which ``day`` starts in ``tz`` (None: the column is already in its own calendar)."""
    midnight = datetime.combine(day, time())
    if tz is None:
        return midnight
    return midnight.replace(tzinfo=ZoneInfo(tz)).astimezone(timezone.utc).replace(tzinfo=None)


def instant_literal(moment: datetime, like: T.DataType) -> Column:
    """A literal of the same timestamp type as the column it is compared with.

    A literal of the other flavour would put a cast on the column and keep the comparison
    from being pushed to the Parquet reader.
    """
    text = moment.isoformat(sep=" ")
    if isinstance(like, T.TimestampNTZType):
        return F.lit(text).cast("timestamp_ntz")
    return F.lit(text + "Z").cast("timestamp")


UNITS = ("day", "month")


def unit_column(ts: str, unit: str) -> str:
    """Name of the partition column that holds the start of the UTC day or month of ``ts`` in a log laid out by it."""
    return f"{ts}_{unit}"


def _pruned(df: DataFrame, ts: str, bound: Column, last: date, lower: bool) -> Column:
    """``bound`` on ``ts``, and where ``df`` is laid out by day or month, the bound on that column which follows from it.
    ``last`` is the outermost UTC date that ``bound`` lets in."""
    for unit in UNITS:
        if unit_column(ts, unit) in df.columns:
            start = F.lit(last.replace(day=1) if unit == "month" else last)
            held = F.col(unit_column(ts, unit))
            bound = bound & (held >= start if lower else held <= start)
    return bound


def since(df: DataFrame, ts: str, day: date, tz: str | None = LOCAL_TZ) -> Column:
    """Predicate "date of ``ts`` in ``tz`` is on or after ``day``" as a bound on the raw column."""
    start = start_of_day_utc(day, tz)
    bound = F.col(ts) >= instant_literal(start, df.schema[ts].dataType)
    return _pruned(df, ts, bound, start.date(), lower=True)


def until(df: DataFrame, ts: str, day: date, tz: str | None = LOCAL_TZ) -> Column:
    """Predicate "date of ``ts`` in ``tz`` is on or before ``day``" as a bound on the raw column."""
    end = start_of_day_utc(day + timedelta(days=1), tz)
    bound = F.col(ts) < instant_literal(end, df.schema[ts].dataType)
    return _pruned(df, ts, bound, (end - timedelta(microseconds=1)).date(), lower=False)


def rolling_window(df: DataFrame, ts: str, days: int, as_of: AsOf, tz: str | None = LOCAL_TZ) -> DataFrame:
    """Rows whose local date lies in the last ``days`` days before the UTC date of ``as_of``."""
    return df.where(since(df, ts, as_of.days_back(days), tz))


def fixed_window(df: DataFrame, ts: str, start: date, end: date, tz: str | None = None) -> DataFrame:
    """Rows whose date in ``tz`` (None: the stored UTC date) lies between two dates, both included."""
    return df.where(since(df, ts, start, tz) & until(df, ts, end, tz))


def month_label(day: Column) -> Column:
    """'Mar 2024'."""
    return F.date_format(day, "MMM yyyy")


def sunday_week(day: Column) -> Column:
    """Week of the year, weeks start on Sunday, days before the first Sunday are week 0."""
    return F.floor((F.dayofyear(day) + 7 - F.dayofweek(day)) / 7).cast("bigint")


def day_start(ts: Column) -> Column:
    """The date of ``ts`` at 00:00:00."""
    return F.to_date(ts).cast("timestamp_ntz")


def joined_key(*cols: Column, sep: str = " - ") -> Column:
    """'a - b - c'; NULL as soon as one part is NULL."""
    parts = [cols[0]]
    for col in cols[1:]:
        parts += [F.lit(sep), col]
    return F.concat(*parts)


def parse_us_date(text: Column) -> Column:
    """MM/DD/YYYY text to a date; bad text raises under ANSI mode, like the source warehouse."""
    return F.to_date(text, "MM/dd/yyyy")
