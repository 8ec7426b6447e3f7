"""How a registered query and its DuckDB statement are declared."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.functions.timeops import AsOf
from registry.standins import Standins, ctes

# Late enough in the evening that the local calendar is a day ahead of UTC.
AS_OF = AsOf(datetime(2001, 8, 1, 20))
TODAY, UTC_TODAY = "DATE '2001-08-02'", "DATE '2001-08-01'"
# Look-backs that cover every row of the given tables, so no query is cheap by reading few of them; the longer one
# is for inputs that a report looks back at further. The short one is for the one report whose scans it looks back
# at less far than its parcels.
ALL_DAYS, LONG_DAYS, SHORT_DAYS = 2500, 2700, 1500

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def comparable(df: DataFrame) -> DataFrame:
    """Money as double and whole numbers as bigint, the types the DuckDB side ends in."""
    casts = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DecimalType):
            casts[field.name] = F.col(field.name).cast("double")
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType, T.ByteType)):
            casts[field.name] = F.col(field.name).cast("bigint")
    return df.withColumns(casts) if casts else df


def case(name: str, needs: Sequence[str], body: str) -> Callable:
    """Registers the decorated ``Standins -> DataFrame`` function and the DuckDB statement ``body``."""

    def register(build: Callable[[Standins], DataFrame]) -> Callable:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Standins.at(spark, sf_dir)))

        QUERIES[name] = run
        views = ctes(list(needs)) if needs else ""
        text = body.strip()
        if not views:
            ORACLES[name] = text
        elif text.startswith("WITH "):
            ORACLES[name] = f"WITH {views},\n{text[5:]}"
        else:
            ORACLES[name] = f"WITH {views}\n{text}"
        return build

    return register


def in_list(values: Sequence[str]) -> str:
    return "(" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + ")"


def local(ts: str) -> str:
    return f"({ts} + INTERVAL 7 HOUR)"


def local_day(ts: str) -> str:
    return f"CAST({ts} + INTERVAL 7 HOUR AS DATE)"


def day(ts: str) -> str:
    return f"CAST({ts} AS DATE)"


def back(ts: str, days: int = ALL_DAYS) -> str:
    """A look-back as DuckDB reads it: local date against the UTC date of the report."""
    return f"{local_day(ts)} >= {UTC_TODAY} - {days}"


def at_first(value: str, time: str, where: str = "TRUE") -> str:
    """Value at the oldest time, smallest non-NULL one at equal times."""
    return f"first({value} ORDER BY {time} ASC, {value} ASC NULLS LAST) FILTER ({where})"


def at_last(value: str, time: str, where: str = "TRUE") -> str:
    """Value at the newest time, largest non-NULL one at equal times."""
    return f"first({value} ORDER BY {time} DESC, {value} DESC NULLS LAST) FILTER ({where})"


def label(code: str, kind: str) -> str:
    return f"(SELECT max(o.option_name) FROM system_option o WHERE o.type_option = '{kind}' AND o.option_value = {code})"


def newest(table: str, key: str, order: str, where: str = "TRUE", cols: str = "*") -> str:
    return (
        f"SELECT {cols} FROM {table} WHERE {where} "
        f"QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY {order} DESC NULLS LAST) = 1"
    )


def money(*names: str, of: str = "") -> str:
    return ", ".join(f"CAST({of}{n} AS DOUBLE) AS {n}" for n in names)


def due(ts: str, days: str) -> str:
    return f"CAST({day(ts)} + CAST({days} AS INTEGER) AS DATE)"


def verdict(pod: str, due_sql: str, sla: str, missing: str, pending: str) -> str:
    """The promise verdict, worded as a table of cases over one comparison date."""
    reached = f"coalesce({local_day(pod)}, {TODAY})"
    return (
        f"CASE WHEN {sla} IS NULL THEN {missing} WHEN {sla} >= 999 THEN 'No SLA (OoC)' "
        f"WHEN {reached} > {due_sql} THEN 'Late' WHEN {pod} IS NULL THEN {pending} ELSE 'Not Late' END"
    )
