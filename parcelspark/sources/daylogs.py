"""Scan and problem logs laid out by UTC day or month, so that a look-back opens the files of its own days only."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.functions.timeops import unit_column
from parcelspark.sources.tables import Tables, require_utc


def write_log(df: DataFrame, path: str, ts: str, unit: str = "day", mode: str = "error") -> None:
    """Writes a log, or with ``mode`` "append" a batch of it, in a folder per UTC day (or ``unit`` "month", for logs of
    years with few rows a day) of ``ts``.

    Rows are gathered by folder first and AQE splits large folders over many tasks, so a day has few files and a hot day
    has no single writer. Files are zstd. Late rows go to the folder of their own day. Rows without a time lie in a folder
    of their own, which no look-back opens. A batch is seen whole or not at all; appending it again adds its rows again.
    """
    require_utc(df.sparkSession)
    held = unit_column(ts, unit)
    laid = df.withColumn(held, F.trunc(F.to_date(ts), "MM") if unit == "month" else F.to_date(ts))
    gathered = laid.hint("rebalance", F.col(held))
    gathered.write.mode(mode).option("compression", "zstd").partitionBy(held).parquet(path)


def read_log(spark: SparkSession, path: str, ts: str, unit: str = "day", shape: T.StructType | None = None) -> DataFrame:
    """The log with its partition column. ``since``, ``until`` and the windows made of them turn their bound on ``ts``
    into one on the folders. With ``shape``, the schema of the log without that column, no file footer is read."""
    require_utc(spark)
    held = unit_column(ts, unit)
    if shape is None:
        shape = spark.read.parquet(path).schema
    fields = [field for field in shape.fields if field.name != held]
    return spark.read.schema(T.StructType([*fields, T.StructField(held, T.DateType())])).parquet(path)


def with_logs(tables: Tables, root: str, logs: Mapping[str, str], unit: str = "day") -> dict[str, DataFrame]:
    """``tables`` for a report that reads those of ``logs`` (table name to its time) from the folders that ``write_log``
    made under ``root``."""
    opened = {
        name: read_log(tables[name].sparkSession, f"{root}/{name}", ts, unit, tables[name].schema) for name, ts in logs.items()
    }
    return _Overlaid(tables, opened)


class _Overlaid(dict):
    """Tables of one mapping over those of another, which may make its tables when asked."""

    def __init__(self, below: Tables, above: Mapping[str, DataFrame]):
        super().__init__(above)
        self.below = below

    def __missing__(self, name: str) -> DataFrame:
        return self.below[name]
