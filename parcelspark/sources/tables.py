"""Readers and writers around the reports. A report takes any mapping of table name to DataFrame."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from parcelspark.sources.schemas import DDL, schema

Tables = Mapping[str, DataFrame]


def require_utc(spark: SparkSession) -> None:
    """Refuses a session whose time zone is not UTC: ``timestamp`` columns would show shifted local times."""
    zone = spark.conf.get("spark.sql.session.timeZone")
    if zone not in ("UTC", "Etc/UTC", "Z", "+00:00"):
        raise ValueError(f"spark.sql.session.timeZone is {zone}; the reports need UTC (see recommended_conf)")


def parquet_tables(spark: SparkSession, root: str, names: Iterable[str] = tuple(DDL)) -> dict[str, DataFrame]:
    """One Parquet folder or file per table under ``root``."""
    require_utc(spark)
    return {name: spark.read.parquet(f"{root}/{name}.parquet") for name in names}


def catalog_tables(spark: SparkSession, namespace: str, names: Iterable[str] = tuple(DDL)) -> dict[str, DataFrame]:
    """Tables of a catalog namespace."""
    require_utc(spark)
    return {name: spark.table(f"{namespace}.{name}") for name in names}


def read_sheet(spark: SparkSession, path: str, name: str = "smu_template_2") -> DataFrame:
    """A hand-kept sheet exported as CSV with a header line; the schema is given, never inferred.

    A bad number or a line with too few fields stops the read instead of becoming NULLs in the report.
    """
    reader = spark.read.schema(schema(name)).option("header", True).option("enforceSchema", False)
    return reader.option("mode", "FAILFAST").csv(path)


def write_report(df: DataFrame, path: str, partition_by: Iterable[str] = ()) -> None:
    """Replaces a report or stage table."""
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(path)


def recommended_conf() -> dict[str, str]:
    """Session settings the jobs are planned for. Set them when the session is built."""
    return {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Split a skewed side even where that costs the next operator its partitioning.
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
        # Lane, tariff and user masters of tens of MB still beat a shuffle of all parcels; larger ones are joined by shuffle.
        "spark.sql.autoBroadcastJoinThreshold": "64MB",
    }
