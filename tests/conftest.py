from __future__ import annotations

import os
import sys
from datetime import datetime, timezone

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from parcelspark.sources.schemas import schema  # noqa: E402
from parcelspark.sources.tables import recommended_conf  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    builder = SparkSession.builder.master("local[8]").appName("parcelspark-tests")
    for key, value in recommended_conf().items():
        builder = builder.config(key, value)
    session = (
        builder.config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def table(spark):
    """Builds an input table from partial rows; columns not named are NULL."""

    def build(name: str, *rows: dict):
        shape = schema(name)
        known = set(shape.names)
        for row in rows:
            assert set(row) <= known, set(row) - known
        return spark.createDataFrame([tuple(row.get(c) for c in shape.names) for row in rows], shape)

    return build


class Carrier(dict):
    """Table mapping for job tests: tables not given are empty."""

    def __init__(self, build, **tables):
        super().__init__({name: build(name, *rows) for name, rows in tables.items()})
        self.build = build

    def __missing__(self, name):
        self[name] = self.build(name)
        return self[name]


@pytest.fixture
def carrier(table):
    return lambda **tables: Carrier(table, **tables)


def utc(text: str) -> datetime:
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def wall(text: str) -> datetime:
    return datetime.fromisoformat(text)


def by(df, *keys):
    """Collected rows of a small result, keyed."""
    rows = df.collect()
    keyed = {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in rows}
    assert len(keyed) == len(rows), "duplicate keys"
    return keyed
