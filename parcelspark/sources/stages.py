"""Stage tables that later jobs join on the same keys: bucketed once, so that none of these jobs shuffles them again."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Callable, Iterator, Mapping, Sequence
from contextlib import contextmanager
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelspark.operators import skew

BUCKET_ROWS = 1_000_000
_RELEASES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@dataclass(frozen=True)
class Stage:
    """A written stage: ``usual`` rows bucketed by ``keys``, and ``hot`` rows of the keys in ``hot_keys`` (``_hot_key``),
    which would overfill a bucket and lie in many files instead. A key's rows are all in one of the two."""

    keys: tuple[str, ...]
    usual: DataFrame
    hot: DataFrame
    hot_keys: DataFrame

    def rows(self) -> DataFrame:
        return self.usual.unionByName(self.hot)

    def mapped(self, change: Callable[[DataFrame], DataFrame]) -> Stage:
        """The stage with both parts changed by a function that keeps the key columns, such as a projection or a filter."""
        return replace(self, usual=change(self.usual), hot=change(self.hot))


def _deleted(spark: SparkSession, folder: str) -> None:
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _releasing(spark: SparkSession) -> Iterator[None]:
    """What ends in here gives up its shuffle files. Otherwise they stay until the driver collects garbage, so those of
    every step lie on the disks at once."""
    before = spark.conf.get(_RELEASES, None)
    spark.conf.set(_RELEASES, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_RELEASES)
        else:
            spark.conf.set(_RELEASES, before)


def _opened(
    spark: SparkSession, path: str, shape: T.StructType, keys: Sequence[str], buckets: int, order: Sequence[str] = ()
) -> DataFrame:
    """The bucketed folder as a table of this session's catalog, which is where Spark keeps buckets."""
    name = "stage_" + hashlib.md5(path.encode()).hexdigest()
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in shape)
    by = ", ".join(f"`{key}`" for key in keys)
    ordered = f"SORTED BY ({', '.join(f'`{name}`' for name in order)}) " if order else ""
    place = path.replace("'", "\\'")
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (compression 'zstd') CLUSTERED BY ({by}) "
        f"{ordered}INTO {buckets} BUCKETS LOCATION '{place}'"
    )
    return spark.table(name)


def write_stage(
    df: DataFrame,
    path: str,
    keys: Sequence[str],
    buckets: int,
    hot_rows: int = skew.HOT_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    order: Sequence[str] = (),
) -> Stage:
    """Writes ``df`` under ``path`` bucketed by ``keys`` and opens it.

    ``df`` is evaluated once, into plain rows that are removed again: the sketch of heavy keys reads their key columns,
    then keys of more than ``hot_rows`` rows (NULL among them) are written aside in as many files as they came in, and
    the rest in one file per bucket. There are ``buckets`` of them, and more where they would get over ``bucket_rows`` rows
    each on average, so that what a task sorts and reads does not grow with the stage. A bucket's rows lie by ``order``,
    which packs them and what is shuffled of them later. A step's shuffle files go when it ends. A stage is written once; a
    new run takes a new folder, and a run that was lost midway leaves one that ``read_stage`` refuses.
    """
    with _releasing(df.sparkSession):
        _write_stage(df, path, keys, buckets, hot_rows, bucket_rows, order)
    return read_stage(df.sparkSession, path)


def _write_stage(
    df: DataFrame, path: str, keys: Sequence[str], buckets: int, hot_rows: int, bucket_rows: int, order: Sequence[str]
) -> None:
    spark = df.sparkSession
    df.write.option("compression", "zstd").parquet(f"{path}/rows")
    rows = spark.read.schema(df.schema).parquet(f"{path}/rows")
    buckets = max(buckets, -(-rows.count() // bucket_rows))
    skew.heavy_keys(rows, *keys, hot_rows=hot_rows, nulls=True).write.parquet(f"{path}/hot_keys")
    usual, hot = skew.parted(rows, spark.read.schema("_hot_key string").parquet(f"{path}/hot_keys"), *keys)
    hot.write.option("compression", "zstd").parquet(f"{path}/hot")
    _opened(spark, f"{path}/usual", df.schema, keys, buckets, order)
    usual.repartition(buckets, *keys).write.insertInto("stage_" + hashlib.md5(f"{path}/usual".encode()).hexdigest())
    layout = json.dumps({"keys": list(keys), "buckets": buckets, "order": list(order), "schema": df.schema.jsonValue()})
    spark.range(1).select(F.lit(layout).alias("value")).coalesce(1).write.text(f"{path}/layout")
    _deleted(spark, f"{path}/rows")


def read_stage(spark: SparkSession, path: str) -> Stage:
    """The stage under ``path``, in this or another session. A folder without a finished stage is refused."""
    layout = json.loads(spark.read.text(f"{path}/layout").first()["value"])
    shape = T.StructType.fromJson(layout["schema"])
    return Stage(
        tuple(layout["keys"]),
        _opened(spark, f"{path}/usual", shape, layout["keys"], layout["buckets"], layout.get("order", ())),
        spark.read.schema(shape).parquet(f"{path}/hot"),
        spark.read.schema("_hot_key string").parquet(f"{path}/hot_keys"),
    )


def left_join(
    left: DataFrame, stage: Stage, on: Mapping[str, str], reduced: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """``left.join(rows of the stage, on, "left")``, or of ``reduced`` rows: an aggregate by the stage's keys and others
    that these determine or refine.

    Only ``left`` is shuffled, into the stage's buckets; usual rows are neither shuffled for the join nor for the
    aggregate. Rows of listed keys are reduced on the map side, or joined with salts. ``on`` maps left names to the
    stage's keys, all of them. NULL keys match nothing.
    """
    if set(on.values()) != set(stage.keys):
        raise ValueError(f"the stage is bucketed by {stage.keys}, not by {tuple(on.values())}")
    by_key = {theirs: ours for ours, theirs in on.items()}
    usual_left, hot_left = skew.parted(left, stage.hot_keys, *(by_key[key] for key in stage.keys))
    condition = [F.col(ours) == F.col(theirs) for ours, theirs in on.items()]
    if reduced is None:
        usual = usual_left.join(stage.usual, condition, "left")
        in_order = {by_key[key]: key for key in stage.keys}
        hot = skew.left_join(hot_left, stage.hot, in_order, hot=stage.hot_keys)
    else:
        usual = usual_left.join(reduced(stage.usual), condition, "left")
        hot = hot_left.join(reduced(stage.hot), condition, "left")
    return usual.unionByName(hot)
