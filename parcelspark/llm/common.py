"""What the operators share: column hygiene, tables in the shared folder, connected components."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelspark.sources.states import shared_folder


def others(df: DataFrame, *added: str) -> list[str]:
    """Columns of ``df`` that an operator keeps: all but those whose names it adds itself, in any case of letters."""
    taken = {name.lower() for name in added}
    return [c for c in df.columns if c.lower() not in taken]


def free(df: DataFrame, name: str) -> str:
    """A name for a passing column that no column of ``df`` has."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def cols(names: Iterable[str]) -> list:
    return [F.col(quoted(name)) for name in names]


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table to the shared folder and read again, so that a lost executor costs no earlier stage.

    Unlike ``checkpoint()`` it evaluates ``df`` once and compresses what it writes.
    """
    path = new_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Deletes a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {name.rsplit("/", 1)[0] for name in df.inputFiles()}:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextlib.contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """What runs inside hands Python workers at most 4 MB of rows at once, where Spark's own limit is 64 MB: whole texts fill
    such a batch, and it is held by the executor's JVM and by the worker. A limit that the session sets itself stays."""
    if _BATCH_BYTES in spark.conf.getAll:
        yield
        return
    spark.conf.set(_BATCH_BYTES, "4m")
    try:
        yield
    finally:
        spark.conf.unset(_BATCH_BYTES)


_REMEMBERED: dict[str, dict] = {}


def remembered(operator: str) -> dict:
    """What tasks of ``operator`` keep for each other in this Python worker. Workers outlive their tasks and are handed to other
    operators, so what those kept is given up first: a worker holds the memory of one operator."""
    for name in [name for name in _REMEMBERED if name != operator]:
        _REMEMBERED.pop(name).clear()
        pa.default_memory_pool().release_unused()
    return _REMEMBERED.setdefault(operator, {})


# Keys above this share of all rows are listed; there are fewer of them than this number.
_SHARE = 10_000


def met(rows: DataFrame, side: DataFrame, keys: list[str], total: int) -> DataFrame:
    """``rows.join(side, keys)`` of two stored tables, where ``side`` has one row per key and holds in ``n`` how many of
    the ``total`` rows have it. Rows of keys above a ten-thousandth of all stay where they are and meet a broadcast of
    these keys, which are fewer than 10,000 at any size; so no task of the shuffled join gets many rows of one key.
    """
    hot = F.col("n") * F.lit(_SHARE) > F.lit(total)
    listed, usual = F.broadcast(side.where(hot)), side.where(~hot)
    plain = rows.join(F.broadcast(side.where(hot).select(*keys)), keys, "left_anti").join(usual, keys)
    return rows.join(listed, keys).unionByName(plain).drop("n")


def components(links: DataFrame) -> DataFrame:
    """(node, component): the smallest node that can be reached over ``links`` (a, b), for nodes that have a link.

    Large-star and small-star rounds (Kiveris et al., 2014): each node hands its neighbours to the smallest one.
    A round is two aggregations and two joins on the node; hubs are reduced on the map side, and the joins are
    plain ones that AQE can split. Rounds grow with the logarithm of a component's diameter.
    """
    edges = stored(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).where("a <> b").distinct(), "edges"
    )
    while True:
        # Stars are done: every node has one edge, and none that an edge leads to has an edge on.
        ends = edges.select("a", F.lit(1).alias("n")).union(edges.select("b", F.lit(0))).groupBy("a")
        open_ends = ends.agg(F.sum("n").alias("up"), F.min("n").alias("low")).where("up > 1 OR (up > 0 AND low = 0)")
        if open_ends.isEmpty():
            break
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        lowest = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.where("b > a").join(lowest, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        handed = large.join(small, "a")
        following = stored(
            handed.where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(small.select("a", F.col("m").alias("b")))
            .distinct(),
            "edges",
        )
        dropped(edges)
        edges = following
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )
