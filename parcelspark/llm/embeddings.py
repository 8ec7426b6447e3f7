"""Near-duplicate embeddings: tiles in PCA order, compared on leading dimensions first, with bounds that stop early."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import components, dropped, quoted, stored

_SLACK = 1e-9
# Leading coordinates that order the tiles, and dimensions that are added at a time when two tiles are compared.
_ORDER, _STEP = 4, 16


def _vectors(column: pa.Array) -> np.ndarray:
    """A list column of equal lengths as a matrix."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


def _basis(nodes: DataFrame) -> tuple[int, np.ndarray]:
    """The commonest dimension and its principal axes, as columns, largest first.

    The axes are those of the second moments of all unit vectors, summed over tasks as d * d numbers. They only
    decide the order of work, never a result; vectors of other dimensions are compared along their own axes.
    """
    most = nodes.groupBy("dim").count().orderBy(F.desc("count"), "dim").first()
    if most is None:
        return 0, np.zeros((0, 0))
    dim = most["dim"]

    def moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dim, dim))
        for batch in batches:
            if batch.num_rows:
                unit = _vectors(batch.column(0))
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                total += unit.T @ unit
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(dim * dim)), pa.array(total.ravel())], names=["at", "v"])

    summed = (
        nodes.where(F.col("dim") == dim)
        .select("vector")
        .mapInArrow(moments, "at long, v double")
        .groupBy("at")
        .agg(F.sum("v").alias("v"))
        .toArrow()
    )
    matrix = np.zeros(dim * dim)
    matrix[summed.column("at").to_numpy()] = summed.column("v").to_numpy()
    _, axes = np.linalg.eigh(matrix.reshape(dim, dim))
    return dim, np.ascontiguousarray(axes[:, ::-1])


def _tiles(nodes: DataFrame, basis: tuple[int, np.ndarray], size: int, threshold: float) -> DataFrame:
    """Tiles of up to ``size`` vectors of one label and dimension: (tile, label, dim, low, high, nids, counts,
    vectors), where low and high bound the leading coordinates of the unit vectors.

    Vectors are dealt and sorted by label and by the cell of their leading coordinates, so tiles are compact there;
    a hot label is spread over as many ranges as its rows need.
    """
    width = float(np.sqrt(2 - 2 * threshold))

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lead = np.zeros((batch.num_rows, _ORDER))
            dims = batch.column(2).to_numpy()
            for dim in np.unique(dims):
                rows = np.flatnonzero(dims == dim)
                unit = _vectors(batch.column(4).take(pa.array(rows)))
                unit /= np.linalg.norm(unit, axis=1)[:, None]
                unit = unit @ basis[1] if dim == basis[0] else unit
                lead[rows, : min(_ORDER, dim)] = unit[:, :_ORDER]
            cells = [pa.array(np.floor(lead[:, i] / width).astype(np.int32)) for i in range(_ORDER)]
            leads = pa.FixedSizeListArray.from_arrays(pa.array(lead.ravel()), _ORDER).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([*batch.columns, *cells, leads], names=names)

    cells = [f"c{i}" for i in range(_ORDER)]
    names = ["nid", "label", "dim", "n", "vector", *cells, "lead"]
    ordered = (
        nodes.select("nid", "label", "dim", "n", "vector")
        .mapInArrow(
            placed,
            "nid binary, label string, dim int, n long, vector array<double>, "
            + ", ".join(f"{c} int" for c in cells)
            + ", lead array<double>",
        )
    )
    ordered = stored(ordered, "placed")
    parts = max(1, -(-ordered.count() // (4 * size)))
    ordered = ordered.repartitionByRange(parts, "label", "dim", *cells, "nid").sortWithinPartitions("label", "dim", *cells, "nid")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[pa.RecordBatch] = []
        key, rows = None, 0

        def flush() -> pa.RecordBatch:
            table = pa.Table.from_batches(held).combine_chunks()
            lead = _vectors(table.column("lead").chunk(0))
            return pa.RecordBatch.from_arrays(
                [
                    pa.array([number]),
                    pa.array([key[0]]),
                    pa.array([key[1]], pa.int32()),
                    pa.array([lead.min(axis=0)], pa.list_(pa.float64())),
                    pa.array([lead.max(axis=0)], pa.list_(pa.float64())),
                    pa.array([table.column("nid").to_pylist()], pa.list_(pa.binary())),
                    pa.array([table.column("n").to_numpy()], pa.list_(pa.int64())),
                    pa.array([_vectors(table.column("vector").chunk(0)).tobytes()], pa.binary()),
                ],
                names=["tile", "label", "dim", "low", "high", "nids", "counts", "vectors"],
            )

        for batch in batches:
            keys = list(zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()))
            start = 0
            while start < len(keys):
                stop = start
                while stop < len(keys) and keys[stop] == keys[start] and stop - start < size:
                    stop += 1
                if held and (keys[start] != key or rows + stop - start > size):
                    yield flush()
                    number, held, rows = number + 1, [], 0
                key = keys[start]
                held.append(batch.slice(start, stop - start))
                rows, start = rows + stop - start, stop
        if held:
            yield flush()

    return ordered.mapInArrow(
        cut,
        "tile long, label string, dim int, low array<double>, high array<double>, nids array<binary>, "
        "counts array<long>, vectors binary",
    )


def close_pairs(a: np.ndarray, b: np.ndarray, axes: np.ndarray | None, threshold: float, same: bool):
    """(i, j) of the rows of ``a`` and ``b`` whose cosine in double precision reaches ``threshold``; i < j if ``same``.

    Unit vectors are turned to the principal axes. Products of the leading dimensions are accumulated a step at a
    time; by Cauchy-Schwarz the rest adds at most the product of the suffix norms, and pairs that cannot reach the
    threshold with it stop there. What is left is computed from the vectors as given.
    """
    norm_a, norm_b = np.linalg.norm(a, axis=1), np.linalg.norm(b, axis=1)
    turned = [x / n[:, None] for x, n in ((a, norm_a), (b, norm_b))]
    if axes is not None:
        turned = [x @ axes for x in turned]
    left, right = turned
    dim = left.shape[1]
    rest = [np.sqrt(np.maximum(np.cumsum((x**2)[:, ::-1], axis=1)[:, ::-1], 0)) for x in turned]
    upto = min(_STEP, dim)
    product = left[:, :upto] @ right[:, :upto].T
    if upto < dim:
        reach = product + rest[0][:, upto][:, None] * rest[1][:, upto]
    else:
        reach = product
    i, j = np.nonzero(reach >= threshold - _SLACK)
    if same:
        i, j = i[i < j], j[i < j]
    total = product[i, j]
    while upto < dim and len(i):
        following = min(upto + _STEP, dim)
        total = total + np.einsum("ij,ij->i", left[i, upto:following], right[j, upto:following])
        reach = total if following == dim else total + rest[0][i, following] * rest[1][j, following]
        alive = reach >= threshold - _SLACK
        i, j, total, upto = i[alive], j[alive], total[alive], following
    exact = np.einsum("ij,ij->i", a[i], b[j]) / (norm_a[i] * norm_b[j])
    return i[exact >= threshold], j[exact >= threshold]


def _roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """For each of n nodes the smallest one that links connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[i], root[j])
        following = root.copy()
        np.minimum.at(following, i, low)
        np.minimum.at(following, j, low)
        following = following[following]
        if (following == root).all():
            return root
        root = following


def _links(tiles: DataFrame, basis: tuple[int, np.ndarray], threshold: float) -> DataFrame:
    """(a, b, n): with null b the number of vectors that node a is linked with in a pair of tiles; else an edge of a
    star that connects the same nodes as the links do. A pair of tiles yields at most two rows per vector.

    Tiles of one label meet only where the boxes of their leading coordinates are close enough.
    """
    side = lambda s: tiles.select("label", "dim", *(F.col(c).alias(f"{c}_{s}") for c in ("tile", "low", "high")))
    apart = F.aggregate(
        F.sequence(F.lit(0), F.lit(_ORDER - 1)),
        F.lit(0.0),
        lambda total, i: total
        + F.pow(
            F.greatest(
                F.lit(0.0),
                F.get("low_a", i) - F.get("high_b", i),
                F.get("low_b", i) - F.get("high_a", i),
            ),
            F.lit(2.0),
        ),
    )
    pairs = (
        side("a").join(side("b"), ["label", "dim"])
        .where((F.col("tile_a") <= F.col("tile_b")) & (apart <= 2 - 2 * threshold + _SLACK))
        .select("tile_a", "tile_b", "dim")
    )
    load = lambda s: tiles.select(*(F.col(c).alias(f"{c}_{s}") for c in ("tile", "nids", "counts", "vectors")))
    both = pairs.join(load("a"), "tile_a").join(load("b"), "tile_b").select(
        "tile_a", "tile_b", "dim", "nids_a", "counts_a", "vectors_a", "nids_b", "counts_b", "vectors_b"
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                tile_a, tile_b, dim, nids_a, counts_a, raw_a, nids_b, counts_b, raw_b = (
                    column[r].as_py() for column in batch.columns
                )
                a = np.frombuffer(raw_a).reshape(-1, dim)
                b = np.frombuffer(raw_b).reshape(-1, dim)
                same = tile_a == tile_b
                i, j = close_pairs(a, b, basis[1] if dim == basis[0] else None, threshold, same)
                if not len(i):
                    continue
                nids, counts, at = nids_a, counts_a, j
                if not same:
                    nids, counts, at = nids_a + nids_b, counts_a + counts_b, j + len(nids_a)
                weight = np.array(counts)
                linked = np.bincount(i, weight[at], len(nids)) + np.bincount(at, weight[i], len(nids))
                some = np.flatnonzero(linked)
                root = _roots(len(nids), i, at)
                arms = np.flatnonzero(root != np.arange(len(nids)))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([nids[x] for x in some] + [nids[x] for x in arms], pa.binary()),
                        pa.array([None] * len(some) + [nids[root[x]] for x in arms], pa.binary()),
                        pa.array(linked[some].astype(np.int64).tolist() + [0] * len(arms), pa.int64()),
                    ],
                    names=["a", "b", "n"],
                )

    return both.mapInArrow(run, "a binary, b binary, n long")


def linked(
    df: DataFrame,
    threshold: float = 0.93,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    label: str = "label",
    tile: int = 512,
) -> DataFrame:
    """A row per row of ``df``: ``vec_id``, ``n_links`` (other rows whose cosine with it is at least ``threshold``),
    ``component_id`` (the smallest id that links reach) and ``kept`` (whether the row has it).

    Rows are compared only where labels are equal and not null and vectors are equally long. Vectors that are null,
    empty or zero, or hold null or non-finite components, link with nothing: no links, their own id, kept. Equal
    vectors are compared as one and counted as many, so copies cost nothing; links are counted and connected
    within a pair of tiles, and no pair of vectors is ever a row. A component of null ids alone has a null id and
    keeps its rows. Within a label work grows with the square of its distinct vectors, less what the bounds skip.
    """
    vector = F.col(quoted(embedding)).cast("array<double>")
    usable = (
        F.col(quoted(label)).isNotNull()
        & vector.isNotNull()
        & F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(vector, lambda x: x != 0)
    )
    identity = F.unhex(F.md5(F.struct(F.col(quoted(label)), vector).cast("string").cast("binary")))
    rows = df.select(
        F.col(quoted(vec_id)).alias("vec_id"),
        F.col(quoted(label)).cast("string").alias("label"),
        vector.alias("vector"),
        F.when(F.coalesce(usable, F.lit(False)), identity).alias("nid"),
    )
    nodes = stored(
        rows.where("nid IS NOT NULL")
        .groupBy("nid")
        .agg(
            F.first("label").alias("label"),
            F.first("vector").alias("vector"),
            F.min("vec_id").alias("id"),
            F.count("*").alias("n"),
        )
        .withColumn("dim", F.size("vector")),
        "vectors",
    )
    basis = _basis(nodes)
    tiles = stored(_tiles(nodes, basis, tile, threshold), "tiles")
    links = stored(_links(tiles, basis, threshold), "links")
    dropped(tiles)
    counts = links.where("b IS NULL").groupBy(F.col("a").alias("nid")).agg(F.sum("n").alias("others"))
    connected = components(links.where("b IS NOT NULL").select("a", "b")).select(F.col("node").alias("nid"), "component")
    known = (
        nodes.select("nid", "id", "n")
        .join(counts, "nid", "left")
        .join(connected, "nid", "left")
        .withColumn("component", F.coalesce("component", "nid"))
    )
    smallest = known.groupBy("component").agg(F.min("id").alias("component_id"))
    facts = known.join(smallest, "component").select(
        F.col("nid").alias("k"), (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("links"), "component_id"
    )
    found = F.col("k").isNotNull()
    return rows.select("vec_id", "nid").join(facts, F.col("nid") == F.col("k"), "left").select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("long").alias("n_links"),
        F.when(found, F.col("component_id")).otherwise(F.col("vec_id")).alias("component_id"),
        F.when(found, F.col("vec_id").eqNullSafe(F.col("component_id"))).otherwise(F.lit(True)).alias("kept"),
    )
