"""Hard negatives by Four-Russians scoring: subset sums of each anchor, indexed with bit planes of the candidates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm.common import dropped, quoted, stored

_GROUP = 8
# Anchors and candidates that a step of the scoring takes; both bound its memory, none the work.
_ANCHORS, _CANDIDATES = 64, 1024


def planes(values: np.ndarray, bits: int) -> np.ndarray:
    """Bit planes of whole numbers in two's complement, (bits, groups of eight dimensions, rows) as bytes. Rows are
    padded with zeros to whole groups; bit i of a byte is the group's dimension i."""
    rows, dim = values.shape
    padded = np.zeros((rows, -(-dim // _GROUP) * _GROUP), np.int64)
    padded[:, :dim] = values
    packed = [np.packbits((padded >> p & 1).astype(np.uint8), axis=1, bitorder="little") for p in range(bits)]
    return np.ascontiguousarray(np.stack([p.T for p in packed]))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): for every byte the sum of the anchor's dimensions whose bits are set, built by adding
    one dimension to all sums without it."""
    rows, dim = anchors.shape
    padded = np.zeros((rows, -(-dim // _GROUP) * _GROUP), anchors.dtype)
    padded[:, :dim] = anchors
    table = np.zeros((padded.shape[1] // _GROUP, 1 << _GROUP, rows), anchors.dtype)
    for i in range(_GROUP):
        table[:, 1 << i : 2 << i] = table[:, : 1 << i] + padded.T[i::_GROUP][:, None, :]
    return table


def scores(table: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """(candidates, anchors): exact inner products. Planes are added from the sign's down, doubling in between."""
    bits, groups, rows = codes.shape
    groups = min(groups, len(table))
    total = np.zeros((rows, table.shape[2]), table.dtype)
    for p in range(bits - 1, -1, -1):
        if p < bits - 1:
            total <<= 1
        for g in range(groups):
            part = table[g].take(codes[p, g], axis=0)
            if p == bits - 1:
                total -= part
            else:
                total += part
    return total


def whole_components(embedding: Column, scale: int) -> Column:
    """floor(scale * x) of every component, in double precision."""
    return F.transform(embedding.cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x))


def _usable(df: DataFrame, vec_id: str, embedding: str, label: Column, scale: int) -> DataFrame:
    """(id, label, vector) of the rows that take part, one per id."""
    vector = F.col(quoted(embedding)).cast("array<double>")
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return (
        df.select(
            F.col(quoted(vec_id)).cast("long").alias("id"),
            label.cast("string").alias("label"),
            F.when(finite, whole_components(vector, scale)).alias("vector"),
        )
        .where("id IS NOT NULL AND label IS NOT NULL AND vector IS NOT NULL")
        .groupBy("id")
        .agg(F.min(F.struct("label", "vector")).alias("row"))
        .select("id", "row.label", "row.vector")
    )


def _block_row(ids, labels, data: np.ndarray) -> list:
    return [pa.array([ids], pa.list_(pa.int64())), pa.array([labels], pa.list_(pa.string())), pa.array([data.tobytes()], pa.binary())]


def _blocks(rows: DataFrame, parts: int, dim: int, bits: int | None, spread: str) -> DataFrame:
    """(block, ids, labels, data): rows dealt evenly by id to ``parts`` blocks, sorted by label and id. ``data`` holds
    the bit planes where ``bits`` is given, else the numbers themselves."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.sort_by([("label", "ascending"), ("id", "ascending")])
        values = np.zeros((table.num_rows, dim), np.int64)
        for row, vector in enumerate(table.column("vector").to_pylist()):
            values[row, : len(vector)] = vector
        data = values if bits is None else planes(values, bits)
        own = _block_row(table.column("id").to_pylist(), table.column("label").to_pylist(), data)
        return pa.Table.from_arrays([table.column("block").combine_chunks()[:1], *own], names=["block", "ids", "labels", "data"])

    block = F.pmod(F.xxhash64("id", F.lit(spread)), F.lit(parts)).cast("int")
    return (
        rows.withColumn("block", block)
        .groupBy("block")
        .applyInArrow(pack, "block int, ids array<long>, labels array<string>, data binary")
    )


def _best(anchor: np.ndarray, score: np.ndarray, ids: np.ndarray, n: int) -> np.ndarray:
    """Places of the first ``n`` of each anchor, by score and then by smaller id."""
    order = np.lexsort((ids, -score, anchor))
    own = anchor[order]
    rank = np.arange(len(own)) - np.searchsorted(own, own)
    return order[rank < n]


class _Cell:
    """Candidates of one block and what is done with anchors that stream past."""

    def __init__(self, ids, labels, data: bytes, bits: int):
        self.ids, self.labels = np.array(ids, np.int64), np.array(labels, object)
        self.codes = np.frombuffer(data, np.uint8).reshape(bits, -1, len(ids))

    def of_label(self, label: str) -> slice:
        return slice(*(int(np.searchsorted(self.labels, label, side)) for side in ("left", "right")))


def _nearest(cell: _Cell, ids: np.ndarray, labels: np.ndarray, values: np.ndarray, n: int):
    """(anchor, candidate id, score): the block's first ``n`` of each anchor's own label, itself apart."""
    found = []
    for label in dict.fromkeys(labels.tolist()):
        own, there = np.flatnonzero(labels == label), cell.of_label(label)
        for start in range(0, len(own), _ANCHORS):
            part = own[start : start + _ANCHORS]
            table = subset_sums(values[part])
            for low in range(there.start, there.stop, _CANDIDATES):
                near = slice(low, min(low + _CANDIDATES, there.stop))
                score = scores(table, cell.codes[:, :, near]).T
                i, j = np.nonzero(ids[part][:, None] != cell.ids[near])
                best = _best(i, score[i, j], cell.ids[near][j], n)
                found.append((ids[part][i[best]], cell.ids[near][j[best]], score[i[best], j[best]].astype(np.int64)))
    return found


def _between(cell: _Cell, ids, labels, values, reach: list[list], n: int, low: int, high: int):
    """(anchor, positive, candidate id, score): for each anchor and positive the block's first ``n`` candidates of
    another label whose score lies between ``low`` and ``high`` percent of the positive's."""
    most = max(map(len, reach), default=0)
    pos = np.full((len(ids), most), -1, np.int64)
    # No score lies between 1 and 0, so a missing positive or a negative one finds nothing.
    floor, roof = np.ones((len(ids), most), np.int64), np.zeros((len(ids), most), np.int64)
    for row, positives in enumerate(reach):
        for k, (positive, score) in enumerate(positives):
            pos[row, k], floor[row, k], roof[row, k] = positive, -(-low * score // 100), high * score // 100
    found = []
    _, codes = np.unique(np.concatenate([cell.labels, labels]).astype(str), return_inverse=True)
    there, own = codes[: len(cell.ids)], codes[len(cell.ids) :]
    for start in range(0, len(ids), _ANCHORS):
        part = slice(start, min(start + _ANCHORS, len(ids)))
        table, least = subset_sums(values[part]), floor[part].copy()
        kept = [[np.zeros(0, np.int64)] * 3 for _ in range(most)]
        for at in range(0, len(cell.ids), _CANDIDATES):
            near = slice(at, at + _CANDIDATES)
            score = scores(table, cell.codes[:, :, near])
            other = there[near][:, None] != own[part]
            for k in range(most):
                j, i = np.nonzero((score >= least[:, k]) & (score <= roof[part, k]) & other)
                if not len(i):
                    continue
                held = [np.concatenate(x) for x in zip(kept[k], (i, score[j, i].astype(np.int64), cell.ids[near][j]))]
                best = _best(*held, n)
                kept[k] = held = [x[best] for x in held]
                count = np.bincount(held[0], minlength=len(least))
                last = np.flatnonzero(np.diff(held[0], append=-1))
                full = last[count[held[0][last]] == n]
                least[held[0][full], k] = held[1][full]  # an equal score may still win by its id
        for k in range(most):
            i, score, candidate = kept[k]
            found.append((ids[part][i], pos[part, k][i], candidate, score))
    return found


def _streamed(anchors: DataFrame, candidates: DataFrame, parts: int, spans: int, bits: int, run, shape: str) -> DataFrame:
    """``run`` over every block of candidates and every block of anchors. A task keeps one block of candidates while
    the anchors of a span of blocks stream past it; anchors go to every block of candidates, these to every span."""
    column = [F.col(c) for c in ("ids", "labels", "data")]
    extra = F.col("reach") if "reach" in anchors.columns else F.lit(None).cast("array<array<array<long>>>")
    one = candidates.select(
        F.explode(F.sequence(F.lit(0), F.lit(spans - 1))).alias("span"), F.col("block").alias("cell"), F.lit(0).alias("side"),
        *column, F.lit(None).cast("array<array<array<long>>>").alias("reach"),
    )
    other = anchors.select(
        (F.col("block") % spans).alias("span"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("cell"),
        F.lit(1).alias("side"), *column, extra.alias("reach"),
    )
    dealt = (
        one.union(other)
        .repartitionById(parts * spans, (F.col("cell") * spans + F.col("span")).cast("int"))
        .sortWithinPartitions("side")
    )

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell = None
        for batch in batches:
            for r in range(batch.num_rows):
                _, _, side, ids, labels, data, reach = (c[r].as_py() for c in batch.columns)
                if side == 0:
                    cell = _Cell(ids, labels, data, bits)
                elif cell is not None:
                    yield from run(cell, np.array(ids, np.int64), np.array(labels, object), data, reach)

    return dealt.mapInArrow(stream, shape)


def _first(rows: DataFrame, keys: list[str], n: int) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc("score"), "candidate")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


def mined(
    df: DataFrame,
    anchor: Column,
    label: Column,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    block: int = 4096,
    anchor_block: int = 512,
    span: int = 64,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    ``anchor`` is a condition on the column ``id``, the row's id, ``label`` its class. Components become floor(scale *
    x); a score is the whole-number inner product. An anchor's positives are its first rows of the same label, for
    each of which the first rows of other labels follow whose score is ``low`` to ``high`` percent of the positive's.
    Higher scores come first, then smaller ids.

    Scoring is exact and complete, every anchor against every row: per group of eight dimensions an anchor's 256
    subset sums are looked up with the bytes of the candidates' bit planes, and planes are added by doubling. Rows of
    the same label are scored in a first pass, all others in a second, when the positives' scores are known. Blocks
    are dealt by id, so a hot label is spread like any other; tasks hold one block of ``block`` candidates, and
    ``span`` blocks of anchors stream past it.

    Rows with a null id, label or vector, or a null or non-finite component take no part, nor does an id's second
    row (the smallest label, then vector, counts). Shorter vectors are filled up with zeros. Numbers whose products
    may leave 63 bits are refused. Without anchors or rows the result is empty. Other columns are ignored.
    """
    spark = df.sparkSession
    rows = stored(_usable(df, vec_id, embedding, label, scale), "usable")
    about = rows.select(
        "id", F.size("vector").alias("dim"), F.array_min("vector").alias("least"), F.array_max("vector").alias("most"), anchor.alias("anchor")
    ).agg(
        F.count("*").alias("rows"), F.count_if("anchor").alias("anchors"), F.max("dim").alias("dim"),
        F.min("least").alias("least"), F.max("most").alias("most"),
    ).first()
    shape = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if not about["anchors"]:
        return spark.createDataFrame([], shape)
    dim, most = max(about["dim"], 1), max(abs(about["least"] or 0), abs(about["most"] or 0), 1)
    if 100 * dim * most * most >= 1 << 62:
        raise ValueError(f"components up to {most} of {dim} dimensions: scores may leave 63 bits")
    bits = max((about["most"] or 0).bit_length(), (-1 - min(about["least"] or 0, -1)).bit_length()) + 1
    kind = np.int32 if dim * most << bits < 1 << 31 else np.int64
    parts, anchor_parts = -(-about["rows"] // block), -(-about["anchors"] // anchor_block)
    spans = -(-anchor_parts // span)
    candidates = stored(_blocks(rows, parts, dim, bits, "candidates"), "candidates")
    asked = stored(_blocks(rows.where(anchor), anchor_parts, dim, None, "anchors"), "anchors")

    def numbers(data: bytes, n: int) -> np.ndarray:
        return np.frombuffer(data, np.int64).reshape(n, -1).astype(kind)

    def near(cell, ids, labels, data, _):
        for columns in _nearest(cell, ids, labels, numbers(data, len(ids)), positives):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "candidate", "score"])

    def far(cell, ids, labels, data, reach):
        for columns in _between(cell, ids, labels, numbers(data, len(ids)), reach, negatives, low, high):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "positive", "candidate", "score"])

    same = _streamed(asked, candidates, parts, spans, bits, near, "anchor long, candidate long, score long")
    chosen = stored(_first(same, ["anchor"], positives), "positives")
    reach = chosen.groupBy("anchor").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", "candidate", "score"))), lambda c: F.array(c["candidate"], c["score"])).alias("own")
    )
    none = F.array().cast("array<array<long>>")
    reaching = (
        asked.select("block", F.posexplode("ids").alias("at", "anchor"))
        .join(reach, "anchor", "left")
        .groupBy("block")
        .agg(F.transform(F.sort_array(F.collect_list(F.struct("at", F.coalesce("own", none).alias("own")))), lambda x: x["own"]).alias("reach"))
    )
    different = _streamed(
        asked.join(reaching, "block"), candidates, parts, spans, bits, far, "anchor long, positive long, candidate long, score long"
    )
    found = stored(_first(different, ["anchor", "positive"], negatives), "negatives")
    for table in (rows, candidates, asked):
        dropped(table)
    scored = chosen.select("anchor", F.col("candidate").alias("positive"), F.col("score").alias("positive_score"))
    return found.join(scored, ["anchor", "positive"]).select(
        F.col("anchor").alias("anchor_id"),
        F.col("positive").alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        F.col("candidate").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )
