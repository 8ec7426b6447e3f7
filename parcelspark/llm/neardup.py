"""Near-duplicate texts: improved consistent weighted sampling over TF-IDF shingles, banded, verified exactly."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import words
from parcelspark.llm.common import cols, components, dropped, free, quoted, remembered, small_batches, stored

_TABLE_BITS = 16
_BLOCK_SHINGLES = 2_000_000
# Rounds in which texts meet some drawn from the class that most holders of a shingle are in, and how many of these.
_LEAD_ROUNDS, _LEADS = 2, 32
# So many shingles before its own one does a row of a prefix know; what two texts share further back is made distinct later.
_BEFORE = 32


@dataclass(frozen=True)
class Settings:
    """``bands`` of ``rows`` samples: two texts of weighted similarity s meet with 1 - (1 - s**rows)**bands, which is
    0.99995 at 0.8. ``common`` is the share of documents from which on a shingle counts as common: the inverse
    document frequency of rarer ones is that of this share, so that the table of common shingles is bounded."""

    shingle: int = 5
    similarity: float = 0.8
    bands: int = 14
    rows: int = 3
    common: float = 0.01
    seed: int = 20


def shingles(text: str | bytes, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes of a text, sorted, and how often each occurs. A text of fewer words is one shingle."""
    own = words.spelled(text)
    if not len(own):
        return own, np.zeros(0)
    return np.unique(words.Runs(own).each(min(size, len(own))), return_counts=True)


class Weights:
    """TF-IDF weights: occurrences times 1 + ln(N / df) / ln(1 / common), with df at least ``common`` * N. So a weight
    is one to two times the number of occurrences, and a passage in every document counts half of a rare one."""

    def __init__(self, n: int, shingle: np.ndarray, df: np.ndarray, common: float):
        share = np.maximum(df / max(n, 1), common)
        self.known = Known(shingle)
        self.idf = 1 + np.log(1 / share) / np.log(1 / common)

    def of(self, shingle: np.ndarray, count: np.ndarray) -> np.ndarray:
        weight = np.full(len(shingle), Sampler.USUAL)
        place, at = self.known.find(shingle)
        weight[place] = self.idf[at]
        return weight * count


def similarity(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Weighted Jaccard similarity of two (sorted shingles, weights)."""
    _, i, j = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    both = np.minimum(a[1][i], b[1][j]).sum()
    either = a[1].sum() + b[1].sum() - both
    return float(both / either) if either else 0.0


class Sampler:
    """Improved consistent weighted sampling (Ioffe, 2010). Each sample picks the shingle with the least
    c / (y * exp(r)), y = exp(r * (t - beta)), t = floor(ln w / r + beta), where r and c are Gamma(2, 1) and beta is
    uniform, all fixed per shingle and sample; the sample is the pair (shingle, t). Two texts agree in a sample with
    their weighted Jaccard similarity. The variables come from tables that a hash of the shingle indexes; for the
    weight that most shingles have, that of a rare one that occurs once, the whole value is tabled."""

    USUAL = 2.0

    def __init__(self, samples: int, seed: int):
        draw = np.random.default_rng(seed)
        size = 1 << _TABLE_BITS
        self.r = draw.gamma(2.0, 1.0, size)
        self.by_r = 1 / self.r
        self.beta = draw.random(size)
        self.least = np.log(draw.gamma(2.0, 1.0, size)) - self.r
        self.odd = draw.integers(0, 1 << 63, samples, np.uint64) * np.uint64(2) + np.uint64(1)
        self.usual = self._value(np.arange(size), np.log(self.USUAL))

    def _steps(self, at: np.ndarray, log: np.ndarray | float) -> np.ndarray:
        return np.floor(log * self.by_r[at] + self.beta[at])

    def _value(self, at: np.ndarray, log: np.ndarray | float) -> np.ndarray:
        return (self.least[at] - self.r[at] * (self._steps(at, log) - self.beta[at])).astype(np.float32)

    def of(self, shingle: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """A hash of each sample of a text with at least one shingle."""
        log = np.log(weight)
        sample = np.arange(len(self.odd))
        best_value = np.full(len(self.odd), np.inf, np.float32)
        best = np.zeros(len(self.odd), np.int64)
        for start in range(0, len(shingle), 4096):
            part = slice(start, start + 4096)
            place = self.odd[:, None] * shingle[part]
            place >>= np.uint64(64 - _TABLE_BITS)
            at = place.view(np.int64)
            value = self.usual.take(at, mode="clip")
            other = np.flatnonzero(weight[part] != self.USUAL)
            if len(other):
                value[:, other] = self._value(at[:, other], log[part][other])
            low = value.argmin(axis=1)
            value = value[sample, low]
            better = value < best_value
            best[better], best_value[better] = low[better] + start, value[better]
        at = ((self.odd * shingle[best]) >> np.uint64(64 - _TABLE_BITS)).view(np.int64)
        steps = self._steps(at, log[best]).astype(np.int64).view(np.uint64)
        return words.mixed(shingle[best] + steps * np.uint64(0x9E3779B97F4A7C15))


class Known:
    """Which of many shingles are in a sorted list: a bit table sorts out most of those that are not."""

    _BITS = 20

    def __init__(self, shingle: np.ndarray):
        self.shingle = shingle
        self.table = np.zeros(1 << self._BITS, bool)
        self.table[shingle >> np.uint64(64 - self._BITS)] = True

    def find(self, shingle: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in ``shingle`` of those listed, and their places in the list."""
        likely = np.flatnonzero(self.table[(shingle >> np.uint64(64 - self._BITS)).view(np.int64)])
        if not len(likely):
            return likely, likely
        at = np.searchsorted(self.shingle, shingle[likely])
        at[at == len(self.shingle)] = 0
        same = self.shingle[at] == shingle[likely]
        return likely[same], at[same]


def _rows(df: DataFrame, doc_id: str, text: str) -> DataFrame:
    """(doc, tid, text) of the rows with text; ``tid`` is the MD5 of the text, which stands for the text."""
    return df.select(
        F.col(quoted(doc_id)).cast("long").alias("doc"),
        F.unhex(F.md5(F.col(quoted(text)).cast("binary"))).alias("tid"),
        F.col(quoted(text)).alias("text"),
    ).where("text IS NOT NULL")


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(documents, shingles of each of them) of up to two million shingles, or those of one longer text. All blocks lie in
    one buffer: a block may be changed, and is gone with the next one."""
    remembered("neardup")
    held = np.empty(_BLOCK_SHINGLES, np.uint64)
    docs, count = 0, 0
    for batch in batches:
        for text in words.each(batch.column(0)):
            own, _ = shingles(text, size)
            if docs and count + len(own) > len(held):
                yield docs, held[:count]
                docs, count = 0, 0
            if len(own) > len(held):
                yield 1, own
                continue
            held[count : count + len(own)] = own
            docs, count = docs + 1, count + len(own)
    if docs:
        yield docs, held[:count]


def _frequent(held: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray]:
    """The values that are in ``held`` at least ``least`` times, sorted, and how often. Sorts ``held`` in place, so that no
    copy of it is made unless most values are frequent."""
    held.sort()
    apart = max(int(np.ceil(least)), 1) - 1
    first = held[: max(len(held) - apart, 0)]
    found = np.unique(first[first == held[len(held) - len(first) :]])
    return found, np.searchsorted(held, found, "right") - np.searchsorted(held, found, "left")


def common_shingles(rows: DataFrame, n: int, settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The shingles that ``settings.common`` of all documents hold, sorted, with their exact document frequencies.

    A first pass over all texts reports what a block of documents holds in at least half that share of its own
    documents. Blocks that do not report a shingle hold it in less than half the share, so it can only be common if
    the reports add up to half the share of all; there are at most 2 * (mean shingles per document) / common such
    shingles, which bounds what the driver collects and broadcasts. A second pass counts these exactly.
    """
    least, size = settings.common, settings.shingle
    spark = rows.sparkSession

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for docs, held in _blocks(batches, size):
            found, count = _frequent(held, least / 2 * docs)
            for start in range(0, len(found), 100_000):
                part = slice(start, start + 100_000)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(words.signed(found[part])), pa.array(count[part].astype(np.int64))], names=["shingle", "n"]
                )

    likely = (
        rows.select("text").mapInArrow(report, "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least / 2 * n)
        .select("shingle")
        .toArrow()
    )
    wanted = np.sort(likely.column("shingle").to_numpy().view(np.uint64))
    if not len(wanted):
        return wanted, np.zeros(0)
    sent = spark.sparkContext.broadcast(wanted)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        known, total = Known(own), np.zeros(len(own), np.int64)
        for _, held in _blocks(batches, size):
            total += np.bincount(known.find(held)[1], minlength=len(own))
        seen = total > 0
        yield pa.RecordBatch.from_arrays([pa.array(words.signed(own[seen])), pa.array(total[seen])], names=["shingle", "n"])

    counted = (
        rows.select("text").mapInArrow(count, "shingle long, n long")
        .groupBy("shingle").agg(F.sum("n").alias("n"))
        .where(F.col("n") >= least * n)
        .toArrow()
    )
    shingle, df = counted.column("shingle").to_numpy().view(np.uint64), counted.column("n").to_numpy()
    order = np.argsort(shingle)
    return shingle[order], df[order]


def _sketched(rows: DataFrame, weights, settings: Settings) -> DataFrame:
    """(doc, tid, total, bands): the text's weight, a hash per band, then one per pair of neighbouring bands; none for a
    text without words."""
    width = settings.rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("neardup")
        sampler, own = Sampler(settings.bands * width, settings.seed), weights.value
        places = np.arange(settings.bands).astype(np.uint64)
        for batch in batches:
            bands, totals = [], []
            for text in words.each(batch.column(2)):
                shingle, count = shingles(text, settings.shingle)
                weight = own.of(shingle, count)
                totals.append(float(weight.sum()))
                if not len(shingle):
                    bands.append([])
                    continue
                samples = sampler.of(shingle, weight).reshape(settings.bands, width)
                key = places
                for column in samples.T:
                    key = words.mixed(key * np.uint64(0x9E3779B97F4A7C15) + column)
                bands.append(words.signed(np.concatenate([key, words.mixed(key + np.roll(key, -1))])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(totals, pa.float64()), pa.array(bands, pa.list_(pa.int64()))],
                names=["doc", "tid", "total", "bands"],
            )

    return rows.mapInArrow(run, "doc long, tid binary, total double, bands array<long>")


def _verified(pairs: DataFrame, texts: DataFrame, weights, settings: Settings) -> DataFrame:
    """The (a, b) of ``pairs`` whose texts are as similar as asked for. ``b`` is joined last, so that rows with one
    ``b`` are neighbours and its shingles are made once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("neardup")
        own, last, known = weights.value, None, None

        def weighed(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
            shingle, count = shingles(zlib.decompress(packed), settings.shingle)
            return shingle, own.of(shingle, count)

        for batch in batches:
            found = []
            for b, left, right in zip(*(batch.column(i).to_pylist() for i in (0, 2, 3))):
                if b != last:
                    last, known = b, weighed(right)
                found.append(similarity(weighed(left), known) >= settings.similarity)
            keep = pa.array(found, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column(1).filter(keep), batch.column(0).filter(keep)], names=["a", "b"]
            )

    left = texts.select(F.col("tid").alias("a"), F.col("packed").alias("left"))
    right = texts.select(F.col("tid").alias("b"), F.col("packed").alias("right"))
    return (
        pairs.join(left, "a").join(right, "b").select("b", "a", "left", "right").mapInArrow(run, "a binary, b binary")
    )


def _packed(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        remembered("neardup")
        for batch in batches:
            packed = [zlib.compress(text.encode(), 2) for text in words.each(batch.column(2))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(packed, pa.binary())], names=["doc", "tid", "packed"]
            )

    return rows.mapInArrow(run, "doc long, tid binary, packed binary")


def _held(texts: DataFrame, settings: Settings) -> DataFrame:
    """(tid, shared): the shingles of a text that another one of ``texts`` holds too, with the number of holders, as
    packed 64-bit numbers. A text without any has no row. A shingle occurs once in a text, so no shingle's rows are
    more than a text's share of all."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for tid, packed in zip(*(batch.column(i).to_pylist() for i in (0, 1))):
                own, _ = shingles(zlib.decompress(packed), settings.shingle)
                for start in range(0, len(own), 100_000):
                    part = words.signed(own[start : start + 100_000])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([tid] * len(part), pa.binary()), pa.array(part)], names=["tid", "shingle"]
                    )

    spread = stored(texts.select("tid", "packed").mapInArrow(run, "tid binary, shingle long"), "spread")
    often = spread.groupBy("shingle").agg(F.count("*").alias("n")).where("n > 1")
    return spread.join(often, "shingle").groupBy("tid").agg(F.collect_list(F.struct("n", "shingle")).alias("shared"))


def _prefixes(texts: DataFrame, held: DataFrame, weights, settings: Settings) -> DataFrame:
    """(shingle, tid, class, total, rest, before): of each text the rarest shingles, as far as they and all after them,
    ``rest``, weigh at least ``similarity`` of its ``total`` weight; ``before`` are the last ones that come earlier. All texts are read in one order, by holders and then by the
    shingle, so this much is left at the first shingle that two texts share if they are as similar as asked for.
    Shingles that no other text holds come first and only take their weight."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = weights.value
        for batch in batches:
            for tid, group, packed, shared in zip(*(words.each(batch.column(i), 64) for i in range(4))):
                shingle, count = shingles(zlib.decompress(packed), settings.shingle)
                weight = own.of(shingle, count)
                total = float(weight.sum())
                found = np.array([x["shingle"] for x in shared], np.int64).view(np.uint64)
                order = np.lexsort((found, np.array([x["n"] for x in shared])))
                found = found[order]
                mine = weight[np.searchsorted(shingle, found)]
                rest = np.cumsum(mine[::-1])[::-1]
                upto = rest >= settings.similarity * total * (1 - 1e-9)
                if not upto.any():
                    continue
                n = int(upto.sum())
                prefix = words.signed(found[upto])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(prefix),
                        pa.array([tid] * n, pa.binary()),
                        pa.array([group] * n, pa.binary()),
                        pa.array(np.full(n, total)),
                        pa.array(rest[upto]),
                        pa.array([prefix[max(i - _BEFORE, 0) : i] for i in range(n)], pa.list_(pa.int64())),
                    ],
                    names=["shingle", "tid", "class", "total", "rest", "before"],
                )

    return (
        texts.join(held, "tid").select("tid", "class", "packed", "shared")
        .mapInArrow(run, "shingle long, tid binary, class binary, total double, rest double, before array<long>")
    )


def _left_over(met: DataFrame, component: DataFrame) -> DataFrame:
    """(tid, class) of the texts in buckets of three and more whose members are not all in one class yet."""
    crowd = met.where("size > 2").join(component, "tid", "left").withColumn("class", F.coalesce("component", "tid"))
    parted = (
        crowd.groupBy("bucket").agg(F.min("class").alias("low"), F.max("class").alias("high"))
        .where("low <> high").select("bucket")
    )
    return crowd.join(parted, "bucket").select("tid", "class").distinct()


def _mixed(prefixes: DataFrame, draw: int = 0) -> DataFrame:
    """(shingle, top, lead): of the shingles that texts of several classes hold the class with most of them and one of its
    texts, drawn by a hash that differs from shingle to shingle and from ``draw`` to ``draw``."""
    drawn = F.struct(F.xxhash64("tid", "shingle", F.lit(draw)).alias("draw"), "tid", "total", "rest")
    return (
        prefixes.groupBy("shingle", "class").agg(F.count("*").alias("n"), F.min(drawn).alias("lead"))
        .groupBy("shingle").agg(F.max(F.struct("n", "class", "lead")).alias("top"), F.count("*").alias("classes"))
        .where("classes > 1").select("shingle", F.col("top.class").alias("top"), F.col("top.lead").alias("lead"))
    )


def _near_weights(w: str, total: str, settings: Settings) -> Column:
    """No text is more similar to another than the lighter one's share of the heavier one's weight."""
    return F.least(w, total) >= settings.similarity * (1 - 1e-9) * F.greatest(w, total)


def _may_be_near(w: str, r: str, total: str, rest: str, settings: Settings) -> Column:
    """Whether two texts of weights ``w`` and ``total`` of which ``r`` and ``rest`` are left at a shingle they share may be
    as similar as asked for, if it is the first one."""
    least = settings.similarity * (1 - 1e-9) / (1 + settings.similarity)
    return _near_weights(w, total, settings) & (F.least(r, rest) >= least * (F.col(w) + F.col(total)))


def _lead_pairs(prefixes: DataFrame, draw: int, settings: Settings) -> DataFrame:
    """(a, b): each text with up to ``_LEADS`` of those drawn at its shingles from the class that most holders are in, if
    that is not its own: those with most weight left from the shingle on."""
    best = Window.partitionBy("tid").orderBy(F.desc(F.least(F.col("rest") / F.col("total"), F.col("r") / F.col("w"))), "t")
    return (
        prefixes.join(_mixed(prefixes, draw), "shingle").where("class <> top")
        .select("tid", "total", "rest", F.col("lead.tid").alias("t"), F.col("lead.total").alias("w"), F.col("lead.rest").alias("r"))
        .where(_near_weights("w", "total", settings))
        .groupBy("tid", "t").agg(*(F.max(c).alias(c) for c in ("rest", "total", "r", "w")))
        .withColumn("place", F.row_number().over(best)).where(F.col("place") <= _LEADS)
        .select(F.least("t", "tid").alias("a"), F.greatest("t", "tid").alias("b"))
        .distinct()
    )


def _rest_pairs(prefixes: DataFrame, settings: Settings) -> DataFrame:
    """(a, b), a < b: every pair of texts of two classes that may be as similar as asked for, by a prefix filter. Two
    texts of similarity s share at least s / (1 + s) of the weight of both. So at the first shingle they share that much
    must be left in either: of the lighter one that is at most a ninth of its weight from the start, at s = 0.8. A pair
    is made at its first shingle only. Where a shingle's holders are mostly of one class, only the others are paired
    with all, so pairs do not grow with the square of that class."""
    met = stored(prefixes.join(_mixed(prefixes).drop("lead"), "shingle"), "held")
    few = met.where("class <> top").select(
        "shingle", F.col("tid").alias("t"), F.col("class").alias("c"), F.col("total").alias("w"), F.col("rest").alias("r"),
        F.col("before").alias("earlier"),
    )
    return (
        few.join(met, "shingle")
        .where("c <> class AND (class = top OR t < tid)")
        .where(_may_be_near("w", "r", "total", "rest", settings))
        .where(~F.arrays_overlap("earlier", "before"))
        .select(F.least("t", "tid").alias("a"), F.greatest("t", "tid").alias("b"))
        .distinct()
    )


def _renamed(prefixes: DataFrame, merged: DataFrame) -> DataFrame:
    """``prefixes`` with the classes that the links ``merged`` between them make."""
    whole = components(merged).select(F.col("node").alias("class"), F.col("component").alias("whole"))
    return prefixes.join(whole, "class", "left").withColumn("class", F.coalesce("whole", "class")).drop("whole")


def classes(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """A row per row of ``df``: ``doc_id``, ``tid`` (MD5 of the text), ``class_id`` (the smallest id among texts that
    verified links connect) and ``kept`` (whether the row has this id).

    Equal texts are one node. In each band's bucket one member is drawn as leader, by a hash that differs from band
    to band, and every other member is compared with it; texts of a group meet many leaders, and chains of links join
    them. Where unlike texts fill a bucket, those that share the next band as well form a bucket of their own with its
    own leader. Buckets whose members are not in one class after that are settled exactly: at each rare shingle the texts
    of other classes first meet one of the class that most holders are in, and then a prefix filter over the weighted
    shingles finds every pair of two classes that can still be similar enough, and no bucket has a cap. So texts that meet in a bucket and are as similar as asked for always end up in one class. Pairs grow with
    the members of a bucket, and with their square only where texts of different classes share most of their weight.
    Whatever is paired is verified on whole texts. Leaders come from an aggregation that is reduced on the map side, and are joined
    back by a plain join that AQE can split where a bucket is hot.

    A null text belongs to no class but its own. Texts without words have only their equals. A class of null ids
    alone has a null ``class_id`` and keeps all its rows. Rows that repeat an id and a text are kept or not together.
    """
    with small_batches(df.sparkSession):
        return _classes(df, doc_id, text, settings)


def _classes(df: DataFrame, doc_id: str, text: str, settings: Settings) -> DataFrame:
    n = df.count()
    rows = _rows(df, doc_id, text)
    weights = df.sparkSession.sparkContext.broadcast(Weights(n, *common_shingles(rows, n, settings), settings.common))
    sketched = stored(_sketched(rows, weights, settings), "sketches")
    nodes = stored(
        sketched.groupBy("tid").agg(F.min("doc").alias("doc"), F.min("total").alias("total"), F.min("bands").alias("bands")),
        "nodes",
    )
    members = nodes.select("tid", "total", F.posexplode("bands").alias("band", "key")).select(
        "tid", "total", F.struct("band", "key").alias("bucket")
    )
    leaders = (
        members.groupBy("bucket")
        .agg(
            F.min(F.struct(F.xxhash64("tid", "bucket").alias("draw"), "tid", "total")).alias("lead"),
            F.count("*").alias("size"),
        )
        .where("size > 1")
        .select("bucket", F.col("lead.tid").alias("b"), F.col("lead.total").alias("heavy"), "size")
    )
    met = stored(members.join(leaders, "bucket"), "met")
    # No text is more similar to another than the lighter one's share of the heavier one's weight.
    near = F.least("total", "heavy") >= settings.similarity * (1 - 1e-9) * F.greatest("total", "heavy")
    asked = met.where("tid <> b").where(near)
    pairs = stored(
        asked.groupBy(F.col("tid").alias("a"), "b").agg(F.max(F.struct("size", "bucket")).alias("best")), "pairs"
    )
    involved = nodes.join(
        met.where("size > 2 OR tid <> b").select("tid").union(pairs.select("b")).distinct(), "tid"
    ).select(F.col("tid").alias("t"), F.col("doc").alias("d"))
    texts = stored(
        _packed(rows)
        .join(involved, (F.col("tid") == F.col("t")) & F.col("doc").eqNullSafe(F.col("d")))
        .dropDuplicates(["t", "d"])
        .select("tid", "packed"),
        "texts",
    )
    # First each text meets the leader of its largest bucket; then those leaders whose class it is not in already.
    first = pairs.groupBy("a").agg(F.max(F.struct("best", "b")).alias("pick")).select("a", F.col("pick.b").alias("b"))
    links = stored(_verified(first, texts, weights, settings), "links")
    component = stored(components(links).select(F.col("node").alias("tid"), "component"), "components")
    class_by = lambda key, name: component.select(F.col("tid").alias(key), F.col("component").alias(name))
    further = (
        pairs.select("a", "b").join(first, ["a", "b"], "left_anti")
        .join(class_by("a", "x"), "a", "left").join(class_by("b", "y"), "b", "left")
        .where(F.coalesce("x", "a") != F.coalesce("y", "b")).select("a", "b")
    )
    links = stored(_verified(further, texts, weights, settings).union(links), "links")
    component = stored(components(links).select(F.col("node").alias("tid"), "component"), "components")
    joined = nodes.select("tid", "doc").join(component, "tid", "left").withColumn("class", F.coalesce("component", "tid"))
    left = stored(_left_over(met, component), "left")
    dropped(met)
    if not left.isEmpty():
        seen = pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
        own = stored(texts.join(left, "tid"), "own")
        held = stored(_held(own, settings), "shared")
        prefixes = stored(_prefixes(own, held, weights, settings), "prefixes")
        of_classes = lambda found: (
            found.join(left.select(F.col("tid").alias("a"), F.col("class").alias("x")), "a")
            .join(left.select(F.col("tid").alias("b"), F.col("class").alias("y")), "b")
            .select(F.col("x").alias("a"), F.col("y").alias("b"))
        )
        merged = links.where("false")  # a table made of Python rows would take Python workers of another kind
        for draw in range(_LEAD_ROUNDS):
            # Texts of a class that one link settles need not be paired with all of it.
            lead = stored(_lead_pairs(_renamed(prefixes, merged), draw, settings).join(seen, ["a", "b"], "left_anti"), "lead")
            seen = seen.union(lead)
            merged = stored(of_classes(_verified(lead, texts, weights, settings)).union(merged), "merged")
        rest = stored(_rest_pairs(_renamed(prefixes, merged), settings).join(seen, ["a", "b"], "left_anti"), "rest")
        merged = of_classes(_verified(rest, texts, weights, settings)).union(merged)
        joined = joined.join(
            components(merged).select(F.col("node").alias("class"), F.col("component").alias("whole")), "class", "left"
        ).select("tid", "doc", F.coalesce("whole", "class").alias("class"))
    dropped(pairs)
    dropped(texts)
    named = joined.groupBy("class").agg(F.min("doc").alias("class_id"))
    class_of = joined.join(named, "class").select(F.col("tid").alias("t"), "class_id")
    own = df.select(
        F.col(quoted(doc_id)).cast("long").alias("doc_id"),
        F.unhex(F.md5(F.col(quoted(text)).cast("binary"))).alias("tid"),
    )
    return own.join(class_of, F.col("tid") == F.col("t"), "left").select(
        "doc_id",
        "tid",
        F.when(F.col("tid").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(F.col("tid").isNull(), F.lit(True)).otherwise(F.col("doc_id").eqNullSafe(F.col("class_id"))).alias("kept"),
    )


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows of ``df`` that ``classes`` keeps, one of rows that repeat an id and a text. Columns stay as they are."""
    own_doc, own_tid, kept_doc, kept_tid = (free(df, c) for c in ("_own_doc", "_own_tid", "_kept_doc", "_kept_tid"))
    kept = (
        classes(df, doc_id, text, settings)
        .where("kept")
        .select(F.col("doc_id").alias(kept_doc), F.coalesce("tid", F.lit(b"")).alias(kept_tid))
        .distinct()
    )
    names = df.columns
    own = df.withColumns(
        {
            own_doc: F.col(quoted(doc_id)).cast("long"),
            own_tid: F.coalesce(F.unhex(F.md5(F.col(quoted(text)).cast("binary"))), F.lit(b"")),
        }
    )
    return (
        own.join(kept, F.col(own_doc).eqNullSafe(F.col(kept_doc)) & (F.col(own_tid) == F.col(kept_tid)), "left_semi")
        .dropDuplicates([own_doc, own_tid])
        .select(*cols(names))
    )
