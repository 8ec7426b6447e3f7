"""Language identification: averaged embeddings of hashed subwords, a linear softmax over them, and calibrated scores."""

from __future__ import annotations

import functools
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelspark.llm import words
from parcelspark.llm.common import cols, free, others, quoted

UNDETERMINED = "und"
_SIZES = (1, 2, 3, 4)
_PART = 1 << 17
_BASE = np.uint64(0x100000001B3)


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the labelled rows that are learned from, ``per_language`` those of one language; the rest
    are the model's size and its training. ``precision`` is the share of right answers among those not rejected."""

    sample: int = 4000
    per_language: int = 500
    bits: int = 16
    dim: int = 16
    epochs: int = 8
    batch: int = 32
    rate: float = 4.0
    precision: float = 0.99
    longest: int = 200
    seed: int = 11


@functools.cache
def _letters() -> np.ndarray:
    return np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)


def _spelled(text: str) -> np.ndarray:
    """Code points of the text's lower-case words of letters, one blank around each."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[points]
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    found = np.where(letter, points, np.uint32(32))[keep]
    return np.concatenate([[32], found, [32]]).astype(np.uint64)


def subwords(text: str, bits: int) -> Iterator[np.ndarray]:
    """Buckets of all subwords of one to four characters, a word's ends counting as characters, part by part. A text
    without letters has none."""
    points = _spelled(text)
    if len(points) < 3:
        return
    for start in range(0, len(points), _PART):
        part = points[start : start + _PART + _SIZES[-1] - 1]
        blank = part == 32
        own = min(_PART, len(part))
        code, inner = part, None
        for size in _SIZES:
            if size > 1:
                code = code[:-1] * _BASE + part[size - 1 :]
            if size == 2:
                good = ~(blank[:-1] & blank[1:])
            elif size == 1:
                good = ~blank
            else:
                last = blank[1 : len(blank) - size + 2] if size == 3 else blank[size - 2 : -1]
                inner = last if inner is None else inner[:-1] | last
                good = ~inner
            found = code[:own][good[:own]]
            yield (words.mixed(found + np.uint64(size)) >> np.uint64(64 - bits)).view(np.int64)


def bag(text: str, bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(buckets, occurrences) of a text's subwords."""
    parts = list(subwords(text, bits))
    found, count = np.unique(np.concatenate(parts), return_counts=True) if parts else (np.zeros(0, np.int64),) * 2
    return found.astype(np.int32), count.astype(np.int32)


def _spans(text: str, draw: np.random.Generator, longest: int) -> list[str]:
    """Three runs of words from random places: up to ``longest``, 20 and 5 words."""
    own = text.split()
    found = []
    for most in (longest, 20, 5):
        size = min(len(own), int(draw.integers(1, most + 1)) if most < longest else longest)
        at = int(draw.integers(0, len(own) - size + 1))
        found.append(" ".join(own[at : at + size]))
    return found


@dataclass
class Model:
    """``embedding`` per bucket, ``weight`` and ``bias`` per language, the temperature that calibrates scores and the
    least score that is not rejected."""

    languages: list[str]
    bits: int
    embedding: np.ndarray
    weight: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0
    least: float = 0.0
    table: np.ndarray | None = field(default=None, repr=False)

    def logits(self, text: str) -> np.ndarray | None:
        """None for a text without letters. With few languages a bucket's share of each is tabled."""
        if self.table is None and len(self.languages) <= self.embedding.shape[1]:
            self.table = np.ascontiguousarray(self.embedding @ self.weight.T)
        rows = self.embedding if self.table is None else self.table
        total, n = np.zeros(rows.shape[1]), 0
        for found in subwords(text, self.bits):
            total += rows.take(found, axis=0).sum(axis=0, dtype=np.float64)
            n += len(found)
        if not n:
            return None
        mean = total / n
        return (self.weight @ mean if self.table is None else mean) + self.bias

    def answer(self, text: str | None) -> tuple[str, float, bool]:
        """(language, score, rejected)."""
        logits = self.logits(text) if text and self.languages else None
        if logits is None:
            return UNDETERMINED, 0.0, True
        share = _softmax(logits[None, :] / self.temperature)[0]
        best = int(share.argmax())
        return self.languages[best], float(share[best]), bool(share[best] < self.least)


def _softmax(logits: np.ndarray) -> np.ndarray:
    raised = np.exp(logits - logits.max(axis=1, keepdims=True))
    return raised / raised.sum(axis=1, keepdims=True)


class _Bags:
    """Bags of many texts, one after the other, with shares instead of counts."""

    def __init__(self, bags: list[tuple[np.ndarray, np.ndarray]]):
        self.bags = [(found, (count / count.sum())[:, None].astype(np.float32)) for found, count in bags]

    def of(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        own = [self.bags[r] for r in rows]
        sizes = np.array([len(found) for found, _ in own])
        return np.concatenate([x for x, _ in own]), np.concatenate([x for _, x in own]), sizes


def fitted(bags: list, classes: np.ndarray, languages: list[str], settings: Settings) -> Model:
    """Stochastic gradient descent on the cross entropy, in small batches with a falling rate."""
    draw = np.random.default_rng(settings.seed)
    embedding = draw.uniform(-1, 1, (1 << settings.bits, settings.dim)).astype(np.float32) / settings.dim
    weight = np.zeros((len(languages), settings.dim), np.float32)
    bias = np.zeros(len(languages), np.float32)
    data, steps = _Bags(bags), settings.epochs * -(-len(bags) // settings.batch)
    # A language's share of the loss does not depend on how often it was sampled.
    balance = 1 / np.maximum(np.bincount(classes, minlength=len(languages)), 1)
    balance = (balance / balance[classes].mean()).astype(np.float32)
    step = 0
    for _ in range(settings.epochs):
        order = draw.permutation(len(bags))
        for start in range(0, len(order), settings.batch):
            rows = order[start : start + settings.batch]
            found, share, sizes = data.of(rows)
            starts = np.cumsum(sizes) - sizes
            mean = np.add.reduceat(embedding[found] * share, starts, axis=0)
            slope = _softmax(mean @ weight.T + bias)
            slope[np.arange(len(rows)), classes[rows]] -= 1
            slope *= balance[classes[rows]][:, None]
            rate = np.float32(settings.rate * (1 - step / steps))
            back = np.repeat(slope @ weight, sizes, axis=0)
            weight -= rate / len(rows) * (slope.T @ mean)
            bias -= rate / len(rows) * slope.sum(axis=0)
            np.subtract.at(embedding, found, rate * share * back)
            step += 1
    return Model(languages, settings.bits, embedding, weight, bias)


def calibrated(model: Model, bags: list, classes: np.ndarray, precision: float) -> Model:
    """Sets the temperature to the one that makes the scores of texts not learned from likeliest, and ``least`` to the
    smallest score from which on at least ``precision`` of them are right."""
    if not len(bags):
        return model
    data = _Bags(bags)
    logits = np.concatenate(
        [[(model.embedding[found] * share).sum(axis=0) @ model.weight.T + model.bias] for found, share in data.bags]
    )

    def loss(log_temperature: float) -> float:
        share = _softmax(logits / np.exp(log_temperature))
        return -np.log(np.maximum(share[np.arange(len(classes)), classes], 1e-12)).mean()

    tried = np.linspace(-4, 4, 161)
    model.temperature = float(np.exp(tried[int(np.argmin([loss(t) for t in tried]))]))
    share = _softmax(logits / model.temperature)
    score, right = share.max(axis=1), share.argmax(axis=1) == classes
    order = np.argsort(-score, kind="stable")
    good = np.flatnonzero(np.cumsum(right[order]) >= precision * np.arange(1, len(order) + 1))
    model.least = float(score[order[good[-1]]]) if len(good) else 1.0
    return model


def learned(
    df: DataFrame, learn: Column, doc_id: str = "doc_id", text: str = "text", lang: str = "lang", settings: Settings = Settings()
) -> Model:
    """A model of the labelled rows for which ``learn`` holds.

    At most ``settings.sample`` documents are learned from, and ``per_language`` of a language, the first by a hash of
    the id; languages take turns. They are chosen by id and label alone; then their texts are read, and three spans
    of words of each become bags of subwords in Spark tasks, so the driver gets at most three bags of ``2**bits`` entries
    a document, whatever the texts. A quarter of the documents is not trained on but calibrates the scores. Rows
    without id, text or label are not learned from; of rows that repeat an id one is. Without any, the model answers
    ``und``.
    """
    rows = df.select(
        F.col(quoted(doc_id)).alias("doc"), F.col(quoted(lang)).alias("lang"), F.col(quoted(text)).alias("text"), learn.alias("learn")
    ).where("learn AND doc IS NOT NULL AND lang IS NOT NULL")
    turn = Window.partitionBy("lang").orderBy(F.xxhash64("doc"), "doc")
    chosen = (
        rows.select("doc", "lang")
        .withColumn("turn", F.row_number().over(turn))
        .where(F.col("turn") <= settings.per_language)
        .orderBy("turn", "lang", "doc")
        .limit(settings.sample)
        .select("doc")
        .distinct()
    )
    # At most ``sample`` ids, so the list may be broadcast at any table size.
    texts = rows.where("text IS NOT NULL").join(F.broadcast(chosen), "doc", "left_semi").groupBy("doc").agg(
        F.min(F.struct("lang", "text")).alias("row")
    )

    def spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, own, body in zip(*(words.each(c, 64) for c in batch.columns)):
                if not body.split():
                    continue
                bags = [bag(span, settings.bits) for span in _spans(body, np.random.default_rng(part), settings.longest)]
                bags = [b for b in bags if len(b[0])]
                if bags:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([part] * len(bags)),
                            pa.array([own] * len(bags)),
                            *(pa.array([b[i].tobytes() for b in bags], pa.binary()) for i in (0, 1)),
                        ],
                        names=["draw", "lang", "found", "n"],
                    )

    table = (
        texts.select(F.shiftright(F.xxhash64("doc"), 1).bitwiseAND(F.lit((1 << 62) - 1)).alias("draw"), F.col("row.lang").alias("lang"), F.col("row.text").alias("text"))
        .mapInArrow(spans, "draw long, lang string, found binary, n binary")
        .toArrow()
        .sort_by([("draw", "ascending"), ("lang", "ascending"), ("found", "ascending")])
    )
    lang_of = table.column("lang").to_pylist()
    bags = [(np.frombuffer(f, np.int32), np.frombuffer(n, np.int32)) for f, n in zip(table.column("found").to_pylist(), table.column("n").to_pylist())]
    languages = sorted(set(lang_of))
    if not languages:
        empty = np.zeros((1, settings.dim), np.float32)
        return Model([], settings.bits, empty, empty[:0], np.zeros(0, np.float32))
    classes = np.array([languages.index(x) for x in lang_of])
    held = table.column("draw").to_numpy() % 4 == 0
    pick = lambda which: [bags[i] for i in np.flatnonzero(which)]
    if held.all():
        held[:] = False
    return calibrated(fitted(pick(~held), classes[~held], languages, settings), pick(held), classes[held], settings.precision)


def identified(df: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``df`` without ``text``, with ``lang_pred``, ``score`` (0 to 1, the calibrated probability of the answer) and
    ``rejected`` (whether the score is below the model's least one).

    Whole texts are read, long ones part by part. A null text, one without a letter, and any text if nothing was
    learned are ``und`` with score 0 and rejected. Equal texts have equal answers; an empty table stays empty. No
    shuffle. Input columns with an added column's name are replaced.
    """
    added = ["lang_pred", "score", "rejected"]
    kept = others(df, text, *added)
    source = df.select(*cols(kept), F.col(quoted(text)).alias(free(df, "_text")))
    schema = df.select(*cols(kept), F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("rejected")).schema
    sent = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = sent.value
        for batch in batches:
            answers = [own.answer(body) for body in words.each(batch.column(batch.num_columns - 1), 64)]
            made = [pa.array([a[i] for a in answers], kind) for i, kind in enumerate((pa.string(), pa.float64(), pa.bool_()))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *made], names=schema.names)

    return source.mapInArrow(run, schema)
