"""Removal of long passages that repeat across documents, over a sparse De Bruijn graph of word k-mers.

Every window of 50 words holds at least one selected k-mer of 26 words: of its 25 k-mers the one with the smallest
hash, the leftmost of equals. The choice depends on the window's words alone, so two documents that share a window
share a selected k-mer, at one place in it. Selected k-mers are the graph's nodes, two that follow each other in a
document an edge; they overlap, so an edge fixes all words it spans. k-mers of a single document are dropped at
once. Paths along which every occurrence continues alike are compacted into one, and an occurrence of such a path is
one long span. A window within it repeats wherever the path does; windows across a path's end are compared one by
one. Each span and each such window is verified by a 128-bit digest of its words at its coordinates, made of two
unlike 64-bit hashes of each word.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import words
from parcelspark.llm.common import cols, dropped, free, met, stored

_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def _smallest(kmers: np.ndarray, span: int) -> np.ndarray:
    """For each window of ``span`` k-mers the place of its smallest one, the leftmost of equals."""
    if len(kmers) < span:
        return np.zeros(0, np.int64)
    return np.lib.stride_tricks.sliding_window_view(kmers, span).argmin(axis=1) + np.arange(len(kmers) - span + 1)


def _batches(columns: list[list], types: list[pa.DataType], names: list[str], size: int = 50_000):
    """Arrow batches of long numpy columns."""
    whole = [np.concatenate(c) if c else np.zeros(0) for c in columns]
    for start in range(0, len(whole[0]), size):
        yield pa.RecordBatch.from_arrays([pa.array(c[start : start + size], t) for c, t in zip(whole, types)], names=names)


def _nodes(rows: DataFrame, window: int, k: int) -> DataFrame:
    """(doc, crc, pos, node, next, gap) of each selected k-mer; next and gap are 0 at a document's end."""
    names = ["doc", "crc", "pos", "node", "next", "gap"]
    types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int32()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), words.each(batch.column(1))):
                data = text.encode()
                own = words.split(data)
                if len(own) < window:
                    continue
                kmers = words.Runs(words.hashed(own)).each(k)
                at = np.unique(_smallest(kmers, window - k + 1))
                node = words.signed(kmers[at])
                following, gap = np.zeros(len(at), np.int64), np.zeros(len(at), np.int32)
                following[:-1], gap[:-1] = node[1:], np.diff(at)
                crc = zlib.crc32(data)
                values = (np.full(len(at), doc), np.full(len(at), crc), at.astype(np.int32), node, following, gap)
                for column, value in zip(made, values):
                    column.append(value)
            yield from _batches(made, types, names)

    return rows.select("doc", "text").mapInArrow(run, "doc long, crc long, pos int, node long, next long, gap int")


def _paths(occurrences: DataFrame) -> DataFrame:
    """(node, head, off, n): the first node of the compacted path that a node lies on, the words between them, and the
    node's occurrences.

    u and v are joined if every occurrence of u is followed by v at one distance and v occurs as often as u: then
    each occurrence of v follows one of u. Paths are found by pointer jumping: each round joins every node with the
    node it points to, so rounds grow with the logarithm of the longest path. There are no circles, since each
    document ends.
    """
    nodes = stored(
        occurrences.groupBy("node").agg(
            F.count("*").alias("n"),
            F.min("next").alias("next"),
            (F.min("next") == F.max("next")).alias("one"),
            F.min("gap").alias("gap"),
            (F.min("gap") == F.max("gap")).alias("same"),
        ),
        "nodes",
    )
    forth = nodes.where("one AND same AND gap > 0").select(
        F.col("node").alias("head"), F.col("next").alias("node"), F.col("gap").alias("off"), "n"
    )
    open_ends = stored(
        nodes.select("node", "n")
        .join(forth, ["node", "n"], "left")
        .select(
            "node", F.coalesce("head", "node").alias("head"), F.coalesce("off", F.lit(0)).cast("long").alias("off"), "n"
        ),
        "paths",
    )
    dropped(nodes)
    while True:
        ahead = open_ends.select(F.col("node").alias("head"), F.col("head").alias("h"), F.col("off").alias("o"))
        jumped = stored(
            open_ends.join(ahead, "head").select(
                "node",
                F.col("h").alias("head"),
                (F.col("off") + F.col("o")).alias("off"),
                "n",
                (F.col("h") != F.col("head")).alias("moved"),
            ),
            "paths",
        )
        dropped(open_ends)
        if jumped.where("moved").isEmpty():
            return jumped.drop("moved")
        open_ends = jumped.drop("moved")


def _items(docs: DataFrame, window: int, k: int) -> DataFrame:
    """(a, b, doc, crc, start, end, more): the digest of each path occurrence of a window's length or more, and of
    each window around a repeated node that such a path does not hold whole. A document has one row per digest;
    ``more`` holds the starts of further places with the same words, which a text that repeats itself has many of."""
    names = ["a", "b", "doc", "crc", "start", "end", "more"]
    types = [pa.int64()] * 4 + [pa.int32()] * 2 + [pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made: list[list] = [[] for _ in names]
            for doc, crc, packed, spans in zip(*(words.each(c) for c in batch.columns)):
                data = zlib.decompress(packed)
                # Two hashes of each word that know nothing of each other, one for each half of a digest.
                own, other = words.hashed(words.split(data)), words.spelled(data)
                kmers = words.Runs(own).each(k)
                nearest = _smallest(kmers, window - k + 1)
                low = np.full(len(kmers), -1)
                high = np.full(len(kmers), -1)
                starts, ends = [], []
                for span in spans:
                    first, last = span["first"], span["last"]
                    # Nodes of one path occurrence; other selected k-mers never lie between them.
                    low[first : last + 1], high[first : last + 1] = first, last + k
                    if last + k - first >= window:
                        starts.append(first)
                        ends.append(last + k)
                begin = np.arange(len(nearest))
                across = (low[nearest] >= 0) & ((begin < low[nearest]) | (begin + window > high[nearest]))
                start = np.concatenate([np.array(starts, np.int64), begin[across]])
                end = np.concatenate([np.array(ends, np.int64), begin[across] + window])
                a, b = (words.signed(words.Runs(h, lane).of(start, end)) for lane, h in enumerate((own, other)))
                order = np.lexsort((start, b, a))
                a, b, start, end = a[order], b[order], start[order], end[order]
                opens = np.ones(len(a), bool)
                opens[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
                first = np.flatnonzero(opens)
                more = np.full(len(first), None, object)
                sizes = np.diff(np.append(first, len(a)))
                for group in np.flatnonzero(sizes > 1):
                    more[group] = start[first[group] + 1 : first[group] + sizes[group]].tolist()
                values = (
                    a[first],
                    b[first],
                    np.full(len(first), doc),
                    np.full(len(first), crc),
                    start[first].astype(np.int32),
                    end[first].astype(np.int32),
                    more,
                )
                for column, value in zip(made, values):
                    column.append(value)
            yield from _batches(made, types, names)

    return docs.mapInArrow(run, "a long, b long, doc long, crc long, start int, end int, more array<int>")


def _zipped(rows: DataFrame) -> DataFrame:
    """(doc, crc, packed): texts as they travel, in about two thirds of what they take in a shuffle as they are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [text.encode() for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array([zlib.crc32(d) for d in data], pa.int64()),
                    pa.array([zlib.compress(d, 2) for d in data], pa.binary()),
                ],
                names=["doc", "crc", "packed"],
            )

    return rows.select("doc", "text").mapInArrow(run, "doc long, crc long, packed binary")


def repeated_spans(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> tuple[DataFrame, DataFrame]:
    """(doc, crc, spans): for documents with words to remove, the word spans from start to end, and of the same length
    from each of ``more``, whose windows also start in a document with a smaller id; and (doc, text), the rows it
    looked at.

    ``crc`` is the CRC-32 of the text's bytes; with the id it tells rows apart, so that an id may have several texts.
    Rows without id or text take no part; rows with equal ids never remove each other's words.
    """
    k = window // 2 + 1
    rows = df.select(F.col(doc_id).cast("long").alias("doc"), F.col(text).alias("text")).where(
        "doc IS NOT NULL AND text IS NOT NULL"
    )
    nodes = stored(_nodes(rows, window, k), "kmers")
    repeated = nodes.groupBy("node").agg(F.min("doc").alias("x"), F.max("doc").alias("y"), F.count("*").alias("n"))
    repeated = stored(repeated.where("x < y").select("node", "n"), "repeated")
    occurrences = stored(met(nodes, repeated, ["node"], nodes.count()), "occurrences")
    dropped(nodes)
    dropped(repeated)
    paths = _paths(occurrences)
    on_path = (
        met(occurrences, paths, ["node"], occurrences.count())
        .groupBy("doc", "crc", "head", (F.col("pos") - F.col("off")).alias("at"))
        .agg(F.min("pos").alias("first"), F.max("pos").alias("last"))
    )
    per_doc = on_path.groupBy("doc", "crc").agg(F.collect_set(F.struct("first", "last")).alias("spans"))
    items = stored(_items(_zipped(rows).join(per_doc, ["doc", "crc"]), window, k), "items")
    sources = items.groupBy("a", "b").agg(F.min("doc").alias("source"), F.max("doc").alias("y"), F.count("*").alias("n"))
    sources = stored(sources.where("source < y").drop("y"), "sources")
    spans = (
        met(items, sources, ["a", "b"], items.count())
        .where("source < doc")
        .groupBy("doc", "crc")
        .agg(F.collect_list(F.struct("start", "end", "more")).alias("spans"))
    )
    return spans, rows


def _removed(count: int, spans: list[dict]) -> np.ndarray:
    """Which of ``count`` words the spans cover."""
    change = np.zeros(count + 1, np.int64)
    for span in spans:
        size = span["end"] - span["start"]
        for start in (span["start"], *(span["more"] or ())):
            change[start] += 1
            change[start + size] -= 1
    return np.cumsum(change)[:-1] > 0


def _without(data: bytes, gone: np.ndarray) -> bytes:
    """The text without these words; each takes the blanks up to the next word with it."""
    places = [m.start() for m in _WORD.finditer(data)] + [len(data)]
    kept, at = [], 0
    edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(np.int8), [0]])))
    for begin, end in edges.reshape(-1, 2).tolist():
        kept.append(data[at : places[begin]])
        at = places[end]
    kept.append(data[at:])
    return b"".join(kept)


def _digest(data: bytes, gone: np.ndarray | None) -> tuple[int, int, str]:
    own = words.split(data)
    kept = own if gone is None else [w for w, out in zip(own, gone.tolist()) if not out]
    return len(own), len(own) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


def changed_texts(spans: DataFrame, rows: DataFrame) -> DataFrame:
    """(doc, crc, new_text, n_words, n_removed, kept_sha256) of the documents that lose words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = []
            for doc, crc, packed, own in zip(*(words.each(c) for c in batch.columns)):
                data = zlib.decompress(packed)
                gone = _removed(len(words.split(data)), own)
                made.append((doc, crc, _without(data, gone).decode(), *_digest(data, gone)))
            if made:
                types = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
                names = ["doc", "crc", "new_text", "n_words", "n_removed", "kept_sha256"]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*made), types)], names=names)

    return _zipped(rows).join(spans, ["doc", "crc"]).mapInArrow(
        run, "doc long, crc long, new_text string, n_words long, n_removed long, kept_sha256 string"
    )


def deduplicated(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """``df`` with the words removed from ``text`` that a window of ``window`` words covers which also starts in a
    document with a smaller id. Windows are judged on the input. Other columns and documents stay as they are, null
    texts and ids too; a text may end up empty. Repeated rows with one id lose the same words.
    """
    spans, rows = repeated_spans(df, doc_id, text, window)
    doc, crc, new = (free(df, c) for c in ("_doc", "_crc", "_new"))
    changed = changed_texts(spans, rows).select(
        F.col("doc").alias(doc), F.col("crc").alias(crc), F.struct("new_text").alias(new)
    ).dropDuplicates([doc, crc])
    names = df.columns
    joined = df.join(
        changed,
        (F.col(doc_id).cast("long") == F.col(doc)) & (F.crc32(F.col(text).cast("binary")) == F.col(crc)),
        "left",
    )
    return joined.select(
        *(
            F.when(F.col(new).isNotNull(), F.col(f"{new}.new_text")).otherwise(F.col(text)).alias(c) if c == text else cols([c])[0]
            for c in names
        )
    )


def digests(df: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = 50) -> DataFrame:
    """A row per row of ``df``: ``doc_id``, ``n_words``, ``n_removed`` and ``kept_sha256`` of what ``deduplicated``
    keeps; texts that lose nothing are digested where they are read."""
    spans, rows = repeated_spans(df, doc_id, text, window)
    changed = changed_texts(spans, rows).select(
        F.col("doc").alias("_doc"), F.col("crc").alias("_crc"), F.col("n_removed").alias("_n"), F.col("kept_sha256").alias("_sha")
    ).dropDuplicates(["_doc", "_crc"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = [(text or "").encode() for text in batch.column(1).to_pylist()]
            n, _, sha = zip(*(_digest(d, None) for d in data))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([zlib.crc32(d) for d in data], pa.int64()), pa.array(n, pa.int64()), pa.array(sha)],
                names=["doc_id", "crc", "n_words", "sha"],
            )

    whole = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text)).mapInArrow(
        run, "doc_id long, crc long, n_words long, sha string"
    )
    return whole.join(changed, (F.col("doc_id") == F.col("_doc")) & (F.col("crc") == F.col("_crc")), "left").select(
        "doc_id",
        "n_words",
        F.coalesce("_n", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("_sha", "sha").alias("kept_sha256"),
    )
