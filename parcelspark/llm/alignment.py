"""Two tokenizers over one text: groups of tokens that cover the same bytes, and which tokens end together how often.

The distinct linked pairs of ids get a minimal perfect hash. Their counts are dense vectors indexed by it, summed as a
tree; a second pass aligns the texts again and looks the counts up.
"""

from __future__ import annotations

import hashlib
import os
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm import words
from parcelspark.llm.common import cols, dropped, free, others, stored

# Chunks of text that a worker keeps with their alignment. When so many are new, those not met since are forgotten.
CACHE_ENTRIES = 200_000
_LEARNED = 4096
_BLANK = "▁"
_LOW = np.uint64(0xFFFFFFFF)


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable Latin-1 for itself, the rest from U+0100."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(printable)]
    return {chr(b): b for b in printable} | {chr(0x100 + i): b for i, b in enumerate(rest)}


#: How byte-level tokenizers part a text before they merge (a fixed value of the format).
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def _ranked(tokenizer, bytes_of: list[bytes]):
    """The same tokenizer as a ``tiktoken`` encoding, which is several times faster; none where the two could differ:
    unless the file holds plain byte-level merges whose results are numbered in the order of the merges."""
    import json

    import tiktoken

    told = json.loads(tokenizer.to_str())
    model, before = told["model"], told["pre_tokenizer"] or {}
    merges = [m.split(" ") if isinstance(m, str) else m for m in model.get("merges", [])]
    vocabulary = model.get("vocab", {})
    plain = (
        told["normalizer"] is None
        and model["type"] == "BPE"
        and not any(model.get(k) for k in ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges"))
        and (before.get("type"), before.get("add_prefix_space"), before.get("use_regex")) == ("ByteLevel", False, True)
        and len(vocabulary) == len(merges) + 256
        and sorted(vocabulary.values()) == list(range(len(vocabulary)))
        and all(vocabulary.get(a + b) == 256 + i for i, (a, b) in enumerate(merges))
    )
    if not plain:
        return None
    ranks = {bytes_of[number]: number for number in vocabulary.values()}
    return tiktoken.Encoding("byte level", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})


class Vocabularies:
    """A byte-level tokenizer A of the ``tokenizers`` library and a piece model B of ``sentencepiece``."""

    def __init__(self, byte_level: str, pieces: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=pieces)
        letters, vocabulary = _byte_of_letter(), self.a.get_vocab()
        self.bytes_a = [b""] * (max(vocabulary.values()) + 1)
        for token, number in vocabulary.items():
            known = all(c in letters for c in token)
            self.bytes_a[number] = bytes(map(letters.__getitem__, token)) if known else token.encode()
        self.fast = _ranked(self.a, self.bytes_a)
        piece = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [
            bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(piece)
        ]
        self.sizes_a, self.sizes_b = (np.array(list(map(len, t)), np.int64) for t in (self.bytes_a, self.bytes_b))
        # No piece goes on with a blank behind another character, so each blank before a visible one begins a piece.
        self.parted = not any(_BLANK in p.lstrip(_BLANK) for p in piece)

    def pair_bound(self) -> int:
        """How many pairs of ids can ever be linked: those whose bytes end alike, so that one is the other's end."""
        held_a, held_b = Counter(filter(None, self.bytes_a)), Counter(filter(None, self.bytes_b))
        longer_a = sum(n * held_b[t[i:]] for t, n in held_a.items() for i in range(len(t)))
        return longer_a + sum(n * held_a[t[i:]] for t, n in held_b.items() for i in range(1, len(t)))

    def ids_a(self, text: str) -> list[int]:
        if self.fast is not None:
            return self.fast.encode_ordinary(text)
        return self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def encoded(self, text: str) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of A over blank + text and of B over the text; none where a tokenizer does not keep the bytes."""
        a = self.ids_a(" " + text)
        b = self.b.encode(text, num_threads=1)
        whole = b" " + text.encode()
        if b"".join(map(self.bytes_a.__getitem__, a)) != whole or b"".join(map(self.bytes_b.__getitem__, b)) != whole:
            return None
        return np.array(a, np.int64), np.array(b, np.int64)


class Aligner:
    """Alignments of texts, with a bounded memory of the chunks between blanks.

    Both tokenizers begin a token at each blank between visible characters and read on from there alike whatever came
    before, so a text's alignment is that of its chunks, one after the other. Other texts are aligned as a whole.
    """

    #: groups of ids as text, links as 64-bit numbers (A's id in the upper half), counts of A's and B's ids likewise
    Record = tuple[bytes, bytes, int]

    def __init__(self, byte_level: str, pieces: str, groups: bool = True):
        self.own, self.groups = Vocabularies(byte_level, pieces), groups
        self.known: dict[str, Aligner.Record | None] = {}
        self.older: dict[str, Aligner.Record | None] = {}

    def _cut(self, a: np.ndarray, b: np.ndarray):
        """Ends of the groups in bytes and in A's and B's ids, the groups as text, and their links."""
        ends_a, ends_b = np.cumsum(self.own.sizes_a[a]), np.cumsum(self.own.sizes_b[b])
        ends, last_a, last_b = np.intersect1d(ends_a, ends_b, assume_unique=True, return_indices=True)
        names_a, names_b = (list(map(str, ids.tolist())) if self.groups else [] for ids in (a, b))
        groups, x, y = [], 0, 0
        for i, j in zip((last_a + 1).tolist(), (last_b + 1).tolist()) if self.groups else ():
            groups.append(f"{names_a[x] if i - x == 1 else ','.join(names_a[x:i])}|{names_b[y] if j - y == 1 else ','.join(names_b[y:j])}")
            x, y = i, j
        links = a[last_a].astype(np.uint64) << np.uint64(32) | b[last_b].astype(np.uint64)
        return ends, last_a + 1, last_b + 1, groups, links

    def whole(self, text: str) -> Record | None:
        ids = self.own.encoded(text) if text else None
        if ids is None:
            return None
        *_, groups, links = self._cut(*ids)
        return ";".join(groups).encode(), links.tobytes(), len(ids[0]) << 32 | len(ids[1])

    def _learn(self, new: list[str]) -> None:
        """Aligns chunks as one text, since a call costs more than a chunk, and parts it at their ends. A chunk whose
        bytes a tokenizer does not keep is found by halving."""
        for start in range(0, len(new), _LEARNED):
            part = new[start : start + _LEARNED]
            ids = self.own.encoded(" ".join(part))
            if ids is not None:
                ends, upto_a, upto_b, groups, links = self._cut(*ids)
                wanted = np.cumsum([len(chunk.encode()) + 1 for chunk in part])
                at = np.searchsorted(ends, wanted)
            if ids is None or not (ends[at] == wanted).all():
                if len(part) == 1:
                    self.known[part[0]] = None
                else:
                    self._learn(part[: len(part) // 2])
                    self._learn(part[len(part) // 2 :])
                continue
            packed, g, x, y = links.tobytes(), 0, 0, 0
            for chunk, to, i, j in zip(part, (at + 1).tolist(), upto_a[at].tolist(), upto_b[at].tolist()):
                self.known[chunk] = ";".join(groups[g:to]).encode(), packed[8 * g : 8 * to], i - x << 32 | j - y
                g, x, y = to, i, j

    def of(self, texts: list[str | None]) -> list[Record | None]:
        """The alignment of each text; none of null and empty ones and where bytes are not kept."""
        if not self.own.parted:
            return [self.whole(text or "") for text in texts]
        if len(self.known) > CACHE_ENTRIES:
            self.known, self.older = {}, self.known
        known = self.known
        split = [text.split(" ") if text else [] for text in texts]
        new = set().union(*split).difference(known)
        again = new.intersection(self.older)
        known.update((chunk, self.older[chunk]) for chunk in again)
        new -= again
        odd = {chunk for chunk in new if not chunk or chunk[0].isspace()}
        known.update(dict.fromkeys(odd))
        self._learn(list(new - odd))
        found = []
        for text, parts in zip(texts, split):
            records = list(map(known.__getitem__, parts))
            if None in records:
                found.append(self.whole(text))
            elif records:
                groups, links, counts = zip(*records)
                found.append((b";".join(groups), b"".join(links), sum(counts)))
            else:
                found.append(None)
        return found


_ALIGNERS: dict[tuple[str, str, bool], Aligner] = {}


def aligner(byte_level: str, pieces: str, groups: bool = True) -> Aligner:
    """One per worker process, so that its memory lasts. Without ``groups`` records have no text of them."""
    at = (byte_level, pieces, groups)
    if at not in _ALIGNERS:
        _ALIGNERS.clear()
        _ALIGNERS[at] = Aligner(*at)
    return _ALIGNERS[at]


# --- minimal perfect hash ------------------------------------------------------------------------

_BUCKETS = 256
_STEP = np.uint64(0x9E3779B97F4A7C15)
_PER_GROUP = 4


def buckets_of(keys: np.ndarray) -> np.ndarray:
    return (words.mixed(keys) >> np.uint64(56)).astype(np.int32)


def _group(keys: np.ndarray, groups: np.ndarray | int) -> np.ndarray:
    return ((words.mixed(keys) >> np.uint64(16) & _LOW) % np.asarray(groups, np.uint64)).astype(np.int64)


def _place(keys: np.ndarray, pilot: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    return (words.mixed(keys + (pilot.astype(np.uint64) + np.uint64(1)) * _STEP) % np.asarray(size, np.uint64)).astype(np.int64)


def hash_bucket(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(keys in the order of their places, pilot of each group) of the distinct keys of a bucket.

    Keys fall into groups of four on average. Groups are placed from the largest on, each with the least pilot that
    puts all its keys on free places; there are as many places as keys.
    """
    size = len(keys)
    count = max(1, size // _PER_GROUP)
    group = _group(keys, count)
    order = np.argsort(group, kind="stable")
    starts = np.searchsorted(group[order], np.arange(count + 1))
    placed, used, pilots = np.zeros(size, np.uint64), np.zeros(size, bool), np.zeros(count, np.uint32)
    for g in np.argsort(-np.diff(starts), kind="stable"):
        own = keys[order[starts[g] : starts[g + 1]]]
        first, tries = 0, 16
        while len(own):
            pilot = np.arange(first, first + tries)
            place = _place(own[None, :], pilot[:, None], size)
            row = np.sort(place, axis=1)
            good = ~used[place].any(axis=1) & (row[:, 1:] != row[:, :-1]).all(axis=1)
            if good.any():
                best = int(good.argmax())
                pilots[g], used[place[best]], placed[place[best]] = pilot[best], True, own
                break
            first, tries = first + tries, min(4096, tries * 4)
    return placed, pilots


class PerfectHash:
    """Distinct 64-bit keys to 0, 1, 2, ... without gaps, from the ``hash_bucket`` of each bucket."""

    def __init__(self, buckets: dict[int, tuple[np.ndarray, np.ndarray]]):
        empty = np.zeros(0, np.uint64), np.zeros(0, np.uint32)
        parts = [buckets.get(b, empty) for b in range(_BUCKETS)]
        self.sizes, self.groups = (np.array([len(p[i]) for p in parts]) for i in (0, 1))
        self.first, self.first_group = (np.cumsum(s) - s for s in (self.sizes, self.groups))
        self.keys, self.pilots = (np.concatenate([p[i] for p in parts]) for i in (0, 1))

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, verified with the key stored there; -1 for others."""
        found = np.full(len(keys), -1)
        bucket = buckets_of(keys)
        there = np.flatnonzero(self.sizes[bucket])
        bucket, own = bucket[there], keys[there]
        pilot = self.pilots[self.first_group[bucket] + _group(own, self.groups[bucket])]
        at = self.first[bucket] + _place(own, pilot, self.sizes[bucket])
        found[there] = np.where(self.keys[at] == own, at, -1)
        return found


class Linked:
    """The linked pairs of a corpus and their counts, by the place that the perfect hash gives a pair."""

    def __init__(self, places: PerfectHash, counts: np.ndarray):
        self.places, self.counts = places, counts
        second = (places.keys & _LOW).astype(np.int64)
        most = np.zeros(int(second.max(initial=-1)) + 1, np.int64)
        np.maximum.at(most, second, counts)
        self.best = counts == most[second]

    def of(self, keys: np.ndarray) -> np.ndarray:
        at = self.places.find(keys)
        if (at < 0).any():
            raise ValueError("a text was aligned otherwise than before: its table must not change between two reads")
        return at


_PIECE = 1 << 16


def _tree_sum(vectors: DataFrame, branches: int, fan: int = 32) -> DataFrame:
    """(branch, piece, data) summed over the branches, ``fan`` at a time, level by level."""

    def added(table: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(data.as_py(), np.int64) for data in table.column("data"))
        head = [table.column(c).combine_chunks()[:1] for c in ("branch", "piece")]
        return pa.Table.from_arrays([*head, pa.array([total.tobytes()], pa.binary())], names=["branch", "piece", "data"])

    while True:
        branches = -(-branches // fan)
        vectors = (
            vectors.withColumn("branch", F.floor(F.col("branch") / fan).cast("int"))
            .groupBy("branch", "piece")
            .applyInArrow(added, "branch int, piece int, data binary")
        )
        if branches <= 1:
            return vectors


def linked_pairs(df: DataFrame, byte_level: str, pieces: str, text: str = "text") -> Linked:
    """Counts of all linked pairs of ``df``. The vocabularies bound the number of pairs whatever the corpus
    (``Vocabularies.pair_bound``), and with it the hash, each count vector and what is broadcast."""
    bound = Vocabularies(byte_level, pieces).pair_bound()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = aligner(byte_level, pieces, groups=False)
        keys, total = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        held, waiting = [], 0

        def merged() -> tuple[np.ndarray, np.ndarray]:
            new, n = np.unique(np.frombuffer(b"".join(held), np.uint64), return_counts=True)
            both, at = np.unique(np.concatenate([keys, new]), return_inverse=True)
            result = np.zeros(len(both), np.int64)
            np.add.at(result, at, np.concatenate([total, n]))
            return both, result

        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                for record in own.of(batch.column(0).slice(begin, 256).to_pylist()):
                    if record:
                        held.append(record[1])
                        waiting += len(record[1])
                if waiting > 16_000_000:
                    keys, total = merged()
                    held, waiting = [], 0
        keys, total = merged()
        for start in range(0, len(keys), 100_000):
            part = keys[start : start + 100_000]
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets_of(part)), pa.array(words.signed(part)), pa.array(total[start : start + 100_000])],
                names=["bucket", "pair", "n"],
            )

    counted = stored(df.select(text).mapInArrow(count, "bucket int, pair long, n long"), "pairs")

    def build(table: pa.Table) -> pa.Table:
        keys, pilots = hash_bucket(table.column("pair").to_numpy().view(np.uint64))
        return pa.Table.from_arrays(
            [table.column("bucket").combine_chunks()[:1], *(pa.array([x.tobytes()], pa.binary()) for x in (keys, pilots))],
            names=["bucket", "keys", "pilots"],
        )

    buckets = (
        counted.select("bucket", "pair").distinct().groupBy("bucket").applyInArrow(build, "bucket int, keys binary, pilots binary").toArrow()
    )
    places = PerfectHash(
        {b: (np.frombuffer(k, np.uint64), np.frombuffer(p, np.uint32)) for b, k, p in zip(*(c.to_pylist() for c in buckets.columns))}
    )
    size = len(places.keys)
    if size > bound:
        raise AssertionError(f"{size} pairs, but the vocabularies allow {bound}")
    sent = df.sparkSession.sparkContext.broadcast(places)

    def dense(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            at = sent.value.find(batch.column(0).to_numpy().view(np.uint64))
            np.add.at(total, at, batch.column(1).to_numpy())
        for piece in range(-(-size // _PIECE)):
            data = total[piece * _PIECE : (piece + 1) * _PIECE].tobytes()
            yield pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()], pa.int32()), pa.array([piece], pa.int32()), pa.array([data], pa.binary())],
                names=["branch", "piece", "data"],
            )

    read = counted.select("pair", "n")
    vectors = read.mapInArrow(dense, "branch int, piece int, data binary")
    summed = _tree_sum(vectors, max(1, read.rdd.getNumPartitions())).select("piece", "data").toArrow()
    counts = np.frombuffer(b"".join(data for _, data in sorted(zip(*(c.to_pylist() for c in summed.columns)))), np.int64)
    dropped(counted)
    return Linked(places, counts)


def pair_counts(df: DataFrame, byte_level: str, pieces: str, text: str = "text") -> DataFrame:
    """(a_id, b_id, n): how often a token of A and one of B end at the same byte, over all texts of ``df``."""
    found = linked_pairs(df, byte_level, pieces, text)
    keys = found.places.keys
    table = pa.table({"a_id": pa.array((keys >> np.uint64(32)).astype(np.int32)), "b_id": pa.array((keys & _LOW).astype(np.int32)), "n": pa.array(found.counts)})
    return df.sparkSession.createDataFrame(table)


def aligned(df: DataFrame, byte_level: str, pieces: str, text: str = "text", groups: bool = True) -> DataFrame:
    """``df`` without ``text``, with ``n_a`` and ``n_b`` (ids), ``n_groups``, ``n_links``, ``n_best`` (links whose
    count is the highest of their B id in the corpus, ties included), ``count_sum`` (over links), ``groups_sha256``
    and, where asked for, ``groups`` (``a1,a2|b1;a3|b2,b3``).

    A reads blank + text; B adds the blank itself. Byte offsets at which tokens of both end cut them into groups, and
    the two tokens that end there are linked; a pair's count is how often it is linked in all of ``df``. Null and
    empty texts and those whose bytes a tokenizer changes have no tokens, no groups and no digest ('').

    Equal texts have equal rows, each counts; long texts are aligned whole; an empty table stays empty. The texts are
    read twice and never shuffled. Input columns with an added column's name are replaced.
    """
    numbers = ("n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum")
    added = [*numbers, "groups_sha256", "groups"]
    kept = others(df, text, *added)
    source = df.select(*cols(kept), F.col(text).alias(free(df, "_text")))
    schema = df.select(
        *cols(kept), *(F.lit(0).cast("long").alias(c) for c in numbers), *(F.lit("").alias(c) for c in added[6 : 8 if groups else 7])
    ).schema
    sent = df.sparkSession.sparkContext.broadcast(linked_pairs(df, byte_level, pieces, text))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, corpus = aligner(byte_level, pieces), sent.value
        for batch in batches:
            for begin in range(0, batch.num_rows, 256):
                part = batch.slice(begin, 256)
                records = own.of(part.column(part.num_columns - 1).to_pylist())
                links = [record[1] if record else b"" for record in records]
                at = corpus.of(np.frombuffer(b"".join(links), np.uint64))
                sizes = np.array([len(x) // 8 for x in links])
                ends = np.cumsum(sizes)
                sums = [np.concatenate([[0], np.cumsum(v[at])]) for v in (corpus.best, corpus.counts)]
                n_best, count_sum = (s[ends] - s[ends - sizes] for s in sums)
                counts = [record[2] if record else 0 for record in records]
                made = [pa.array([n >> 32 for n in counts], pa.int64()), pa.array([n & 0xFFFFFFFF for n in counts], pa.int64())]
                made += [pa.array(v.astype(np.int64)) for v in (sizes, sizes, n_best, count_sum)]
                made.append(pa.array([hashlib.sha256(r[0]).hexdigest() if r else "" for r in records], pa.string()))
                if groups:
                    made.append(pa.array([r[0].decode() if r else "" for r in records], pa.string()))
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], *made], names=schema.names)

    return source.mapInArrow(run, schema)
