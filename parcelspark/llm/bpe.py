"""Byte-level BPE by prefix dynamic programming, exact appends and edits, and decoding.

For a merge table whose tokens are merged by rank, each prefix of a byte string has exactly one token that can end
its encoding: the longest one that is reachable and that stands validly after the last token of the shorter prefix.
So one table entry per byte describes the encodings of all prefixes at once, and an append or an edit only has to
fill the entries behind the first changed byte.
"""

from __future__ import annotations

import array
import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelspark.llm.common import cols, free, others

# Entries that a worker keeps of pieces it has encoded; a full cache is emptied, which costs time only.
CACHE_ENTRIES = 400_000


def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to rank from a file of base64 and rank per line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class Vocabulary:
    """Ranks and what the prefix table needs of them: which tokens are reachable, and which pairs may stand together."""

    def __init__(self, ranks: dict[bytes, int]):
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"no token for single bytes {missing[:5]}")
        self.ranks = ranks
        self.bytes_of = {rank: token for token, rank in ranks.items()}
        self.halves: dict[int, tuple[int, int] | None] = {}
        self.reachable: dict[bytes, int] = {}
        for token, rank in ranks.items():
            parts = self._merged(token, stop=2) if len(token) > 1 else None
            if parts is None:
                self.halves[rank] = None
                self.reachable[token] = rank
            elif len(parts) == 2:
                self.halves[rank] = ranks[parts[0]], ranks[parts[1]]
                self.reachable[token] = rank
        self.longest = max(map(len, self.reachable))
        self.pairs: dict[tuple[int, int], bool] = {}

    def _merged(self, data: bytes, stop: int) -> list[bytes]:
        """Merges the lowest-ranked neighbour pair, the left one of equals, until ``stop`` parts are left or none fits."""
        parts = [data[i : i + 1] for i in range(len(data))]
        ranks = [self.ranks.get(data[i : i + 2]) for i in range(len(data) - 1)]
        while len(parts) > stop:
            fits = [r for r in ranks if r is not None]
            if not fits:
                break
            at = ranks.index(min(fits))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
            del ranks[at]
            if at > 0:
                ranks[at - 1] = self.ranks.get(parts[at - 1] + parts[at])
            if at < len(ranks):
                ranks[at] = self.ranks.get(parts[at] + parts[at + 1])
        return parts

    def may_follow(self, left: int, right: int) -> bool:
        """Whether merging both tokens' bytes yields just these two.

        It does unless, at some stage of building them, the parts that touch would have merged with each other first.
        The stages are visited backwards: of the two parts that touch, the one made last is taken apart, and only a
        merge that would have come before it counts.
        """
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= CACHE_ENTRIES:
                self.pairs.clear()
            known = self.pairs[left, right] = self._stay_apart(left, right)
        return known

    def _stay_apart(self, left: int, right: int) -> bool:
        ranks, bytes_of, halves = self.ranks, self.bytes_of, self.halves
        # A merge across the seam happened if its rank is below that of the next part to be made; at equal
        # ranks the one further left comes first.
        before = len(ranks) + 1
        while True:
            across = ranks.get(bytes_of[left] + bytes_of[right])
            if across is not None and across < before:
                return False
            of_left, of_right = halves[left], halves[right]
            if of_left is None and of_right is None:
                return True
            if of_right is None or (of_left is not None and left > right):
                before, left = left, of_left[1]
            else:
                before, right = right + 1, of_right[0]


class PrefixTable:
    """The last token of every prefix of one piece of text."""

    def __init__(self, vocabulary: Vocabulary, data: bytes = b""):
        self.vocabulary = vocabulary
        self.data = b""
        self.last: list[int] = [-1]
        self.append(data)

    def append(self, more: bytes) -> None:
        """Exactly the table of the longer text; earlier entries stay."""
        self.replace(len(self.data), len(self.data), more)

    def replace(self, start: int, stop: int, by: bytes) -> None:
        """The table of the text with bytes ``start`` to ``stop`` replaced: entries up to ``start`` stay."""
        data = self.data = self.data[:start] + by + self.data[stop:]
        vocabulary, last = self.vocabulary, self.last
        token_at, pairs, longest = vocabulary.reachable.get, vocabulary.pairs.get, vocabulary.longest
        del last[start + 1 :]
        for end in range(start + 1, len(data) + 1):
            for begin in range(max(0, end - longest), end):
                rank = token_at(data[begin:end])
                if rank is None:
                    continue
                if begin == 0:
                    break
                fits = pairs((last[begin], rank))
                if fits is None:
                    fits = vocabulary.may_follow(last[begin], rank)
                if fits:
                    break
            last.append(rank)

    def tokens(self, end: int | None = None) -> list[int]:
        """The encoding of the first ``end`` bytes, of all by default.

        A text that is a token as a whole is that token, also where merging would not reach it.
        """
        end = len(self.data) if end is None else end
        whole = self.vocabulary.ranks.get(self.data[:end])
        if whole is not None:
            return [whole]
        found = []
        while end > 0:
            found.append(self.last[end])
            end -= len(self.vocabulary.bytes_of[self.last[end]])
        return found[::-1]


class _Pieces(dict):
    """Piece of text to its ids as little-endian unsigned 32-bit integers; bounded."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary

    def __missing__(self, piece: str) -> bytes:
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        data = piece.encode()
        whole = self.vocabulary.ranks.get(data)
        ids = [whole] if whole is not None else PrefixTable(self.vocabulary, data).tokens()
        packed = array.array("I", ids).tobytes()
        if len(piece) <= 64:
            self[piece] = packed
        return packed


class _Chunks(dict):
    """A word with what follows it up to the next blank, to its ids; bounded.

    The splitting pattern always starts a piece at a blank before a visible character, so texts can be cut there.
    """

    def __init__(self, codec: Codec):
        self.codec = codec

    def __missing__(self, chunk: str) -> bytes:
        if not chunk or chunk[0].isspace():
            raise _OddBlank
        if len(self) >= CACHE_ENTRIES:
            self.clear()
        packed = b"".join(map(self.codec.pieces.__getitem__, self.codec.split(" " + chunk)))
        if len(chunk) <= 64:
            self[chunk] = packed
        return packed


class _OddBlank(Exception):
    """A blank that does not stand before a visible character."""


class Codec:
    """Texts to ids and back, piece by piece of ``pattern``. Blank means Unicode's White_Space, as in the ranks' home."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.vocabulary = Vocabulary(ranks)
        self.split = regex.compile(pattern).findall
        self.pieces = _Pieces(self.vocabulary)
        self.chunks = _Chunks(self)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        head, *rest = text.split(" ")
        try:
            if rest and head and not head[-1].isspace():
                return b"".join(map(self.pieces.__getitem__, self.split(head))) + b"".join(
                    map(self.chunks.__getitem__, rest)
                )
        except _OddBlank:
            pass
        return b"".join(map(self.pieces.__getitem__, self.split(text)))

    def decode(self, packed: bytes) -> bytes:
        ids = array.array("I")
        ids.frombytes(packed)
        return b"".join(map(self.vocabulary.bytes_of.__getitem__, ids))


_CODECS: dict[tuple[str, str], Codec] = {}


def codec(ranks_path: str, pattern: str) -> Codec:
    """One codec per worker process, so that its caches last."""
    key = ranks_path, pattern
    if key not in _CODECS:
        _CODECS[key] = Codec(load_ranks(ranks_path), pattern)
    return _CODECS[key]


def encoded(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: bool = True) -> DataFrame:
    """``df`` without ``text``, with ``ids`` (array of int; only where asked for), ``n_tokens``, ``ids_sha256`` and
    ``decoded_sha256`` (of the bytes that the ids decode to).

    No shuffle; each task encodes its Arrow batches with one codec per worker. A null text is an empty one and has
    no ids. ``ranks_path`` must exist on every executor. Input columns with an added column's name are replaced.
    """
    kept = others(df, text, "ids", "n_tokens", "ids_sha256", "decoded_sha256")
    source = df.select(*cols(kept), F.coalesce(F.col(text), F.lit("")).alias(free(df, "_text")))
    schema = df.select(
        *cols(kept),
        F.lit(None).cast("array<int>").alias("ids"),
        F.lit(0).cast("long").alias("n_tokens"),
        F.lit("").alias("ids_sha256"),
        F.lit("").alias("decoded_sha256"),
    ).schema
    if not ids:
        schema = type(schema)([f for f in schema if f.name != "ids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks_path, pattern)
        for batch in batches:
            texts, rest = batch.column(batch.num_columns - 1), batch.columns[:-1]
            for start in range(0, batch.num_rows, 256):
                part = texts[start : start + 256]
                packed = [own.encode(value) for value in part.to_pylist()]
                made = [
                    pa.array([len(p) // 4 for p in packed], pa.int64()),
                    pa.array([hashlib.sha256(p).hexdigest() for p in packed]),
                    pa.array([hashlib.sha256(own.decode(p)).hexdigest() for p in packed]),
                ]
                if ids:
                    made.insert(0, pa.array([array.array("I", p).tolist() for p in packed], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(
                    [c[start : start + len(part)] for c in rest] + made, names=schema.names
                )

    return source.mapInArrow(run, schema)


def decoded(df: DataFrame, ranks_path: str, ids: str = "ids", into: str = "text") -> DataFrame:
    """``df`` with ``into``: the text that ``ids`` stand for. Null ids give null; bytes that are no UTF-8 are replaced."""
    kept = others(df, ids, into)
    source = df.select(*cols(kept), F.col(ids).alias(free(df, "_ids")))
    schema = df.select(*cols(kept), F.lit(None).cast("string").alias(into)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = codec(ranks_path, r"\S+").vocabulary.bytes_of
        for batch in batches:
            texts = [
                None if row is None else b"".join(map(tokens.__getitem__, row)).decode(errors="replace")
                for row in batch.column(batch.num_columns - 1).to_pylist()
            ]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(texts, pa.string())], names=schema.names)

    return source.mapInArrow(run, schema)
