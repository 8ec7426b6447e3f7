"""Best-fit packing of token pieces into fixed-size sequences, by hierarchical merging of underfull bins."""

from __future__ import annotations

import array
import os
import string
import zlib
from collections.abc import Callable, Iterable, Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from parcelspark.llm.common import cols, dropped, free, others, remembered, stored

# Chunks of text that a worker keeps with their ids; a full cache keeps half of them: those just met again, then the oldest.
CACHE_ENTRIES = 700_000

# Bytes of text that are encoded at once, but for a longer text.
PART_BYTES = 4 << 20

# What may stand behind a word, and the last character that words which end before it are looked for with: all tables of
# Unicode agree on what is a letter up to there.
_MARKS = string.punctuation
_LETTERS = "\u024f"

_PLACE = ["sequence_id", "offset"]

# What a Python worker does with a task's batches.
Step = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


class Chunks:
    """A byte-level tokenizer of the ``tokenizers`` library with a bounded memory of what it has encoded.

    Its splitting pattern starts a piece at each blank before a visible character, so a text is the sequence of its
    chunks from one such blank to the next. Texts with other blanks are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.known: dict[str, bytes] = {}  # no bytes: a chunk whose ids depend on what is around it
        self.marks: dict[str, bytes] = {}
        vocabulary = self.tokenizer.get_vocab()
        self.blank = np.zeros(max(vocabulary.values()) + 1, bool)
        for token, number in vocabulary.items():
            self.blank[number] = token.startswith("\u0120")  # what a byte-level token has for a blank

    def _encoded(self, texts: list[str], at_once: int = 16) -> list[bytes]:
        """Few at once, since the library holds some hundred bytes a token of them."""
        found = []
        for start in range(0, len(texts), at_once):
            part = self.tokenizer.encode_batch_fast(texts[start : start + at_once], add_special_tokens=False)
            found += [array.array("I", one.ids).tobytes() for one in part]
        return found

    def _behind_blanks(self, chunks: list[str]) -> list[bytes]:
        """Ids of chunks, encoded as one text, since a call costs more than a chunk, and parted at the blanks before them."""
        found = []
        for start in range(0, len(chunks), 4096):
            part = chunks[start : start + 4096]
            ids = np.array(self.tokenizer.encode_batch_fast([" " + " ".join(part)], add_special_tokens=False)[0].ids, "<u4")
            packed, begins = ids.tobytes(), (4 * np.flatnonzero(self.blank[ids])).tolist()
            found += [packed[begin:end] for begin, end in zip(begins, [*begins[1:], len(packed)])]
        return found

    def _with_marks(self, chunk: str) -> bytes | None:
        """Ids of a known word and the marks behind it: the pattern ends a piece between a letter or digit and a mark."""
        word = chunk.rstrip(_MARKS)
        if not 0 < len(chunk) - len(word) <= 16 or not word or word[-1] > _LETTERS or not word[-1].isalnum():
            return None
        ids = self.known.get(word)
        if not ids:
            return None
        marks = chunk[len(word) :]
        if marks not in self.marks:
            if len(self.marks) >= 10_000:
                self.marks.clear()
            self.marks[marks] = self._encoded([marks])[0]
        return ids + self.marks[marks]

    def _learned(self, new: list[str]) -> list[bytes]:
        found = [
            b"" if not chunk or chunk[0].isspace() else self._with_marks(chunk) if chunk[-1] in _MARKS else None for chunk in new
        ]
        rest = iter(self._behind_blanks([chunk for chunk, ids in zip(new, found) if ids is None]))
        found = [next(rest) if ids is None else ids for ids in found]
        self.known.update(zip(new, found))
        return found

    def _ids_of(self, chunks: list[str]) -> list[bytes]:
        """Ids of unlike chunks."""
        if len(self.known) > CACHE_ENTRIES:
            kept = {chunk: self.known[chunk] for chunk in chunks if chunk in self.known}
            for chunk, ids in islice(self.known.items(), CACHE_ENTRIES // 2):
                kept.setdefault(chunk, ids)
            self.known = dict(islice(kept.items(), CACHE_ENTRIES // 2))
        found = list(map(self.known.get, chunks))
        new = iter(self._learned([chunk for chunk, ids in zip(chunks, found) if ids is None]))
        return [next(new) if ids is None else ids for ids in found]

    def encode(self, texts: list[str] | pa.Array) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers. Arrow parts the chunks, tells them apart and puts their
        ids in place, so Python handles each unlike chunk of a call once."""
        column = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        split = pc.split_pattern(column, " ")
        at, parts = split.offsets.to_numpy(), split.values
        heads = parts.take(pa.array(at[:-1])).to_pylist()
        inner = np.ones(len(parts), bool)
        inner[at[:-1]] = False
        rest = parts.filter(pa.array(inner)).dictionary_encode()
        upto = at - np.arange(len(at))  # where a text's chunks begin in ``rest``
        del split, parts, inner
        ids_of = pa.array(self._ids_of(rest.dictionary.to_numpy(zero_copy_only=False).tolist()), pa.large_binary())
        packed = ids_of.take(rest.indices)
        sizes = pc.binary_length(packed).to_numpy()
        # Texts that are encoded as a whole: those with an odd chunk, or a first one that the next blank may belong to.
        whole = set((np.searchsorted(upto, np.flatnonzero(sizes == 0), "right") - 1).tolist())
        whole.update(row for row, head in enumerate(heads) if (not head and upto[row] < upto[row + 1]) or head[-1:].isspace())
        firsts = self._encoded(["" if row in whole else head for row, head in enumerate(heads)])
        for row in whole:
            firsts[row] = self._encoded([column[row].as_py()])[0]
        ends = np.concatenate([[0], np.cumsum(sizes)])[upto].tolist()
        data = memoryview(packed.buffers()[2] or b"")
        return [
            first if row in whole else first + data[ends[row] : ends[row + 1]] for row, first in enumerate(firsts)
        ]


def chunks(path: str) -> Chunks:
    """One per worker process, so that its memory lasts until another operator that asks for memory has the worker."""
    own = remembered("packing")
    if path not in own:
        own[path] = Chunks(path)
    return own[path]


def parts(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """A batch in parts of ``PART_BYTES`` of the texts in its last column; a longer text is a part of its own."""
    upto, begin = np.cumsum(pc.binary_length(batch.column(batch.num_columns - 1)).to_numpy(), dtype=np.int64), 0
    while begin < batch.num_rows:
        done = upto[begin - 1] if begin else 0
        end = max(begin + 1, int(np.searchsorted(upto, done + PART_BYTES, "right")))
        yield batch.slice(begin, end - begin)
        begin = end


def cut(length: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document: one if it fits, else full ones after a first one with the rest."""
    first = length if length <= capacity else length % capacity or capacity
    return [(0, first)] + [(start, capacity) for start in range(first, length, capacity)]


def tokenized(
    df: DataFrame, tokenizer: str, capacity: int, text: str = "text", end_id: int = 0, ids: bool = True
) -> DataFrame:
    """A row per piece: the columns of ``df`` but ``text``, then ``piece`` (from 0), ``start``, ``length``,
    ``ids_crc32`` and, where asked for, ``ids`` (array of int).

    A document's ids are those of its text followed by ``end_id``; a null text is an empty one. Documents longer
    than ``capacity`` ids are cut, others stay whole. Strings of special tokens in a text are ordinary text.
    No shuffle. Input columns with an added column's name are replaced.
    """
    source, run, schema = _tokenizing(df, tokenizer, capacity, text, end_id, ids)
    return source.mapInArrow(run, schema)


def _tokenizing(
    df: DataFrame, tokenizer: str, capacity: int, text: str, end_id: int, ids: bool, left_out: Iterable[str] = ()
) -> tuple[DataFrame, Step, StructType]:
    """The rows that ``tokenized`` hands to Python workers, what these do with them, and the columns of the result."""
    added = ["piece", "start", "length", "ids_crc32", "ids"]
    kept = others(df, text, *added, *left_out)
    source = df.select(*cols(kept), F.coalesce(F.col(text), F.lit("")).alias(free(df, "_text")))
    schema = df.select(
        *cols(kept),
        F.lit(0).alias("piece"),
        *(F.lit(0).cast("long").alias(c) for c in added[1:4]),
        *([F.lit(None).cast("array<int>").alias("ids")] if ids else []),
    ).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, end = chunks(tokenizer), array.array("I", [end_id]).tobytes()
        for batch in batches:
            for part in parts(batch):
                rows, piece, start, length, crc, values = [], [], [], [], [], []
                for row, packed in enumerate(own.encode(part.column(part.num_columns - 1))):
                    packed += end
                    for number, (at, size) in enumerate(cut(len(packed) // 4, capacity)):
                        data = packed[4 * at : 4 * (at + size)]
                        rows.append(row)
                        piece.append(number)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(data))
                        if ids:
                            values.append(array.array("I", data).tolist())
                made = [pa.array(piece, pa.int32()), *(pa.array(v, pa.int64()) for v in (start, length, crc))]
                if ids:
                    made.append(pa.array(values, pa.list_(pa.int32())))
                taken = [part.column(i).take(pa.array(rows, pa.int32())) for i in range(part.num_columns - 1)]
                yield pa.RecordBatch.from_arrays(taken + made, names=schema.names)

    return source, run, schema


def best_fit(sizes: list[int], capacity: int) -> tuple[list[int], list[int], list[int]]:
    """For each item its bin and place there, and the fill of each bin: largest items first, each into the fullest
    bin that still has room. Open bins are found by their room in a bit set, so an item costs no search."""
    bin_of, place, fills = [0] * len(sizes), [0] * len(sizes), []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0
    for item in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        size = sizes[item]
        enough = rooms >> size
        if enough:
            room = size + (enough & -enough).bit_length() - 1
            target = by_room[room].pop()
            if not by_room[room]:
                rooms ^= 1 << room
        else:
            target, room = len(fills), capacity
            fills.append(0)
        bin_of[item], place[item] = target, fills[target]
        fills[target] += size
        room -= size
        if room:
            by_room[room].append(target)
            rooms |= 1 << room
    return bin_of, place, fills


def packed(
    pieces: DataFrame, capacity: int, full: float = 0.98, local: int = 16_384, group: int = 8_192
) -> DataFrame:
    """``pieces`` with ``sequence_id`` and ``offset``: bins of ``capacity``, each filled without gap from 0.

    First each task packs its own rows, ``local`` at a time, with no shuffle, and the result is written to the shared
    folder. Bins filled to ``full`` are done. The others become items themselves: they are dealt to groups of about
    ``group``, packed by best fit again, and so on over ever fewer groups until one group is left or a round joins
    hardly any (then what is left is all larger than the room beside it). Only (bin, fill) travels, never a piece.
    ``length`` must lie between 1 and ``capacity``. An empty table stays empty; input columns named like an added
    column are replaced.
    """
    source = pieces.select(*cols(others(pieces, *_PLACE)))
    run, schema = _placing(source.schema, capacity, local)
    return _merged(stored(source.mapInArrow(run, schema), "pieces"), capacity, full, group)


def tokenized_and_packed(
    df: DataFrame, tokenizer: str, capacity: int, text: str = "text", end_id: int = 0, ids: bool = True,
    full: float = 0.98, local: int = 16_384, group: int = 8_192,
) -> DataFrame:
    """``packed(tokenized(df))``, where one Python worker does both with a task's rows. Two operators in a row take two
    workers a task, and Spark keeps both for what comes next, so an executor would hold twice as many."""
    source, tokenize, pieces = _tokenizing(df, tokenizer, capacity, text, end_id, ids, _PLACE)
    place, schema = _placing(pieces, capacity, local)
    made = source.mapInArrow(lambda batches: place(tokenize(batches)), schema)
    return _merged(stored(made, "pieces"), capacity, full, group)


def _placing(pieces: StructType, capacity: int, local: int) -> tuple[Step, StructType]:
    """The first step of ``packed``, within a task, and the columns of its result."""
    schema = StructType(list(pieces.fields))
    for name in _PLACE:
        schema.add(name, "long", False)
    at = pieces.names.index("length")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, waiting, rows = TaskContext.get().partitionId() << 40, [], 0

        def flush() -> pa.Table:
            table = pa.Table.from_batches(waiting)
            bins, places, fills = best_fit(table.column(at).to_pylist(), capacity)
            numbers = pa.array([base + b for b in bins], pa.int64())
            return len(fills), table.append_column("sequence_id", numbers).append_column(
                "offset", pa.array(places, pa.int64())
            )

        for batch in batches:
            for start in range(0, batch.num_rows, local):
                part = batch.slice(start, local)
                if rows + part.num_rows > local:
                    used, table = flush()
                    yield from table.to_batches()
                    base, waiting, rows = base + used, [], 0
                waiting.append(part)
                rows += part.num_rows
        if rows:
            yield from flush()[1].to_batches()

    return run, schema


def _merged(local_bins: DataFrame, capacity: int, full: float, group: int) -> DataFrame:
    """``local_bins`` with underfull bins merged, as ``packed`` says."""
    kept = others(local_bins, *_PLACE)
    items = stored(
        local_bins.groupBy(F.col("sequence_id").alias("bin"))
        .agg(F.sum("length").alias("fill"))
        .where(F.col("fill") < int(full * capacity)),
        "bins",
    )
    moved = None
    count = items.count()
    while count > 1:
        groups = -(-count // group)

        def merge(bins: pd.DataFrame) -> pd.DataFrame:
            bins = bins.sort_values(["fill", "bin"], ascending=[False, True])
            found, place, fills = best_fit(bins.fill.tolist(), capacity)
            first = dict(reversed(list(zip(found, bins.bin.tolist()))))
            return pd.DataFrame(
                {
                    "bin": bins.bin.to_numpy(),
                    "parent": [first[b] for b in found],
                    "shift": place,
                    "fill": [fills[b] for b in found],
                }
            )

        merged = stored(
            items.groupBy(F.pmod(F.xxhash64("bin", F.lit(groups)), F.lit(groups)))
            .applyInPandas(merge, "bin long, parent long, shift long, fill long"),
            "merged",
        )
        round_moves = merged.where("bin <> parent").select("bin", "parent", "shift")
        if moved is None:
            moved = round_moves
        else:
            after = round_moves.select(F.col("bin").alias("parent"), F.col("parent").alias("p"), F.col("shift").alias("s"))
            moved = (
                moved.join(after, "parent", "left")
                .select("bin", F.coalesce("p", "parent").alias("parent"), (F.col("shift") + F.coalesce("s", F.lit(0))).alias("shift"))
                .union(round_moves)
            )
        following = stored(
            merged.where("bin = parent").where(F.col("fill") < int(full * capacity)).select("bin", "fill"), "bins"
        )
        left = following.count()
        dropped(items)
        items = following
        if groups == 1 or left > 0.95 * count:
            break
        count = left
    if moved is None:
        return local_bins
    start, target, shift = (free(local_bins, c) for c in ("_bin", "_parent", "_shift"))
    moves = moved.select(F.col("bin").alias(start), F.col("parent").alias(target), F.col("shift").alias(shift))
    return local_bins.join(moves, F.col("sequence_id") == F.col(start), "left").select(
        *cols(kept),
        F.coalesce(target, "sequence_id").alias("sequence_id"),
        (F.col("offset") + F.coalesce(shift, F.lit(0))).alias("offset"),
    )
