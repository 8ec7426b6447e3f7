from __future__ import annotations

import array
import random
import zlib

import public_tokenizers
import pyarrow as pa
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from parcelspark.llm import packing
from parcelspark.llm.queries import pack_documents

PATH = public_tokenizers.path("byte_bpe_50k.json")


def test_chunks_give_the_library_s_ids():
    own, library = packing.Chunks(PATH), Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    draw = random.Random(1)
    odd = ["a", " ", "  ", "\n", " \n", "thing", "é", "12", "'s", "\t", "<|endoftext|>", "日本", " b", "\x85", "　"]
    texts = ["".join(draw.choice(odd) for _ in range(draw.randrange(12))) for _ in range(800)]
    for text, packed in zip(texts, own.encode(texts)):
        assert array.array("I", packed).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_a_full_cache_keeps_what_came_first(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 6)
    own, library = packing.Chunks(PATH), Tokenizer.from_file(PATH)
    texts = ["a b c", "a d e f  g", "", " h i j k", "b c l\u3000m n o p q", "a b z"]
    for text in texts * 2:
        packed = own.encode([text])[0]
        assert array.array("I", packed).tolist() == library.encode(text, add_special_tokens=False).ids, text
    assert set(list(own.known)[:2]) == {"b", "c"}


class Counted:
    """A tokenizer that lists what it was asked for."""

    def __init__(self, tokenizer):
        self.tokenizer, self.asked = tokenizer, []

    def encode_batch_fast(self, texts, add_special_tokens):
        self.asked += texts
        return self.tokenizer.encode_batch_fast(texts, add_special_tokens=add_special_tokens)


def test_marks_behind_a_known_word_do_not_encode_it_again():
    own = packing.Chunks(PATH)
    own.encode(["a word and étude"])
    library = own.tokenizer
    own.tokenizer = Counted(library)
    texts = ["a word, word. étude) étude!!", "word and. word", "a word, étude."]
    for text, packed in zip(texts, own.encode(texts)):
        assert array.array("I", packed).tolist() == library.encode(text, add_special_tokens=False).ids
    assert not [asked for asked in own.tokenizer.asked if " word" in asked or "tude" in asked]  # before, all but " word"


def test_a_full_cache_keeps_what_is_met_again(monkeypatch):
    monkeypatch.setattr(packing, "CACHE_ENTRIES", 6)
    own = packing.Chunks(PATH)
    own.encode(["x one two three four five six seven"])
    own.tokenizer = Counted(own.tokenizer)
    own.encode(["x six seven new"])
    assert own.tokenizer.asked == [" new", "x"]  # before, the first third alone was kept
    assert set(own.known) == {"six", "seven", "one", "new"}


def test_letters_marks_and_blanks_give_the_library_s_ids():
    own, library = packing.Chunks(PATH), Tokenizer.from_file(PATH)
    library.encode_special_tokens = True
    for c in map(chr, [*range(1, 0x300), 0x85, 0x2028, 0x3000, 0xFEFF, 0x1F600]):
        texts = [f"w x{c} x{c}. x{c}.' {c} {c}, {c}!?s {c}1) 1{c}", f"w x{c}, x{c}\". x{c}\n. {c}s {c}s's {c}s' {c}' {c}''s"]
        for text, packed in zip(texts, own.encode(pa.array(texts))):
            assert array.array("I", packed).tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_parts_are_bounded_by_the_bytes_of_texts(monkeypatch):
    monkeypatch.setattr(packing, "PART_BYTES", 10)
    texts = ["", "é" * 4, "x", "y" * 30, "", "z" * 10, "a"]
    batch = pa.RecordBatch.from_arrays([pa.array(range(7)), pa.array(texts)], names=["doc_id", "text"])
    assert [part.column(0).to_pylist() for part in packing.parts(batch)] == [[0, 1, 2], [3], [4, 5], [6]]
    assert not list(packing.parts(batch.slice(0, 0)))
    own = packing.Chunks(PATH)
    found = [ids for part in packing.parts(batch) for ids in own.encode(part.column(1))]
    assert found == own.encode(texts) and found[0] == b"" and own.encode([]) == []


def test_cut_leaves_the_rest_in_front():
    assert packing.cut(5, 8) == [(0, 5)] and packing.cut(8, 8) == [(0, 8)]
    assert packing.cut(17, 8) == [(0, 1), (1, 8), (9, 8)] and packing.cut(16, 8) == [(0, 8), (8, 8)]


def test_best_fit_fills_bins_without_overlap():
    draw = random.Random(2)
    for _ in range(100):
        sizes = [draw.randrange(1, 21) for _ in range(draw.randrange(60))]
        bins, places, fills = packing.best_fit(sizes, 20)
        taken = {}
        for size, b, place in zip(sizes, bins, places):
            for unit in range(place, place + size):
                assert (b, unit) not in taken
                taken[b, unit] = True
        assert all(0 < f <= 20 for f in fills) and sum(fills) == sum(sizes)


def check(found, capacity):
    assert sum(found.length) == found.length.sum()
    ordered = found.sort_values(["sequence_id", "offset"])
    ends = ordered.offset + ordered.length
    assert (ends.groupby(ordered.sequence_id).shift(fill_value=0) == ordered.offset).all()
    assert ends.max() <= capacity


def test_rounds_join_underfull_bins_of_many_tasks(spark):
    df = spark.range(4000).select("id", (F.pmod(F.xxhash64("id"), F.lit(60)) + 1).alias("length"), F.lit(9).alias("Offset"))
    found = packing.packed(df.repartition(40), 100, local=20, group=16).toPandas()
    assert len(found) == 4000 and set(found.id) == set(range(4000))
    check(found, 100)
    assert found.sequence_id.nunique() <= 1.05 * found.length.sum() / 100


def test_items_that_never_join_end_the_rounds(spark):
    found = packing.packed(spark.range(300).select("id", F.lit(60).alias("length")), 100, local=8, group=16).toPandas()
    assert found.sequence_id.nunique() == 300


def test_nulls_empty_long_and_repeats(spark):
    long = "some words here " * 3000
    rows = [(1, None), (2, ""), (2, ""), (3, long), (None, "x")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    pieces = packing.tokenized(df, PATH, 64)
    found = packing.packed(pieces, 64).toPandas()
    check(found, 64)
    assert found[found.doc_id == 1].length.tolist() == [1] and found[found.doc_id == 2].length.tolist() == [1, 1]
    of = found[found.doc_id == 3].sort_values("piece")
    ids = [i for part in of["ids"] for i in part]
    assert ids == Tokenizer.from_file(PATH).encode(long, add_special_tokens=False).ids + [0]
    assert (of.length[1:] == 64).all()
    assert all(zlib.crc32(array.array("I", list(r["ids"])).tobytes()) == r.ids_crc32 for _, r in of.iterrows())
    assert packing.packed(packing.tokenized(df.limit(0), PATH, 64), 64).count() == 0


def test_one_worker_tokenizes_and_packs(spark, monkeypatch):
    long = "some words here " * 300
    rows = [(i, f"text {i} " * (i % 30), 7) for i in range(200)] + [(200, None, 7), (201, long, 7), (None, "x", 7), (5, "y", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, Offset int").repartition(3, "doc_id")
    plans, stored = [], packing.stored

    def seen(made, name):
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return stored(made, name)

    monkeypatch.setattr(packing, "stored", seen)
    found = packing.tokenized_and_packed(df, PATH, 64, local=50, group=16)
    assert plans[0].count("MapInArrow") == 1  # before, two operators took two workers of each task
    apart = packing.packed(packing.tokenized(df, PATH, 64), 64, local=50, group=16)
    assert found.columns == apart.columns
    found, apart = found.toPandas(), apart.toPandas()
    check(found, 64)
    assert found.sequence_id.nunique() <= 1.05 * apart.sequence_id.nunique()
    pieces = lambda t: sorted(zip(t.doc_id.fillna(-1), t.piece, t.start, t.length, t.ids_crc32))
    assert pieces(found) == pieces(apart) and len(found) > len(rows)
    assert packing.tokenized_and_packed(df.limit(0), PATH, 64).count() == 0


def test_packing_of_documents_takes_one_worker_a_task(spark, monkeypatch):
    plans, stored = [], packing.stored

    def seen(made, name):
        plans.append(made._jdf.queryExecution().executedPlan().toString())
        return stored(made, name)

    monkeypatch.setattr(packing, "stored", seen)
    found = pack_documents(spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string"))
    assert plans[0].count("MapInArrow") == 1
    assert sorted(found.toPandas().length) == [1, 3]
