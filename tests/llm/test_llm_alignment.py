from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from parcelspark.llm import alignment

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    None, "", " ", "a", "hello  world", "Ünïcode wörds 😀😀 日本語テキスト", "a▁b", "x" * 5000, "tab\tand\nlines\r\n\r\n  indented();\r\n",
    "<|endoftext|> </s> [INST]<s>", "the the the", "hello world", "hello world", " leading", "trailing ", " nbsp　wide", "nul\x00l",
    "don't 12345 I'll;\r\n}", "́combining é", "the\n the \nthe", "<0x0A> literal",
]


@pytest.fixture(scope="module")
def plain():
    """A plain version: whole texts, ends as sets."""
    tokenizer = Tokenizer.from_file(A)
    tokenizer.encode_special_tokens = True
    pieces = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = alignment._byte_of_letter()
    names = {i: t for t, i in tokenizer.get_vocab().items()}

    def piece_bytes(i):
        p = pieces.id_to_piece(i)
        return bytes([int(p[3:5], 16)]) if pieces.is_byte(i) else p.replace("▁", " ").encode()

    def ends(parts):
        return np.cumsum([len(p) for p in parts]).tolist()

    def groups(text):
        if not text:
            return None
        a = tokenizer.encode(" " + text, add_special_tokens=False).ids
        b = pieces.encode(text)
        raw_a = [bytes(letters[c] for c in names[i]) for i in a]
        raw_b = [piece_bytes(i) for i in b]
        whole = (" " + text).encode()
        if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
            return None
        end_a, end_b = ends(raw_a), ends(raw_b)
        made, x, y = [], 0, 0
        for end in sorted(set(end_a) & set(end_b)):
            i, j = end_a.index(end) + 1, end_b.index(end) + 1
            made.append((a[x:i], b[y:j]))
            x, y = i, j
        return made

    return groups


def written(groups):
    return ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)


def expected(plain, texts):
    found = [plain(t) for t in texts]
    counts = Counter((a[-1], b[-1]) for groups in found for a, b in groups or [])
    best = Counter()
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    rows = []
    for groups in found:
        own = [(a[-1], b[-1]) for a, b in groups or []]
        rows.append(
            (
                sum(len(a) for a, _ in groups or []), sum(len(b) for _, b in groups or []), len(own), len(own),
                sum(counts[p] == best[p[1]] for p in own), sum(counts[p] for p in own),
                hashlib.sha256(written(groups).encode()).hexdigest() if groups else "", written(groups or []),
            )
        )
    return rows, counts


def test_equals_plain_version(spark, plain):
    rows, counts = expected(plain, TEXTS)
    df = spark.createDataFrame([(i, t, "gone") for i, t in enumerate(TEXTS)], "doc_id long, text string, N_A string").repartition(5)
    found = sorted(map(tuple, alignment.aligned(df, A, B).collect()))
    assert found == [(i, *row) for i, row in enumerate(rows)]
    pairs = alignment.pair_counts(df, A, B).collect()
    assert {(r.a_id, r.b_id): r.n for r in pairs} == counts and len(pairs) == len(counts)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.aligned(df, A, B, groups=False).collect() == []
    only = spark.createDataFrame([(1, None), (None, "")], df.schema)
    assert {tuple(r) for r in alignment.aligned(only, A, B, groups=False).collect()} == {(1, 0, 0, 0, 0, 0, 0, ""), (None, 0, 0, 0, 0, 0, 0, "")}


@settings(max_examples=60, deadline=None)
@given(st.lists(st.text(st.sampled_from(list(" \n\t\rabthe.;)é▁日 '1")), max_size=25), max_size=8))
def test_chunks_give_what_whole_texts_give(plain, texts):
    own = alignment.aligner(A, B)
    own.known.clear()
    own.older.clear()
    for text, record in zip(texts, own.of(texts)):
        groups = plain(text)
        assert (record is None) == (groups is None)
        if groups:
            assert record[0].decode() == written(groups)


@pytest.mark.parametrize("n", [0, 1, 2, 5, 300, 20_000])
def test_perfect_hash(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.uint64))
    bucket = alignment.buckets_of(keys)
    places = alignment.PerfectHash({int(b): alignment.hash_bucket(keys[bucket == b]) for b in np.unique(bucket)})
    assert sorted(places.find(keys)) == list(range(len(keys)))
    absent = np.setdiff1d(np.arange(5000, dtype=np.uint64), keys)
    assert (places.find(absent) == -1).all()


def test_linked_pairs_end_alike():
    own = alignment.Vocabularies(A, B)
    assert 100_000 < own.pair_bound() < 2_000_000 and own.parted


def test_faster_encoding_gives_the_same_ids(tmp_path):
    own = alignment.Vocabularies(A, B)
    assert own.fast is not None
    for text in filter(None, TEXTS):
        assert own.ids_a(text) == own.a.encode(text, add_special_tokens=False).ids
    changed = tmp_path / "changed.json"
    changed.write_text(open(A).read().replace('"use_regex":true', '"use_regex":false').replace('"use_regex": true', '"use_regex": false'))
    assert alignment.Vocabularies(str(changed), B).fast is None


def test_forgotten_chunks_are_aligned_again(monkeypatch):
    monkeypatch.setattr(alignment, "CACHE_ENTRIES", 3)
    texts = ["one two three", "four five", "one six", "two seven eight nine ten", "one two"]
    own, whole = alignment.Aligner(A, B), alignment.Aligner(A, B)
    assert [own.of([text])[0] for text in texts] == [whole.whole(text) for text in texts]
