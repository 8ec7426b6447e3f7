from __future__ import annotations

import array
import hashlib
import random

import public_tokenizers
import pytest
import tiktoken

from parcelspark.llm import bpe

RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
ODD = ["a", "b", " ", "  ", "\n", "\t", "é", "ß", "12", "'s", "the ", "\x1c", "\x85", "　", "😀", "#", "ing", "  \n", "日本", "́", "\r\n"]


@pytest.fixture(scope="module")
def codec():
    return bpe.codec(RANKS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library(codec):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=codec.vocabulary.ranks, special_tokens={})


def test_same_ids_as_the_library_and_exact_round_trip(codec, library):
    draw = random.Random(3)
    for _ in range(1500):
        text = "".join(draw.choice(ODD) for _ in range(draw.randrange(40)))
        packed = codec.encode(text)
        assert array.array("I", packed).tolist() == library.encode_ordinary(text), text
        assert codec.decode(packed) == text.encode()


def test_appends_and_edits_equal_a_fresh_table(codec):
    draw = random.Random(4)
    letters = b"aeinstrh \xc3\xa9g"
    for _ in range(200):
        data = bytes(draw.choice(letters) for _ in range(draw.randrange(1, 40)))
        cut = draw.randrange(len(data))
        grown = bpe.PrefixTable(codec.vocabulary, data[:cut])
        grown.append(data[cut:])
        assert grown.last == bpe.PrefixTable(codec.vocabulary, data).last
        start = draw.randrange(len(data))
        stop = draw.randrange(start, len(data) + 1)
        grown.replace(start, stop, b"ing")
        assert grown.last == bpe.PrefixTable(codec.vocabulary, data[:start] + b"ing" + data[stop:]).last


def test_every_prefix_is_encoded_as_plain_merging_does(codec):
    data = b"unbelievablyrestingthingness"
    table = bpe.PrefixTable(codec.vocabulary, data)
    for end in range(1, len(data) + 1):
        if data[:end] not in codec.vocabulary.ranks:
            merged = codec.vocabulary._merged(data[:end], stop=1)
            assert table.tokens(end) == [codec.vocabulary.ranks[m] for m in merged]


def test_nulls_empty_long_and_clashing_columns(spark, library):
    long = "word 123 " * 20_000
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (3, long, 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, N_TOKENS int")
    found = sorted(bpe.encoded(df, RANKS, public_tokenizers.PATTERN).collect(), key=lambda r: r.doc_id)
    assert [r.n_tokens for r in found[:3]] == [0, 0, 0]
    assert found[3].ids == library.encode_ordinary(long)
    assert found[3].decoded_sha256 == hashlib.sha256(long.encode()).hexdigest()
    back = bpe.decoded(bpe.encoded(df, RANKS, public_tokenizers.PATTERN), RANKS)
    assert {r.doc_id: r.text for r in back.collect()} == {1: "", 2: "", 3: long}
    assert bpe.encoded(df.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_vocabulary_without_a_byte_is_refused():
    with pytest.raises(ValueError):
        bpe.Vocabulary({b"a": 0})
