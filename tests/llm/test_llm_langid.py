from __future__ import annotations

import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelspark.llm import langid, queries, words

SMALL = langid.Settings(sample=120, per_language=60, bits=12, epochs=6)


def plain_subwords(text, bits):
    found = []
    for word in re.findall(r"[^\W\d_]+", text.lower()):
        assert word.isalpha()
        marked = [32, *map(ord, word), 32]
        for size in (1, 2, 3, 4):
            for at in range(len(marked) - size + 1):
                own = marked[at : at + size]
                if size == 1 and own == [32]:
                    continue
                code = 0
                for c in own:
                    code = (code * 0x100000001B3 + c) % 2**64
                mixed = words.mixed(np.array([code + size], np.uint64))[0]
                found.append(int(mixed) >> (64 - bits))
    return sorted(found)


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from(list("abzÄßéñ日本1_ \n.-'İ")), max_size=30))
def test_subwords_equal_plain_version(text):
    if not all(w.isalpha() for w in re.findall(r"[^\W\d_]+", text.lower())):
        return
    parts = [p for p in langid.subwords(text, 12)]
    assert sorted(np.concatenate(parts).tolist() if parts else []) == plain_subwords(text, 12)


def test_long_texts_are_read_in_parts(monkeypatch):
    text = "der schnelle Fuchs, " * 200
    whole = np.sort(np.concatenate(list(langid.subwords(text, 12))))
    monkeypatch.setattr(langid, "_PART", 37)
    assert (np.sort(np.concatenate(list(langid.subwords(text, 12)))) == whole).all()


def _corpus(seed=3, n=240):
    """Two made-up languages that share some letters."""
    draw = np.random.default_rng(seed)
    parts = {"aa": ["ka", "to", "mi", "rel", "on"], "bb": ["sch", "eu", "mi", "on", "tz"]}
    rows = []
    for doc in range(n):
        lang = ("aa", "bb")[doc % 2]
        own = ["".join(draw.choice(parts[lang], 3)) for _ in range(int(draw.integers(5, 60)))]
        rows.append((doc, " ".join(own), lang))
    return rows


SHAPE = "doc_id long, text string, lang string"


def test_held_out_accuracy_and_scores(spark):
    df = spark.createDataFrame(_corpus(), SHAPE)
    model = langid.learned(df, ~queries.held_out(), settings=SMALL)
    found = langid.identified(df.withColumn("held", queries.held_out()), model).collect()
    held = [r for r in found if r.held]
    assert {r.doc_id for r in held} == {d for d, _, _ in _corpus() if zlib.crc32(str(d).encode()) % 5 == 0}
    assert np.mean([r.lang_pred == r.lang for r in held]) > 0.95
    assert all(0 <= r.score <= 1 for r in found) and np.mean([r.score for r in held]) > 0.8


def test_labels_of_other_rows_change_nothing(spark):
    rows = _corpus()
    df = spark.createDataFrame(rows, SHAPE)
    other = spark.createDataFrame(
        [(d, t, "zz" if zlib.crc32(str(d).encode()) % 5 == 0 else lang) for d, t, lang in rows] + [(None, "katomi", "zz"), (7000, "katomi", None)],
        SHAPE,
    )
    a, b = (langid.learned(x, ~queries.held_out(), settings=SMALL) for x in (df, other))
    assert a.languages == b.languages == ["aa", "bb"] and a.least == b.least and a.temperature == b.temperature
    assert np.array_equal(a.embedding, b.embedding) and np.array_equal(a.weight, b.weight)


def test_texts_without_letters_nulls_long_and_repeated_rows(spark):
    df = spark.createDataFrame(_corpus(), SHAPE)
    model = langid.learned(df, F.lit(True), settings=SMALL)
    rows = [(1, None, "x"), (2, "", "x"), (3, "12 345 _ !?", "x"), (4, "katomi " * 30_000, "x"), (5, "katomi", "x"), (5, "katomi", "x"), (None, "euschtz", None)]
    odd = spark.createDataFrame(rows, "doc_id long, text string, SCORE string")
    found = sorted((tuple(r) for r in langid.identified(odd, model).collect()), key=str)
    assert [r[1] for r in found] == ["und", "und", "und", "aa", "aa", "aa", "bb"]
    assert found[4] == found[5] and {r[2] for r in found[:3]} == {0.0} and all(r[3] for r in found[:3])


def test_score_below_the_least_one_is_rejected(spark):
    df = spark.createDataFrame(_corpus(), SHAPE)
    model = langid.learned(df, F.lit(True), settings=SMALL)
    mixed = model.answer("mion onmi mimion onon")
    assert mixed[1] < model.answer("katorel")[1]
    model.least = (mixed[1] + model.answer("katorel")[1]) / 2
    assert model.answer("mion onmi mimion onon")[2] and not model.answer("katorel")[2]


@pytest.mark.parametrize("rows", [[], [(1, "katomi", None)], [(1, None, "aa"), (2, "12", "bb")]])
def test_nothing_to_learn_from(spark, rows):
    df = spark.createDataFrame(rows, SHAPE)
    model = langid.learned(df, F.lit(True), settings=SMALL)
    assert model.languages == []
    assert {(r.lang_pred, r.score) for r in langid.identified(df, model).collect()} <= {("und", 0.0)}


def test_one_row_is_enough(spark):
    model = langid.learned(spark.createDataFrame([(4, "katomi", "aa")] * 3, SHAPE), F.lit(True), settings=SMALL)
    assert model.answer("tomi")[0] == "aa"


def test_sample_is_bounded_and_languages_take_turns(spark):
    rows = [(d, "katomi rel", "aa") for d in range(500)] + [(1000 + d, "schtz eu", "bb") for d in range(9)]
    seen = []
    import parcelspark.llm.langid as module

    def spy(bags, classes, languages, own):
        seen.append(np.bincount(classes).tolist())
        return module.Model(languages, own.bits, np.zeros((1 << own.bits, 4), np.float32), np.zeros((2, 4), np.float32), np.zeros(2, np.float32))

    original, module.fitted = module.fitted, spy
    try:
        langid.learned(spark.createDataFrame(rows, SHAPE), F.lit(True), settings=langid.Settings(sample=30, per_language=20, bits=8))
    finally:
        module.fitted = original
    assert sum(seen[0]) <= 3 * 29 and seen[0][1] > 0
