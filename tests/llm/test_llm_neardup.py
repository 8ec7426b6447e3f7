from __future__ import annotations

import random
import tracemalloc

import brute
import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from parcelspark.llm import neardup, packing, words
from parcelspark.llm.common import components, remembered, small_batches


def test_samples_agree_as_often_as_weighted_jaccard_says():
    sampler, draw = neardup.Sampler(4000, 1), np.random.default_rng(4)
    for _ in range(3):
        u = np.unique(draw.integers(0, 2**63, 400, np.uint64))
        weight = draw.integers(1, 4, len(u)) * 1.5
        keep = np.sort(draw.choice(len(u), 300, False))
        a, b = (u[:300], weight[:300]), (u[keep], weight[keep] * draw.choice([1, 1, 1, 2], 300))
        assert abs((sampler.of(*a) == sampler.of(*b)).mean() - neardup.similarity(a, b)) < 0.04


def test_long_texts_are_sampled_whole():
    sampler, draw = neardup.Sampler(50, 1), np.random.default_rng(5)
    u = np.unique(draw.integers(0, 2**63, 20_000, np.uint64))
    whole = sampler.of(u, np.ones(len(u)))
    parts = {tuple(sampler.of(u[i : i + 4096], np.ones(len(u[i : i + 4096])))) for i in range(0, len(u), 4096)}
    assert all(any(p[k] == whole[k] for p in parts) for k in range(50))


def corpus(draw):
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(5))
    passage = [word() for _ in range(40)]
    docs, i = [], 0
    for _ in range(25):
        base = [word() for _ in range(draw.randrange(60, 200))] + (passage if draw.random() < 0.5 else [])
        for _ in range(draw.randrange(1, 6)):
            copy = list(base)
            for _ in range(draw.choice([0, 0, 1, 2, 3])):
                copy[draw.randrange(len(copy))] = word()
            docs.append((i, " ".join(copy)))
            i += 1
    hub = [word() for _ in range(300)]
    for _ in range(60):
        copy = list(hub)
        copy[draw.randrange(300)] = word()
        docs.append((i, " ".join(copy)))
        i += 1
    return docs


def test_classes_equal_all_pairs(spark):
    docs = corpus(random.Random(3))
    docs += [(5000, ""), (5001, ""), (5002, "one two"), (5003, "one  two"), (5004, "one two three"), (5005, "w" * 300_000)]
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, CLASS_ID int")
    found = {r.doc_id: (r.class_id, r.kept) for r in neardup.classes(df).collect()}
    want = brute.near_classes(docs)
    assert {d: c for d, (c, _) in found.items()} == want
    assert all(kept == (d == c) for d, (c, kept) in found.items())


def test_similar_texts_in_buckets_full_of_unlike_ones_are_linked(spark):
    draw = random.Random(8)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    template, docs = [word() for _ in range(80)], []
    for i in range(400):
        docs.append((i, " ".join(template + [word() for _ in range(8)])))
    for i in range(1000, 1120, 2):
        own = [word() for _ in range(8)]
        docs.append((i, " ".join(template + own)))
        docs.append((i + 1, " ".join(template + own[:3] + [word() for _ in range(5)])))
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    found = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    want = brute.near_classes(docs)
    assert all(want[i + 1] == i for i in range(1000, 1120, 2)) and want[5] == 5
    assert found == want


def test_common_shingles_are_counted_exactly(spark):
    draw = random.Random(4)
    docs = [f"in every document these words {draw.random()}" + (" and now and then these too" if i % 20 == 0 else "") for i in range(400)]
    rows = spark.createDataFrame([(i, b"x", t) for i, t in enumerate(docs)], "doc long, tid binary, text string").repartition(7)
    shingle, df = neardup.common_shingles(rows, 400, neardup.Settings())
    every = [neardup.shingles(t, 5)[0] for t in docs]
    values, counts = np.unique(np.concatenate(every), return_counts=True)
    often = counts >= 4
    assert np.array_equal(shingle, values[often]) and np.array_equal(df, counts[often])


def test_rows_kept_with_nulls_repeats_and_other_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    rows = [(3, text, 1), (1, text, 2), (1, text, 3), (None, text, 4), (7, None, 5), (7, None, 5), (None, None, 6), (9, "x", 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tid int")
    found = neardup.deduplicated(df)
    assert found.columns == df.columns
    kept = sorted((r.doc_id or 0, r.text is None) for r in found.collect())
    assert kept == [(0, True), (1, False), (7, True), (9, False)]
    assert neardup.deduplicated(df.limit(0)).count() == 0
    assert neardup.classes(df).count() == len(rows)


def test_components_of_long_chains_and_hubs(spark):
    chain = spark.range(60).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    hub = spark.range(1000, 1200).select(F.lit(2000).cast("long").alias("a"), F.col("id").alias("b"))
    found = {r.node: r.component for r in components(chain.union(hub)).collect()}
    assert all(found[i] == 0 for i in range(61)) and all(found[i] == 1000 for i in [*range(1000, 1200), 2000])
    assert components(chain.limit(0)).count() == 0


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("ab\u00e9 \n\t\x0b\x1f\u00a0")), max_size=12), max_size=5))
def test_hashes_tell_words_apart_as_splitting_does(parts):
    text = " ".join(parts)
    own = words.split(text)
    found = words.spelled(text).tolist()
    assert len(found) == len(own) and len(set(zip(found, own))) == len(set(found)) == len(set(own))


def test_long_texts_are_hashed_in_pieces(monkeypatch):
    text = "one two  three\nfour " * 40 + "x" * 300 + " end"
    whole = words.spelled(text)
    monkeypatch.setattr(words, "_PIECE", 16)
    assert (words.spelled(text) == whole).all()


@pytest.mark.parametrize("share", [0.82, 0.88])
def test_many_unlike_texts_of_one_template(spark, monkeypatch, share):
    """Texts that share most of a template, below the similarity asked for, with pairs above it planted among them:
    exactly the pairs of a comparison of all are linked, and few others are looked at."""
    draw = random.Random(int(share * 100))
    word = lambda: "".join(draw.choice("abcdefghijklmnop") for _ in range(6))
    template, size = [word() for _ in range(200)], 120
    texts = []
    for i in range(size):
        own = [word() for _ in range(int(len(template) * (1 - share) / share))]
        texts.append(" ".join(template[: len(template) // 2] + own + template[len(template) // 2 :]))
    texts += [t + " " + word() for t in texts[:10]]
    seen = []
    original = neardup._rest_pairs
    monkeypatch.setattr(neardup, "_rest_pairs", lambda *a: seen.append(original(*a)) or seen[-1])
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classes = {r.doc_id: r.class_id for r in neardup.classes(df).collect()}
    bags = [neardup.shingles(t, 5) for t in texts]
    n = len(texts)
    held = {}
    for shingle, _ in bags:
        for x in shingle.tolist():
            held[x] = held.get(x, 0) + 1
    often = sorted(x for x, k in held.items() if k >= 0.01 * n)
    weights = neardup.Weights(n, np.array(often, np.uint64), np.array([held[x] for x in often]), 0.01)
    weighed = [(s, weights.of(s, c)) for s, c in bags]
    sets = brute.Sets()
    for i in range(n):
        sets.root(i)
        for j in range(i):
            if neardup.similarity(weighed[i], weighed[j]) >= 0.8:
                sets.join(i, j)
    assert classes == {i: sets.root(i) for i in range(n)}
    if seen:
        assert seen[0].count() <= 5 * n


def joined_rows(df):
    """Rows that the joins of an executed plan made, as far as their conditions let them pass."""
    found = []

    def walk(node):
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        if "Join" in name:
            found.append(node.metrics().apply("numOutputRows").value())
        for n in range(node.children().size()):
            walk(node.children().apply(n))

    walk(df._jdf.queryExecution().executedPlan())
    return found


def test_a_pair_is_made_at_its_first_shingle_and_a_text_meets_few_drawn_ones(spark):
    """20 texts of one class and 10 of others share five shingles."""
    rows = [
        (s, b"t%02d" % t, b"a" if t < 20 else b"b%02d" % t, 100.0, 100.0 - s, list(range(s))) for t in range(30) for s in range(5)
    ]
    shape = "shingle long, tid binary, class binary, total double, rest double, before array<long>"
    prefixes = spark.createDataFrame(rows, shape)
    pairs = neardup._rest_pairs(prefixes, neardup.Settings())
    assert len({(bytes(r.a), bytes(r.b)) for r in pairs.collect()}) == 10 * 20 + 45
    assert joined_rows(pairs) == [10 * 20 + 45]
    lead = neardup._lead_pairs(prefixes, 0, neardup.Settings()).collect()
    assert 10 <= len(lead) <= 50 and all(bytes(min(r.a, r.b, key=bytes)) < b"t20" for r in lead)


def test_blocks_hold_every_text_whole_and_count_what_is_frequent(monkeypatch):
    monkeypatch.setattr(neardup, "_BLOCK_SHINGLES", 100)
    draw = random.Random(9)
    texts = [" ".join(draw.choice("abcd") for _ in range(draw.choice([0, 3, 20, 60]))) for _ in range(200)]
    texts[50] = " ".join(f"w{i}" for i in range(300))
    own = [neardup.shingles(text, 5)[0] for text in texts]
    batches = [pa.RecordBatch.from_arrays([pa.array(texts[i : i + 70])], names=["text"]) for i in range(0, 200, 70)]
    docs = 0
    for n, held in neardup._blocks(iter(batches), 5):
        want = np.concatenate(own[docs : docs + n])
        docs += n
        assert np.array_equal(np.sort(held), np.sort(want)) and (n == 1 or len(held) <= 100)
        for least in (0.2, 1, 1.5, n / 2, n, n + 1):
            value, count = np.unique(want, return_counts=True)
            found, often = neardup._frequent(held.copy(), least)
            assert np.array_equal(found, value[count >= least]) and np.array_equal(often, count[count >= least])
    assert docs == 200 and not len(neardup._frequent(np.zeros(0, np.uint64), 3)[0])


def test_a_block_is_in_memory_once(monkeypatch):
    monkeypatch.setattr(neardup, "_BLOCK_SHINGLES", 400_000)
    texts = [" ".join(f"w{i}x{j}" for j in range(500)) for i in range(1000)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    tracemalloc.start()
    try:
        for docs, held in neardup._blocks(iter([batch]), 5):
            neardup._frequent(held, docs / 200)
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert peak < 2 * 8 * 400_000  # before, blocks were kept as texts' arrays, joined, and copied by np.unique


def test_a_worker_gives_up_what_another_operator_kept():
    path = public_tokenizers.path("byte_bpe_50k.json")
    own = packing.chunks(path)
    own.encode(["some words"])
    assert packing.chunks(path) is own and own in remembered("packing").values()
    list(neardup._blocks(iter([]), 5))
    assert not remembered("packing") and packing.chunks(path) is not own


def test_workers_get_small_batches(spark):
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    df = spark.range(3000).selectExpr("repeat('x', 5000) AS text").coalesce(1)

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], names=["n"])

    with small_batches(spark):
        assert df.mapInArrow(sizes, "n long").selectExpr("max(n)").first()[0] < 5_000_000
    assert name not in spark.conf.getAll
    spark.conf.set(name, "1m")
    try:
        with small_batches(spark):
            assert spark.conf.get(name) == "1m"
        assert spark.conf.get(name) == "1m"
    finally:
        spark.conf.unset(name)


def test_python_workers_are_of_one_kind(spark, monkeypatch):
    """A table made of Python rows is read by other workers than those of mapInArrow, and an executor keeps both."""
    draw = random.Random(4)
    word = lambda: "".join(draw.choice("abcdefghij") for _ in range(6))
    template = [word() for _ in range(80)]
    texts = [" ".join(template + [word() for _ in range(8)]) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    settled, lead_pairs = [], neardup._lead_pairs
    monkeypatch.setattr(neardup, "_lead_pairs", lambda *a: settled.append(lead_pairs(*a)) or settled[-1])

    def refused(*_, **__):
        raise AssertionError("createDataFrame")

    monkeypatch.setattr(type(spark), "createDataFrame", refused)
    assert neardup.classes(df).count() == 60 and settled
