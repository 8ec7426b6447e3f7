from __future__ import annotations

import random

import brute
import pytest
from pyspark.sql import functions as F

from parcelspark.llm import common, substrings
from parcelspark.llm import words as word_hashes


def expected(docs, window):
    own, gone = brute.substring_removal(docs, window)
    out = {}
    for doc, w in own.items():
        kept = [x for x, g in zip(w, gone[doc]) if not g]
        out[doc] = (len(w), len(w) - len(kept), brute.sha(" ".join(kept)))
    return out


@pytest.mark.parametrize("window", [6, 10])
def test_small_windows_over_repetitive_texts(spark, window):
    draw = random.Random(window)
    base = [draw.choice("abcdefgh") for _ in range(60)]
    docs = []
    for i in range(60):
        own = []
        for _ in range(draw.randrange(1, 6)):
            at = draw.randrange(50)
            own += base[at : at + draw.randrange(3, 30)] if draw.random() < 0.6 else [draw.choice("abcdefghxyz") for _ in range(draw.randrange(20))]
        docs.append((i, " ".join(["a"] * draw.randrange(40) if draw.random() < 0.2 else own)))
    df = spark.createDataFrame(docs, "doc_id long, text string")
    found = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.digests(df, window=window).collect()}
    assert found == expected(docs, window)


def words(draw, n):
    return ["".join(draw.choice("abcdefghijkl") for _ in range(4)) for _ in range(n)]


def test_passages_copies_nulls_long_texts_and_extra_columns(spark):
    draw = random.Random(8)
    shared, long = words(draw, 70), words(draw, 20_000)
    docs = [(i, " \n".join(words(draw, 30) + shared + words(draw, 30))) for i in range(20)]
    docs += [(100, " ".join(long)), (101, " ".join(long)), (102, " ".join(long[5000:9000])), (103, ""), (104, None)]
    docs += [(105, " ".join(shared[:49])), (106, " ".join(shared[:50]))]
    rows = [(d, t, d) for d, t in docs] + [(19, docs[19][1], 19), (None, docs[3][1], 7)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _crc int")
    found = substrings.digests(df.where("doc_id IS NOT NULL")).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in found} == expected(docs, 50)
    whole = substrings.deduplicated(df)
    assert whole.columns == df.columns
    own, gone = brute.substring_removal(docs)
    texts = {}
    for r in whole.collect():
        texts.setdefault(r.doc_id, []).append(r.text)
    assert texts[0] == [docs[0][1]] and texts[104] == [None] and texts[None] == [docs[3][1]] and texts[101] == [""]
    assert len(texts[19]) == 2
    for doc, text in docs:
        if text is not None:
            assert brute.words(texts[doc][0]) == [w for w, g in zip(own[doc], gone[doc]) if not g]
    assert substrings.digests(df.limit(0)).count() == 0


def test_one_id_with_two_texts(spark):
    draw = random.Random(9)
    shared = " ".join(words(draw, 60))
    rows = [(1, shared), (2, shared + " tail"), (2, "head " + shared)]
    found = substrings.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id, r.n_removed) for r in found) == [(1, 0), (2, 60), (2, 60)]


def test_words_that_collide_in_one_hash_stay_apart(spark, monkeypatch):
    """The halves of a digest, made as ``_items`` makes them: where one hash takes all words for one, the other does not."""
    draw = random.Random(3)
    first, second = words(draw, 50), words(draw, 50)
    monkeypatch.setattr(word_hashes, "hashed", lambda own: word_hashes.np.ones(len(own), word_hashes.np.uint64))
    digests = []
    for own in (first, second, first):
        data = " ".join(own).encode()
        halves = (word_hashes.hashed(word_hashes.split(data)), word_hashes.spelled(data))
        whole = word_hashes.np.array([0]), word_hashes.np.array([50])
        digests.append(tuple(int(word_hashes.Runs(h, lane).of(*whole)[0]) for lane, h in enumerate(halves)))
    assert digests[0][0] == digests[1][0] and digests[0] != digests[1] and digests[0] == digests[2]


def test_rows_of_hot_keys_are_not_shuffled(spark, tmp_path):
    """A third of the rows have one key: no task of the join gets more than five times the median."""
    i = F.col("id")
    rows = spark.range(0, 60_000, 1, 6).select(F.when(i % 3 == 0, -1).otherwise(i % 25_000).alias("k"), i.alias("v"))
    rows.write.parquet(f"{tmp_path}/rows")
    rows = spark.read.parquet(f"{tmp_path}/rows")
    rows.groupBy("k").agg(F.count("*").alias("n"), F.max("v").alias("m")).where("k % 2 = 0 OR k < 0").write.parquet(f"{tmp_path}/side")
    side = spark.read.parquet(f"{tmp_path}/side")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        joined = common.met(rows, side, ["k"], rows.count())
        plain = rows.join(side.drop("n"), "k")
        assert sorted(joined.collect()) == sorted(plain.select(*joined.columns).collect())
        sizes = sorted(r["count"] for r in joined.groupBy(F.spark_partition_id().alias("p")).count().collect())
        assert sizes[-1] <= 5 * sizes[len(sizes) // 2]
        assert common.met(rows, side.limit(0), ["k"], 60_000).count() == common.met(rows.limit(0), side, ["k"], 0).count() == 0
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
