from __future__ import annotations

import os
import random

import brute
import pytest

import corpus_pipeline
import __spark_entry__ as driver
from check import compare, duck
from parcelspark.llm import queries

SF = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def test_registry_has_the_thirteen_queries_and_the_pipeline():
    names = set(driver.queries())
    assert set(queries.QUERIES) | {"pipeline"} <= names
    assert sorted(int(n[2:].split("_")[0]) for n in queries.QUERIES) == list(range(1, 14))
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "substring_dedup", "secret_scan", "best_fit_packing"]


def prose(draw, n):
    return ["".join(draw.choice("abcdefghijk") for _ in range(draw.randrange(3, 8))) for _ in range(n)]


def documents(spark):
    draw = random.Random(11)
    passage = prose(draw, 60)
    rows = {i: prose(draw, 150) for i in range(60)}
    rows[70] = rows[5][:-1] + ["changed"]
    rows[71] = list(rows[6])
    for i in (10, 20, 30):
        rows[i] = rows[i][:80] + passage + rows[i][80:]
    rows[80] = [w + "$$" for w in rows[7]]
    rows[81] = ["few", "words"]
    rows[40] = rows[40] + ["token=9f8A7b3Qz1XcV5nM2kLp0"]
    made = [(i, " ".join(w), "en", f"s{i % 2}", len(" ".join(w))) for i, w in rows.items()] + [(90, None, None, None, None)]
    return spark.createDataFrame(made, COLUMNS), rows


def test_stages_equal_plain_versions(spark):
    docs, rows = documents(spark)
    kept = set(rows) - {80, 81}
    found = []
    for name, stage in corpus_pipeline.STAGES[:4]:
        docs = stage(spark, docs, "")
        assert docs.columns == [c.split()[0] for c in COLUMNS.split(", ")], name
        found.append({r.doc_id: r.text for r in docs.collect()})
    assert set(found[0]) == kept
    classes = brute.near_classes(sorted(found[0].items()))
    assert set(found[1]) == {d for d, c in classes.items() if d == c} and not {70, 71} & set(found[1])
    own, gone = brute.substring_removal(sorted(found[1].items()))
    assert all(brute.words(t) == [w for w, g in zip(own[d], gone[d]) if not g] for d, t in found[2].items())
    assert sum(map(sum, gone.values())) == 120 and set(found[2]) == set(found[1])
    assert "[SECRET]" in found[3][40] and all(found[3][d] == t for d, t in found[2].items() if d != 40)
    assert all(r.n_chars == len(r.text) for r in docs.collect())
    packed = corpus_pipeline.STAGES[4][1](spark, docs, "").toPandas()
    assert set(packed.doc_id) == set(found[3]) and packed.groupby("sequence_id").length.sum().max() <= 2048


def test_stages_take_an_empty_table(spark):
    docs = spark.createDataFrame([], COLUMNS)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
        assert docs.count() == 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted({*queries.QUERIES, "pipeline"} - set(queries.ORACLES)))
def test_queries_run_on_the_smallest_folder(spark, name):
    assert driver.queries()[name](spark, SF).count() > 0


@pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_same_rows_as_duckdb(spark, name):
    same, note = compare(spark, duck(SF), SF, queries.QUERIES[name], queries.ORACLES[name])
    assert same, note
