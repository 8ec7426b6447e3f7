from __future__ import annotations

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from hypothesis.extra import numpy as hnp
from pyspark.sql import functions as F

from parcelspark.llm import negatives

SHAPE = "vec_id long, embedding array<double>, label int, ID string"


def expected(rows, scale=256, every=5):
    usable = {}
    for vec, values, label in rows:
        if vec is None or label is None or values is None or any(v is None or not math.isfinite(v) for v in values):
            continue
        one = (str(label), [math.floor(scale * v) for v in values])
        usable[vec] = min(usable.get(vec, one), one)
    score = lambda a, b: sum(x * y for x, y in zip(a, b))
    found = []
    for a, (own, vector) in usable.items():
        if a % every:
            continue
        ranked = sorted((-score(vector, v), b, label == own) for b, (label, v) in usable.items() if b != a)
        for s, b, _ in [r for r in ranked if r[2]][:5]:
            fit = [r for r in ranked if not r[2] and -50 * s <= -100 * r[0] <= -95 * s][:3]
            found += [(a, b, k + 1, r[1], -s, -r[0]) for k, r in enumerate(fit)]
    return sorted(found)


def mined(spark, rows, **sizes):
    df = spark.createDataFrame([(*r, "x") for r in rows], SHAPE)
    return sorted(map(tuple, negatives.mined(df.drop("ID"), F.col("id") % 5 == 0, F.col("label"), **sizes).collect()))


@settings(max_examples=25, deadline=None)
@given(
    hnp.arrays(np.int64, st.tuples(st.integers(1, 9), st.integers(1, 19)), elements=st.integers(-300, 300)),
    st.integers(1, 7),
)
def test_scores_equal_inner_products(values, anchors):
    own = values[:anchors]
    codes = negatives.planes(values, 10)
    assert (negatives.scores(negatives.subset_sums(own), codes) == values @ own.T).all()


@pytest.mark.parametrize("sizes", [{}, {"block": 16, "anchor_block": 4, "span": 2}])
def test_equals_all_pairs_with_ties(spark, sizes):
    draw = np.random.default_rng(5)
    base = draw.normal(size=(6, 11))
    rows = [(i, np.round(base[draw.integers(6)] + draw.normal(size=11) * 0.4, 1).tolist(), int(draw.choice([0, 0, 0, 1, 2]))) for i in range(150)]
    rows += [(200 + i, rows[3][1], i % 2) for i in range(20)]  # equal vectors in two classes
    result = mined(spark, rows, scale=4, **sizes)
    assert result == expected(rows, scale=4) and len(result) > 100


def test_unusable_rows_repeats_lengths_and_negative_scores(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0, 0.5], 1), (5, None, 1), (10, [], 1), (15, [nan, 1.0, 1.0], 1), (20, [1.0, None, 1.0], 1)]
    rows += [(25, [inf, 1.0, 1.0], 1), (30, [1.0, 1.0, 1.0], None), (None, [1.0, 1.0, 1.0], 1), (1, [1.0, 2.0], 1)]
    rows += [(2, [0.7, 1.4], 2), (2, [0.7, 1.4], 2), (3, [1.0, 1.0], 2), (3, [0.9, 1.0], 1), (4, [-1.0, -2.0], 1), (6, [-0.5, -1.2], 2)]
    rows += [(7, [0.4, 1.5, 0.0, 0.3], 2), (35, [-3.0, 1.0], 4)]
    result = mined(spark, rows)
    assert result == expected(rows) and result


def test_nothing_to_mine(spark):
    assert mined(spark, []) == []
    assert mined(spark, [(1, [1.0], 1), (2, [1.0], 2)]) == []
    with pytest.raises(ValueError):
        mined(spark, [(0, [1e30], 1)], scale=1)
