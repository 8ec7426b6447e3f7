from __future__ import annotations

import brute
import numpy as np
import pytest

from parcelspark.llm import embeddings


def expected(rows, threshold):
    groups, sets, links = {}, brute.Sets(), {r[0]: 0 for r in rows}
    for vec, values, label in rows:
        sets.root(vec)
        if label is not None and values and all(v is not None and np.isfinite(v) for v in values) and any(values):
            groups.setdefault((label, len(values)), []).append((vec, values))
    for members in groups.values():
        x = np.array([v for _, v in members], float)
        x /= np.linalg.norm(x, axis=1)[:, None]
        for i, j in zip(*np.nonzero(np.triu(x @ x.T >= threshold, 1))):
            a, b = members[i][0], members[j][0]
            links[a] += 1
            links[b] += 1
            sets.join(a, b)
    return {vec: (links[vec], sets.root(vec)) for vec, _, _ in rows}


@pytest.mark.parametrize("dim", [2, 6, 40])
def test_equals_all_pairs(spark, dim):
    draw = np.random.default_rng(dim)
    base = draw.normal(size=(8, dim))
    rows = [(i, (base[draw.integers(8)] + draw.normal(size=dim) * draw.choice([0, 0.15, 0.3])).tolist(), int(draw.integers(3))) for i in range(300)]
    df = spark.createDataFrame([(*r, 0) for r in rows], "vec_id long, embedding array<double>, label int, NID int")
    found = {r.vec_id: (r.n_links, r.component_id) for r in embeddings.linked(df, tile=16).collect()}
    assert found == expected(rows, 0.93)


def test_unusable_vectors_copies_and_other_dimensions(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0] * 3, 1), (4, [nan, 1.0, 1.0], 1), (5, [inf, 1.0, 1.0], 1), (6, [1.0, None, 1.0], 1)]
    rows += [(7, [1.0, 2.0, 3.0], None), (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0], 2)]
    rows += [(20 + i, [1.0, 2.0, 3.0], 1) for i in range(30)] + [(60, [1.0, 2.0, 3.1], 1), (61, [-0.0, 1.0, 0.0], 1), (62, [0.0, 1.0, 0.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    found = {r.vec_id: r for r in embeddings.linked(df).collect()}
    assert {v: (r.n_links, r.component_id) for v, r in found.items()} == expected(rows, 0.93)
    assert all(r.kept == (r.vec_id == r.component_id) for r in found.values())


def test_repeated_rows_null_ids_and_empty(spark):
    rows = [(1, [1.0, 0.0], 1), (1, [1.0, 0.0], 1), (None, [1.0, 0.0], 1), (None, [0.0, 1.0], 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    found = [(r.vec_id, r.n_links, r.component_id, r.kept) for r in embeddings.linked(df).collect()]
    assert sorted(map(repr, found)) == sorted(map(repr, [(1, 2, 1, True), (1, 2, 1, True), (None, 2, 1, False), (None, 0, None, True)]))
    assert embeddings.linked(df.limit(0)).count() == 0


def test_bounds_never_lose_a_pair():
    draw = np.random.default_rng(1)
    a = draw.normal(size=(80, 50))
    b = np.concatenate([a[:40] + draw.normal(size=(40, 50)) * 0.3, draw.normal(size=(40, 50))])
    unit = lambda x: x / np.linalg.norm(x, axis=1)[:, None]
    axes = np.linalg.qr(draw.normal(size=(50, 50)))[0]
    for threshold in (0.5, 0.9, 0.95):
        found = set(zip(*(x.tolist() for x in embeddings.close_pairs(a, b, axes, threshold, same=False))))
        assert found == set(zip(*(x.tolist() for x in np.nonzero(unit(a) @ unit(b).T >= threshold))))
