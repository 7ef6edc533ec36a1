import numpy as np
import pytest

from cubagem.llm.neighbours import Block, nearest

VECTORS = "vec_id long, embedding array<float>, label int, rank string"


def brute(rows, k, every):
    good = [
        (i, np.array(v, np.float64)) for i, v in rows
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v)
    ]
    out = {}
    for q, v in good:
        if q % every == 0 and q not in out:
            near = sorted((-float(v @ w), i) for i, w in good if i != q and len(w) == len(v))
            out[q] = [(i, -s) for s, i in near[:k]]
    return out


@pytest.mark.parametrize("kind", ["unit", "norms", "clusters"])
def test_recall(spark, kind):
    rng = np.random.default_rng(1)
    x = rng.standard_normal((1500, 24))
    if kind == "clusters":
        x = x * 0.3 + rng.standard_normal((10, 24))[rng.integers(0, 10, 1500)]
    x = x / np.linalg.norm(x, axis=1)[:, None] if kind != "norms" else x * rng.uniform(0.1, 3, (1500, 1))
    rows = [(i, v) for i, v in enumerate(x.astype(np.float32).tolist())]
    found = {}
    for r in nearest(spark.createDataFrame([(*r, 0, "") for r in rows], VECTORS), block=400, query_block=40).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    right, expected = 0, brute(rows, 20, 20)
    assert found.keys() == expected.keys()
    for q, near in expected.items():
        own = sorted(found[q])
        assert [r for r, _, _ in own] == list(range(1, 21))
        right += len({i for _, i, _ in own} & {i for i, _ in near})
        for _, i, score in own:
            assert score == pytest.approx(float(np.float64(rows[q][1]) @ np.float64(rows[i][1])), abs=1e-12)
    assert right >= 0.95 * 20 * len(expected)


def test_odd_vectors(spark):
    inf, nan = float("inf"), float("nan")
    rows = [(0, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.0]), (20, None), (40, []), (60, [0.0, 0.0]), (3, [inf, 1.0]),
            (4, [nan, 1.0]), (5, [None, 1.0]), (None, [1.0, 1.0]), (6, [-1.0, 0.0]), (7, [1.0, 2.0, 3.0]),
            (80, [2.0, 0.0, 0.0, 1.0]), (6, [-1.0, 0.0])]
    found = nearest(spark.createDataFrame([(*r, 0, "") for r in rows], VECTORS))
    got = {}
    for r in found.orderBy("rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    assert got == {0: [(1, 1.0), (2, 1.0), (6, -1.0), (6, -1.0)]}
    assert nearest(spark.createDataFrame([], VECTORS)).collect() == []


def test_doubles_stay_doubles(spark):
    rows = [(0, [0.3, 0.1]), (1, [1.0, 0.9]), (2, [0.1, 0.2])]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in found] == [(1, 0.3 * 1.0 + 0.1 * 0.9), (2, 0.3 * 0.1 + 0.1 * 0.2)]


def test_more_rows_than_16_bits_number():
    vectors = np.random.default_rng(3).standard_normal((70_000, 4))
    index = Block(vectors, np.full(70_000, 7), float(np.linalg.norm(vectors, axis=1).max()), 16, 9)
    ids, scores = index.search(0, vectors[0], 20, 0.6, 0.05)
    assert (ids == 7).all() and np.allclose(scores, np.sort(vectors @ vectors[0])[::-1][:20])


def test_components_far_apart_in_size(spark):
    rows = [(0, [1e200, 0.0]), (1, [2e100, 1.0]), (2, [-1e-200, 1e-300]), (20, [5e-324, 1e-200]), (3, [1e100, 1e200])]
    found = nearest(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).orderBy("rank").collect()
    got = {q: [(r["vec_id"], r["score"]) for r in found if r["query_id"] == q] for q in (0, 20)}
    vectors = {i: np.array(v) for i, v in rows}
    for q, near in got.items():
        every = sorted((-float(np.einsum("j,j->", vectors[i], vectors[q])), i) for i in vectors if i != q)
        assert near == [(i, -s) for s, i in every]
