import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import block_neighbours, impact_index


def table(spark, rows):
    return spark.createDataFrame([(i, v, 1, 1, 1.0) for i, v in rows], "vec_id long, embedding array<float>, label int, rank int, score double")


def brute(rows, every, k, change, usable):
    held = {}
    for i, v in rows:
        if i is None or v is None or any(x is None or not math.isfinite(x) for x in v) or not usable(v):
            continue
        held[i] = min(held.get(i, v), v)
    out = []
    for q, x in held.items():
        if q % every:
            continue
        scored = []
        for i, y in held.items():
            if i != q:
                total = 0 * change(1.0)
                for a, b in zip(x, y):  # the shorter one ends it: zeros add nothing
                    total += change(a) * change(b)
                scored.append((-total, i))
        out += [(q, n + 1, i, -s) for n, (s, i) in enumerate(sorted(scored)[:k])]
    return sorted(out)


def vectors(n, dim, seed, scale=1.0):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (5, dim))
    data = (centres[draw.integers(0, 5, n)] + 0.3 * draw.normal(0, 1, (n, dim))) * scale / np.sqrt(dim)
    return [(i, [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]


ODD = [
    (0, [1.0, 0.5]), (100, [1.0, 0.5]), (100, [1.0, 0.5]), (1, [1.0, 0.5]), (2, None), (3, []), (4, [None, 1.0]), (5, [float("nan"), 1.0]),
    (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (200, [0.0, 0.0]), (7, [-1.0, 0.25, 3.0]), (8, [0.001]), (300, [0.3, -0.7, 0.1]),
]


def impact(spark, rows, k=5):
    found = impact_index.impact_top_k(table(spark, rows), F.col("vec_id") % 50 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


def nearest(spark, rows, k=20):
    found = block_neighbours.block_nearest(table(spark, rows), F.col("vec_id") % 20 == 0, k)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    return sorted(map(tuple, found.collect()))


@pytest.mark.parametrize("blocks", [8192, 37])
def test_impact_index_is_exact(spark, monkeypatch, blocks):
    monkeypatch.setattr(impact_index, "BLOCK", blocks)
    monkeypatch.setattr(impact_index, "QUERIES_A_BLOCK", 3)
    rows = vectors(400, 24, 1)
    rows += [(1000 + i, rows[i][1]) for i in range(60)]  # ties
    assert impact(spark, rows) == brute(rows, 50, 5, lambda x: math.floor(256 * x), lambda v: True)


def test_impact_index_on_odd_rows(spark):
    assert impact(spark, ODD) == brute(ODD, 50, 5, lambda x: math.floor(256 * x), lambda v: True)
    assert impact(spark, []) == []
    assert impact(spark, [(50, [1.0])]) == []


def test_impacts_beyond_doubles(spark):
    rows = [(0, [1e20, 3.0]), (1, [1e-20, 7.0]), (2, [2.0**60, 1.0]), (3, [1.0, 1.0])]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    found = impact(spark, rows)
    expected = brute(rows, 50, 5, lambda x: math.floor(256 * x), lambda v: True)
    assert found == [(q, r, v, min(s, 2**63 - 1)) for q, r, v, s in expected]


def test_levels_stop_on_proof_only():
    draw = np.random.default_rng(2)
    centres = draw.normal(0, 60, (200, 16))
    data = np.floor(centres[draw.integers(0, 200, 4000)] + draw.normal(0, 6, (4000, 16)))
    kinds = np.frexp(np.abs(data))[1] * (data != 0)
    levels = [np.where(kinds == level, data, 0).T for level in range(int(kinds.max()), 0, -1)]
    queries, own = data[:20], np.arange(20)
    rows, cols, used = impact_index.score_at_a_time(queries, own, np.arange(4000), levels, 5)
    assert used < len(levels) and len(rows) < 20 * 400
    scores = queries @ data.T
    scores[np.arange(20), own] = -np.inf
    for q in range(20):
        assert set(np.argsort(-scores[q], kind="stable")[:5]) <= set(cols[rows == q])


@pytest.mark.parametrize("blocks", [8192, 41])
def test_block_join_finds_every_neighbour(spark, monkeypatch, blocks):
    monkeypatch.setattr(block_neighbours, "BLOCK", blocks)
    monkeypatch.setattr(block_neighbours, "QUERIES_A_BLOCK", 7)
    rows = vectors(300, 24, 4)
    rows += [(1000 + i, rows[i][1]) for i in range(60)]
    assert nearest(spark, rows) == brute(rows, 20, 20, float, any)


def test_block_join_on_odd_rows(spark):
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in ODD]
    assert nearest(spark, rows) == brute(rows, 20, 20, float, any)
    assert nearest(spark, []) == []
    tiny = [(0, [1e-44, 0.0]), (1, [3e38, 1.0]), (2, [1e-30, -1.0]), (20, [-3e38, 3e38])]
    tiny = [(i, [float(np.float32(x)) for x in v]) for i, v in tiny]
    assert nearest(spark, tiny) == brute(tiny, 20, 20, float, any)


def test_bounds_hold():
    draw = np.random.default_rng(9)
    a, b = draw.normal(0, 1, (50, 30)), draw.normal(0, 5, (400, 30))
    rows, cols = block_neighbours.possible(a, np.full(50, -1), b, np.arange(400), block_neighbours.encode(b), 3)
    assert len(rows) < 50 * 40
    for q, scores in enumerate(a @ b.T):
        assert set(np.argsort(-scores)[:3]) <= set(cols[rows == q])
