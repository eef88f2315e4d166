import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from silverline.llm import cover_tree, hard_negatives

LONG = 2**63


def brute(rows, k=5, least=80):
    held = []
    for i, v, label in rows:
        if i is not None and v is not None and label is not None and all(x is not None and math.isfinite(x) for x in v):
            held.append((i, [math.floor(256 * x) for x in v], math.fmod(label + 1, 10) if i % 7 == 0 else label))
    out = []
    for a, (anchor, x, label) in enumerate(held):
        if anchor % 100:
            continue
        scored = []
        for b, (i, y, other) in enumerate(held):
            if a != b:
                scored.append((-max(-LONG, min(LONG - 1, sum(p * q for p, q in zip(x, y)))), i, other))
        scored.sort()
        for s, positive, _ in [t for t in scored if t[2] == label][:k]:
            fits = [(-n, i) for n, i, other in scored if other != label and least * -s <= 100 * -n <= 100 * -s]
            out += [(anchor, positive, r + 1, i, -s, n) for r, (n, i) in enumerate(fits[:k])]
    return sorted(out)


def mined(spark, rows, **more):
    schema = "vec_id long, embedding array<float>, label int, row long, block int, place int, vector string, positive_score long"
    table = spark.createDataFrame([(i, v, c, 1, 1, 1, "x", 1) for i, v, c in rows], schema)
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    found = hard_negatives.hard_negatives(table, F.col("vec_id") % 100 == 0, label, **more)
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(map(tuple, found.collect()))


def embeddings(n, dim, seed, spread=0.3):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (5, dim))
    data = (centres[draw.integers(0, 5, n)] + spread * draw.normal(0, 1, (n, dim))) / np.sqrt(dim)
    return [(i * 10, [float(np.float32(x)) for x in v], int(draw.integers(-2, 10))) for i, v in enumerate(data)]


ODD = [
    (0, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [1.0, 0.5], 1), (100, [0.5, 0.5], 1), (1, [0.9, 0.5], 2), (1, [0.9, 0.5], 2), (2, None, 1),
    (3, [], 1), (4, [None, 1.0], 1), (5, [math.nan, 1.0], 2), (6, [math.inf, 1.0], 2), (None, [1.0, 1.0], 2), (200, [0.0, 0.0], 3),
    (7, [-1.0, 0.25, 3.0], 1), (8, [0.001], 3), (300, [0.25, -0.75, 0.125], None), (400, [-1.0, -0.5], 5), (9, [-0.9, 0.1], 5), (10, [0.0], 4),
]


@pytest.mark.parametrize(("block", "anchors"), [(4096, 4096), (90, 7)])
def test_equals_brute_force(spark, monkeypatch, block, anchors):
    monkeypatch.setattr(hard_negatives, "BLOCK", block)
    monkeypatch.setattr(hard_negatives, "ANCHORS", anchors)
    rows = embeddings(400, 16, 1)
    rows += [(5000 + i, rows[i % 3][1], i % 10) for i in range(120)]  # copies: ties, and more of them than a leaf holds
    rows += rows[:30]  # the same rows again
    assert mined(spark, rows) == brute(rows)


def test_odd_rows(spark):
    assert mined(spark, ODD) == brute(ODD)
    assert mined(spark, []) == []
    assert mined(spark, [(100, [1.0], 1)]) == []
    assert mined(spark, [(100, [1.0], 1), (1, [1.0], 2)]) == []


def test_scores_beyond_doubles(spark):
    rows = [(i * 50, [float(np.float32(x)) for x in v], i % 2) for i, v in enumerate([[2e14, 3.0], [2e14, 7.0], [1.9e14, 1.0], [2e14, 5.0], [1.0, 1.0], [3e30, 0.0], [2.9e30, 1.0]])]
    assert mined(spark, rows) == brute(rows)


def test_other_shares_and_numbers(spark):
    rows = embeddings(200, 8, 3)
    found = mined(spark, rows, k=2, n_positives=1, least=50)
    assert {r[2] for r in found} <= {1, 2} and all(50 * r[4] <= 100 * r[5] <= 100 * r[4] for r in found)


def tree(n=3000, seed=5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 200, (60, 6))
    data = np.floor(centres[draw.integers(0, 60, n)] + draw.normal(0, 4, (n, 6)))
    ids, labels = np.arange(n) * 3, draw.integers(0, 10, n)
    return data, ids, labels, cover_tree.CoverTree.build(ids, labels, np.arange(n), data)


def test_nodes_cover_and_separate():
    data, ids, _, held = tree()
    augmented = np.c_[held.vectors, np.sqrt(np.maximum((data * data).sum(1).max() - (held.vectors**2).sum(1), 0))]
    assert sorted(held.ids) == sorted(ids)
    for node in range(len(held.centres)):
        centre = augmented[held.centres[node]]
        below = augmented[held.begin[node] : held.end[node]]
        assert held.begin[node] <= held.centres[node] < held.end[node]
        assert np.linalg.norm(below - centre, axis=1).max() <= held.reach[node]
        children = np.arange(held.child[node], held.child_end[node])
        if len(children):
            assert held.begin[children[0]] == held.begin[node] and held.end[children[-1]] == held.end[node]
            assert (held.begin[children[1:]] == held.end[children[:-1]]).all()
            around = augmented[held.centres[children]]
            apart = np.linalg.norm(around[:, None] - around[None], axis=2) + np.eye(len(children)) * 1e9
            assert apart.min() > held.reach[node] / 2 - 1e-3
            assert held.reach[children].max() <= held.reach[node] / 2 + 1e-3


def test_descent_skips_what_lies_outside_the_windows():
    data, ids, labels, held = tree()
    held = cover_tree.CoverTree.from_columns(held.to_columns())
    search = cover_tree.Search(held)
    for row in range(0, 3000, 100):
        query = data[row]
        scores = (data @ query).astype(int)
        low, high = np.sort(scores)[[-60, -20]].tolist()
        windows = [cover_tree.Best(low, high, 5), cover_tree.Best(low, low + 1, 5)]
        search.run(query, row, int(labels[row]), False, windows)
        for window in windows:
            fits = [(-s, i) for s, i, c, r in zip(scores.tolist(), ids.tolist(), labels.tolist(), range(3000)) if window.low <= s <= window.high and c != labels[row] and r != row]
            assert [(-s, i) for s, i in zip(window.scores.tolist(), window.ids.tolist())] == sorted(fits)[:5]
    assert search.visited < 0.35 * 30 * 3000
