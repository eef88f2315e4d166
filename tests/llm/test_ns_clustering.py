import hashlib
import math

import numpy as np
import pytest

from silverline.llm import ns_clustering

MOST = 2**27


def brute(rows, number=16, rounds=3, dim=64):
    kept = []
    for i, v in rows:
        if v is not None and len(v) == dim and all(x is not None and math.isfinite(x) for x in v):
            kept.append((i, [math.floor(max(-MOST, min(MOST, 64 * x))) for x in v]))
    key = lambda r: (hashlib.sha256(f"1:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centroids = [x for _, x in sorted(kept, key=key)[:number]]
    apart = lambda x, c: sum((a - b) ** 2 for a, b in zip(x, c, strict=True))
    for r in range(rounds + 1):
        placed = [min((apart(x, c), j) for j, c in enumerate(centroids)) for _, x in kept]
        if r < rounds:
            for j in range(len(centroids)):
                own = [x for (_, x), (_, c) in zip(kept, placed, strict=True) if c == j]
                if own:
                    centroids[j] = [sum(column) // len(own) for column in zip(*own, strict=True)]
    total = sum(d for d, _ in placed) if kept else 0
    each = [sum(d for d, c in placed if c == j) for j in range(len(centroids))]
    checksum = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return sorted([(i, c, d, each[c], total, checksum[c]) for (i, _), (d, c) in zip(kept, placed, strict=True)], key=str)


def clustered(spark, rows, **more):
    schema = "vec_id long, embedding array<float>, label int, x array<int>, cluster int, distance long, known string, rounds int, key string"
    table = spark.createDataFrame([(i, v, 1, [1], 1, 1, "x", 1, "x") for i, v in rows], schema)
    found, history = ns_clustering.cluster(table, **more)
    out = ns_clustering.with_inertia(found, history[-1])
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted(map(tuple, out.collect()), key=str), found


def vectors(n, dim, seed, spread=0.5):
    draw = np.random.default_rng(seed)
    centres = draw.normal(0, 1, (7, dim))
    data = centres[draw.integers(0, 7, n)] + spread * draw.normal(0, 1, (n, dim))
    return [(int(i), [float(np.float32(x)) for x in v]) for i, v in enumerate(data)]


def test_equals_evaluating_everything(spark):
    rows = vectors(600, 64, 1)
    rows += [(i, v) for i, v in rows[:20]] + [(5000 + i, rows[3][1]) for i in range(200)]
    found, state = clustered(spark, rows)
    assert found == brute(rows)
    assert state.agg({"evaluated": "sum"}).first()[0] < 0.95 * len(rows) * 16 * 4


def test_odd_rows(spark):
    base = [x for _, x in vectors(4, 64, 2)]
    rows = [(1, base[0]), (1, base[0]), (1, base[1]), (None, base[2]), (None, base[2]), (2, None), (3, []), (4, base[3][:63]), (5, base[3] + [1.0])]
    rows += [(6, base[0][:63] + [None]), (7, base[0][:63] + [math.nan]), (8, base[0][:63] + [-math.inf]), (9, [3e38] * 64), (10, [-3e38] * 64), (-11, [0.0] * 64)]
    rows = [(i, v and [x if x is None else float(np.float32(x)) for x in v]) for i, v in rows]
    assert clustered(spark, rows)[0] == brute(rows)
    assert clustered(spark, [])[0] == []
    assert clustered(spark, [(1, None)])[0] == []
    assert clustered(spark, rows[:1])[0] == brute(rows[:1])


def test_other_numbers(spark):
    rows = vectors(150, 5, 3)
    assert clustered(spark, rows, number=4, rounds=6, dim=5)[0] == brute(rows, 4, 6, 5)


@pytest.mark.parametrize("seed", range(5))
def test_bounds_hold_over_many_rounds(seed):
    """Small grids give many ties; total displacements are shorter than summed ones where centroids go back and forth."""
    draw = np.random.default_rng(seed)
    x = draw.integers(-4, 5, (400, 3))
    history = [draw.integers(-4, 5, (9, 3))]
    own, known, rounds, done = np.full(400, -1), np.zeros((400, 9)), np.zeros((400, 9), np.int64), 0
    for r in range(12):
        own, distance, evaluated = ns_clustering.assign(x, history, own, known, rounds, r == 11)
        all_of_them = ((x[:, None] - history[-1][None]) ** 2).sum(2)
        assert (own == all_of_them.argmin(1)).all()
        assert ((distance == all_of_them.min(1)) | (distance == -1)).all()
        done += evaluated.sum()
        step = draw.integers(-1, 2, (9, 3)) * draw.integers(0, 2, (9, 1))
        history.append(np.clip(history[-1] + (step if r % 2 else -step), -6, 6))
    assert (distance >= 0).all() and done < 0.9 * 12 * 400 * 9
