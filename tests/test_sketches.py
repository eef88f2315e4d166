import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverline.operators import sketches


def run(spark, seed, n):
    draw = random.Random(seed)
    rows = [(draw.choice("aaabbc") if draw.random() > 0.1 else None, draw.randint(0, 5000), draw.gauss(0, 1)) for _ in range(n)]
    return rows, spark.createDataFrame(rows, "kind string, number int, size double")


def test_merged_runs_are_within_the_stated_errors(spark, tmp_path):
    root, rows = str(tmp_path), []
    assert sketches.kept_profiles(spark, root, "t") is None
    for seed, n in enumerate((4000, 1, 9000, 0)):
        more, df = run(spark, seed, n)
        rows += more
        sketches.keep_profile(df, root, "t", f"r{seed}")
    sketches.keep_profile(run(spark, 2, 9000)[1], root, "t", "r2")  # repeated
    found = {r.column: r for r in sketches.merged_profile(sketches.kept_profiles(spark, root, "t")).collect()}
    for i, column in enumerate(("kind", "number", "size")):
        values = [r[i] for r in rows if r[i] is not None]
        line = found[column]
        assert (line.n_rows, line.n_nulls) == (len(rows), len(rows) - len(values))
        assert line.n_distinct == pytest.approx(len(set(values)), rel=0.05)
        if column == "kind":
            assert line.quantiles is None
        else:
            for q, value in zip(sketches.QUANTILES, line.quantiles, strict=True):
                below, upto = sum(v < value for v in values), sum(v <= value for v in values)
                assert below / len(values) - 0.015 <= q <= upto / len(values) + 0.015
    counts = Counter(r[0] for r in rows if r[0] is not None)
    assert {t["item"]: t["count"] for t in found["kind"].top if t["item"] is not None} == dict(counts)


def test_only_sketches_are_read(spark, tmp_path):
    _, df = run(spark, 1, 20_000)
    for name in ("a", "b"):
        sketches.keep_profile(df, str(tmp_path), "t", name, tracked=1000)
    assert len(list(Path(tmp_path).rglob("*.parquet"))) == 2
    kept = sketches.kept_profiles(spark, str(tmp_path), "t")
    assert kept.count() == 2 * 3
    one = sketches.merged_profile(kept.where(F.col("profiled_run") == "a"), tracked=1000)
    assert {r.n_rows for r in one.collect()} == {20_000}


def test_empty_table(spark):
    empty = sketches.merged_profile(sketches.sketched(run(spark, 0, 3)[1].where("false"))).collect()
    assert [(r.n_rows, r.n_nulls, r.n_distinct, r.quantiles) for r in empty] == [(0, 0, 0, None)] * 3
