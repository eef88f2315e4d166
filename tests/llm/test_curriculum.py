import random
import re
from collections import Counter, defaultdict

import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F

from silverline.llm import curriculum, queries
from silverline.llm.common import running_total


def targets(sizes):
    """Shares by weight; what lies above a limit is shared again, until nothing does."""
    order = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: n % 3 + 1 for n, s in enumerate(order)}
    target, open_sources, rest = {}, set(order), float(sum(sizes.values()))
    while open_sources:
        level = rest / sum(weight[s] for s in open_sources)
        full = {s for s in open_sources if weight[s] * level > 3 * sizes[s] + 1e-9}
        if not full:
            return target | {s: weight[s] * level for s in open_sources}
        for s in full:
            target[s] = 3.0 * sizes[s]
            rest -= 3 * sizes[s]
        open_sources -= full
    return target


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def check(rows, found):
    sizes = defaultdict(int)
    for _, text, source in rows:
        sizes[source] += words(text)
    expected = targets(sizes)
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, words(t)) for i, t, _ in rows)
    by_size = defaultdict(list)
    for s in sizes:
        by_size[sizes[s]].append(expected[s])
    for r in found:
        assert any(r.target == pytest.approx(t) for t in by_size[r.source_size])
        assert r.taken <= 3 * r.size and r.taken == r.copies * r.size
        assert (r.first_position is None) == (r.copies == 0)
        assert r.first_position is None or 0 <= r.first_position <= 1
        assert len(r.positions) == len(r.word_positions) == r.copies
        assert all(w == int(p * sum(sizes.values())) for p, w in zip(r.positions, r.word_positions, strict=True))
    taken, largest = defaultdict(int), defaultdict(int)
    for r in found:
        taken[r.source_size, r.target] += r.taken
        largest[r.source_size, r.target] = max(largest[r.source_size, r.target], r.size)
    for (size, target), n in taken.items():
        sources = sum(1 for s in sizes if sizes[s] == size)
        assert abs(n - target * sources) <= sources * largest[size, target] / 2 + 1e-6


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = curriculum.mix_sources(docs).collect()
    check([(r.doc_id, r.text, r.source) for r in docs.collect()], found)
    again = curriculum.mix_sources(docs.repartition(5)).collect()
    assert sorted(again) == sorted(found)


def test_limits_are_shared_again(spark):
    draw = random.Random(2)
    for sizes in ([1000, 5, 1], [10, 10, 10], [1, 200, 3, 4000, 5], [7]):
        rows = [(n, " ".join(["w"] * draw.randint(0, 9)), f"s{i}") for i, total in enumerate(sizes) for n in range(i * 10_000, i * 10_000 + total // 4 + 1)]
        check(rows, curriculum.mix_sources(documents(spark, rows)).collect())


def test_odd_rows(spark):
    rows = odd_rows()
    check(rows, curriculum.mix_sources(documents(spark, rows)).collect())
    assert curriculum.mix_sources(documents(spark, [])).collect() == []
    blank = [(1, "", "a"), (2, None, "b")]
    assert sorted((r.doc_id, r.target, r.taken) for r in curriculum.mix_sources(documents(spark, blank)).collect()) == [(1, 0.0, 0), (2, 0.0, 0)]


def test_training_order(spark):
    rows = [(i, " ".join(["w"] * (i % 7 + 1)), f"s{i % 3}") for i in range(900)]
    docs = documents(spark, rows)
    ordered = curriculum.training_order(docs)
    assert ordered.columns == docs.columns
    got = ordered.collect()
    copies = {r.doc_id: r.copies for r in curriculum.mix_sources(docs).collect()}
    assert Counter(r.doc_id for r in got) == Counter({k: v for k, v in copies.items() if v})
    # sources with a falling weight come early, those with a rising one late
    place = defaultdict(list)
    for at, r in enumerate(got):
        place[r.source].append(at / len(got))
    mean = {s: sum(x) / len(x) for s, x in place.items()}
    assert mean["s0"] < mean["s1"] < mean["s2"]


def test_position_inverts_the_integral(spark):
    df = spark.createDataFrame([(b, 100, 2, t, r) for b in range(0, 100, 7) for t in (60.0, 150.0) for r in range(3)], "before int, source_size int, size int, target double, rank int")
    for r in df.select("*", curriculum.position(curriculum.F.lit(0)).alias("t")).collect():
        reached, slope = (r.before + 1) / r.target, curriculum.SLOPES[r["rank"]]
        if reached <= 1:
            assert r.t + slope * (r.t**2 - r.t) == pytest.approx(reached)


def test_every_copy_has_its_position_and_the_query_their_order(spark, sf_dir):
    found = curriculum.mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).collect()
    by_source, position_of = defaultdict(list), {}
    for r in found:
        assert len(r.positions) == r.copies and r.positions == sorted(r.positions) and (r.positions or [None])[0] == r.first_position
        by_source[r.source_size, r.target].append(r)
        position_of[r.doc_id, r.size] = r.first_position
    assert any(r.copies > 1 for r in found)
    slopes = set()
    for (size, target), rows in by_source.items():  # a copy lies one stream of the source behind the one before it
        fits = [
            slope for slope in curriculum.SLOPES
            if all(slope * (b * b - a * a) + (1 - slope) * (b - a) == pytest.approx(size / target) for r in rows for a, b in zip(r.positions, r.positions[1:], strict=False))
        ]
        assert fits
        slopes |= set(fits)
    assert slopes == set(curriculum.SLOPES)
    places = [position_of[r.doc_id, r.size] for r in queries.QUERIES["op8_curriculum_mix"](spark, sf_dir).collect()]
    assert places == sorted(places, key=lambda t: (t is None, t or 0)) and len(places) == len(found)


def test_running_total_moves_the_rows_once(spark):
    rows = [(None if i % 3 == 0 else "" if i % 3 == 1 else "a", i, i % 5) for i in range(60)]
    df = spark.createDataFrame(rows, "g string, i long, b int").repartition(4)
    settings = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        totals = running_total(df, ["g"], F.col("b"), [F.col("i")], F.col("i"), "t")
        plan = totals._jdf.queryExecution().executedPlan().toString()
        got = {r.i: r.t for r in totals.collect()}
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert totals.columns == ["g", "i", "b", "t"]
    assert got == {i: sum(j for h, j, c in rows if h == g and (c, j) < (b, i)) for g, i, b in rows}
    # the rows for the window; of their sums per bucket, those of a bucket, of a group, and once more for the join
    assert plan.count("Exchange hashpartitioning") == 4
