import zlib
from collections import Counter

import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F

from silverline.llm import sharding
from silverline.llm.sharding import Shard, shard_of, shard_tree


def shards(spark, tree, n=20_000):
    keys = spark.range(n).select(F.col("id").cast("long").alias("k"))
    return {r.k: r.s for r in keys.select("k", shard_of(F.col("k"), tree).alias("s")).collect()}


@pytest.mark.parametrize(("n", "base"), [(1, 1), (5, 5), (5, 3), (8, 8), (9, 8), (12, 8)])
def test_one_more_shard_takes_rows_only_into_itself(spark, n, base):
    before, after = shards(spark, shard_tree(n, base=base)), shards(spark, shard_tree(n + 1, base=base))
    assert set(before.values()) == set(range(n))
    moved = {k for k in before if before[k] != after[k]}
    assert {after[k] for k in moved} == {n}
    assert abs(len(moved) / len(before) - 1 / (n + 1)) < 0.02


def test_rows_follow_the_weights(spark):
    tree = [Shard(0, 0, 0, 1), Shard(0, 0, 1, 3), Shard(0, 1, 2, 2), Shard(1, 0, 3, 4), Shard(1, 0, 4, 0)]
    counts = Counter(shards(spark, tree).values())
    assert {s: round(c / 2000) for s, c in counts.items()} == {0: 1, 1: 3, 2: 2, 3: 4}


def test_a_changed_weight_moves_nothing_between_other_subtrees(spark):
    tree = [Shard(r, k, 4 * r + 2 * k + s, 1.0) for r in range(2) for k in range(2) for s in range(2)]
    heavier = [Shard(s.region, s.rack, s.shard, 2.0 if s.shard == 0 else 1.0) for s in tree]
    before, after = shards(spark, tree), shards(spark, heavier)
    for k in before:
        if before[k] != after[k]:
            assert after[k] // 4 == 0  # into the region whose weight grew
            if before[k] // 4 == 0:
                assert after[k] // 2 == 0  # and there into the rack whose weight grew
                if before[k] // 2 == 0:
                    assert after[k] == 0


def test_whole_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    rows = sharding.assign_shards(docs, 8).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    for r in rows:
        data = (texts[r.doc_id] or "").encode()
        assert (r.size, r.text_crc32, r.law) == (len(data) + 1, zlib.crc32(data), "key")
        assert r.grown_shard in (r.shard, 8)
    for s in range(8):
        assert sorted(r.slot for r in rows if r.shard == s) == list(range(sum(r.shard == s for r in rows)))
    again = sharding.assign_shards(docs.repartition(3), 8)
    assert sorted(again.collect()) == sorted(rows)


def test_odd_rows(spark):
    rows = odd_rows()
    found = sharding.assign_shards(documents(spark, rows), 8).collect()
    assert Counter((r.doc_id, r.size) for r in found) == Counter((i, len((t or "").encode()) + 1) for i, t, _ in rows)
    assert len({(r.shard, r.slot) for r in found}) == len(rows)
    assert len({r.shard for r in found if r.doc_id is None}) == 1
    assert sharding.assign_shards(documents(spark, []), 8).collect() == []
