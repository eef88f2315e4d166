import random

from silverline.operators import hierarchy as module
from silverline.operators.hierarchy import hierarchy


def placed(spark, rows, kind="long"):
    df = spark.createDataFrame(rows, f"id {kind}, parent_id {kind}, root string, depth string, status string" if rows and len(rows[0]) > 2 else f"id {kind}, parent_id {kind}")
    return {r.key: (r.root, r.depth, r.status) for r in hierarchy(df).collect()}


def walked(rows):
    parents = {}
    for key, parent in rows:
        if key is not None:
            known = [p for p in (parents.get(key), parent) if p is not None]
            parents[key] = min(known) if known else None
    out = {}
    for key in parents:
        at, steps, seen = key, 0, set()
        while parents.get(at) is not None and parents[at] in parents and at not in seen:
            seen.add(at)
            at, steps = parents[at], steps + 1
        if at in seen:
            out[key] = (None, None, "cycle" if at == key else "into cycle")
        else:
            own = "root" if parents[key] is None else "orphan" if parents[key] not in parents else "below"
            out[key] = (at, steps, own)
    return out


def test_roots_depths_and_cycles(spark):
    rows = [(1, None), (2, 1), (3, 2), (4, 99), (5, 4), (6, 7), (7, 6), (8, 7), (9, 9), (10, 8), (None, 1), (11, None), (11, 1), (3, 5)]
    assert placed(spark, rows) == walked(rows)
    assert placed(spark, rows)[10] == (None, None, "into cycle") and placed(spark, rows)[9] == (None, None, "cycle")
    assert placed(spark, []) == {}
    assert placed(spark, [("b", "a"), ("a", None)], "string") == {"a": ("a", 0, "root"), "b": ("a", 1, "below")}


def test_random_graphs(spark):
    draw = random.Random(4)
    for n in (1, 2, 7, 60):
        rows = [(k, draw.choice([None, *range(n + 2)])) for k in range(n)]
        assert placed(spark, rows) == walked(rows)


def test_long_chain_and_long_cycle(spark):
    chain = spark.range(10_000).selectExpr("id", "nullif(id - 1, -1) AS parent_id")
    found = hierarchy(chain)
    assert found.where("root = 0 AND depth = key").count() == 10_000
    ring = spark.range(1000).selectExpr("id", "(id + 1) % 1000 AS parent_id").union(spark.range(1000, 1100).selectExpr("id", "id - 1"))
    assert {r.status: r["count"] for r in hierarchy(ring).groupBy("status").count().collect()} == {"cycle": 1000, "into cycle": 100}


def test_many_children_of_one_parent(spark):
    star = spark.range(20_000).selectExpr("id", "CASE WHEN id > 0 THEN 0 END AS parent_id")
    assert hierarchy(star).where("root = 0 AND depth = CAST(key > 0 AS INT)").count() == 20_000


def test_keys_are_not_broadcast(spark, monkeypatch):
    chain = spark.range(300).selectExpr("id", "CASE WHEN id < 200 THEN nullif(id - 1, -1) ELSE 200 + (id + 1) % 100 END AS parent_id")
    read, plans = module._stored, []

    def noted(df):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return read(df)

    monkeypatch.setattr(module, "_stored", noted)
    found = hierarchy(chain)
    plans.append(found._jdf.queryExecution().executedPlan().toString())
    assert found.where("root = 0 AND depth = key AND key < 200").count() == 200
    assert sum("SortMergeJoin" in p for p in plans) >= 8 and not any("Broadcast" in p for p in plans)
