"""Hard negatives by cover trees: for an anchor and each of its positives, the best rows of other labels in a window.

Candidates are divided into blocks at random, and each block gets a cover tree over norm-augmented vectors
(:mod:`silverline.llm.cover_tree`), one row of an index that is written once. Anchors are searched in blocks of a bounded
number, each sent to all trees: first for the best rows of their own label, then, with the windows that these scores
set, for rows of other labels. All windows of an anchor share one best-first descent, which leaves out nodes whose bounds
lie outside every window and ends when nothing better can come. Scores are whole numbers taken at the leaves.

Defined cases: rows without an id, a label or a vector of finite numbers take no part; rows that repeat an id are rows of
their own, as candidates and as anchors; vectors of different length compare as if filled up with zeros; scores beyond a
long stop at its ends; an anchor without positives, and a window without negatives, gives no row; an empty table gives an
empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.llm.common import checkpointed
from silverline.llm.cover_tree import HIGHEST, LOWEST, Best, CoverTree, Search
from silverline.llm.tiles import block_count, matrix, widen

BLOCK, ANCHORS = 4096, 4096  # candidates a tree, anchors searched at a time


def whole_vectors(vectors: DataFrame, label: Column, scale: int = 256) -> DataFrame:
    """Rows ``(row, vec_id, label, vector)`` that take part, components as ``floor(scale * x)``; each row has a number."""
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    # floor() gives a long; doubles too large for that are whole already
    floored = lambda v: F.coalesce(F.when(F.abs(v) < 2**52, F.floor(v)).cast("double"), v)
    kept = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull() & finite)
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), F.transform(x, lambda v: floored(v.cast("double") * scale)).alias("vector"))
    return checkpointed(kept.withColumn("row", F.monotonically_increasing_id()))


def build_index(rows: DataFrame, blocks: int) -> DataFrame:
    """A cover tree a block."""
    schema = "block int, " + ", ".join(f"{name} binary" for name in CoverTree.FIELDS)

    def tree(table):
        import pyarrow as pa

        held = [table.column(name).to_numpy().astype(np.int64) for name in ("vec_id", "label", "row")]
        built = CoverTree.build(*held, matrix(table.column("vector"))).to_columns()
        columns = [pa.array([table.column("block")[0].as_py()], pa.int32()), *[pa.array([x], pa.binary()) for x in built.values()]]
        return pa.Table.from_arrays(columns, ["block", *built])

    spark = rows.sparkSession
    tasks = min(blocks, max(4 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))))
    blocked = rows.withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)).cast("int"))
    return checkpointed(blocked.repartition(tasks, "block").groupBy("block").applyInArrow(tree, schema))


def _search(index: DataFrame, asked: DataFrame, work, schema: str) -> DataFrame:
    """``work`` on each tree and each block of the anchors ``(row, vec_id, label, vector, ...)``."""
    spark = index.sparkSession
    asked = checkpointed(asked)
    blocks = block_count(asked.count(), ANCHORS)
    found = spark.createDataFrame([], schema)
    for number in range(blocks):
        held = asked.where(F.pmod(F.xxhash64("row"), F.lit(blocks)) == number).toArrow()  # ANCHORS rows or so
        block = spark.sparkContext.broadcast(held)

        def searched(batches: Iterator, block=block) -> Iterator:
            import pyarrow as pa

            names = [part.split()[0] for part in schema.split(", ")]
            anchors = block.value
            queries = matrix(anchors.column("vector"))
            others = anchors.drop_columns(["vector"]).to_pylist()
            for batch in batches:
                for at in range(batch.num_rows):
                    tree = CoverTree.from_columns({name: batch.column(name)[at].as_py() for name in CoverTree.FIELDS})
                    width = max(queries.shape[1], tree.vectors.shape[1])
                    tree.vectors = widen(tree.vectors, width)
                    search, out = Search(tree), []
                    for query, anchor in zip(widen(queries, width), others, strict=True):
                        out += work(search, query, anchor)
                    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], pa.int64()) for i in range(len(names))], names)

        found = found.unionByName(index.mapInArrow(searched, schema))
    return found


def _first(found: DataFrame, keys: list[str], score: str, ident: str, k: int, name: str) -> DataFrame:
    order = Window.partitionBy(*keys).orderBy(F.desc(score), ident)
    return found.withColumn(name, F.row_number().over(order)).where(F.col(name) <= k)


def positives(index: DataFrame, anchors: DataFrame, k: int = 5) -> DataFrame:
    """The best ``k`` other rows of each anchor's label: ``(row, positive_id, positive_score, place)``."""

    def best(search: Search, query: np.ndarray, anchor: dict) -> list[tuple]:
        window = Best(LOWEST, HIGHEST, k)
        search.run(query, anchor["row"], anchor["label"], True, [window])
        return [(anchor["row"], i, s) for i, s in zip(window.ids.tolist(), window.scores.tolist(), strict=True)]

    found = _search(index, anchors, best, "row long, positive_id long, positive_score long")
    return _first(found, ["row"], "positive_score", "positive_id", k, "place")


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, k: int = 5, n_positives: int = 5, least: int = 80, scale: int = 256) -> DataFrame:
    """For each anchor and positive the best ``k`` rows of other labels that score from ``least`` % of the positive up to all of it.

    ``is_anchor`` is a condition on ``vec_id``, ``label`` an expression of the labels to go by.
    """
    rows = whole_vectors(vectors, label, scale)
    index = build_index(rows, block_count(rows.count(), BLOCK))
    anchors = rows.where(is_anchor)
    best = positives(index, anchors, n_positives)
    held = best.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("place", "positive_id", "positive_score"))).alias("positives"))

    def within(search: Search, query: np.ndarray, anchor: dict) -> list[tuple]:
        scores = sorted({p["positive_score"] for p in anchor["positives"]})
        # whole scores s with least * positive <= 100 * s <= 100 * positive
        windows = {s: Best(max(-(-least * s // 100), LOWEST), s, k) for s in scores if -(-least * s // 100) <= s}
        search.run(query, anchor["row"], anchor["label"], False, list(windows.values()))
        out = []
        for p in anchor["positives"]:
            if window := windows.get(p["positive_score"]):
                pairs = zip(window.ids.tolist(), window.scores.tolist(), strict=True)
                out += [(anchor["row"], anchor["vec_id"], p["place"], p["positive_id"], p["positive_score"], i, s) for i, s in pairs]
        return out

    schema = "row long, anchor_id long, place long, positive_id long, positive_score long, negative_id long, negative_score long"
    found = _search(index, anchors.join(held, "row"), within, schema)
    ranked = _first(found, ["row", "place"], "negative_score", "negative_id", k, "rank")
    return ranked.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
