"""Query blocks against candidate blocks: what the two vector searches share."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def usable_vectors(vectors: DataFrame, nonzero: bool = False) -> DataFrame:
    """``vec_id`` and ``vector`` of rows with an id and a vector of finite numbers.

    An id stands for one vector: rows that repeat it are one row, and if their vectors differ the smallest counts.
    """
    x = F.col("embedding")
    finite = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    kept = F.col("vec_id").isNotNull() & x.isNotNull() & finite
    if nonzero:
        kept = kept & F.exists(x, lambda v: v != 0)
    return vectors.where(kept).groupBy("vec_id").agg(F.min("embedding").alias("vector"))


def block_count(rows: int, size: int) -> int:
    return max(1, -(-rows // size))


def in_block(blocks: int, column: str = "vec_id"):
    return F.pmod(F.xxhash64(column), F.lit(blocks)).cast("int")


def every(blocks: int):
    return F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))


def matrix(column, dim: int | None = None) -> np.ndarray:
    """An Arrow list column as a float64 matrix; shorter vectors are filled up with zeros."""
    column = column.combine_chunks() if hasattr(column, "combine_chunks") else column
    lengths = np.asarray(column.value_lengths().to_numpy(zero_copy_only=False), dtype=np.int64)
    values = np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.float64)
    width = max(dim or 0, int(lengths.max(initial=0)))
    out = np.zeros((len(lengths), width))
    out[np.arange(width) < lengths[:, None]] = values
    return out


def widen(a: np.ndarray, width: int) -> np.ndarray:
    return a if a.shape[1] >= width else np.pad(a, ((0, 0), (0, width - a.shape[1])))


def best_of(rows: np.ndarray, ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` best of each row: highest score first, ties to the smaller id."""
    order = np.lexsort((ids, -scores, rows))
    first = np.flatnonzero(np.r_[True, rows[order][1:] != rows[order][:-1]]) if len(order) else np.empty(0, int)
    place = np.arange(len(order)) - np.repeat(first, np.diff(np.r_[first, len(order)]))
    return order[place < k]


def merged(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` best over all blocks; Spark keeps ``k`` a task before the shuffle, so a query moves few rows."""
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def tiled(left: DataFrame, right: DataFrame, work: Callable, schema: str) -> DataFrame:
    """Apply ``work`` to each pair of a block of ``left`` and a block of ``right``; both carry ``__q`` and ``__v``."""
    return left.groupBy("__q", "__v").cogroup(right.groupBy("__q", "__v")).applyInArrow(work, schema)
