"""Trees held as a parent in each row: roots, depths and cycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.session import scratch_path

ROOT, ORPHAN, BELOW, CYCLE, INTO_CYCLE = "root", "orphan", "below", "cycle", "into cycle"


def _stored(df: DataFrame) -> DataFrame:
    """Written to the shared folder and read again, which ends the lineage of a round."""
    path = scratch_path(df.sparkSession, "hierarchy")
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)


def hierarchy(df: DataFrame, key: str = "id", parent: str = "parent_id") -> DataFrame:
    """For each key its ``root``, its ``depth`` below it and its ``status``.

    A ``root`` has no parent; an ``orphan`` names one that is not there, and counts as a root of
    its own; what is ``below`` either has its root and depth. Keys of a ``cycle``, and those
    whose parents lead ``into cycle``, have neither. Rows without a key are left out; of rows
    that share one the smallest parent counts.

    By pointer doubling: every key points at an ancestor and knows how far up it is. In each
    round it takes over what its ancestor points at, so a chain of n keys takes log n rounds,
    and keys that have reached a root take no part any more. A parent of very many children
    is a hot key on one side of a join only, which adaptive execution splits. No side is
    broadcast: stored, these columns are so small that Spark would send all keys to the driver.
    """
    edges = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.min(parent).alias("parent"))
    edges = _stored(edges)
    found = edges.select(F.col("key").alias("known")).hint("merge")
    linked = edges.join(found, F.col("parent") == F.col("known"), "left")
    at_root = F.col("known").isNull()
    state = linked.select(
        "key",
        F.when(at_root, F.col("key")).otherwise(F.col("parent")).alias("at"),
        F.when(at_root, F.lit(0)).otherwise(F.lit(1)).cast("long").alias("up"),
        at_root.alias("done"),
        F.when(F.col("parent").isNull(), ROOT).when(at_root, ORPHAN).otherwise(BELOW).alias("status"),
    )
    state = _stored(state)
    n_keys, jump = state.count(), 1
    while jump <= n_keys and not state.where(~F.col("done")).isEmpty():
        above = state.select(F.col("key").alias("of"), F.col("at").alias("next"), F.col("up").alias("more"), F.col("done").alias("reached"))
        above = above.hint("merge")
        open_ = state.where(~F.col("done")).join(above, F.col("at") == F.col("of"))
        moved = open_.select("key", F.col("next").alias("at"), (F.col("up") + F.col("more")).alias("up"), F.col("reached").alias("done"), "status")
        state = _stored(state.where("done").unionByName(moved))
        jump *= 2
    # after as many steps as there are keys only cycles are pointed at, and all of their keys are
    circling = state.where(~F.col("done")).select(F.col("at").alias("circling")).distinct().hint("merge")
    marked = state.join(circling, ~F.col("done") & (F.col("key") == F.col("circling")), "left")
    only: Column = F.col("done")
    return marked.select(
        "key",
        F.when(only, F.col("at")).alias("root"),
        F.when(only, F.col("up")).alias("depth"),
        F.when(only, F.col("status")).when(F.col("circling").isNotNull(), CYCLE).otherwise(INTO_CYCLE).alias("status"),
    )
