"""What the operators share: durable intermediate results, running totals over split groups, process-wide caches."""

from __future__ import annotations

import math
import sys
import tempfile
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only where that setting is missing and the session is local does a folder of this machine take its place.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        root = tempfile.mkdtemp(prefix="silverline-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows written once to the shared folder; Spark removes them when nothing refers to them any more."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(df.sparkSession))
    return df.checkpoint()


def bounded_batches(spark: SparkSession, rows: int = 1000) -> SparkSession:
    """Send texts to Python in batches of so many rows, which bounds the memory of a task; returns the session."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)
    return spark


def process_cache(name: str) -> dict:
    """A dictionary that lives as long as the worker process, whatever task asks for it."""
    holder = sys.modules.setdefault("_silverline_process_cache", types.ModuleType("_silverline_process_cache"))
    return holder.__dict__.setdefault("caches", {}).setdefault(name, {})


def split_count(rows: int) -> int:
    """Buckets per group so that neither the buckets of a group nor the rows of a bucket grow faster than the root of the input."""
    return max(1, math.isqrt(max(rows, 0)))


def hash_bucket(buckets: int, *columns: str) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int")


def running_total(df: DataFrame, groups: list[str], bucket: Column, order: list[Column], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows of the same groups that come before a row.

    Rows stand in order of ``bucket``, then ``order``. A group may hold any share of all rows: only a bucket of it
    is sorted in one task, and the buckets are joined by one aggregated row each. Null groups are groups; as keys
    they stand as a sign and a text, neither of them null, so that the join finds the rows where the window left
    them: a null-safe one would send all of them over the network again.
    """
    null, text = [f"__null_{i}" for i in range(len(groups))], [f"__text_{i}" for i in range(len(groups))]
    group = [*null, *text]
    signs = {n: F.col(c).isNull() for n, c in zip(null, groups, strict=True)}
    texts = {t: F.coalesce(F.col(c).cast("string"), F.lit("")) for t, c in zip(text, groups, strict=True)}
    keys = [*group, "__bucket"]
    split = df.withColumns({**signs, **texts, "__bucket": bucket, "__value": value})
    sums = split.groupBy(*keys).agg(F.sum("__value").alias("__sum"))
    earlier = Window.partitionBy(*group).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select(
        *[F.col(k).alias(f"__of_{k}") for k in keys], F.coalesce(F.sum("__sum").over(earlier), F.lit(0)).alias("__offset")
    )
    within = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = split.withColumn("__within", F.coalesce(F.sum("__value").over(within), F.lit(0)))
    same = [F.col(k) == F.col(f"__of_{k}") for k in keys]
    return (
        ranked.join(offsets, same)
        .withColumn(name, F.col("__offset") + F.col("__within"))
        .drop(*keys, "__value", "__within", "__offset", *[f"__of_{k}" for k in keys])
    )


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
