"""Session settings the library is built for, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime SQL settings, safe to apply to a session that already runs.
RUNTIME_SETTINGS = {
    # Audit timestamps are in UTC.
    "spark.sql.session.timeZone": "UTC",
    # Skewed joins and rebalanced writes are split at run time, small shuffles merged,
    # and a join side is broadcast once its measured size allows it.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM never compiles a method of more than 8000 bytes. Rules for dates make longer ones; above
    # this limit Spark evaluates the columns of a step by many short methods instead of one long.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session; returns the session."""
    for key, value in RUNTIME_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(app_name: str = "silverline", cores: int | str = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks. On a cluster, use the cluster's own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
        # tasks that list a local folder start a process for each file
        .config("spark.sql.sources.parallelPartitionDiscovery.threshold", "10000")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return tune(spark)


def scratch_root(spark: SparkSession) -> str:
    """The folder all executors share, a launch setting of the session."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        raise RuntimeError("start the session with spark.checkpoint.dir set to a folder all executors can reach")
    return root.rstrip("/")


def scratch_path(spark: SparkSession, purpose: str) -> str:
    """A new path in the shared folder."""
    return f"{scratch_root(spark)}/{purpose}-{uuid.uuid4().hex}"
