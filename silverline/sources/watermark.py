"""Control table of high-water marks: start time of each entity's last good run.

Saving appends one row, which is a single atomic rename, and reading takes the row
saved last. A job that dies half-way leaves the former mark in force. An entity's rows
lie in two generations: when the present one has ``MOST`` rows the other, older one is
replaced by the next row and becomes the present one. So the newest row is never in what
is being replaced, and an entity has no more than twice ``MOST`` files however many runs it has.
"""

from __future__ import annotations

from urllib.parse import quote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: how marks are written.
WATERMARK_FORMAT = "yyyy-MM-dd HH:mm:ss"
_SCHEMA = "last_successful_run string, saved_at timestamp, entity string, generation int"
MOST = 50  # rows of a generation


def _table(control_root: str) -> str:
    return f"{control_root.rstrip('/')}/watermarks"


def _saved(spark: SparkSession, control_root: str) -> DataFrame:
    empty = spark.createDataFrame([], _SCHEMA)
    empty.write.mode("ignore").partitionBy("entity", "generation").parquet(_table(control_root))
    return spark.read.schema(_SCHEMA).parquet(_table(control_root))


def read_watermarks(spark: SparkSession, control_root: str) -> DataFrame:
    """The mark in force for each entity: (entity, last_successful_run).

    Creates the control table when there is none yet.
    """
    latest = F.max(F.struct("saved_at", "last_successful_run"))["last_successful_run"]
    return _saved(spark, control_root).groupBy("entity").agg(latest.alias("last_successful_run"))


def get_watermark(spark: SparkSession, control_root: str, entity: str) -> str | None:
    """The mark of one entity as text, or None before its first good run."""
    row = read_watermarks(spark, control_root).filter(F.col("entity") == entity).first()
    return row["last_successful_run"] if row else None


def save_watermark(spark: SparkSession, control_root: str, entity: str, run_start_time: str) -> None:
    """Record the start time of a run. Call it only after the run has succeeded."""
    own = _saved(spark, control_root).where(F.col("entity") == entity).groupBy("generation")
    generations = own.agg(F.count(F.lit(1)).alias("n"), F.max("saved_at").alias("at")).orderBy(F.desc("at")).collect()  # two at most
    present, n_rows = (generations[0]["generation"], generations[0]["n"]) if generations else (0, 0)
    full = n_rows >= MOST
    row = spark.range(1, numPartitions=1).select(F.lit(run_start_time).alias("last_successful_run"), F.current_timestamp().alias("saved_at"))
    path = f"{_table(control_root)}/entity={quote(entity, safe='')}/generation={1 - present if full else present}"
    row.write.mode("overwrite" if full else "append").parquet(path)
