"""The current view of a Silver table, kept between runs instead of computed from all of them.

The newest version of each key lies in one of a fixed number of buckets, by the hash of the key; rows without a key are
spread by their content. A batch rewrites the buckets its keys fall into and no others: those are read, merged with the
batch and replaced, while the rest is neither read nor written. Merging takes the newest of equal keys, so a batch that
is merged again, on another day too, changes nothing.

A bucket is replaced when the job commits. A driver that dies just then may leave buckets missing; merge the batch again
after :func:`rebuild_current`, which makes the view anew from all Silver runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.sources.sinks import newest_versions, read_silver, versioned

BUCKETS = 256
BUCKET, NUMBER = "bucket", "buckets"


@dataclass(frozen=True)
class CurrentView:
    """Where the view of an entity lies, what its keys are and which version is the newest.

    ``buckets`` is fixed when the view is begun. Choose it so that a bucket is some hundred megabytes when the table has
    grown: a batch of scattered keys rewrites every bucket, one whose keys are fewer than the buckets only as many.
    """

    root: str
    entity: str
    keys: tuple[str, ...] = ("id",)
    updated: str = "updated_at"
    by: str = "change"
    buckets: int = BUCKETS

    @property
    def path(self) -> str:
        return f"{self.root.rstrip('/')}/{self.entity}"


def _read(spark: SparkSession, view: CurrentView) -> DataFrame:
    """All buckets; those not rewritten since a column was added lack it, so their schemas are merged."""
    return spark.read.option("mergeSchema", True).parquet(view.path)


def _stored(spark: SparkSession, view: CurrentView) -> DataFrame | None:
    try:
        stored = _read(spark, view)
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):  # not begun, or without any rows
            return None
        raise
    begun = stored.select(NUMBER).first()
    if begun and begun[0] != view.buckets:
        raise ValueError(f"the view {view.path} has {begun[0]} buckets, not {view.buckets}")
    return stored


def read_current(spark: SparkSession, view: CurrentView) -> DataFrame:
    """The newest version of each key. A filter on the keys reads all buckets; :func:`lookup_current` does not."""
    return _read(spark, view).drop(BUCKET, NUMBER)


def _bucketed(rows: DataFrame, view: CurrentView) -> DataFrame:
    of = versioned(rows, view.keys)
    return of.withColumn(BUCKET, F.pmod(F.xxhash64("version_of_"), F.lit(view.buckets)).cast("int"))


def lookup_current(spark: SparkSession, view: CurrentView, values: Sequence[Sequence[object]]) -> DataFrame:
    """The rows of some keys, from their buckets only; ``values`` holds one tuple of key values per row asked for."""
    stored = _read(spark, view)
    kinds = {f.name: f.dataType for f in stored.schema.fields}
    columns = ", ".join(f"`{c}` {kinds[c].simpleString()}" for c in view.keys)
    asked = spark.createDataFrame([tuple(v) for v in values], columns)
    buckets = sorted(r[0] for r in _bucketed(asked.withColumn("content_", F.lit(0)), view).select(BUCKET).distinct().collect())
    return stored.where(F.col(BUCKET).isin(buckets)).join(asked, list(view.keys), "left_semi").drop(BUCKET, NUMBER)


def _replace(rows: DataFrame, view: CurrentView, mode: str) -> None:
    placed = rows.drop("version_of_").withColumn(NUMBER, F.lit(view.buckets))
    writer = placed.hint("rebalance", BUCKET).write.mode("overwrite").option("partitionOverwriteMode", mode)
    writer.partitionBy(NUMBER, BUCKET).parquet(view.path)


def merge_current(batch: DataFrame, view: CurrentView) -> list[int]:
    """Merge a cleaned batch into the view; returns the buckets that were rewritten.

    The batch is read twice, once for its buckets: pass one that is stored, such as the run just written to Silver.
    """
    spark = batch.sparkSession
    stored = _stored(spark, view)
    new = _bucketed(batch, view)
    touched = sorted(r[0] for r in new.select(BUCKET).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    if stored is not None:
        old = stored.where(F.col(BUCKET).isin(touched)).drop(BUCKET, NUMBER)
        new = _bucketed(old.unionByName(batch, allowMissingColumns=True), view)
    _replace(newest_versions(new, view.updated, view.by), view, "dynamic")
    return touched


def delete_current(gone: DataFrame, view: CurrentView) -> list[int]:
    """Take the rows of some keys out of the view; returns the buckets that were rewritten.

    Rows without a key stay: what they are versions of is their content, which a key does not tell.
    """
    spark = gone.sparkSession
    stored = _stored(spark, view)
    keys = gone.select(*view.keys).dropna().distinct()
    if stored is None:
        return []
    named = _bucketed(keys.withColumn("content_", F.lit(0)), view).select(BUCKET, *view.keys)
    touched = sorted(r[0] for r in named.select(BUCKET).distinct().collect())  # at most the number of buckets
    if not touched:
        return []
    kept = stored.where(F.col(BUCKET).isin(touched)).drop(NUMBER).join(named.drop(BUCKET), list(view.keys), "left_anti")
    # a dynamic overwrite replaces buckets that get rows; those that keep none are emptied one by one
    emptied = set(touched) - {r[0] for r in kept.select(BUCKET).distinct().collect()}
    _replace(kept, view, "dynamic")
    for bucket in sorted(emptied):
        kept.where(F.lit(False)).drop(BUCKET).write.mode("overwrite").parquet(f"{view.path}/{NUMBER}={view.buckets}/{BUCKET}={bucket}")
    return touched


def rebuild_current(spark: SparkSession, view: CurrentView, silver_root: str) -> None:
    """Make the view anew from all runs of the Silver table, with the number of buckets now wanted."""
    rows = _bucketed(read_silver(spark, silver_root, view.entity), view)
    _replace(newest_versions(rows, view.updated, view.by), view, "static")
