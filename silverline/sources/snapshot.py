"""What changed at a source that keeps no usable change time, and what was deleted there.

A control table holds a digest of the content of every key at the last good run. A run compares it with the source by one
full outer join of keys and digests, so rows themselves are not shuffled: only those that are new or changed are read
again, by their keys, and landed in Bronze; keys that are gone are landed as deletions. The new digests are written before
the mark that points to them moves, and the mark moves last, so a run that fails is repeated as if it had not begun.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.dates import parse_timestamp
from silverline.operators.versions import latest_per_key
from silverline.sources.bronze import bronze_path, write_bronze_counted
from silverline.sources.watermark import get_watermark, save_watermark

INSERTED, CHANGED, DELETED, UNCHANGED = "inserted", "changed", "deleted", "unchanged"


@dataclass(frozen=True)
class SnapshotResult:
    """What one run found: keys by status, and the snapshot it was compared with."""

    entity: str
    since: str | None
    run_start: str
    inserted: int
    changed: int
    deleted: int
    unchanged: int


def digests(source: DataFrame, keys: str | Sequence[str] = "id", updated: str = "updated_at") -> DataFrame:
    """The keys and a ``digest`` of each row's other columns; of rows that share a key the newest counts.

    A row without a key, in any of its columns, is known by its content alone: equal ones are one, and a changed one is
    a deletion and an insertion.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    content = [c for c in source.columns if c not in keys]
    at = parse_timestamp(updated) if dict(source.dtypes).get(updated) == "string" else F.col(updated) if updated in content else F.lit(None)
    # JSON keeps the names of columns that hold something, so a value that moves to another column is a change
    narrow = source.select(*keys, F.md5(F.to_json(F.struct(*content))).alias("digest"), at.alias("changed_at"))
    newest = latest_per_key(narrow, keys, ["changed_at", "digest"]).drop("changed_at")
    keyless = F.exists(F.array(*[F.col(c).isNull() for c in keys]), lambda missing: missing)
    return newest.where(~keyless).unionByName(newest.where(keyless).distinct())


def snapshot_difference(now: DataFrame, before: DataFrame, keys: str | Sequence[str] = "id") -> DataFrame:
    """Each key of two tables of :func:`digests` with its ``status`` and its ``digest``, the former one if it is deleted."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    known = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))

    def keyed(table: DataFrame, name: str) -> DataFrame:
        keyless = F.exists(F.array(*[F.col(c).isNull() for c in keys]), lambda missing: missing)
        own = F.concat_ws(":", F.when(keyless, F.col("digest")), *[F.when(F.col(c).isNull(), "-").otherwise(F.concat(F.lit("+"), known(c))) for c in keys])
        return table.select(own.alias("key_"), F.struct(*keys, "digest").alias(name))

    both = keyed(now, "now_").join(keyed(before, "before_"), "key_", "full_outer")
    status = (
        F.when(F.col("before_").isNull(), INSERTED)
        .when(F.col("now_").isNull(), DELETED)
        .when(F.col("now_.digest") == F.col("before_.digest"), UNCHANGED)
        .otherwise(CHANGED)
    )
    row = F.coalesce("now_", "before_")
    return both.select(*[row[c].alias(c) for c in keys], row["digest"].alias("digest"), status.alias("status"))


def changed_rows(source: DataFrame, difference: DataFrame, keys: str | Sequence[str] = "id", updated: str = "updated_at") -> DataFrame:
    """The rows of the source whose keys are new or changed, each once; versions older than the newest stay out."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    wanted = difference.where(F.col("status").isin(INSERTED, CHANGED)).select(*[F.col(c).alias(f"{c}_wanted") for c in keys], "digest")
    content = [c for c in source.columns if c not in keys]
    named = source.withColumn("digest_", F.md5(F.to_json(F.struct(*content))))
    same = [F.col(c).eqNullSafe(F.col(f"{c}_wanted")) for c in keys]
    found = named.join(wanted, [F.col("digest_") == F.col("digest"), *same], "left_semi")
    return found.dropDuplicates([*keys, "digest_"]).drop("digest_")


def _path(control_root: str, entity: str, run: str) -> str:
    return f"{control_root.rstrip('/')}/snapshots/{entity}/run={run.replace(' ', 'T').replace(':', '')}"


def run_snapshot(
    spark: SparkSession,
    entity: str,
    source: DataFrame,
    bronze_root: str,
    control_root: str,
    keys: str | Sequence[str] = "id",
    now: datetime | None = None,
    updated: str = "updated_at",
) -> SnapshotResult:
    """One run by comparison: lands new and changed rows, and the keys that are gone under ``{entity}_deleted``."""
    now = now or datetime.now(timezone.utc)
    keys = [keys] if isinstance(keys, str) else list(keys)
    run_start, mark = now.strftime("%Y-%m-%d %H:%M:%S"), f"{entity}#snapshot"
    since = get_watermark(spark, control_root, mark)
    new = _path(control_root, entity, run_start)
    if since == run_start:
        raise ValueError(f"the run of {entity} at {run_start} is done already")
    digests(source, keys, updated).write.mode("overwrite").parquet(new)
    held = spark.read.parquet(new)
    before = spark.read.parquet(_path(control_root, entity, since)) if since else held.where(F.lit(False))
    difference = snapshot_difference(held, before, keys).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        counts = {r.status: r["count"] for r in difference.groupBy("status").count().collect()}  # four rows at most
        day, run = now.date().isoformat(), now.strftime("%H%M%S%f")
        write_bronze_counted(changed_rows(source, difference, keys, updated), bronze_root, entity, day, run)
        gone = difference.where(F.col("status") == DELETED).select(*keys, "digest", F.lit(run_start).alias("deleted_at"))
        write_bronze_counted(gone, bronze_root, f"{entity}_deleted", day, run)
    finally:
        difference.unpersist()
    save_watermark(spark, control_root, mark, run_start)
    return SnapshotResult(entity, since, run_start, *[counts.get(s, 0) for s in (INSERTED, CHANGED, DELETED, UNCHANGED)])


def deletions(spark: SparkSession, bronze_root: str, entity: str, keys: str, ingestion_date: str, run_id: str) -> DataFrame:
    """The keys that a run found gone; ``keys`` is their DDL, such as ``id long``."""
    path = f"{bronze_path(bronze_root, f'{entity}_deleted')}/ingestion_date={ingestion_date}/run_id={run_id}"
    return spark.read.schema(f"{keys}, digest string, deleted_at string").json(path)
