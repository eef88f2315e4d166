"""Incremental runs: read the mark, take what changed since, land it, move the mark."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.dates import parse_timestamp
from silverline.sources.bronze import write_bronze_counted
from silverline.sources.watermark import get_watermark, save_watermark

# The entities of a full run, in order.
ENTITIES = [
    "customers",
    "products",
    "reviews",
    "categories",
    "suppliers",
    "payments",
    "inventory",
    "shipping",
    "coupons",
]


@dataclass(frozen=True)
class RunResult:
    """What one run did: the mark it started from, the rows it landed, and how many of them bear no readable date."""

    entity: str
    since: str | None
    run_start: str
    rows: int
    undated: int = 0


def changed_since(
    df: DataFrame, since: str | None, column: str = "updated_at", keep_undated: bool = True
) -> DataFrame:
    """Rows changed at or after the mark; everything when there is no mark.

    A value without a time of day, typed or text, stands for any moment of its day, so it
    is compared with the day of the mark. Typed columns are compared as they are, which
    reaches the scan. Rows whose change time cannot be read are delivered again by every
    run rather than lost; ``keep_undated=False`` leaves them out.
    """
    if since is None:
        return df
    value, mark, kind = F.col(column), F.lit(since).cast("timestamp"), dict(df.dtypes)[column]
    day = F.lit(since).cast("timestamp").cast("date")
    if kind.startswith("timestamp"):
        at, recent = value, value >= mark
    elif kind == "date":
        at, recent = value, value >= day
    else:
        at = parse_timestamp(column)
        recent = F.when(value.contains(":"), at >= mark).otherwise(at.cast("date") >= day)
    return df.filter(recent | at.isNull() if keep_undated else recent)


def run_entity(
    spark: SparkSession,
    entity: str,
    source: DataFrame,
    bronze_root: str,
    control_root: str,
    now: datetime | None = None,
    column: str = "updated_at",
) -> RunResult:
    """One incremental run. The mark moves last, also when no row was new.

    Rows whose change time cannot be read are landed by every run, because nothing tells
    whether they changed. The result counts them; ``latest_per_key`` takes them apart.

    The new mark is the time the run began, so rows that change while it works are
    taken again by the next run. A run that fails leaves the mark where it was.
    """
    now = now or datetime.now(timezone.utc)
    run_start = now.strftime("%Y-%m-%d %H:%M:%S")
    since = get_watermark(spark, control_root, entity)
    rows = changed_since(source, since, column)
    if since is not None:  # few rows of many: kept, so that finding the first does not cost a scan of its own
        rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    undated = parse_timestamp(column).isNull() if dict(rows.dtypes)[column] == "string" else F.col(column).isNull()
    try:
        counts = write_bronze_counted(
            rows, bronze_root, entity, now.date().isoformat(), now.strftime("%H%M%S%f"), {"undated": F.count_if(undated)}
        )
    finally:
        rows.unpersist()
    save_watermark(spark, control_root, entity, run_start)
    return RunResult(entity, since, run_start, counts["rows"], counts["undated"])


def run_all(
    spark: SparkSession,
    sources: Mapping[str, DataFrame],
    bronze_root: str,
    control_root: str,
    entities: Iterable[str] | None = None,
    now: datetime | None = None,
) -> list[RunResult]:
    """Run the named entities, or all known ones that have a source."""
    chosen = list(entities) if entities is not None else [e for e in ENTITIES if e in sources]
    return [run_entity(spark, e, sources[e], bronze_root, control_root, now) for e in chosen]
