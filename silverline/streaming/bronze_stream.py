"""Bronze to Silver as a stream of arriving files.

Cleaning is stateless and its lookups are static, so the batch specification is used
unchanged. The stream's own checkpoint takes the place of the watermark table. Rows that are
delivered again can be dropped on the way; the stream then remembers what it has passed on.
"""

from __future__ import annotations

import hashlib
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from silverline.plans.spec import EntitySpec
from silverline.plans.transformation import run_cleaning
from silverline.sources.bronze import BATCH_FIELDS, batch_schema, bronze_path
from silverline.sources.sinks import write_silver


def stream_bronze(
    spark: SparkSession,
    root: str,
    entity: str,
    schema: StructType,
    multi_line: bool = False,
    max_files: int | None = None,
) -> DataFrame:
    """Batches as they arrive; ``max_files`` bounds what one trigger takes."""
    reader = spark.readStream.schema(batch_schema(schema)).option("multiLine", multi_line)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.json(bronze_path(root, entity))


def without_repeats(
    rows: DataFrame, remember: str, columns: Sequence[str] | None = None, event_time: Column | None = None
) -> DataFrame:
    """Of rows equal in ``columns``, by default all but the batch columns, the first; the rest within ``remember`` go.

    The stream keeps a digest of each row it has passed on, in its checkpoint and so from one
    start to the next, and forgets it when the watermark is ``remember`` past it. Time is that
    of arrival, so a row is never too late, however old the batch it comes in: a repeat that
    arrives after it was forgotten passes, and is one version more for ``current_silver``.
    With an ``event_time`` repeats are told by that instead, and rows behind the watermark
    are dropped, as by every stateful operator of a stream.

    Sizes: a digest for each row of the time remembered. Where that is more than memory
    holds, keep it on disk by the session's ``spark.sql.streaming.stateStore.providerClass``.
    """
    batch = {f.name for f in BATCH_FIELDS}
    content = list(columns) if columns else [c for c in rows.columns if c not in batch]
    named = rows.withColumns({
        "seen_at_": event_time if event_time is not None else F.current_timestamp(),
        "digest_": F.md5(F.to_json(F.struct(*content))),
    })
    return named.withWatermark("seen_at_", remember).dropDuplicatesWithinWatermark(["digest_"]).drop("seen_at_", "digest_")


def stream_to_silver(
    spark: SparkSession,
    spec: EntitySpec,
    bronze_root: str,
    silver_root: str,
    checkpoint: str,
    lookups: Mapping[str, DataFrame] | None = None,
    multi_line: bool = False,
    max_files: int | None = None,
    every: str | None = None,
    remember: str | None = None,
) -> StreamingQuery:
    """Clean what has arrived since the last start and stop, or keep on ``every`` interval.

    Each micro-batch is a run of :func:`write_silver`, named after the stream's checkpoint
    and its number. A batch that is repeated after a failure replaces itself, so no row is
    lost or doubled, and streams and batch jobs may write the same entity. ``remember``, an
    interval such as ``7 days``, drops rows that are delivered again within it.
    """
    raw = stream_bronze(spark, bronze_root, spec.name, spec.schema, multi_line, max_files)
    raw = without_repeats(raw, remember) if remember else raw
    stream = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def write(batch: DataFrame, number: int) -> None:
        cleaned = run_cleaning(batch, batch.sparkSession, spec=spec, lookups=lookups)
        write_silver(cleaned, silver_root, spec.name, run=f"{stream}-{number}")

    writer = raw.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()
