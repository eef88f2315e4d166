"""Latest version of each key over batches that deliver changed rows again."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions.dates import parse_timestamp

VERSION_ORDER = ("updated_at_clean", "bronze_ingestion_date", "run_id")


def latest_per_key(
    df: DataFrame, keys: str | Sequence[str] = "id", order: Sequence[str | Column] = VERSION_ORDER
) -> DataFrame:
    """One row per key: the greatest in ``order``, missing values counting as oldest.

    A row whose key is missing, in any of its columns, is no version of another one: all
    such rows stay. Otherwise an aggregation, not a window: the greatest row per key is
    kept on the map side first, so a key with very many versions sends one row per task.
    Rows equal in ``order`` are told apart by their other columns, so repeated runs agree.
    Columns the table lacks are left out of the order.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    ranks = [
        c.alias(f"rank_{i}") if isinstance(c, Column) else F.col(c).alias(f"rank_{i}")
        for i, c in enumerate(order)
        if isinstance(c, Column) or (c in df.columns and c not in keys)
    ]
    named = {c for c in order if isinstance(c, str)}
    values = [c for c in df.columns if c not in keys]
    newest = F.max(F.struct(*ranks, *[c for c in values if c not in named], *[c for c in values if c in named]))
    # Keyless rows get a key of their own each; the table is read once for both kinds.
    keyless = reduce(Column.__or__, [F.col(c).isNull() for c in keys])
    own = F.when(keyless, F.monotonically_increasing_id())
    grouped = df.withColumn("own_key_", own).groupBy(*keys, "own_key_").agg(newest.alias("row_"))
    return grouped.select(*[F.col(c) if c in keys else F.col("row_")[c].alias(c) for c in df.columns])


def latest_raw(df: DataFrame, keys: str | Sequence[str] = "id", updated: str = "updated_at") -> DataFrame:
    """Latest raw row per key, by the time read from the raw ``updated`` text.

    Done before cleaning it spares cleaning the older versions, and it tells apart
    versions of one day, which a cleaned date does not.
    """
    return latest_per_key(df, keys, [parse_timestamp(updated), "ingestion_date", "run_id"])
