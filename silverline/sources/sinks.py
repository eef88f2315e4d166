"""Sinks: partitioned Silver parquet, a JDBC warehouse, or tables of the catalog."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce
from typing import Protocol
from urllib.parse import quote

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from silverline.functions.dates import parse_timestamp
from silverline.operators.versions import latest_per_key

# The partition level that keeps runs apart.
SILVER_RUN = "silver_run"

# What to do when the target table exists.
WRITE_MODES = {"append": "append", "replace": "overwrite", "fail": "errorifexists"}


def silver_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def write_silver(
    df: DataFrame,
    root: str,
    entity: str,
    partition_by: Sequence[str] = ("ingestion_date",),
    rebalance: bool = False,
    run: str | None = None,
) -> int:
    """Write cleaned rows as parquet and return their number.

    Every run has its own folder, partitioned below, so runs add up, on one day too, and
    a run that is repeated under its name replaces itself as a whole, also on another day
    or with fewer rows. Without a name it gets a new one. A repeat that fails leaves the
    run out until it is repeated again. :func:`current_silver` takes the newest version of
    each key.

    One processing date per run needs no shuffle. When rows of many partitions are mixed,
    ``rebalance`` brings each together first and lets adaptive execution split the large
    ones, which avoids both a file per task and partition and one task per hot partition.
    """
    if rebalance and partition_by:
        df = df.hint("rebalance", *partition_by)
    counted = Observation()
    writer = df.observe(counted, F.count(F.lit(1)).alias("rows")).write.mode("overwrite")
    writer = writer.option("partitionOverwriteMode", "static").partitionBy(*partition_by)
    writer.parquet(f"{silver_path(root, entity)}/{SILVER_RUN}=run-{quote(run or uuid.uuid4().hex, safe='')}")
    return counted.get["rows"]


def read_silver(spark: SparkSession, root: str, entity: str, runs: bool = False) -> DataFrame:
    """The rows of all runs; ``runs`` keeps the name of the run each belongs to."""
    rows = spark.read.parquet(silver_path(root, entity))
    return rows if runs else rows.drop(SILVER_RUN)


# Columns that tell when a row was delivered and cleaned, oldest first.
DELIVERY = ("bronze_ingestion_date", "run_id", "ingestion_timestamp", "ingestion_date")


def versioned(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``version_of_``, what a row is a version of: its key, or its content if it has no key."""
    content = [c for c in rows.columns if c not in (*DELIVERY, *keys)]
    keyless = reduce(Column.__or__, [F.col(c).isNull() for c in keys])
    values = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in keys]
    told_apart = F.when(keyless, F.md5(F.to_json(F.struct(*content)))).otherwise(F.lit(""))
    return rows.withColumn("version_of_", F.struct(told_apart, *values))


def newest_versions(rows: DataFrame, updated: str = "updated_at", by: str = "change") -> DataFrame:
    """The newest row of each ``version_of_``; ``by`` says what newest means, ``change`` time or ``delivery``."""
    order = {"change": [parse_timestamp(updated)], "delivery": []}[by] + [c for c in DELIVERY if c in rows.columns]
    return latest_per_key(rows, "version_of_", [*order, parse_timestamp(updated)])


def current_silver(
    spark: SparkSession,
    root: str,
    entity: str,
    keys: str | Sequence[str] = "id",
    updated: str = "updated_at",
    by: str = "change",
) -> DataFrame:
    """The newest version of each key over all runs.

    Newest by change time, then by Bronze batch, then by processing time; a version whose
    change time cannot be read is older than all dated ones. ``by="delivery"`` goes by batch
    and processing time first, which is right where batches are never delivered late.
    Rows without a key have no versions: each content of them stands once, however often it
    was delivered. :mod:`silverline.sources.current` keeps the result between runs.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    rows = read_silver(spark, root, entity)
    return newest_versions(versioned(rows, keys), updated, by).drop("version_of_")


class Target(Protocol):
    def write(self, df: DataFrame, table: str, mode: str, batch_size: int) -> None: ...


@dataclass(frozen=True)
class JdbcTarget:
    """A database. Executors write in parallel, each partition in its own transaction.

    A task that is repeated after its executor was lost may insert its rows twice, and
    readers see a load in progress. Load into a staging table and run
    :func:`publish_statements` to avoid both.
    """

    url: str
    properties: Mapping[str, str] = field(default_factory=dict)
    connections: int = 16

    def options(self, table: str, batch_size: int) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": table,
            "batchsize": str(batch_size),
            "numPartitions": str(self.connections),
            **self.properties,
        }

    def write(self, df: DataFrame, table: str, mode: str, batch_size: int) -> None:
        # Left to itself the writer narrows the whole stage to this many tasks; the
        # shuffle keeps cleaning parallel and only the inserts on few connections.
        rows = df.repartition(self.connections)
        rows.write.format("jdbc").options(**self.options(table, batch_size)).mode(mode).save()


@dataclass(frozen=True)
class CatalogTarget:
    """Tables of the session catalog, in one database, stored under ``location`` if given."""

    database: str = "default"
    source: str = "parquet"
    location: str | None = None

    def write(self, df: DataFrame, table: str, mode: str, batch_size: int) -> None:
        writer = df.write.format(self.source).mode(mode)
        if self.location:
            writer = writer.option("path", f"{self.location.rstrip('/')}/{table}")
        writer.saveAsTable(f"{self.database}.{table}")


def publish_statements(staging: str, table: str, columns: Sequence[str], key: str = "id") -> list[str]:
    """SQL to run in one database transaction after a staging load.

    Replaces the rows with the same key and inserts each staged row once.
    """
    names = ", ".join(columns)
    return [
        f"DELETE FROM {table} WHERE {key} IN (SELECT {key} FROM {staging})",
        f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging}",
        f"DROP TABLE {staging}",
    ]


def load_dataframe(
    df: DataFrame, table_name: str, target: Target, if_exists: str = "append", chunksize: int = 1000
) -> int:
    """Write a table and return the number of rows, counted during the write."""
    if if_exists not in WRITE_MODES:
        raise ValueError(f"if_exists must be one of {', '.join(WRITE_MODES)}, not {if_exists!r}")
    counted = Observation()
    target.write(
        df.observe(counted, F.count(F.lit(1)).alias("rows")), table_name, WRITE_MODES[if_exists], chunksize
    )
    return counted.get["rows"]


def load_all(
    tables: Mapping[str, DataFrame] | None, target: Target, if_exists: str = "append", chunksize: int = 1000
) -> dict[str, int]:
    """Write each entity to the table of its name; nothing to load gives ``{}``."""
    return {name: load_dataframe(df, name, target, if_exists, chunksize) for name, df in (tables or {}).items()}
