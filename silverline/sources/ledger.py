"""Warehouse loads that may be repeated: a load is staged under its id and published by one row of a ledger.

The rows of a load lie in a partition of their own. Readers go through a view that shows the partitions the ledger names,
so a load appears at once when its ledger row is there, and rows of a load that failed half-way are never seen. A load
whose id is in the ledger is done and is left alone; one that is not is staged anew, replacing what an attempt before may
have left. A load that replaces the table hides all former ones, which :func:`forget_hidden` removes.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

LEDGER_SCHEMA = "table_name string, load_id string, mode string, n_rows long, loaded_at timestamp"
LOAD = "load_id"


@dataclass(frozen=True)
class LedgerTarget:
    """Tables of one database of the session catalog, stored under ``location`` if given."""

    database: str = "default"
    location: str | None = None
    source: str = "parquet"
    ledger: str = "load_ledger"

    def named(self, table: str) -> str:
        return f"{self.database}.{table}"

    def staged(self, table: str) -> str:
        return f"{table}_loads"


def _save(df: DataFrame, target: LedgerTarget, table: str, mode: str, partition_by: Sequence[str] = ()) -> None:
    writer = df.write.format(target.source).mode(mode).partitionBy(*partition_by)
    if target.location:
        writer = writer.option("path", f"{target.location.rstrip('/')}/{table}")
    writer.saveAsTable(target.named(table))


def ledger(spark: SparkSession, target: LedgerTarget) -> DataFrame:
    """The loads that are done."""
    if not spark.catalog.tableExists(target.named(target.ledger)):
        _save(spark.createDataFrame([], LEDGER_SCHEMA), target, target.ledger, "ignore")
    return spark.table(target.named(target.ledger))


def _done(spark: SparkSession, target: LedgerTarget, table: str, load_id: str) -> int | None:
    row = ledger(spark, target).where((F.col("table_name") == table) & (F.col(LOAD) == load_id)).first()
    return None if row is None else row["n_rows"]


def stage(df: DataFrame, target: LedgerTarget, table: str, load_id: str) -> int:
    """Write the rows of a load where readers do not see them yet; returns their number."""
    spark, name, counted = df.sparkSession, target.staged(table), Observation()
    if not spark.catalog.tableExists(target.named(name)):
        _save(df.where(F.lit(False)).withColumn(LOAD, F.lit(load_id)), target, name, "ignore", [LOAD])
    kept = spark.table(target.named(name)).columns
    if set(kept) != {*df.columns, LOAD}:
        raise ValueError(f"{table} has the columns {sorted(set(kept) - {LOAD})}, not {sorted(df.columns)}")
    rows, names = f"{name}_{uuid.uuid4().hex}", ", ".join(f"`{c}`" for c in kept if c != LOAD)
    df.observe(counted, F.count(F.lit(1)).alias("rows")).createOrReplaceTempView(rows)
    try:  # the partition of this load and no other, also if it has no rows now but had some before
        spark.sql(f"INSERT OVERWRITE TABLE {target.named(name)} PARTITION ({LOAD} = '{load_id}') SELECT {names} FROM {rows}")
    finally:
        spark.catalog.dropTempView(rows)
    return counted.get["rows"]


def load_once(tables: Mapping[str, DataFrame] | None, target: LedgerTarget, load_id: str, mode: str = "append") -> dict[str, int]:
    """Load each table under ``load_id``, once: repeated, it changes nothing and returns the same numbers of rows.

    ``mode`` is ``append``, or ``replace``, after which only this load and later ones are seen.
    """
    if mode not in ("append", "replace"):
        raise ValueError(f"mode must be append or replace, not {mode!r}")
    if not load_id.replace("-", "").replace("_", "").isalnum():
        raise ValueError(f"a load id is made of letters, digits, - and _, unlike {load_id!r}")
    counts = {}
    for table, df in (tables or {}).items():
        spark = df.sparkSession
        counts[table] = _done(spark, target, table, load_id)
        if counts[table] is None:
            counts[table] = stage(df, target, table, load_id)
            row = spark.range(1, numPartitions=1).select(
                F.lit(table).alias("table_name"), F.lit(load_id).alias(LOAD), F.lit(mode).alias("mode"),
                F.lit(counts[table]).cast("long").alias("n_rows"), F.current_timestamp().alias("loaded_at"),
            )
            ledger(spark, target)
            _save(row, target, target.ledger, "append")  # one file, one rename: the load is there or not
    return counts


def visible_loads(spark: SparkSession, target: LedgerTarget, table: str) -> DataFrame:
    """The loads of a table since the last one that replaced it."""
    own = ledger(spark, target).where(F.col("table_name") == table)
    since = own.where("mode = 'replace'").agg(F.max("loaded_at")).first()[0]
    return own if since is None else own.where(F.col("loaded_at") >= F.lit(since))


def loaded(spark: SparkSession, target: LedgerTarget, table: str) -> DataFrame:
    """The rows of a table as readers see them: those of its visible loads, from their partitions only."""
    shown = [r[0] for r in visible_loads(spark, target, table).select(LOAD).distinct().collect()]
    spark.catalog.refreshTable(target.named(target.staged(table)))
    return spark.table(target.named(target.staged(table))).where(F.col(LOAD).isin(shown)).drop(LOAD)


def forget_hidden(spark: SparkSession, target: LedgerTarget, table: str) -> list[str]:
    """Remove the rows of loads that a later one has replaced, and of those that were never published; returns their ids."""
    name = target.named(target.staged(table))
    shown = visible_loads(spark, target, table).select(LOAD)
    hidden = [r[0] for r in spark.table(name).select(LOAD).distinct().join(shown, LOAD, "left_anti").collect()]
    for load_id in hidden:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION ({LOAD} = '{load_id}')")
    return sorted(hidden)


def ledger_statements(staging: str, table: str, columns: Sequence[str], load_id: str, key: str = "id", ledger_table: str = "load_ledger") -> list[str]:
    """The same in a database, to run in one transaction after a staging load.

    The ledger has a primary key over table and load: a repeated load fails at its first statement, before anything
    is changed, and the transaction is rolled back.
    """
    names = ", ".join(columns)
    return [
        f"INSERT INTO {ledger_table} (table_name, load_id, n_rows) SELECT '{table}', '{load_id}', count(*) FROM {staging}",
        f"DELETE FROM {table} WHERE {key} IN (SELECT {key} FROM {staging})",
        f"INSERT INTO {table} ({names}) SELECT DISTINCT {names} FROM {staging}",
        f"DROP TABLE {staging}",
    ]
