"""Registered queries and, where SQL can express them, their equivalents in ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under a name, with the SQL that must give the same rows."""

    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = sql
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def portable(df: DataFrame, *integers: str) -> DataFrame:
    """DATE columns and the named integer columns, which hold NULLs, as text.

    Clients turn nullable integers into floats and dates into timestamps, each in its own
    way; as text they are the same everywhere.
    """
    kinds = dict(df.dtypes)
    as_text = {c for c in df.columns if kinds[c] == "date" or c in integers}
    return df.select(*[F.col(c).cast("string").alias(c) if c in as_text else F.col(c) for c in df.columns])
