"""Column profiles that add up: sketches kept for each run and merged, so that no run is read again.

A run's profile is one aggregation of the run: for each column the rows, the NULLs, a sketch of its distinct values, one
of its most frequent values and, for numbers, one of its quantiles. The profile of any runs is that of their merged
sketches, a few kilobytes a column and run, whatever the runs' sizes.

Errors: distinct values are within about 5 % at 2^12 registers (three standard errors); a quantile's rank is within 1 %
at 400; a frequent value's count is exact while a column has no more distinct values than ``tracked``, and else too high
by no more than rows / tracked.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

REGISTERS = 12  # log2 of the registers that count distinct values
RANKS = 400  # size of the sketch of quantiles
TRACKED = 10_000  # values whose frequency is followed
QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
_NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def sketched(df: DataFrame, columns: Sequence[str] | None = None, tracked: int = TRACKED) -> DataFrame:
    """One row for each column with its sketches; one pass over the table, aggregated before the shuffle."""
    kinds = dict(df.dtypes)
    columns = list(columns or df.columns)
    parts = []
    for i, c in enumerate(columns):
        text, number = F.col(c).cast("string"), kinds[c].startswith(_NUMBERS)
        value = F.col(c).cast("double") if number else F.lit(None).cast("double")
        parts += [
            F.count_if(F.col(c).isNull()).alias(f"nulls_{i}"),
            F.hll_sketch_agg(text, REGISTERS).alias(f"distinct_{i}"),
            F.call_function("approx_top_k_accumulate", text, F.lit(tracked)).alias(f"frequent_{i}"),
            F.kll_sketch_agg_double(value, RANKS).alias(f"ranks_{i}"),
        ]
    row = df.agg(F.count(F.lit(1)).alias("n_rows"), *parts)
    lines = F.array(*[
        F.struct(F.lit(c).alias("column"), *[F.col(f"{name}_{i}").alias(name) for name in ("nulls", "distinct", "frequent", "ranks")])
        for i, c in enumerate(columns)
    ])
    return row.select("n_rows", F.explode(lines).alias("line")).select("n_rows", "line.*")


def _path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def keep_profile(run: DataFrame, root: str, entity: str, name: str, columns: Sequence[str] | None = None, tracked: int = TRACKED) -> None:
    """Store the sketches of a run under its name; a repeated run replaces its own."""
    sketched(run, columns, tracked).coalesce(1).write.mode("overwrite").parquet(f"{_path(root, entity)}/profiled_run={name}")


def kept_profiles(spark: SparkSession, root: str, entity: str) -> DataFrame | None:
    """The sketches of all runs, or None before the first."""
    try:
        return spark.read.option("basePath", _path(root, entity)).parquet(f"{_path(root, entity)}/profiled_run=*")
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def merged_profile(sketches: DataFrame, quantiles: Sequence[float] = QUANTILES, top: int = 5, tracked: int = TRACKED) -> DataFrame:
    """One row for each column over some runs: ``n_rows``, ``n_nulls``, ``n_distinct``, ``quantiles`` and the ``top`` values.

    Columns that a run lacks count with the rows of the runs that have them.
    """
    merged = sketches.groupBy("column").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("nulls").alias("n_nulls"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.call_function("approx_top_k_combine", F.col("frequent"), F.lit(tracked)).alias("frequent"),
        F.kll_merge_agg_double("ranks").alias("ranks"),
    )
    asked = F.array(*[F.lit(float(q)) for q in quantiles])
    return merged.select(
        "column",
        "n_rows",
        "n_nulls",
        F.hll_sketch_estimate("distinct").alias("n_distinct"),
        F.when(F.kll_sketch_get_n_double("ranks") > 0, F.kll_sketch_get_quantile_double("ranks", asked)).alias("quantiles"),
        F.call_function("approx_top_k_estimate", F.col("frequent"), F.lit(top)).alias("top"),
    )
