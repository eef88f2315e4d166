"""Quality reports as DataFrames. Every profile is one aggregation, one pass."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from contextlib import contextmanager
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from silverline.functions.text import UNKNOWN, is_blank
from silverline.operators.columns import clean_name
from silverline.operators.lookup import REVIEW

NAME_RESIDUE = r"[^a-zA-Z\s'-]"


def clean_pairs(df: DataFrame) -> list[tuple[str, str]]:
    """(raw, clean) for every column that has a cleaned sibling."""
    return [(c, clean_name(c)) for c in df.columns if clean_name(c) in df.columns]


def _text(df: DataFrame, column: str) -> Column:
    """The column as text, so that raw text and typed values compare under ANSI."""
    value = F.col(column)
    return value if dict(df.dtypes)[column] == "string" else value.cast("string")


def changed(df: DataFrame, raw: str, clean: str) -> Column:
    """Null-safe difference: a NULL that became a sentinel counts as changed."""
    return ~_text(df, raw).eqNullSafe(_text(df, clean))


def date_failed(raw: str, clean: str) -> Column:
    """A value was there but no date came out."""
    return ~is_blank(F.col(raw)) & F.col(clean).isNull()


def row_count(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows"))


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row with the number of NULLs of each column."""
    return df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns or df.columns])


def change_profile(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row with the number of changed values per raw column."""
    return df.agg(*[F.count_if(changed(df, raw, clean)).alias(raw) for raw, clean in pairs or clean_pairs(df)])


def percent(part: Column, whole: Column) -> Column:
    return F.round(F.try_divide(part * 100, whole), 1)


def impact_summary(df: DataFrame, raw: str, clean: str | None = None, sentinel: str = UNKNOWN) -> DataFrame:
    """Rows, changed rows and sentinel rows of one column, with percentages."""
    clean = clean or clean_name(raw)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(changed(df, raw, clean)).alias("changed"),
        F.count_if(F.col(clean) == sentinel).alias("unknown"),
    )
    return counts.select(
        "total",
        "changed",
        percent(F.col("changed"), F.col("total")).alias("changed_pct"),
        "unknown",
        percent(F.col("unknown"), F.col("total")).alias("unknown_pct"),
    )


def quality_report(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per cleaned column from a single pass over the table.

    Columns: column, total, raw_nulls, clean_nulls, changed, unknown, review and
    failed_dates. The last is zero for columns that are not dates, the two before it
    are zero for columns that are not text.
    """
    return _report_lines(df.groupBy(), df, pairs or clean_pairs(df))


def quality_rollup(
    df: DataFrame, by: Sequence[str], sets: Sequence[Sequence[str]] | None = None, pairs: Sequence[tuple[str, str]] | None = None
) -> DataFrame:
    """The lines of :func:`quality_report` for several groupings at once, in one pass.

    ``sets`` lists the groupings, each some of the columns ``by``; without it they are those of
    a rollup: all columns, all but the last, and so on to none. Spark expands each row to one
    per grouping and aggregates it before the shuffle, so few rows move however large a group
    is. ``grouped_by`` names the columns of a line's grouping; the others are NULL in it.
    """
    by = list(by)
    sets = [by[:n] for n in range(len(by), -1, -1)] if sets is None else [list(s) for s in sets]
    grouped = df.groupingSets([[F.col(c) for c in s] for s in sets], *[F.col(c) for c in by])
    # of the bits of the grouping's number, a set one is a column that is not part of it
    left_out = lambda i: F.shiftright(F.grouping_id(), len(by) - 1 - i).bitwiseAND(F.lit(1)) == 1
    named = F.concat_ws(",", *[F.when(~left_out(i), F.lit(c)) for i, c in enumerate(by)])
    return _report_lines(grouped, df, pairs or clean_pairs(df), by, named.alias("grouped_by"))


def _report_lines(grouped: GroupedData, df: DataFrame, pairs: Sequence[tuple[str, str]], by: Sequence[str] = (), *more: Column) -> DataFrame:
    pairs = list(pairs)
    types = dict(df.dtypes)

    def metrics(raw: str, clean: str) -> dict[str, Column]:
        is_text, is_date = types[clean] == "string", types[clean] == "date"
        never = F.lit(False)
        return {
            "raw_nulls": F.col(raw).isNull(),
            "clean_nulls": F.col(clean).isNull(),
            "changed": changed(df, raw, clean),
            "unknown": F.col(clean) == UNKNOWN if is_text else never,
            "review": F.col(clean) == REVIEW if is_text else never,
            "failed_dates": date_failed(raw, clean) if is_date else never,
        }

    per_pair = {raw: metrics(raw, clean) for raw, clean in pairs}
    counted = grouped.agg(
        F.count(F.lit(1)).alias("total"),
        *more,
        *[
            F.struct(*[F.count_if(condition).alias(name) for name, condition in per_pair[raw].items()]).alias(f"m_{i}")
            for i, (raw, _) in enumerate(pairs)
        ],
    )
    lines = F.array(*[F.struct(F.lit(raw).alias("column"), F.col(f"m_{i}").alias("m")) for i, (raw, _) in enumerate(pairs)])
    kept = [*by, *(c for c in counted.columns if c == "grouped_by")]
    return counted.select(*kept, F.explode(lines).alias("line"), "total").select(*kept, "line.column", "total", "line.m.*")


def frequency(df: DataFrame, column: str, ordered: bool = True) -> DataFrame:
    """Count per value, the most frequent first."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n_rows"))
    return counts.orderBy(F.desc("n_rows"), column) if ordered else counts


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def distinct_mapping(df: DataFrame, raw: str, clean: str | None = None) -> DataFrame:
    """What each raw value became, sorted by raw value."""
    clean = clean or clean_name(raw)
    return df.select(raw, clean).distinct().orderBy(raw, clean)


def review_queue(df: DataFrame, raw: str, clean: str | None = None, mark: str = REVIEW) -> DataFrame:
    """Distinct raw values marked for manual review, with their row counts."""
    marked = df.filter(F.col(clean or clean_name(raw)) == mark)
    return marked.groupBy(raw).agg(F.count(F.lit(1)).alias("n_rows"))


def sentinel_count(df: DataFrame, column: str, sentinel: str = UNKNOWN) -> DataFrame:
    return df.agg(F.count_if(F.col(column) == sentinel).alias("n_rows"))


def sample(df: DataFrame, n: int = 20, key: str = "id") -> DataFrame:
    """The first ``n`` rows by key, the same ones every time."""
    return df.orderBy(key).limit(n)


def before_after(df: DataFrame, pairs: Sequence[tuple[str, str]] | None = None, keys: Sequence[str] = ()) -> DataFrame:
    """``{column}_before`` and ``{column}_after`` side by side."""
    columns = [
        F.col(source).alias(f"{raw}_{side}")
        for raw, clean in pairs or clean_pairs(df)
        for side, source in (("before", raw), ("after", clean))
    ]
    return df.select(*keys, *columns)


def changed_rows(df: DataFrame, raw: str, clean: str | None = None) -> DataFrame:
    return df.filter(changed(df, raw, clean or clean_name(raw)))


def sentinel_rows(df: DataFrame, column: str, sentinel: str = UNKNOWN) -> DataFrame:
    return df.filter(F.col(column) == sentinel)


def failed_dates(df: DataFrame, raw: str, clean: str | None = None) -> DataFrame:
    return df.filter(date_failed(raw, clean or clean_name(raw)))


def failed_date_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row with the number of unreadable dates per raw column."""
    return df.agg(*[F.count_if(date_failed(c, clean_name(c))).alias(c) for c in columns])


def residual_characters(df: DataFrame, column: str, pattern: str = NAME_RESIDUE) -> DataFrame:
    """Rows whose text still has a character the pattern forbids."""
    return df.filter(F.col(column).rlike(pattern))


def entity_summary(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and audit columns of each table, in one plan."""
    lines = [
        df.agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(name).alias("entity"),
            "n_rows",
            F.lit(", ".join(c for c in df.columns if "ingestion" in c or "audit" in c)).alias("audit_columns"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, lines)


def column_sums(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """One row per cleaned column: rows, values, and characters of the values as text, in one pass."""
    columns = list(columns or [clean for _, clean in clean_pairs(df)])
    counted = df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        *[
            F.struct(F.count(c).alias("n_values"), F.coalesce(F.sum(F.length(_text(df, c))), F.lit(0)).alias("chars")).alias(f"m_{i}")
            for i, c in enumerate(columns)
        ],
    )
    lines = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"m_{i}").alias("m")) for i, c in enumerate(columns)])
    return counted.select("n_rows", F.explode(lines).alias("line")).select("n_rows", "line.column", "line.m.*")


def schema_report(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type and the number of values it holds."""
    rows = [
        {"position": F.lit(i), "column": F.lit(name), "type": F.lit(kind)} for i, (name, kind) in enumerate(df.dtypes)
    ]
    return _with_value_counts(df, df.columns, rows)


def schema_differences(df: DataFrame, expected: StructType) -> DataFrame:
    """Columns whose type is not the expected one, with the values they hold.

    A column that only one side has is NULL on the other.
    """
    actual = dict(df.dtypes)
    wanted = {f.name: f.dataType.simpleString() for f in expected.fields}
    names = list(wanted) + [c for c in actual if c not in wanted]
    differing = [c for c in names if wanted.get(c) != actual.get(c)]
    rows = [
        {
            "column": F.lit(c),
            "expected": F.lit(wanted.get(c)).cast("string"),
            "actual": F.lit(actual.get(c)).cast("string"),
        }
        for c in differing
    ]
    return _with_value_counts(df, differing, rows)


def _with_value_counts(df: DataFrame, columns: Sequence[str], rows: Sequence[Mapping[str, Column]]) -> DataFrame:
    """One described column per row, with ``n_values`` counted in one pass."""
    held = [F.count(c) if c in df.columns else F.lit(0).cast("bigint") for c in columns]
    counted = df.agg(F.count(F.lit(1)).alias("total"), *[n.alias(f"n{i}") for i, n in enumerate(held)])
    lines = [
        F.struct(*[value.alias(name) for name, value in row.items()], F.col(f"n{i}").alias("n_values"))
        for i, row in enumerate(rows)
    ]
    if not lines:
        lines = [F.lit(None).cast("struct<column: string, expected: string, actual: string, n_values: bigint>")]
        counted = counted.limit(0)
    return counted.select(F.inline(F.array(*lines)))


def keep_for_reports(df: DataFrame) -> DataFrame:
    """Persist a cleaned table that several reports will read, spilling to disk.

    Not needed for one :func:`quality_report`, which reads the table once. The table stays
    until it is released with ``unpersist()``; :func:`kept_for_reports` does that by itself.
    """
    return df.persist(StorageLevel.MEMORY_AND_DISK)


@contextmanager
def kept_for_reports(df: DataFrame) -> Iterator[DataFrame]:
    """The same for reports that are written within a block; the table is released at its end, also after a failure."""
    kept = keep_for_reports(df)
    try:
        yield kept
    finally:
        kept.unpersist()
