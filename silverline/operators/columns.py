"""Column operators on DataFrames: add ``{column}_clean``, or cast in place.

All of them are row-preserving projections. Operators that take several columns add
them in one ``withColumns``, so the plan stays flat however many there are.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.functions import casts, dates, text, validation
from silverline.functions.mapping import map_values

CLEAN_SUFFIX = "_clean"


class MissingColumnWarning(UserWarning):
    """Rules name columns the table does not have; they were skipped."""

    def __init__(self, subject: str, columns: Sequence[str]) -> None:
        super().__init__(f"{subject}: skipped missing {', '.join(columns)}")
        self.subject = subject
        self.columns = list(columns)


def clean_name(column: str) -> str:
    return column + CLEAN_SUFFIX


def present(df: DataFrame, columns: Iterable[str], subject: str) -> list[str]:
    """The columns the table has; warns once about the others."""
    wanted = list(columns)
    missing = [c for c in wanted if c not in df.columns]
    if missing:
        warnings.warn(MissingColumnWarning(subject, missing), stacklevel=3)
    return [c for c in wanted if c in df.columns]


def clean_text_column(
    df: DataFrame,
    column_name: str,
    keep_chars: str = "'-",
    replacement: str = text.UNKNOWN,
    case_mode: str = "title",
    keep_digits: bool = False,
    unicode: bool = False,
) -> DataFrame:
    """Add ``{column}_clean`` with cleaned text."""
    value = text.clean_text(F.col(column_name), keep_chars, replacement, case_mode, keep_digits, unicode)
    return df.withColumn(clean_name(column_name), value)


def clean_code_column(df: DataFrame, column_name: str, keep_chars: str = "-") -> DataFrame:
    """Add ``{column}_clean`` with an upper-case identifier without spaces."""
    return df.withColumn(clean_name(column_name), text.clean_code(F.col(column_name), keep_chars))


def clean_email_column(df: DataFrame, column_name: str = "email") -> DataFrame:
    return df.withColumn(clean_name(column_name), validation.clean_email(F.col(column_name)))


def clean_phone_column(df: DataFrame, column_name: str = "phone") -> DataFrame:
    return df.withColumn(clean_name(column_name), validation.clean_phone(F.col(column_name)))


def clean_category_column(
    df: DataFrame, column_name: str, mapping: Mapping[str, str], default: str = text.UNKNOWN
) -> DataFrame:
    return df.withColumn(clean_name(column_name), map_values(F.col(column_name), mapping, default))


def clean_date_columns(
    df: DataFrame,
    date_columns: Sequence[str],
    formats: Sequence[str] = dates.KNOWN_DATE_FORMATS,
    precedence: str = "first",
) -> DataFrame:
    """Add a DATE ``{column}_clean`` per column, keeping the raw text beside it."""
    return df.withColumns(
        {
            clean_name(c): dates.parse_date(c, formats=formats, precedence=precedence)
            for c in present(df, date_columns, "date columns")
        }
    )


def text_columns(df: DataFrame) -> set[str]:
    return {name for name, kind in df.dtypes if kind == "string"}


def safe_cast_int(df: DataFrame, col_name: str, null_replacement: int | None = None) -> DataFrame:
    value = casts.to_int(F.col(col_name), null_replacement, from_text=col_name in text_columns(df))
    return df.withColumn(col_name, value)


def safe_cast_long(df: DataFrame, col_name: str) -> DataFrame:
    return cast_schema(df, {col_name: "long"})


def safe_cast_double(df: DataFrame, col_name: str) -> DataFrame:
    return cast_schema(df, {col_name: "double"})


def safe_cast_date(df: DataFrame, col_name: str, date_format: str = dates.ISO_DATE_FORMAT) -> DataFrame:
    return df.withColumn(col_name, casts.to_date(F.col(col_name), date_format))


def safe_cast_bool(df: DataFrame, col_name: str, default: bool = False) -> DataFrame:
    return df.withColumn(col_name, casts.to_bool(F.col(col_name), default))


def cast_schema(df: DataFrame, schema_map: Mapping[str, str]) -> DataFrame:
    """Cast columns in place by a map of column to int, long, double, date or bool."""
    columns, texts = present(df, schema_map, "casts"), text_columns(df)
    return df.withColumns({c: casts.cast_value(F.col(c), schema_map[c], c in texts) for c in columns})


def cast_failure_flags(df: DataFrame, schema_map: Mapping[str, str]) -> DataFrame:
    """Add ``{column}_cast_failed`` for the raw columns of a type map.

    Apply it before :func:`cast_schema`, which replaces the raw values.
    """
    columns, texts = present(df, schema_map, "cast flags"), text_columns(df)
    return df.withColumns(
        {f"{c}_cast_failed": casts.cast_failed(F.col(c), schema_map[c], c in texts) for c in columns}
    )


def audit_values(timestamp_col: str = "ingestion_timestamp") -> dict[str, Column]:
    return {timestamp_col: F.current_timestamp(), "ingestion_date": F.current_date()}


def add_audit_timestamps(df: DataFrame, timestamp_col: str = "ingestion_timestamp") -> DataFrame:
    """Add when the row was processed.

    A partition date that came with the raw batch is kept as ``bronze_ingestion_date``.
    """
    if "ingestion_date" in df.columns:
        df = df.withColumnRenamed("ingestion_date", "bronze_ingestion_date")
    return df.withColumns(audit_values(timestamp_col))
