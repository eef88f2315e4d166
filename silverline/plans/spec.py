"""Declarative entity specifications and what they compile to.

A specification names the columns of a table and the rule each one follows. It compiles
to one flat projection over the raw columns, one left join per reference column, and
nothing else: no row is filtered, added or moved.
"""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from silverline.functions import casts, dates, text, validation
from silverline.functions.mapping import map_values
from silverline.operators.columns import (
    audit_values,
    clean_name,
    present,
    text_columns,
)
from silverline.operators.integrity import Rule
from silverline.operators.lookup import join_lookup, normalized


@dataclass(frozen=True)
class TextRule:
    """How one text column is cleaned. ``strip_html`` also replaces the raw column.

    Letters are ASCII ones unless ``unicode`` is set.
    """

    keep_chars: str = ""
    replacement: str = text.UNKNOWN
    case_mode: str = "title"
    keep_digits: bool = False
    strip_html: bool = False
    unicode: bool = False

    def __post_init__(self) -> None:
        if self.case_mode not in text.CASE_MODES:
            raise ValueError(f"unknown case mode {self.case_mode!r}")

    def source(self, col: Column) -> Column:
        return text.strip_html_tags(col) if self.strip_html else col

    def apply(self, column: str) -> Column:
        return text.clean_text(
            self.source(F.col(column)),
            self.keep_chars,
            self.replacement,
            self.case_mode,
            self.keep_digits,
            self.unicode,
        )


@dataclass(frozen=True)
class CodeRule:
    """An identifier: upper case, no spaces."""

    keep_chars: str = "-"

    def apply(self, column: str) -> Column:
        return text.clean_code(F.col(column), self.keep_chars)


@dataclass(frozen=True)
class MapRule:
    """A category with a closed list of canonical values."""

    mapping: Mapping[str, str]
    default: str = text.UNKNOWN

    def apply(self, column: str) -> Column:
        return map_values(F.col(column), self.mapping, self.default)


@dataclass(frozen=True)
class EmailRule:
    def apply(self, column: str) -> Column:
        return validation.clean_email(F.col(column))


@dataclass(frozen=True)
class PhoneRule:
    def apply(self, column: str) -> Column:
        return validation.clean_phone(F.col(column))


@dataclass(frozen=True)
class DateRule:
    """Formats are tried in order; ``precedence="last"`` prefers the later ones."""

    formats: tuple[str, ...] = tuple(dates.KNOWN_DATE_FORMATS)
    precedence: str = "first"

    def apply(self, column: str) -> Column:
        return dates.parse_date(column, formats=self.formats, precedence=self.precedence)


@dataclass(frozen=True)
class ReferenceRule:
    """A value normalised against the lookup table given when the plan is made."""

    lookup: str = "country"


ColumnRule = TextRule | CodeRule | MapRule | EmailRule | PhoneRule | DateRule | ReferenceRule


@dataclass(frozen=True)
class EntitySpec:
    """One table: its raw schema, the rule of each cleaned column, and its types.

    ``rules`` add ``{column}_clean`` in the order given. ``types`` cast in place.
    ``null_tokens`` are words that mean "no value" in a column about to be cast.
    ``constraints`` are checked by the quality reports and by ``run(..., rules=True)``.
    """

    name: str
    schema: StructType
    rules: Mapping[str, ColumnRule]
    types: Mapping[str, str]
    null_tokens: Mapping[str, tuple[str, ...]] = field(default_factory=dict)
    constraints: tuple[Rule, ...] = ()

    @property
    def date_columns(self) -> list[str]:
        return [c for c, rule in self.rules.items() if isinstance(rule, DateRule)]

    def narrow_keys(self) -> EntitySpec:
        """The same specification with 32-bit keys. Keys that do not fit are read as NULL."""
        keys = [c for c in self.types if c == "id" or c.endswith("_id")]
        fields = [
            StructField(f.name, IntegerType(), f.nullable) if f.name == "id" else f for f in self.schema.fields
        ]
        return replace(self, schema=StructType(fields), types={**self.types, **dict.fromkeys(keys, "int")})

    def clean(
        self,
        df: DataFrame,
        lookups: Mapping[str, DataFrame] | None = None,
        audit: bool = True,
        flags: bool = False,
    ) -> DataFrame:
        """Clean a raw table; lazy, row-preserving, raw columns kept beside clean ones.

        Rules for columns the table lacks are skipped with a warning. ``flags`` adds
        ``{column}_cast_failed``; ``audit`` adds the processing time.
        """
        rules = {c: self.rules[c] for c in present(df, self.rules, f"{self.name} rules")}
        types = {c: self.types[c] for c in present(df, self.types, f"{self.name} types")}
        if audit and "ingestion_date" in df.columns:
            df = df.withColumnRenamed("ingestion_date", "bronze_ingestion_date")
        columns, texts = list(df.columns), text_columns(df)
        lookups = lookups or {}

        clean: dict[str, Column] = {}
        for number, (column, rule) in enumerate(rules.items()):
            if isinstance(rule, ReferenceRule):
                standard = f"lookup_standard_{number}"
                joined = join_lookup(df, column, lookups[rule.lookup])
                df = joined.withColumnRenamed("lookup_standard", standard)
                clean[clean_name(column)] = normalized(F.col(column), F.col(standard))
            else:
                clean[clean_name(column)] = rule.apply(column)

        raw = {c: self._raw_value(c, rules.get(c)) for c in columns}
        typed = {c: casts.cast_value(raw[c], types[c], c in texts) if c in types else raw[c] for c in columns}
        failed = {f"{c}_cast_failed": casts.cast_failed(raw[c], types[c], c in texts) for c in types if flags}
        stamps = audit_values() if audit else {}
        return df.select(*[v.alias(name) for name, v in (typed | clean | failed | stamps).items()])

    def _raw_value(self, column: str, rule: ColumnRule | None) -> Column:
        """The raw column without HTML tags and without words that mean "no value"."""
        value = rule.source(F.col(column)) if isinstance(rule, TextRule) else F.col(column)
        return casts.null_tokens(value, *self.null_tokens[column]) if column in self.null_tokens else value


def raw_schema(*columns: str) -> StructType:
    """Raw tables: a 64-bit ``id`` that must be there, and text."""
    return StructType(
        [StructField("id", LongType(), nullable=False)] + [StructField(c, StringType()) for c in columns]
    )
