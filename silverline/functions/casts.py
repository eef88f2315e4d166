"""Casts that yield NULL instead of raising, whatever the ANSI setting."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.dates import ISO_DATE_FORMAT
from silverline.functions.mapping import map_values

# Spellings of true and false.
TRUE_VALUES = ("1", "true", "yes", "t", "y", "si", "s")
FALSE_VALUES = ("0", "false", "no", "f", "n")

# Every text the cast accepts has this shape. On other texts the cast raises and catches
# inside, which costs some fifty times the test.
_INTEGER_SHAPE = r"^[^0-9A-Za-z.,]*\d+[^0-9A-Za-z.,]*$"
_DOUBLE_SHAPE = (
    r"(?i)^[\x00-\x20]*[+-]?(?:(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?[df]?"
    r"|nan|inf|infinity|0x[0-9a-f.]+p[+-]?\d+[df]?)[\x00-\x20]*$"
)


def _try_cast(col: Column, sql_type: str, shape: str, from_text: bool) -> Column:
    """``from_text`` promises a text column; the result is the same either way."""
    value = col.try_cast(sql_type)
    return F.when(col.rlike(shape), value) if from_text else value


def to_int(col: Column, null_replacement: int | None = None, from_text: bool = False) -> Column:
    value = _try_cast(col, "int", _INTEGER_SHAPE, from_text)
    return value if null_replacement is None else F.coalesce(value, F.lit(null_replacement))


def to_long(col: Column, from_text: bool = False) -> Column:
    return _try_cast(col, "bigint", _INTEGER_SHAPE, from_text)


def to_double(col: Column, from_text: bool = False) -> Column:
    return _try_cast(col, "double", _DOUBLE_SHAPE, from_text)


def to_date(col: Column, date_format: str = ISO_DATE_FORMAT) -> Column:
    return F.try_to_date(col, date_format)


def to_bool(col: Column, default: bool = False) -> Column:
    """True/false spellings; anything else, NULL too, gives ``default``."""
    spellings = {**dict.fromkeys(TRUE_VALUES, "true"), **dict.fromkeys(FALSE_VALUES, "false")}
    return map_values(col.cast("string"), spellings, str(default).lower()).cast("boolean")


# Type names of a type map, each with its cast of a column that is text or is not.
CASTS: dict[str, Callable[[Column, bool], Column]] = {
    "int": lambda col, from_text: to_int(col, from_text=from_text),
    "long": to_long,
    "double": to_double,
    "date": lambda col, from_text: to_date(col),
    "bool": lambda col, from_text: to_bool(col),
}


def cast_value(col: Column, type_name: str, from_text: bool = False) -> Column:
    """Cast by the short type names of a type map; unknown names raise ValueError."""
    if type_name not in CASTS:
        raise ValueError(f"unknown type {type_name!r}; use one of {', '.join(CASTS)}")
    return CASTS[type_name](col, from_text)


def cast_failed(col: Column, type_name: str, from_text: bool = False) -> Column:
    """True where a value is there but is not one of the target type."""
    text = col.cast("string")
    present = col.isNotNull() & (F.trim(text) != "")
    if type_name == "bool":
        known = F.lower(F.trim(text)).isin(*TRUE_VALUES, *FALSE_VALUES)
        return F.coalesce(present & ~known, F.lit(False))
    return present & cast_value(col, type_name, from_text).isNull()


def null_tokens(col: Column, *tokens: str) -> Column:
    """NULL where the trimmed value equals a token, whatever its case."""
    folded = [token.lower() for token in tokens]
    return F.when(F.lower(F.trim(col)).isin(*folded), F.lit(None)).otherwise(col)
