"""Date parsing over a list of known formats, linear in the number of formats.

A failed parse costs several microseconds, because the formatter raises and Spark
catches, so trying twenty-two formats on every value is what dominates a cleaning
job. Each format is therefore tried only on values that have its shape: a cheap test
for its separator, then a regular expression that every parseable value must match.
The shape is a necessary condition, so it never changes a result.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted date formats, in order of priority.
KNOWN_DATE_FORMATS = [
    "yyyy-MM-dd",
    "yyyy-MM-dd HH:mm:ss",
    "yyyy-MM-dd'T'HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss.SSS",
    "MM/dd/yyyy",
    "dd/MM/yyyy",
    "MM-dd-yyyy",
    "dd-MM-yyyy",
    "yyyy/MM/dd",
    "d/M/yyyy",
    "M/d/yyyy",
    "yyyy.MM.dd",
    "dd.MM.yyyy",
    "MM.dd.yyyy",
    "dd/MM/yyyy HH:mm:ss",
    "MM/dd/yyyy HH:mm:ss",
    "yyyyMMdd",
    "MMMM d, yyyy",
    "MMM d, yyyy",
    "d MMMM yyyy",
    "d MMM yyyy",
    "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'",
]

# Fixed value: how dates are written.
ISO_DATE_FORMAT = "yyyy-MM-dd"

# Names of the locale in which Spark's formatters read dates.
_MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")

# What each pattern letter run can match at most. Years may be longer than four
# digits when signed; one-letter fields may carry leading zeros.
_FIELD_SHAPES = {
    "yyyy": r"[+-]?\d{4,}",
    "MMMM": f"(?iu:{'|'.join(_MONTHS)})",
    "MMM": f"(?iu:{'|'.join(name[:3] for name in _MONTHS)})",
    "MM": r"(?:0[1-9]|1[0-2])",
    "M": r"0*(?:[1-9]|1[0-2])",
    "dd": r"(?:0[1-9]|[12]\d|3[01])",
    "d": r"0*(?:[1-9]|[12]\d|3[01])",
    "HH": r"(?:[01]\d|2[0-3])",
    "mm": r"[0-5]\d",
    "ss": r"[0-5]\d",
    "SSS": r"\d+",
}

# Digits or letters each run has at least. Where fields of these widths are all there is, a cast reads the value.
_LEAST_WIDTH = {"MMMM": 3, "MMM": 3, "M": 1, "d": 1, "SSS": 1}
_FIXED_FIELDS = ("yyyy", "MM", "dd", "HH", "mm", "ss", "SSS")

_TOKEN = re.compile(r"'([^']*)'|([A-Za-z])\2*|[^A-Za-z']")

_SEPARATORS = ("/", "-", ".", ",", " ")


def _either_case(literal: str) -> str:
    """Literal letters are read in either case."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else re.escape(c) for c in literal)


def format_shape(fmt: str) -> tuple[str | None, str]:
    """Shape regex of a format and its literal characters.

    The regex is None when the format has a field whose texts are not known here, an
    optional section, a quote that is read literally, or a sign kept for later use.
    """
    if any(sign in fmt for sign in "[]{}#") or "''" in fmt or fmt.count("'") % 2:
        return None, ""
    pattern, literals = "", ""
    for token in _TOKEN.finditer(fmt):
        text, quoted, letter = token.group(0), token.group(1), token.group(2)
        if letter and text not in _FIELD_SHAPES:
            return None, ""
        literal = "" if letter else (text if quoted is None else quoted)
        literals += literal
        pattern += _FIELD_SHAPES[text] if letter else _either_case(literal)
    return f"^{pattern}$", literals


def _grouped(formats: Sequence[str]) -> dict[bool, dict[str, list[tuple[str, str]]]] | None:
    """(shape, format) pairs by "has a time of day", then by separator, each in order.

    Fields hold letters, digits and signs of years only, so two formats that can read the
    same value have the same literals, and the grouping keeps the priority between them.
    None when a format's shape is not known.
    """
    groups: dict[bool, dict[str, list[tuple[str, str]]]] = {}
    for fmt in formats:
        shape, literals = format_shape(fmt)
        if shape is None:
            return None
        separator = next((s for s in _SEPARATORS if s in literals), "")
        groups.setdefault(":" in literals, {}).setdefault(separator, []).append((shape, fmt))
    return groups


def _cascade(col: Column, formats: Sequence[str], parse: Callable[[Column, str], Column]) -> Column:
    """First format that parses wins, trying a format only on values of its shape."""
    groups = _grouped(formats)
    if groups is None:
        return F.coalesce(*[parse(col, fmt) for fmt in formats])

    def tried(families: dict[str, list[tuple[str, str]]]) -> Column:
        alternatives = []
        for separator, members in families.items():
            steps = F.coalesce(*[F.when(col.rlike(shape), parse(col, fmt)) for shape, fmt in members])
            alternatives.append(F.when(col.contains(separator), steps) if separator else steps)
        return F.coalesce(*alternatives)

    if len(groups) == 1:
        return tried(next(iter(groups.values())))
    return F.when(col.contains(":"), tried(groups[True])).otherwise(tried(groups[False]))


def _least_width(fmt: str) -> int:
    """Characters that a value of the format's shape has at least."""
    texts = [(t.group(0), t.group(1)) for t in _TOKEN.finditer(fmt)]
    return sum(_LEAST_WIDTH.get(text, len(text)) if quoted is None else len(quoted) for text, quoted in texts)


def _cast_sql(column: str, fmt: str, function: str) -> tuple[int, str] | None:
    """Width of a format whose fields have as many digits as letters, and a cast that reads a value of its shape and that width.

    A cast costs a fraction of a formatter. None for other formats.
    """
    width, places, literals = 0, {}, ""
    for token in _TOKEN.finditer(fmt):
        text, quoted, letter = token.group(0), token.group(1), token.group(2)
        if letter and (text not in _FIXED_FIELDS or text in places):
            return None
        if letter:
            places[text] = width + 1
        else:
            literals += text
        width += len(text if quoted is None else quoted)
    clock = next((c for c in ("HH:mm:ss.SSS", "HH:mm:ss") if c in fmt), "")
    if not literals.isascii() or places.keys() != {"yyyy", "MM", "dd", *(f for f in _FIXED_FIELDS if f in clock)}:
        return None

    def piece(field: str, length: int = 0) -> str:
        return f"substr({column}, {places[field]}, {length or len(field)})"

    day = piece("yyyy", 10) if "yyyy-MM-dd" in fmt else f"concat({piece('yyyy')}, '-', {piece('MM')}, '-', {piece('dd')})"
    if function == "try_to_date":
        return width, f"try_cast({day} AS DATE)"
    return width, f"try_cast({f"concat({day}, ' ', {piece('HH', len(clock))})" if clock else day} AS TIMESTAMP)"


def _cascade_sql(name: str, formats: Sequence[str], function: str) -> str:
    """The same expression as SQL text over a named column.

    Built call by call the tree takes hundreds of round trips from Python to the JVM per
    column; as text it takes one.
    """
    column = "`" + name.replace("`", "``") + "`"
    groups = _grouped(formats)

    def parsed(fmt: str) -> str:
        quoted = fmt.replace("\\", "\\\\").replace("'", "\\'")
        return f"{function}({column}, '{quoted}')"

    def fitting(shape: str, fmt: str) -> str:
        cast, value = _cast_sql(column, fmt, function), parsed(fmt)
        if cast:
            value = f"CASE WHEN octet_length({column}) = {cast[0]} THEN {cast[1]} ELSE {value} END"
        return f"CASE WHEN octet_length({column}) >= {_least_width(fmt)} AND {column} RLIKE r'{shape}' THEN {value} END"

    def tried(families: dict[str, list[tuple[str, str]]]) -> str:
        alternatives = []
        for separator, members in families.items():
            cases = [fitting(shape, fmt) for shape, fmt in members]
            steps = f"coalesce({', '.join(cases)})"
            alternatives.append(
                f"CASE WHEN contains({column}, '{separator}') THEN {steps} END" if separator else steps
            )
        return f"coalesce({', '.join(alternatives)})"

    if groups is None:
        return f"coalesce({', '.join(parsed(fmt) for fmt in formats)})"
    if len(groups) == 1:
        return tried(next(iter(groups.values())))
    return f"CASE WHEN contains({column}, ':') THEN {tried(groups[True])} ELSE {tried(groups[False])} END"


def _ordered(formats: Sequence[str], precedence: str) -> list[str]:
    if precedence not in ("first", "last"):
        raise ValueError(f"precedence must be 'first' or 'last', not {precedence!r}")
    return list(formats) if precedence == "first" else list(reversed(formats))


def parse_date(
    col: Column | str,
    input_format: str | None = None,
    formats: Sequence[str] = KNOWN_DATE_FORMATS,
    precedence: str = "first",
) -> Column:
    """Text to DATE; NULL when no format fits. Takes a column or the name of one.

    With ``input_format`` only that format counts. Otherwise the first listed format
    that fits wins, or the last listed one with ``precedence="last"``, which matters
    for values such as ``01-05-2024``.
    """
    if input_format:
        return F.try_to_date(col, input_format)
    ordered = _ordered(formats, precedence)
    if isinstance(col, str):
        return F.expr(_cascade_sql(col, ordered, "try_to_date"))
    return _cascade(col, ordered, F.try_to_date)


def parse_timestamp(
    col: Column | str, formats: Sequence[str] = KNOWN_DATE_FORMATS, precedence: str = "first"
) -> Column:
    """Like :func:`parse_date`, keeping the time of day where the text has one."""
    ordered = _ordered(formats, precedence)
    if isinstance(col, str):
        return F.expr(_cascade_sql(col, ordered, "try_to_timestamp"))
    return _cascade(col, ordered, lambda c, fmt: F.try_to_timestamp(c, F.lit(fmt)))


def format_date_to_iso(col: Column | str, input_format: str | None = None) -> Column:
    """Text in any known format to ``yyyy-MM-dd`` text; NULL when unreadable."""
    return F.date_format(parse_date(col, input_format), ISO_DATE_FORMAT)
