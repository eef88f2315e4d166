"""Column functions: text, dates, casts, format checks and category maps."""

from silverline.functions.casts import (
    cast_failed,
    cast_value,
    null_tokens,
    to_bool,
    to_date,
    to_double,
    to_int,
    to_long,
)
from silverline.functions.dates import (
    ISO_DATE_FORMAT,
    KNOWN_DATE_FORMATS,
    format_date_to_iso,
    parse_date,
    parse_timestamp,
)
from silverline.functions.mapping import map_values
from silverline.functions.text import (
    UNKNOWN,
    clean_code,
    clean_text,
    is_blank,
    match_key,
    normalize_case,
    normalize_to_null,
    remove_special_chars,
    strip_and_normalize_spaces,
    strip_html_tags,
)
from silverline.functions.validation import (
    clean_email,
    clean_phone,
    is_valid_date,
    is_valid_email,
    is_valid_phone,
)

__all__ = [
    "ISO_DATE_FORMAT",
    "KNOWN_DATE_FORMATS",
    "UNKNOWN",
    "cast_failed",
    "cast_value",
    "clean_code",
    "clean_email",
    "clean_phone",
    "clean_text",
    "format_date_to_iso",
    "is_blank",
    "is_valid_date",
    "is_valid_email",
    "is_valid_phone",
    "map_values",
    "match_key",
    "normalize_case",
    "normalize_to_null",
    "null_tokens",
    "parse_date",
    "parse_timestamp",
    "remove_special_chars",
    "strip_and_normalize_spaces",
    "strip_html_tags",
    "to_bool",
    "to_date",
    "to_double",
    "to_int",
    "to_long",
]
