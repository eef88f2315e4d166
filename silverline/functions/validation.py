"""Format checks. They answer true or false, never NULL, and change nothing."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from silverline.functions.dates import ISO_DATE_FORMAT
from silverline.functions.text import UNKNOWN, match_key

# E-mail pattern and the bounds on the digits of a phone number.
EMAIL_PATTERN = r"^[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{2,}$"
PHONE_MIN_DIGITS = 7
PHONE_MAX_DIGITS = 15


def is_valid_email(col: Column) -> Column:
    return F.coalesce(col.rlike(EMAIL_PATTERN), F.lit(False))


def is_valid_phone(col: Column) -> Column:
    """The digits are counted in one regex match; anything may stand between them."""
    counted = rf"^(?:\D*\d){{{PHONE_MIN_DIGITS},{PHONE_MAX_DIGITS}}}\D*$"
    return F.coalesce(col.rlike(counted), F.lit(False))


def is_valid_date(col: Column, date_format: str = ISO_DATE_FORMAT) -> Column:
    return F.try_to_date(col, date_format).isNotNull()


def _valid_or_unknown(value: Column, valid: Callable[[Column], Column]) -> Column:
    return F.when(valid(value), value).otherwise(F.lit(UNKNOWN))


def clean_email(col: Column) -> Column:
    """Lower-cased, trimmed address, or the sentinel when it is not an address."""
    return _valid_or_unknown(match_key(col), is_valid_email)


def clean_phone(col: Column) -> Column:
    """Trimmed number with its own formatting, or the sentinel."""
    return _valid_or_unknown(match_key(col, "none"), is_valid_phone)
