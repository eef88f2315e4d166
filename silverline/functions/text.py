"""Text functions: Column in, Column out, built from native expressions only."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: what stands for missing text.
UNKNOWN = "UNKNOWN"

# Fixed value: what a regular expression takes for whitespace.
WHITESPACE = " \t\n\x0b\f\r"

CASE_MODES = ("title", "person", "upper", "lower", "none")

# Stands between an apostrophe or hyphen and the letter after it, so that
# initcap sees a word boundary there; taken out again afterwards.
_JOINT = "\u0001 "


def strip_and_normalize_spaces(col: Column) -> Column:
    """Turn every run of whitespace into one space and drop it at both ends.

    Collapsing comes first: ``trim`` only knows the space character, so a leading
    tab has to become a space before it can be trimmed. The regular expression, which
    costs several times the rest, is left to texts that hold two spaces in a row.
    """
    spaced = F.translate(col, WHITESPACE, " " * len(WHITESPACE))
    return F.trim(F.when(spaced.contains("  "), F.regexp_replace(spaced, "  +", " ")).otherwise(spaced))


def normalize_case(col: Column, mode: str = "title") -> Column:
    """Change letter case.

    ``title`` capitalises after whitespace only (``Men's Wear``); ``person`` also
    after an apostrophe or hyphen (``O'Brian``, ``Jean-Claude``).
    """
    if mode == "title":
        return F.initcap(col)
    if mode == "person":
        opened = F.regexp_replace(col, "(['-])", "$1" + _JOINT)
        return F.replace(F.initcap(opened), F.lit(_JOINT), F.lit(""))
    if mode == "upper":
        return F.upper(col)
    if mode == "lower":
        return F.lower(col)
    if mode == "none":
        return col
    raise ValueError(f"unknown case mode {mode!r}; use one of {', '.join(CASE_MODES)}")


def is_blank(col: Column) -> Column:
    """True for NULL, the empty string and strings of spaces."""
    return col.isNull() | (F.trim(col) == "")


def normalize_to_null(col: Column, replacement: str = UNKNOWN) -> Column:
    """Replace missing text (see :func:`is_blank`) by one explicit sentinel."""
    return F.when(is_blank(col), F.lit(replacement)).otherwise(col)


def kept_class(keep_chars: str = "", keep_digits: bool = False, unicode: bool = False, spaces: bool = True) -> str:
    """Inside of a regex character class naming the characters that survive.

    Every extra character is escaped one by one, so that ``'-&`` means those three
    characters and never a range.
    """
    letters = r"\p{L}\p{M}" if unicode else "a-zA-Z"
    digits = "0-9" if keep_digits else ""
    extra = "".join(c if c.isalnum() else "\\" + c for c in keep_chars)
    return letters + digits + (r"\s" if spaces else "") + extra


def remove_special_chars(
    col: Column, keep_chars: str = "", keep_digits: bool = False, unicode: bool = False
) -> Column:
    """Delete everything but letters, whitespace and the characters asked for.

    For ASCII letters, all other characters up to U+00FF are deleted by one translation,
    which costs half of what a regular expression does; only texts that then still hold
    a character beyond ASCII need the expression too. The result is the same.
    """
    return _delete_others(col, keep_chars, keep_digits, unicode)


def _delete_others(col: Column, keep_chars: str, keep_digits: bool, unicode: bool = False, spaces: bool = True) -> Column:
    kept = kept_class(keep_chars, keep_digits, unicode, spaces)
    if unicode or not keep_chars.isascii():
        return F.regexp_replace(col, f"[^{kept}]", "")
    survivors = {*string.ascii_letters, *(string.digits if keep_digits else ""), *(WHITESPACE if spaces else ""), *keep_chars}
    plain = F.translate(col, "".join(c for c in map(chr, range(256)) if c not in survivors), "")
    return F.when(F.octet_length(plain) == F.length(plain), plain).otherwise(F.regexp_replace(plain, f"[^{kept}]", ""))


# Fixed value: what counts as a tag.
TAG_PATTERN = "<[^>]+>"


def strip_html_tags(col: Column) -> Column:
    """Delete ``<...>`` tags; the text around them is joined as it stands."""
    return F.regexp_replace(col, TAG_PATTERN, "")


def clean_text(
    col: Column,
    keep_chars: str = "'-",
    replacement: str = UNKNOWN,
    case_mode: str = "title",
    keep_digits: bool = False,
    unicode: bool = False,
) -> Column:
    """Strip characters, collapse spaces, set the case, then fill the sentinel.

    The sentinel comes last so that it keeps its own spelling: a title-cased column
    still says ``UNKNOWN``, and a filter on it finds the rows.
    """
    kept = remove_special_chars(col, keep_chars, keep_digits, unicode)
    cased = normalize_case(strip_and_normalize_spaces(kept), case_mode)
    return normalize_to_null(cased, replacement)


def clean_code(col: Column, keep_chars: str = "-", replacement: str = UNKNOWN) -> Column:
    """Identifier text: upper case, letters, digits and ``keep_chars``, no spaces."""
    return normalize_to_null(F.upper(_delete_others(col, keep_chars, keep_digits=True, spaces=False)), replacement)


def match_key(col: Column, case: str = "lower") -> Column:
    """Trimmed, case-folded value used as the key of maps and lookups."""
    return normalize_case(F.trim(col), case)
