"""SQL fragments for the checking engine, one per cleaning rule."""

from __future__ import annotations

from collections.abc import Mapping

from silverline.functions import casts
from silverline.plans.spec import CodeRule, DateRule, EmailRule, EntitySpec, MapRule, PhoneRule, TextRule
from workload.bronze import COUNTRIES, DATE_TEXTS, bronze_sql, text_literal

# What each date pattern may look like, in full.
DATE_GUARDS = [
    r"\d{4}-\d{2}-\d{2}",
    r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}",
    r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}",
    r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}\.\d{1,3}",
    r"\d{2}/\d{2}/\d{4}",
    r"\d{2}/\d{2}/\d{4}",
    r"\d{2}-\d{2}-\d{4}",
    r"\d{2}-\d{2}-\d{4}",
    r"\d{4}/\d{2}/\d{2}",
    r"\d{1,2}/\d{1,2}/\d{4}",
    r"\d{1,2}/\d{1,2}/\d{4}",
    r"\d{4}\.\d{2}\.\d{2}",
    r"\d{2}\.\d{2}\.\d{4}",
    r"\d{2}\.\d{2}\.\d{4}",
    r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}",
    r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}",
    r"\d{8}",
    r"[A-Za-z]{3,9} \d{1,2}, \d{4}",
    r"[A-Za-z]{3} \d{1,2}, \d{4}",
    r"\d{1,2} [A-Za-z]{3,9} \d{4}",
    r"\d{1,2} [A-Za-z]{3} \d{4}",
    r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}\.\d{1,3}Z",
]


def collapse(x: str) -> str:
    return rf"trim(regexp_replace({x}, '[\s\x0B]+', ' ', 'g'))"


def strip(x: str, keep: str = "", digits: bool = False) -> str:
    kept = "a-zA-Z" + ("0-9" if digits else "") + r"\s\x0B" + "".join("\\" + c for c in keep)
    return f"regexp_replace({x}, {text_literal(f'[^{kept}]')}, '', 'g')"


def capitals(x: str, boundaries: str) -> str:
    """Upper-case the first letter of every token between boundary characters."""
    inside = "".join("\\" + c for c in boundaries)
    tokens = f"regexp_extract_all({x}, {text_literal(f'[^{inside}]+|[{inside}]')})"
    return f"array_to_string(list_transform({tokens}, lambda w: upper(w[1]) || lower(w[2:])), '')"


def cased(x: str, mode: str) -> str:
    return {
        "title": lambda: capitals(x, " "),
        "person": lambda: capitals(x, " '-"),
        "upper": lambda: f"upper({x})",
        "lower": lambda: f"lower({x})",
        "none": lambda: x,
    }[mode]()


def sentinel(x: str, replacement: str = "UNKNOWN") -> str:
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN {text_literal(replacement)} ELSE {x} END"


def clean_text(x: str, keep: str = "", replacement: str = "UNKNOWN", mode: str = "title", digits: bool = False) -> str:
    return sentinel(cased(collapse(strip(x, keep, digits)), mode), replacement)


def clean_code(x: str) -> str:
    return sentinel(f"upper(regexp_replace({x}, '[^a-zA-Z0-9-]', '', 'g'))")


def email_ok(x: str) -> str:
    return rf"coalesce(regexp_full_match({x}, '[a-zA-Z0-9._%+\-]+@[a-zA-Z0-9.\-]+\.[a-zA-Z]{{2,}}'), false)"


def clean_email(x: str) -> str:
    address = f"lower(trim({x}))"
    return f"CASE WHEN {email_ok(address)} THEN {address} ELSE 'UNKNOWN' END"


def phone_ok(x: str) -> str:
    return f"coalesce(length(regexp_replace({x}, '[^0-9]', '', 'g')) BETWEEN 7 AND 15, false)"


def clean_phone(x: str) -> str:
    return f"CASE WHEN {phone_ok(x)} THEN trim({x}) ELSE 'UNKNOWN' END"


def mapped(x: str, mapping: Mapping[str, str], default: str = "UNKNOWN") -> str:
    branches = " ".join(f"WHEN {text_literal(raw)} THEN {text_literal(to)}" for raw, to in mapping.items())
    return f"CASE lower(trim({x})) {branches} ELSE {text_literal(default)} END"


def country(x: str) -> str:
    branches = " ".join(f"WHEN {text_literal(raw)} THEN {text_literal(to)}" for raw, to in COUNTRIES.items())
    return f"CASE WHEN {x} IS NULL OR trim({x}) = '' THEN 'UNKNOWN' ELSE CASE {x} {branches} END END"


def _tries(x: str, last: bool) -> str:
    pairs = list(zip(DATE_TEXTS, DATE_GUARDS, strict=True))
    return ", ".join(
        f"CASE WHEN regexp_full_match({x}, {text_literal(guard)}) THEN try_strptime({x}, {text_literal(fmt)}) END"
        for (_, fmt), guard in (reversed(pairs) if last else pairs)
    )


def moment(x: str) -> str:
    return f"coalesce({_tries(x, last=False)})"


def parsed_date(x: str, last: bool = False) -> str:
    return f"CAST(coalesce({_tries(x, last)}) AS DATE)"


def date_string(x: str, last: bool = False) -> str:
    return f"CAST({parsed_date(x, last)} AS VARCHAR)"


def as_int(x: str, kind: str = "INTEGER") -> str:
    return f"CASE WHEN regexp_full_match(trim({x}), '[+-]?[0-9]+') THEN try_cast(trim({x}) AS {kind}) END"


def as_double(x: str) -> str:
    shape = r"[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?"
    return f"CASE WHEN regexp_full_match(trim({x}), '{shape}') THEN try_cast(trim({x}) AS DOUBLE) END"


def as_bool(x: str, default: str = "false") -> str:
    yes = ", ".join(text_literal(v) for v in casts.TRUE_VALUES)
    no = ", ".join(text_literal(v) for v in casts.FALSE_VALUES)
    return (
        f"CASE WHEN lower(trim({x})) IN ({yes}) THEN true WHEN lower(trim({x})) IN ({no}) THEN false ELSE {default} END"
    )


def typed(x: str, kind: str) -> str:
    if kind == "int":
        return as_int(x)
    if kind == "long":
        return as_int(x, "BIGINT")
    return as_double(x) if kind == "double" else as_bool(x)


def in_place(spec: EntitySpec, column: str) -> str:
    rule = spec.rules.get(column)
    x = column
    if isinstance(rule, TextRule) and rule.strip_html:
        x = f"regexp_replace({x}, '<[^>]+>', '', 'g')"
    for token in spec.null_tokens.get(column, ()):
        x = f"CASE WHEN lower(trim({x})) = {text_literal(token)} THEN NULL ELSE {x} END"
    if column == "id":
        return "CAST(id AS BIGINT)"
    return typed(x, spec.types[column]) if column in spec.types else x


def cleaned(spec: EntitySpec, column: str) -> str:
    rule = spec.rules[column]
    if isinstance(rule, TextRule):
        x = f"regexp_replace({column}, '<[^>]+>', '', 'g')" if rule.strip_html else column
        return clean_text(x, rule.keep_chars, rule.replacement, rule.case_mode, rule.keep_digits)
    if isinstance(rule, CodeRule):
        return clean_code(column)
    if isinstance(rule, MapRule):
        return mapped(column, rule.mapping, rule.default)
    if isinstance(rule, EmailRule):
        return clean_email(column)
    if isinstance(rule, PhoneRule):
        return clean_phone(column)
    if isinstance(rule, DateRule):
        return date_string(column)
    return country(column)


def entity_sql(spec: EntitySpec, raw_sql: str | None = None) -> str:
    """The cleaned table of an entity, audit columns left out, dates as text."""
    raw = [f"{in_place(spec, f.name)} AS {f.name}" for f in spec.schema.fields]
    clean = [f"{cleaned(spec, c)} AS {c}_clean" for c in spec.rules]
    return f"WITH b AS ({raw_sql or bronze_sql(spec.name)}) SELECT {', '.join(raw + clean)} FROM b"


def integers_of(spec: EntitySpec) -> list[str]:
    """Integer columns an entity casts from text, which may hold NULLs."""
    return [c for c, kind in spec.types.items() if kind in ("int", "long") and c != "id"]


def portable(sql: str, *integers: str) -> str:
    """The same rows with the named integer columns as text."""
    if not integers:
        return sql
    texts = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in integers)
    return f"SELECT * REPLACE ({texts}) FROM ({sql}) typed"


def portable_entity(spec: EntitySpec) -> str:
    return portable(entity_sql(spec), *integers_of(spec))
