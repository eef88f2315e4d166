"""Raw, dirty shop tables derived from the given tables.

Every column is a SQL expression over one given table, dirtied by a rule on its key and
written so that Spark and the checking engine read it the same way. Only dates need
their own spelling per engine. Row counts are those of the given tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverline.functions.dates import KNOWN_DATE_FORMATS
from silverline.plans.entities import ENTITY_SPECS
from silverline.plans.spec import EntitySpec
from silverline.session import scratch_path
from workload.registry import table

SPARK, DUCK = "spark", "duck"

# The known date formats as strftime spells them.
DUCK_DATE_FORMATS = [
    "%Y-%m-%d",
    "%Y-%m-%d %H:%M:%S",
    "%Y-%m-%dT%H:%M:%S",
    "%Y-%m-%d %H:%M:%S.%g",
    "%m/%d/%Y",
    "%d/%m/%Y",
    "%m-%d-%Y",
    "%d-%m-%Y",
    "%Y/%m/%d",
    "%-d/%-m/%Y",
    "%-m/%-d/%Y",
    "%Y.%m.%d",
    "%d.%m.%Y",
    "%m.%d.%Y",
    "%d/%m/%Y %H:%M:%S",
    "%m/%d/%Y %H:%M:%S",
    "%Y%m%d",
    "%B %-d, %Y",
    "%b %-d, %Y",
    "%-d %B %Y",
    "%-d %b %Y",
    "%Y-%m-%dT%H:%M:%S.%gZ",
]
DATE_TEXTS = list(zip(KNOWN_DATE_FORMATS, DUCK_DATE_FORMATS, strict=True))

# Country spellings of the raw tables, and the standard name each must get.
COUNTRIES = {
    "germany": "Germany",
    " GERMANY ": "Germany",
    "DE": "Germany",
    "deu": "Germany",
    "Federal Republic of Germany": "Germany",
    "UK": "United Kingdom",
    "u.s.a.": "United States",
    "EEUU": "United States",
    "fr": "France",
    "Espana": "REVISAR_MANUAL",
    "Atlantis": "REVISAR_MANUAL",
    "Germny": "REVISAR_MANUAL",
    "Itly": "REVISAR_MANUAL",
}


def text_literal(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def pick(key: str, options: list[str | None], raw_sql: bool = False) -> str:
    """One of the options by the key's remainder; values are texts unless ``raw_sql``."""
    branches = " ".join(
        f"WHEN {i} THEN {option if raw_sql else text_literal(option)}" for i, option in enumerate(options)
    )
    return f"CASE ({key}) % {len(options)} {branches} END"


def part_of(key: str, divisor: int) -> str:
    """The key without its lowest digits, so that two picks by one key differ."""
    return f"CAST(floor(({key}) / {divisor}) AS BIGINT)"


def at_time(engine: str, base: str, seconds: str) -> str:
    if engine == SPARK:
        return f"timestampadd(SECOND, {seconds}, {base})"
    return f"({base} + to_seconds({seconds}))"


def day_of(engine: str, key: str) -> str:
    """A point in time that follows from the key, for tables without dates."""
    base = "TIMESTAMP_NTZ'1995-01-01 00:00:00'" if engine == SPARK else "TIMESTAMP '1995-01-01 00:00:00'"
    return at_time(engine, base, f"(({key}) % 3650) * 86413")


def date_text(engine: str, moment: str, key: str) -> str:
    """The moment as text in one of all known formats, or not a date at all."""
    written = [
        f"date_format({moment}, {text_literal(spark)})" if engine == SPARK else f"strftime({moment}, {text_literal(duck)})"
        for spark, duck in DATE_TEXTS
    ]
    return pick(key, [*written, "'bad-date'", "NULL", "''"], raw_sql=True)


def text(value: str) -> str:
    return f"CAST({value} AS STRING)"


def person(key: str) -> str:
    first = pick(key, ["john", "MARIA", "o'brian", "jean-claude", "Anna", "d'angelo", "mary ann", "LI", "josé"])
    last = pick(part_of(key, 9), ["smith", "GARCIA", "o'neill", "smith-jones", "lee", "Müller", "van der berg"])
    full = f"({first} || ' ' || {last})"
    return pick(
        key,
        [
            "NULL",
            "'   '",
            "''",
            f"('  ' || {full} || '  ')",
            f"(chr(9) || {full} || chr(10))",
            f"upper({full})",
            f"({full} || '!#42')",
            f"({first} || '   ' || {last})",
            full,
            f"('(' || {full} || ')')",
            full,
        ],
        raw_sql=True,
    )


def email(key: str) -> str:
    user = f"('user.' || {text(key)})"
    return pick(
        key,
        [
            f"({user} || '@gmail.com')",
            f"('  ' || upper({user}) || '@Mail.Example.ORG ')",
            f"({user} || '@empresa.com.mx')",
            f"({user} || 'gmail.com')",
            f"({user} || '@')",
            "'@sinlocal.com'",
            "NULL",
            "'   '",
        ],
        raw_sql=True,
    )


def phone(key: str) -> str:
    line = f"lpad({text(f'({key}) % 10000')}, 4, '0')"
    return pick(
        key,
        [
            f"('+1 (555) 123-' || {line})",
            f"('  555-' || {line})",
            f"('+52 55 1234 ' || {line} || ' ')",
            "'123'",
            "'abc-defg'",
            f"('1234567890123' || {line})",
            "NULL",
            "''",
        ],
        raw_sql=True,
    )


def number(value: str, key: str) -> str:
    """A numeric column as the texts sources send: clean, padded, signed, or not a number."""
    return pick(
        key,
        [
            text(value),
            f"('  ' || {text(value)} || ' ')",
            f"('-' || {text(value)})",
            "'abc'",
            "'1,299'",
            "''",
            "NULL",
            text(value),
        ],
        raw_sql=True,
    )


def flag(key: str) -> str:
    return pick(key, ["1", "TRUE", " yes ", "t", "Si", "0", "FALSE", "no", "N", "maybe", None, ""])


def bronze_columns(entity: str, engine: str) -> tuple[str, dict[str, str]]:
    """The given table an entity is derived from, and its columns as SQL."""

    def stamps(moment: str, key: str, *names: str) -> dict[str, str]:
        names = names or ("created_at", "updated_at")
        return {
            name: date_text(engine, at_time(engine, moment, f"CAST({n + 1} AS BIGINT) * 90061"), f"({key}) + {n * 7}")
            for n, name in enumerate(names)
        }

    if entity == "customers":
        k = "c_custkey"
        cities = ["new york", "ST. LOUIS", "  paris ", "São Paulo", None, "Berlin #1", "winston-salem"]
        return "customer", {
            "id": k,
            "name": person(k),
            "email": email(k),
            "phone": phone(k),
            "city": pick(k, cities),
            "country": pick(k, [*COUNTRIES, None, "  "]),
            **stamps(day_of(engine, k), k, "created_at", "updated_at", "registration_date"),
        }
    if entity == "coupons":
        k = "event_id"
        code = f"('  ' || event_type || '-' || {text('user_id')} || ' ')"
        codes = [code, f"upper({code})", f"replace({code}, '-', ' #')", "NULL", "'  '", "'DUPLICATE'"]
        kinds = ["FIXED", "dollar", " $ ", "Percentage", "percent", "%", "BOGO", "buy_one_get_one",
                 "free_shipping", "invalid_type", None, ""]
        return "events", {
            "id": k,
            "code": pick(k, codes, raw_sql=True),
            "discount_type": pick(k, kinds),
            "discount_value": number("value", k),
            "min_order": number("user_id", part_of(k, 8)),
            "max_uses": number(f"({k}) % 500", part_of(k, 3)),
            "used_count": number(f"({k}) % 90", part_of(k, 5)),
            **stamps("ts", k, "expires_at"),
            "is_active": flag(k),
            **stamps("ts", part_of(k, 2)),
        }
    if entity == "categories":
        k = "p_partkey"
        names = [f"('  ' || lower(p_type) || ' & ' || p_name || '  ')", "'Men''s   Wear'", "p_type",
                 "'food & BEVERAGES (new)'", "NULL", "''", "(p_brand || ' @ ' || p_type)"]
        notes = [f"('All  ' || p_name || ', ' || p_type || ' / ' || p_brand || '; 100% ok.')", "NULL", "'  '"]
        return "part", {
            "id": k,
            "name": pick(k, names, raw_sql=True),
            "parent_id": pick(k, ["NULL", text(part_of(k, 2)), text(part_of(k, 3)), text(f"{k} + 900000000"), "'none'"],
                              raw_sql=True),
            "description": pick(k, notes, raw_sql=True),
            "is_active": flag(k),
            **stamps(day_of(engine, k), k),
        }
    if entity == "inventory":
        k = "(l_orderkey * 8 + l_linenumber)"
        halls = ["  Main Hub  ", "WH-Main", "warehouse   a", "DOCK 7!", None, "", "north_yard"]
        states = ["in stock", "IN_STOCK", " InStock ", "LOW_STOCK", "low stock", "out of stock", "Out_Of_Stock",
                  "discontinued", "pending", "N/A", None, " "]
        return "lineitem", {
            "id": k,
            "product_id": number("l_partkey", part_of(k, 2)),
            "warehouse": pick(k, halls),
            "quantity": number("CAST(l_quantity AS BIGINT)", k),
            "reorder_point": number("l_quantity", part_of(k, 8)),
            **stamps("l_shipdate", k, "last_restock"),
            "status": pick(k, states),
            **stamps("l_shipdate", part_of(k, 2)),
        }
    if entity == "payments":
        k = "o_orderkey"
        methods = ["credit_card", "Credit Card", "CREDIT", "debit", "debit card", " PayPal", "cash", "transfer",
                   "bank_transfer", "Bitcoin", "crypto", "cheque", None, ""]
        states = ["completed", "SUCCESS", "paid", "Pending", "failed", "declined", "cancelled", "canceled",
                  "refunded", "??", None, " "]
        ids = [f"(' txn-' || {text(k)} || ' ')", f"('TXN # ' || {text(k)})", "NULL", "'   '",
               f"('txn_' || {text(k)} || '-b')"]
        return "orders", {
            "id": k,
            "order_id": number("o_orderkey", part_of(k, 2)),
            "amount": number("(o_totalprice + 0.0012)", k),
            "method": pick(k, methods),
            "status": pick(k, states),
            "transaction_id": pick(k, ids, raw_sql=True),
            **stamps("o_orderdate", k, "paid_at", "created_at", "updated_at"),
        }
    if entity == "products":
        k = "p_partkey"
        names = ["p_name", "('  ' || upper(p_name) || ' (v2.0) ')", "(p_name || ' & co™')", "NULL", "''",
                 "(p_name || ' w/ ' || p_type)"]
        notes = [f"('<p>' || p_name || '</p><p>The  <b>' || p_brand || '</b>, 100% ok</p>')", "p_type", "NULL",
                 "'<br/>'", "'  '"]
        stock = [text("p_size"), "' Unlimited '", "'UNLIMITED'", f"('-' || {text('p_size')})", "'12.5'", "NULL"]
        return "part", {
            "id": k,
            "name": pick(k, names, raw_sql=True),
            "category": pick(k, ["lower(p_type)", "(' ' || p_type || '  & more')", "NULL", "'--'"], raw_sql=True),
            "price": number("p_retailprice", k),
            "stock": pick(k, stock, raw_sql=True),
            "brand": pick(k, ["p_brand", "lower(p_brand)", "' '", "'h.p.'"], raw_sql=True),
            "description": pick(k, notes, raw_sql=True),
            **stamps(day_of(engine, k), k),
        }
    if entity == "reviews":
        k = "doc_id"
        titles = ["('  very   ' || lang || ' (' || source || ')! ')", "NULL", "''", "upper(source)", "'it''s ok #1'"]
        return "documents", {
            "id": k,
            "product_id": number(f"({k}) % 2000", k),
            "customer_id": number(f"({k}) % 1500", part_of(k, 2)),
            "rating": pick(k, ["5", "4", " 3 ", "0", "11", "-1", "4.5", "five", None]),
            "title": pick(k, titles, raw_sql=True),
            "comment": pick(k, ["text", "text", "text", "NULL", "text", "'   '"], raw_sql=True),
            "verified_purchase": flag(k),
            **stamps(day_of(engine, k), k),
        }
    if entity == "shipping":
        k = "(l_orderkey * 8 + l_linenumber)"
        carriers = ["fedex", "FedEx ", "UPS", " dhl", "USPS", "amazon", "Amazon Logistics", "local courier",
                    "pigeon", None, ""]
        states = ["pending", "in transit", "IN_TRANSIT", "Delivered", "delayed", "lost", "cancelled", "canceled",
                  "unknown", None, "  "]
        codes = [f"('  1z ' || {text(k)} || ' ')", f"('trk-' || {text(k)})", "NULL", "''", f"('#' || {text(k)} || '/é')"]
        return "lineitem", {
            "id": k,
            "order_id": number("l_orderkey", part_of(k, 2)),
            "carrier": pick(k, carriers),
            "tracking_number": pick(k, codes, raw_sql=True),
            "status": pick(part_of(k, 3), states),
            **stamps("l_shipdate", k, "estimated_delivery", "actual_delivery"),
            "cost": number("l_extendedprice", part_of(k, 4)),
            **stamps("l_shipdate", part_of(k, 5)),
        }
    if entity == "suppliers":
        k = "s_suppkey"
        names = ["('  ' || lower(s_name) || ' inc. ')", "'ProSupplies & Co.'", "NULL", "''", "s_name"]
        return "supplier", {
            "id": k,
            "name": pick(k, names, raw_sql=True),
            "contact_name": person(k),
            "email": email(k),
            "phone": phone(part_of(k, 2)),
            "country": pick(k, [*COUNTRIES, None, "  "]),
            "rating": number(f"(({k}) % 50) / 10.0", k),
            "is_active": flag(k),
            **stamps(day_of(engine, k), k),
        }
    raise KeyError(entity)


def derive(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw table of an entity, computed from its given table."""
    source, columns = bronze_columns(entity, SPARK)
    return table(spark, sf_dir, source).selectExpr(*[f"{sql} AS {name}" for name, sql in columns.items()])


_landed: dict[tuple[str, str, str], str] = {}


def bronze(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw table of an entity, landed once per session as parquet in the shared folder.

    Cleaning then starts from stored raw columns, as it does in use. Computed in the same
    plan, the expressions that make a column dirty would be copied into every place that
    reads it.
    """
    key = (spark.sparkContext.applicationId, sf_dir, entity)
    if key not in _landed:
        path = scratch_path(spark, f"bronze-{entity}")
        derive(spark, sf_dir, entity).write.parquet(path)
        _landed[key] = path
    return spark.read.parquet(_landed[key])


def computed(spark: SparkSession, sf_dir: str, entity: str) -> DataFrame:
    """The raw table of an entity as :func:`bronze` gives it, without writing it first.

    For queries that read it once. The generator is a border for the optimizer: no filter or
    column above it gets a copy of the expressions that make a column dirty.
    """
    raw = derive(spark, sf_dir, entity)
    return raw.select(F.inline(F.array(F.struct(*raw.columns))))


def bronze_sql(entity: str) -> str:
    """The same raw table as a SELECT for the checking engine."""
    source, columns = bronze_columns(entity, DUCK)
    return "SELECT " + ", ".join(f"{sql} AS {name}" for name, sql in columns.items()) + f" FROM {source}"


def spec_of(entity: str) -> EntitySpec:
    return ENTITY_SPECS[entity]
