"""Queries for the column functions: text, format checks, dates, casts, category maps."""

from __future__ import annotations

from pyspark.sql import functions as F

from silverline.functions import casts, dates, mapping, text, validation
from silverline.operators import columns
from workload import oracle as o
from workload.bronze import bronze, bronze_sql
from workload.registry import portable, query, table

# Text


@query("collapse_spaces", f"SELECT doc_id, {o.collapse('text')} AS text_clean FROM documents")
def _(spark, sf_dir):
    return table(spark, sf_dir, "documents").select(
        "doc_id", text.strip_and_normalize_spaces(F.col("text")).alias("text_clean")
    )


@query(
    "case_modes",
    f"""WITH b AS (SELECT id, {o.collapse('name')} AS name FROM ({bronze_sql('customers')}) t)
    SELECT id, {o.cased('name', 'title')} AS title, {o.cased('name', 'person')} AS person,
           upper(name) AS upper, lower(name) AS lower FROM b""",
)
def _(spark, sf_dir):
    name = text.strip_and_normalize_spaces(F.col("name"))
    return bronze(spark, sf_dir, "customers").select(
        "id", *[text.normalize_case(name, mode).alias(mode) for mode in ("title", "person", "upper", "lower")]
    )


@query(
    "strip_special",
    f"""SELECT doc_id, {o.strip('text')} AS letters, {o.strip('text', "'-")} AS name_chars,
               {o.strip('text', "'-.,&/()", True)} AS prose FROM documents""",
)
def _(spark, sf_dir):
    value = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        text.remove_special_chars(value).alias("letters"),
        text.remove_special_chars(value, "'-").alias("name_chars"),
        text.remove_special_chars(value, "'-.,&/()", keep_digits=True).alias("prose"),
    )


@query(
    "blank_sentinel",
    f"""SELECT id, {o.sentinel('city')} AS city, {o.sentinel('name', 'N/A')} AS name,
               {o.sentinel('country')} AS country FROM ({bronze_sql('customers')}) b""",
)
def _(spark, sf_dir):
    return bronze(spark, sf_dir, "customers").select(
        "id",
        text.normalize_to_null(F.col("city")).alias("city"),
        text.normalize_to_null(F.col("name"), "N/A").alias("name"),
        text.normalize_to_null(F.col("country")).alias("country"),
    )


@query("strip_html", "SELECT page_id, regexp_replace(html, '<[^>]+>', '', 'g') AS plain FROM pages")
def _(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.strip_html_tags(F.col("html")).alias("plain"))


@query(
    "clean_text",
    f"""SELECT doc_id, {o.clean_text('text', "'-.,!?()", 'No comment', 'none', True)} AS text_clean FROM documents""",
)
def _(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    cleaned = columns.clean_text_column(docs, "text", "'-.,!?()", "No comment", "none", keep_digits=True)
    return cleaned.select("doc_id", "text_clean")


@query(
    "clean_conversations",
    f"""SELECT conv_id, turn, {o.clean_text('role')} AS role_clean, {o.clean_text('text', "'-", mode='lower')} AS text_clean
        FROM conversations""",
)
def _(spark, sf_dir):
    turns = columns.clean_text_column(table(spark, sf_dir, "conversations"), "role", keep_chars="")
    return columns.clean_text_column(turns, "text", case_mode="lower").select(
        "conv_id", "turn", "role_clean", "text_clean"
    )


@query(
    "clean_names",
    f"""SELECT id, name, {o.clean_text('name', "'-", mode='title')} AS title_clean,
               {o.clean_text('name', "'-", mode='person')} AS name_clean FROM ({bronze_sql('customers')}) b""",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "customers")
    titled = raw.withColumn("title_clean", text.clean_text(F.col("name")))
    return columns.clean_text_column(titled, "name", case_mode="person").select(
        "id", "name", "title_clean", "name_clean"
    )


@query(
    "clean_code",
    f"SELECT id, transaction_id, {o.clean_code('transaction_id')} AS transaction_id_clean FROM ({bronze_sql('payments')}) b",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "payments")
    return columns.clean_code_column(raw, "transaction_id").select("id", "transaction_id", "transaction_id_clean")


@query(
    "match_keys",
    f"SELECT id, upper(trim(country)) AS upper_key, lower(trim(country)) AS lower_key FROM ({bronze_sql('customers')}) b",
)
def _(spark, sf_dir):
    return bronze(spark, sf_dir, "customers").select(
        "id",
        text.match_key(F.col("country"), "upper").alias("upper_key"),
        text.match_key(F.col("country")).alias("lower_key"),
    )


@query(
    "clean_email",
    f"""SELECT id, email, {o.email_ok('email')} AS valid, {o.clean_email('email')} AS email_clean
        FROM ({bronze_sql('customers')}) b""",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "customers").withColumn("valid", validation.is_valid_email(F.col("email")))
    return columns.clean_email_column(raw).select("id", "email", "valid", "email_clean")


@query(
    "clean_phone",
    f"""SELECT id, phone, {o.phone_ok('phone')} AS valid, {o.clean_phone('phone')} AS phone_clean
        FROM ({bronze_sql('customers')}) b""",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "customers").withColumn("valid", validation.is_valid_phone(F.col("phone")))
    return columns.clean_phone_column(raw).select("id", "phone", "valid", "phone_clean")


# Dates


@query("parse_dates", f"SELECT id, paid_at, {o.date_string('paid_at')} AS paid_on FROM ({bronze_sql('payments')}) b")
def _(spark, sf_dir):
    paid = dates.parse_date(F.col("paid_at")).alias("paid_on")
    return portable(bronze(spark, sf_dir, "payments").select("id", "paid_at", paid))


@query(
    "parse_dates_last_wins",
    f"SELECT id, paid_at, {o.date_string('paid_at', last=True)} AS paid_on FROM ({bronze_sql('payments')}) b",
)
def _(spark, sf_dir):
    paid = dates.parse_date(F.col("paid_at"), precedence="last").alias("paid_on")
    return portable(bronze(spark, sf_dir, "payments").select("id", "paid_at", paid))


@query(
    "parse_given_format",
    f"""SELECT id, created_at, CASE WHEN regexp_full_match(created_at, '\\d{{2}}/\\d{{2}}/\\d{{4}}')
        THEN CAST(CAST(try_strptime(created_at, '%d/%m/%Y') AS DATE) AS VARCHAR) END AS created_on
        FROM ({bronze_sql('payments')}) b""",
)
def _(spark, sf_dir):
    created = dates.parse_date(F.col("created_at"), "dd/MM/yyyy").alias("created_on")
    return portable(bronze(spark, sf_dir, "payments").select("id", "created_at", created))


@query("iso_dates", f"SELECT id, {o.date_string('last_restock')} AS restocked FROM ({bronze_sql('inventory')}) b")
def _(spark, sf_dir):
    return bronze(spark, sf_dir, "inventory").select(
        "id", dates.format_date_to_iso(F.col("last_restock")).alias("restocked")
    )


@query(
    "date_valid",
    f"""SELECT id, coalesce(regexp_full_match(created_at, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
        AND try_strptime(created_at, '%Y-%m-%d') IS NOT NULL, false) AS valid FROM ({bronze_sql('payments')}) b""",
)
def _(spark, sf_dir):
    return bronze(spark, sf_dir, "payments").select(
        "id", validation.is_valid_date(F.col("created_at")).alias("valid")
    )


_SHIP_DATES = ["estimated_delivery", "actual_delivery", "created_at", "updated_at"]


@query(
    "clean_dates",
    f"""SELECT id, {', '.join(f"{o.date_string(c)} AS {c}_clean" for c in _SHIP_DATES)}
        FROM ({bronze_sql('shipping')}) b""",
)
def _(spark, sf_dir):
    cleaned = columns.clean_date_columns(bronze(spark, sf_dir, "shipping"), _SHIP_DATES)
    return portable(cleaned.select("id", *[f"{c}_clean" for c in _SHIP_DATES]))


@query(
    "audit_columns",
    "SELECT count(*) AS n_rows, count(*) AS stamped, count(*) AS dated, count(*) AS kept_batch_date FROM orders",
)
def _(spark, sf_dir):
    raw = table(spark, sf_dir, "orders").withColumn("ingestion_date", F.col("o_orderdate").cast("date"))
    return columns.add_audit_timestamps(raw).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count("ingestion_timestamp").alias("stamped"),
        F.count_if(F.col("ingestion_date") == F.col("ingestion_timestamp").cast("date")).alias("dated"),
        F.count_if(F.col("bronze_ingestion_date") == F.col("o_orderdate").cast("date")).alias("kept_batch_date"),
    )


# Casts


@query(
    "cast_int",
    o.portable(
        f"SELECT id, quantity AS raw, {o.as_int('quantity')} AS quantity FROM ({bronze_sql('inventory')}) b", "quantity"
    ),
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "inventory").withColumn("raw", F.col("quantity"))
    return portable(columns.safe_cast_int(raw, "quantity").select("id", "raw", "quantity"), "quantity")


@query(
    "cast_int_replaced",
    f"SELECT id, coalesce({o.as_int('reorder_point')}, 0) AS reorder_point FROM ({bronze_sql('inventory')}) b",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "inventory")
    return columns.safe_cast_int(raw, "reorder_point", null_replacement=0).select("id", "reorder_point")


@query(
    "cast_long",
    o.portable(f"SELECT id, {o.as_int('order_id', 'BIGINT')} AS order_id FROM ({bronze_sql('shipping')}) b", "order_id"),
)
def _(spark, sf_dir):
    cast = columns.safe_cast_long(bronze(spark, sf_dir, "shipping"), "order_id")
    return portable(cast.select("id", "order_id"), "order_id")


@query("cast_double", f"SELECT id, amount AS raw, {o.as_double('amount')} AS amount FROM ({bronze_sql('payments')}) b")
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "payments").withColumn("raw", F.col("amount"))
    return columns.safe_cast_double(raw, "amount").select("id", "raw", "amount")


@query(
    "cast_bool",
    f"""SELECT id, is_active AS raw, {o.as_bool('is_active')} AS is_active,
               {o.as_bool('is_active', 'true')} AS active_unless_denied FROM ({bronze_sql('coupons')}) b""",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "coupons").withColumns(
        {"raw": F.col("is_active"), "active_unless_denied": casts.to_bool(F.col("is_active"), default=True)}
    )
    return columns.safe_cast_bool(raw, "is_active").select("id", "raw", "is_active", "active_unless_denied")


@query(
    "cast_date",
    f"""SELECT id, CASE WHEN regexp_full_match(expires_at, '\\d{{4}}-\\d{{2}}-\\d{{2}}')
        THEN CAST(CAST(try_strptime(expires_at, '%Y-%m-%d') AS DATE) AS VARCHAR) END AS expires_at
        FROM ({bronze_sql('coupons')}) b""",
)
def _(spark, sf_dir):
    return portable(columns.safe_cast_date(bronze(spark, sf_dir, "coupons"), "expires_at").select("id", "expires_at"))


_COUPON_TYPES = {"discount_value": "double", "min_order": "long", "max_uses": "int", "is_active": "bool"}


@query(
    "cast_schema",
    o.portable(
        f"""SELECT id, {', '.join(f'{o.typed(c, t)} AS {c}' for c, t in _COUPON_TYPES.items())}
        FROM ({bronze_sql('coupons')}) b""",
        "min_order",
        "max_uses",
    ),
)
def _(spark, sf_dir):
    cast = columns.cast_schema(bronze(spark, sf_dir, "coupons"), _COUPON_TYPES)
    return portable(cast.select("id", *_COUPON_TYPES), "min_order", "max_uses")


def _failed(x: str, kind: str) -> str:
    if kind == "bool":
        return f"coalesce(trim({x}) <> '' AND {o.as_bool(x, 'NULL')} IS NULL, false)"
    return f"coalesce({x} IS NOT NULL AND trim({x}) <> '' AND {o.typed(x, kind)} IS NULL, false)"


@query(
    "cast_flags",
    f"""SELECT id, {', '.join(f'{_failed(c, t)} AS {c}_cast_failed' for c, t in _COUPON_TYPES.items())}
        FROM ({bronze_sql('coupons')}) b""",
)
def _(spark, sf_dir):
    flagged = columns.cast_failure_flags(bronze(spark, sf_dir, "coupons"), _COUPON_TYPES)
    return flagged.select("id", *[f"{c}_cast_failed" for c in _COUPON_TYPES])


@query(
    "stock_unlimited",
    o.portable(
        f"""SELECT id, stock AS raw,
        {o.as_int("CASE WHEN lower(trim(stock)) = 'unlimited' THEN NULL ELSE stock END")} AS stock
        FROM ({bronze_sql('products')}) b""",
        "stock",
    ),
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "products")
    known = casts.null_tokens(F.col("stock"), "unlimited")
    return portable(raw.select("id", F.col("stock").alias("raw"), casts.to_int(known).alias("stock")), "stock")


# Category maps

_MAPS = {
    "map_discount_type": ("coupons", "discount_type", mapping.DISCOUNT_TYPE),
    "map_inventory_status": ("inventory", "status", mapping.INVENTORY_STATUS),
    "map_payment_method": ("payments", "method", mapping.PAYMENT_METHOD),
    "map_payment_status": ("payments", "status", mapping.PAYMENT_STATUS),
    "map_shipping_carrier": ("shipping", "carrier", mapping.SHIPPING_CARRIER),
    "map_shipping_status": ("shipping", "status", mapping.SHIPPING_STATUS),
}


def _map_query(entity, column, values):
    def run(spark, sf_dir):
        mapped = columns.clean_category_column(bronze(spark, sf_dir, entity), column, values)
        return mapped.select("id", column, f"{column}_clean")

    return run


for _name, (_entity, _column, _values) in _MAPS.items():
    query(
        _name,
        f"SELECT id, {_column}, {o.mapped(_column, _values)} AS {_column}_clean FROM ({bronze_sql(_entity)}) b",
    )(_map_query(_entity, _column, _values))
