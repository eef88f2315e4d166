"""Queries for quality reports, lookups, keys, references and range rules."""

from __future__ import annotations

from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators import columns, integrity, lookup, quality, sketches
from silverline.operators.hierarchy import hierarchy
from silverline.plans.transformation import normalize_country, run_cleaning, with_paid_time
from silverline.session import scratch_path
from silverline.sources.countries import COUNTRY_ALIASES, country_names, iso_variants
from workload import oracle as o
from workload.bronze import bronze, bronze_sql, derive, spec_of, text_literal
from workload.entity_queries import silver
from workload.registry import portable, query, table


def silver_sql(entity: str) -> str:
    return f"({o.entity_sql(spec_of(entity))}) s"


def _pairs(entity: str) -> list[str]:
    return list(spec_of(entity).rules)


# Lookups


@query(
    "country_lookup",
    f"SELECT id, country, {o.country('country')} AS country_clean FROM ({bronze_sql('customers')}) b",
)
def _(spark, sf_dir):
    return normalize_country(bronze(spark, sf_dir, "customers")).select("id", "country", "country_clean")


_NATION_TEXT = "CASE s_suppkey % 5 WHEN 0 THEN lower(n_name) WHEN 1 THEN ' n' || CAST(n_nationkey AS STRING) || ' ' WHEN 2 THEN 'Nowhere' WHEN 3 THEN NULL ELSE n_name END"


@query(
    "reference_lookup",
    f"""WITH b AS (SELECT s_suppkey, {_NATION_TEXT} AS nation FROM supplier JOIN nation ON s_nationkey = n_nationkey)
    SELECT s_suppkey, nation, CASE WHEN nation IS NULL OR trim(nation) = '' THEN 'UNKNOWN'
           ELSE coalesce(n_name, 'REVISAR_MANUAL') END AS nation_clean
    FROM b LEFT JOIN nation ON upper(trim(nation)) IN (upper(n_name), 'N' || CAST(n_nationkey AS STRING))""",
)
def _(spark, sf_dir):
    nation = table(spark, sf_dir, "nation")
    variants = F.explode(F.array("n_name", F.concat(F.lit("N"), F.col("n_nationkey").cast("string"))))
    entries = nation.select(variants.alias("variant"), F.col("n_name").alias("standard"))
    raw = (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .selectExpr("s_suppkey", f"{_NATION_TEXT} AS nation")
    )
    return lookup.normalize_by_reference(raw, "nation", lookup.lookup_table(entries))


@query(
    "reference_suggest",
    f"""WITH misses AS (
        SELECT country, count(*) AS n_rows FROM ({bronze_sql('customers')}) b
        WHERE {o.country('country')} = 'REVISAR_MANUAL' GROUP BY country),
    ranked AS (
        SELECT country, n_rows, name, CAST(levenshtein(upper(trim(country)), upper(name)) AS INTEGER) AS d,
               row_number() OVER (PARTITION BY country ORDER BY levenshtein(upper(trim(country)), upper(name)), name) AS r
        FROM misses, (VALUES {', '.join(f"({text_literal(c)})" for c in country_names())}) AS c(name))
    SELECT country, n_rows, CASE WHEN d <= 3 THEN name END AS suggestion, CASE WHEN d <= 3 THEN CAST(d AS VARCHAR) END AS distance
    FROM ranked WHERE r = 1""",
)
def _(spark, sf_dir):
    cleaned = normalize_country(bronze(spark, sf_dir, "customers"))
    return portable(lookup.suggest_for_unmatched(cleaned, "country", country_names(), max_distance=3), "distance")


_VARIANTS = sorted({**iso_variants(), **COUNTRY_ALIASES}.items())
_VARIANT_LIST = ", ".join(text_literal(variant) for variant, _ in _VARIANTS)


@query(
    "country_catalogue",
    f"""WITH variants(variant, standard) AS (VALUES {', '.join(f"({text_literal(a)}, {text_literal(b)})" for a, b in _VARIANTS)}),
    spelled AS (
        SELECT 'customer' AS origin, CAST(c_custkey AS BIGINT) AS k, list_extract([{_VARIANT_LIST}], CAST(c_custkey % {len(_VARIANTS)} AS INTEGER) + 1) AS country
        FROM customer
        UNION ALL SELECT 'nation', CAST(n_nationkey AS BIGINT), n_name FROM nation)
    SELECT origin, k, country, coalesce(standard, 'REVISAR_MANUAL') AS country_clean
    FROM spelled LEFT JOIN (SELECT DISTINCT upper(variant) AS v, standard FROM variants) u ON upper(trim(country)) = v""",
)
def _(spark, sf_dir):
    """Every nation, and every spelling of the catalogue on the customers."""
    spelled = table(spark, sf_dir, "customer").selectExpr(
        "'customer' AS origin",
        "CAST(c_custkey AS BIGINT) AS k",
        f"element_at(array({_VARIANT_LIST.replace(chr(39) * 2, chr(92) + chr(39))}), CAST(c_custkey % {len(_VARIANTS)} AS INT) + 1) AS country",
    )
    nations = table(spark, sf_dir, "nation").selectExpr("'nation' AS origin", "CAST(n_nationkey AS BIGINT) AS k", "n_name AS country")
    return normalize_country(spelled.unionByName(nations))


@query(
    "reports_over_kept_table",
    f"""SELECT 'rows' AS report, NULL AS value, count(*) AS n_rows FROM {silver_sql('suppliers')}
    UNION ALL SELECT 'country', country_clean, count(*) FROM {silver_sql('suppliers')} GROUP BY country_clean
    UNION ALL SELECT 'active', CAST(is_active AS VARCHAR), count(*) FROM {silver_sql('suppliers')} GROUP BY is_active""",
)
def _(spark, sf_dir):
    """Three reports over one table that is cleaned once and kept."""
    kept = quality.keep_for_reports(silver(spark, sf_dir, "suppliers"))
    rows = quality.row_count(kept).selectExpr("'rows' AS report", "CAST(NULL AS STRING) AS value", "n_rows")
    country = quality.frequency(kept, "country_clean", ordered=False).selectExpr("'country' AS report", "country_clean AS value", "n_rows")
    active = quality.frequency(kept, "is_active", ordered=False).selectExpr("'active' AS report", "CAST(is_active AS STRING) AS value", "n_rows")
    return rows.unionByName(country).unionByName(active)


_PLACES = [("New York", "United States"), ("St. Louis", "United States"), ("Paris", "France"),
           ("Paris", "United States"), ("Winston-Salem", "United States")]


@query(
    "geo_mismatch",
    f"""WITH places(city, country) AS (VALUES {', '.join(f"({text_literal(a)}, {text_literal(b)})" for a, b in _PLACES)}),
    known AS (SELECT upper(city) AS k, list_sort(list_distinct(list(country))) AS expected_countries FROM places GROUP BY 1)
    SELECT id, city_clean, country_clean, array_to_string(expected_countries, '|') AS expected_countries
    FROM {silver_sql('customers')} JOIN known ON upper(trim(city_clean)) = k
    WHERE country_clean NOT IN ('UNKNOWN', 'REVISAR_MANUAL') AND NOT list_contains(expected_countries, country_clean)""",
)
def _(spark, sf_dir):
    places = spark.createDataFrame(pa.table({"city": [c for c, _ in _PLACES], "country": [c for _, c in _PLACES]}))
    found = lookup.geo_mismatch(silver(spark, sf_dir, "customers"), places)
    return found.select(
        "id", "city_clean", "country_clean", F.array_join("expected_countries", "|").alias("expected_countries")
    )


# Where customers live: a city of their nation, but for every twenty-third of them, who name their nation's neighbour's.
_CITY = "'Port ' || CAST((c_nationkey + CASE WHEN c_custkey % 23 = 0 THEN 1 ELSE 0 END) % 25 AS STRING) || ' ' || CAST(c_custkey % 2 AS STRING)"


@query(
    "geo_mismatch_known_places",
    f"""WITH living AS (SELECT c_custkey AS id, {_CITY} AS city_clean, n_name AS country_clean FROM customer JOIN nation ON c_nationkey = n_nationkey),
    counts AS (SELECT upper(city_clean) AS k, country_clean, count(*) AS n FROM living GROUP BY 1, 2),
    shares AS (SELECT *, sum(n) OVER (PARTITION BY k) AS of_city FROM counts),
    known AS (SELECT k, list_sort(list(country_clean)) AS expected FROM shares WHERE n >= 3 AND n >= 0.25 * of_city GROUP BY k)
    SELECT id, city_clean, country_clean, array_to_string(expected, '|') AS expected_countries
    FROM living JOIN known ON upper(city_clean) = k WHERE NOT list_contains(expected, country_clean)""",
)
def _(spark, sf_dir):
    """Cities in a country that hardly any customer of the city lives in, by the customers themselves."""
    joined = table(spark, sf_dir, "customer").join(table(spark, sf_dir, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    living = joined.select(F.col("c_custkey").alias("id"), F.expr(_CITY).alias("city_clean"), F.col("n_name").alias("country_clean"))
    found = lookup.geo_mismatch(living, lookup.known_places(living, least_share=0.25))
    return found.select("id", "city_clean", "country_clean", F.array_join("expected_countries", "|").alias("expected_countries"))


# References and keys


@query(
    "orphan_rows",
    f"""SELECT id, order_id, amount FROM {silver_sql('payments')}
        WHERE order_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM orders WHERE o_orderkey = order_id)""",
)
def _(spark, sf_dir):
    payments, orders = silver(spark, sf_dir, "payments"), table(spark, sf_dir, "orders")
    return integrity.orphan_rows(payments, "order_id", orders, "o_orderkey").select("id", "order_id", "amount")


_REFERENCES = [
    ("payments", "order_id", "orders", "o_orderkey"),
    ("shipping", "order_id", "orders", "o_orderkey"),
    ("inventory", "product_id", "part", "p_partkey"),
    ("reviews", "product_id", "part", "p_partkey"),
    ("reviews", "customer_id", "customer", "c_custkey"),
]


@query(
    "orphan_keys",
    " UNION ALL ".join(
        f"""SELECT '{child}.{fk}' AS reference, {fk} AS parent_key, count(*) AS n_rows FROM {silver_sql(child)}
        WHERE {fk} IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {parent} WHERE {pk} = {fk}) GROUP BY {fk}"""
        for child, fk, parent, pk in _REFERENCES
    ),
)
def _(spark, sf_dir):
    found = [
        integrity.orphan_keys(silver(spark, sf_dir, child, raw=derive), fk, table(spark, sf_dir, parent), pk).select(
            F.lit(f"{child}.{fk}").alias("reference"), F.col(fk).alias("parent_key"), "n_rows"
        )
        for child, fk, parent, pk in _REFERENCES
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "self_orphan_rows",
    f"""SELECT id, parent_id FROM {silver_sql('categories')} WHERE parent_id IS NOT NULL
        AND parent_id NOT IN (SELECT CAST(p_partkey AS BIGINT) FROM part)""",
)
def _(spark, sf_dir):
    return integrity.self_orphan_rows(silver(spark, sf_dir, "categories")).select("id", "parent_id")


@query(
    "duplicate_codes",
    f"""SELECT code_clean, count(*) AS n_rows FROM {silver_sql('coupons')} WHERE code_clean <> 'UNKNOWN'
        GROUP BY code_clean HAVING count(*) > 1""",
)
def _(spark, sf_dir):
    return integrity.duplicate_keys(silver(spark, sf_dir, "coupons"), "code_clean", ignore=["UNKNOWN"])


# Profiles


@query("row_counts", "SELECT count(*) AS n_rows FROM lineitem")
def _(spark, sf_dir):
    return quality.row_count(bronze(spark, sf_dir, "shipping"))


_SHIPPING_RAW = [f.name for f in spec_of("shipping").schema.fields]


@query(
    "null_profile",
    f"""SELECT {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in _SHIPPING_RAW)}
        FROM ({bronze_sql('shipping')}) b""",
)
def _(spark, sf_dir):
    return quality.null_profile(bronze(spark, sf_dir, "shipping"))


@query(
    "null_profile_silver",
    f"""SELECT {', '.join(f"count(*) FILTER (WHERE {c} IS NULL) AS {c}" for c in
        [*[f.name for f in spec_of('payments').schema.fields], *[f'{c}_clean' for c in _pairs('payments')]])}
        FROM {silver_sql('payments')}""",
)
def _(spark, sf_dir):
    return quality.null_profile(silver(spark, sf_dir, "payments", audit=False))


def _changes_sql(entity: str) -> str:
    return ", ".join(
        f"count(*) FILTER (WHERE {c} IS DISTINCT FROM {c}_clean) AS {c}" for c in _pairs(entity)
    )


@query("change_profile", f"SELECT {_changes_sql('shipping')} FROM {silver_sql('shipping')}")
def _(spark, sf_dir):
    return quality.change_profile(silver(spark, sf_dir, "shipping", audit=False))


@query(
    "impact_summary",
    f"""SELECT total, changed, round(changed * 100.0 / total, 1) AS changed_pct, unknown,
               round(unknown * 100.0 / total, 1) AS unknown_pct FROM (
        SELECT count(*) AS total, count(*) FILTER (WHERE name IS DISTINCT FROM name_clean) AS changed,
               count(*) FILTER (WHERE name_clean = 'UNKNOWN') AS unknown FROM {silver_sql('customers')}) t""",
)
def _(spark, sf_dir):
    return quality.impact_summary(silver(spark, sf_dir, "customers"), "name")


def _report_sql(entity: str) -> str:
    spec = spec_of(entity)

    def line(column: str) -> str:
        is_date = column in spec.date_columns
        failed = f"trim({column}) <> '' AND {column}_clean IS NULL"

        def counted(condition: str) -> str:
            return f"count(*) FILTER (WHERE {condition})"

        return (
            f"SELECT {text_literal(column)} AS \"column\", count(*) AS total, {counted(f'{column} IS NULL')} AS raw_nulls,"
            f" {counted(f'{column}_clean IS NULL')} AS clean_nulls,"
            f" {counted(f'{column} IS DISTINCT FROM {column}_clean')} AS changed,"
            f" {counted('false' if is_date else column + '_clean = ' + text_literal('UNKNOWN'))} AS unknown,"
            f" {counted('false' if is_date else column + '_clean = ' + text_literal('REVISAR_MANUAL'))} AS review,"
            f" {counted(failed if is_date else 'false')} AS failed_dates FROM s"
        )

    return f"WITH s AS ({o.entity_sql(spec)}) " + " UNION ALL ".join(line(c) for c in spec.rules)


for _entity in ("customers", "payments", "shipping"):

    def _report(spark, sf_dir, entity=_entity):
        return quality.quality_report(silver(spark, sf_dir, entity))

    query(f"quality_report_{_entity}", _report_sql(_entity))(_report)


# What the lines of a rollup are grouped by: a batch of the payments and two cleaned categories.
_BATCH = "CONCAT('batch ', CAST(id % 4 AS STRING))"


def _rollup_sql(entity: str, by: list[str]) -> str:
    """Every grouping and every column counted by itself."""
    spec, out = spec_of(entity), []
    for n in range(len(by), -1, -1):
        dims = ", ".join(f"{c} AS {c}" if i < n else f"CAST(NULL AS VARCHAR) AS {c}" for i, c in enumerate(by))
        sets = f"GROUP BY GROUPING SETS (({', '.join(by[:n])}))"
        for column in spec.rules:
            is_date = column in spec.date_columns
            failed = f"trim({column}) <> '' AND {column}_clean IS NULL" if is_date else "false"
            unknown, review = ("false" if is_date else f"{column}_clean = '{mark}'" for mark in ("UNKNOWN", "REVISAR_MANUAL"))
            conditions = {
                "raw_nulls": f"{column} IS NULL", "clean_nulls": f"{column}_clean IS NULL",
                "changed": f"{column} IS DISTINCT FROM {column}_clean", "unknown": unknown, "review": review, "failed_dates": failed,
            }
            counts = ", ".join(f"count(*) FILTER (WHERE {c}) AS {name}" for name, c in conditions.items())
            out.append(f"""SELECT {dims}, '{",".join(by[:n])}' AS grouped_by, {text_literal(column)} AS "column", count(*) AS total, {counts} FROM s {sets}""")
    return f"WITH s AS (SELECT *, {_BATCH} AS batch FROM ({o.entity_sql(spec)}) e) " + " UNION ALL ".join(out)


@query("quality_rollup", _rollup_sql("payments", ["batch", "method_clean", "status_clean"]))
def _(spark, sf_dir):
    cleaned = silver(spark, sf_dir, "payments").withColumn("batch", F.expr(_BATCH))
    return quality.quality_rollup(cleaned, ["batch", "method_clean", "status_clean"])


_PROFILED = ["method_clean", "status_clean", "order_id", "amount"]


@query(
    "sketch_profile",
    f"WITH s AS (SELECT * FROM {silver_sql('payments')}) "
    + " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count(*) - count({c}) AS n_nulls, true AS distinct_within, true AS median_within,
        (SELECT max(n) FROM (SELECT count(*) AS n FROM s GROUP BY {c})) AS most_frequent FROM s"""
        for c in _PROFILED
    ),
)
def _(spark, sf_dir):
    """The profile of four runs from their stored sketches; estimates are held against the exact values of all rows."""
    cleaned, root = silver(spark, sf_dir, "payments"), scratch_path(spark, "profiles")
    for n in range(4):
        sketches.keep_profile(cleaned.where(F.col("id") % 4 == n), root, "payments", f"r{n}", _PROFILED, tracked=1_000_000)
    merged = sketches.merged_profile(sketches.kept_profiles(spark, root, "payments"), tracked=1_000_000)
    median = F.when(F.col("quantiles").isNotNull(), F.col("quantiles")[2])
    found = merged.select("column", "n_rows", "n_nulls", "n_distinct", median.alias("median"), F.col("top")[0]["count"].alias("most_frequent"))
    lines = []
    for r in found.collect():  # a line for each of four columns
        value = F.col(r["column"]).cast("double") if r["median"] is not None else F.lit(None).cast("double")
        share = lambda part, value=value: F.coalesce(F.try_divide(F.count_if(part), F.count(value)), F.lit(0.5))
        middle = F.lit(r["median"]).cast("double")
        lines.append(
            cleaned.agg(
                F.lit(r["column"]).alias("column"),
                F.lit(r["n_rows"]).cast("long").alias("n_rows"),
                F.lit(r["n_nulls"]).cast("long").alias("n_nulls"),
                (F.abs(F.lit(r["n_distinct"]) - F.countDistinct(r["column"])) <= 0.05 * F.countDistinct(r["column"])).alias("distinct_within"),
                ((share(value < middle) <= 0.515) & (share(value <= middle) >= 0.485)).alias("median_within"),
                F.lit(r["most_frequent"]).cast("long").alias("most_frequent"),
            )
        )
    return reduce(DataFrame.unionByName, lines)


# A tree over the parts: a chain through all even keys with twigs, roots, missing parents, cycles and what leads into them.
_PARENT = """CASE WHEN k = 2 OR k % 10 = 1 THEN NULL WHEN k % 2 = 0 THEN k - 2 WHEN k % 30 = 3 THEN k + 2 WHEN k % 30 = 5 THEN k - 2
    WHEN k % 30 = 7 THEN k - 4 WHEN k % 30 = 9 THEN k WHEN k % 30 = 13 THEN k + 900000000 ELSE k - 1 END"""


@query(
    "category_paths",
    f"""WITH RECURSIVE keys AS (SELECT CAST(p_partkey AS BIGINT) AS k FROM part),
    edges AS (SELECT k, CAST({_PARENT} AS BIGINT) AS parent FROM keys),
    tops AS (SELECT k, CASE WHEN parent IS NULL THEN 'root' ELSE 'orphan' END AS status FROM edges WHERE parent IS NULL OR parent NOT IN (SELECT k FROM keys)),
    placed AS (SELECT k, k AS root, CAST(0 AS BIGINT) AS depth, status FROM tops
        UNION ALL SELECT e.k, p.root, p.depth + 1, 'below' FROM placed p JOIN edges e ON e.parent = p.k),
    steps AS (SELECT e.k, e.parent AS seen, 1 AS n FROM edges e WHERE e.k NOT IN (SELECT k FROM placed)
        UNION ALL SELECT s.k, e.parent, s.n + 1 FROM steps s JOIN edges e ON e.k = s.seen WHERE s.n < 8)
    SELECT CAST(k AS VARCHAR) AS key, CAST(root AS VARCHAR) AS root, CAST(depth AS VARCHAR) AS depth, status FROM placed
    UNION ALL SELECT CAST(k AS VARCHAR), NULL, NULL, CASE WHEN bool_or(seen = k) THEN 'cycle' ELSE 'into cycle' END FROM steps GROUP BY k""",
)
def _(spark, sf_dir):
    parts = table(spark, sf_dir, "part").select(F.col("p_partkey").cast("long").alias("k"))
    edges = parts.select(F.col("k").alias("id"), F.expr(_PARENT).cast("long").alias("parent_id"))
    return portable(hierarchy(edges), "key", "root", "depth")


@query(
    "frequency",
    f"SELECT country_clean, count(*) AS n_rows FROM {silver_sql('customers')} GROUP BY country_clean",
)
def _(spark, sf_dir):
    return quality.frequency(silver(spark, sf_dir, "customers"), "country_clean")


@query(
    "frequency_carrier",
    f"SELECT carrier_clean, count(*) AS n_rows FROM {silver_sql('shipping')} GROUP BY carrier_clean",
)
def _(spark, sf_dir):
    return quality.frequency(silver(spark, sf_dir, "shipping"), "carrier_clean")


@query("distinct_values", f"SELECT DISTINCT discount_type FROM ({bronze_sql('coupons')}) b")
def _(spark, sf_dir):
    return quality.distinct_values(bronze(spark, sf_dir, "coupons"), "discount_type")


@query("distinct_mapping", f"SELECT DISTINCT status, status_clean FROM {silver_sql('inventory')}")
def _(spark, sf_dir):
    return quality.distinct_mapping(silver(spark, sf_dir, "inventory"), "status")


@query(
    "review_queue",
    f"""SELECT country, count(*) AS n_rows FROM {silver_sql('suppliers')}
        WHERE country_clean = 'REVISAR_MANUAL' GROUP BY country""",
)
def _(spark, sf_dir):
    return quality.review_queue(silver(spark, sf_dir, "suppliers"), "country")


@query(
    "sample_rows",
    f"SELECT id, method, method_clean, status, status_clean FROM {silver_sql('payments')} ORDER BY id LIMIT 20",
)
def _(spark, sf_dir):
    paid = silver(spark, sf_dir, "payments").select("id", "method", "method_clean", "status", "status_clean")
    return quality.sample(paid, 20)


@query(
    "sentinel_count",
    f"SELECT count(*) AS n_rows FROM {silver_sql('coupons')} WHERE discount_type_clean = 'UNKNOWN'",
)
def _(spark, sf_dir):
    return quality.sentinel_count(silver(spark, sf_dir, "coupons"), "discount_type_clean")


# Row-level views


@query(
    "before_after",
    f"""SELECT id, {', '.join(f'{c} AS {c}_before, {c}_clean AS {c}_after' for c in _pairs('categories'))}
        FROM {silver_sql('categories')}""",
)
def _(spark, sf_dir):
    return portable(quality.before_after(silver(spark, sf_dir, "categories", audit=False), keys=["id"]))


@query(
    "equality_filter",
    f"SELECT id, country FROM {silver_sql('customers')} WHERE country_clean = 'Germany' OR trim(country) = ''",
)
def _(spark, sf_dir):
    cleaned = silver(spark, sf_dir, "customers")
    wanted = (F.col("country_clean") == "Germany") | (F.trim("country") == "")
    return cleaned.filter(wanted).select("id", "country")


@query(
    "changed_rows",
    f"SELECT id, warehouse, warehouse_clean FROM {silver_sql('inventory')} WHERE warehouse IS DISTINCT FROM warehouse_clean",
)
def _(spark, sf_dir):
    changed = quality.changed_rows(silver(spark, sf_dir, "inventory"), "warehouse")
    return changed.select("id", "warehouse", "warehouse_clean")


@query("sentinel_rows", f"SELECT id, email FROM {silver_sql('customers')} WHERE email_clean = 'UNKNOWN'")
def _(spark, sf_dir):
    return quality.sentinel_rows(silver(spark, sf_dir, "customers"), "email_clean").select("id", "email")


@query(
    "failed_dates",
    f"""SELECT id, paid_at FROM {silver_sql('payments')}
        WHERE trim(paid_at) <> '' AND paid_at_clean IS NULL""",
)
def _(spark, sf_dir):
    return quality.failed_dates(silver(spark, sf_dir, "payments"), "paid_at").select("id", "paid_at")


@query(
    "failed_date_counts",
    "SELECT "
    + ", ".join(
        f"count(*) FILTER (WHERE trim({c}) <> '' AND {c}_clean IS NULL) AS {c}" for c in spec_of("shipping").date_columns
    )
    + f" FROM {silver_sql('shipping')}",
)
def _(spark, sf_dir):
    cleaned = silver(spark, sf_dir, "shipping")
    return quality.failed_date_counts(cleaned, spec_of("shipping").date_columns)


@query(
    "residual_characters",
    f"""SELECT id, name FROM ({bronze_sql('customers')}) b WHERE regexp_matches(name, '[^a-zA-Z\\s''-]')""",
)
def _(spark, sf_dir):
    return quality.residual_characters(bronze(spark, sf_dir, "customers"), "name").select("id", "name")


@query(
    "residual_characters_clean",
    f"""SELECT id, name_clean FROM {silver_sql('customers')} WHERE regexp_matches(name_clean, '[^a-zA-Z\\s''-]')""",
)
def _(spark, sf_dir):
    found = quality.residual_characters(silver(spark, sf_dir, "customers"), "name_clean")
    return found.select("id", "name_clean")


@query(
    "missing_columns",
    f"""SELECT CAST(id AS BIGINT) AS id, brand, {o.cleaned(spec_of('products'), 'brand')} AS brand_clean
        FROM ({bronze_sql('products')}) b""",
)
def _(spark, sf_dir):
    narrow = bronze(spark, sf_dir, "products").select("id", "brand")
    return run_cleaning(narrow, spark, spec=spec_of("products"), audit=False)


# Schemas

_PAYMENT_TYPES = {"id": "bigint", "order_id": "bigint", "amount": "double"}
_PAYMENT_COLUMNS = [(f.name, _PAYMENT_TYPES.get(f.name, "string")) for f in spec_of("payments").schema.fields] + [
    (f"{c}_clean", "date" if c in spec_of("payments").date_columns else "string") for c in _pairs("payments")
]


@query(
    "schema_report",
    f"WITH s AS ({o.entity_sql(spec_of('payments'))}) "
    + " UNION ALL ".join(
        f"SELECT {i} AS position, {text_literal(c)} AS \"column\", {text_literal(t)} AS type, count({c}) AS n_values FROM s"
        for i, (c, t) in enumerate(_PAYMENT_COLUMNS)
    ),
)
def _(spark, sf_dir):
    return quality.schema_report(silver(spark, sf_dir, "payments", audit=False))


_CUSTOMER_COLUMNS = {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int", "c_acctbal": "double",
                     "c_mktsegment": "string"}


@query(
    "schema_differences",
    " UNION ALL ".join(
        [
            f"SELECT {text_literal(f.name)} AS \"column\", {text_literal(f.dataType.simpleString())} AS expected,"
            " CAST(NULL AS VARCHAR) AS actual, CAST(0 AS BIGINT) AS n_values"
            for f in spec_of("customers").schema.fields
        ]
        + [f"SELECT '{c}', NULL, '{t}', count({c}) FROM customer" for c, t in _CUSTOMER_COLUMNS.items()]
    ),
)
def _(spark, sf_dir):
    return quality.schema_differences(table(spark, sf_dir, "customer"), spec_of("customers").schema)


@query(
    "clean_pairs",
    "SELECT * FROM (VALUES "
    + ", ".join(f"({text_literal(c)}, {text_literal(c + '_clean')}, {n})" for c, n in
                [(c, "(SELECT count(*) FROM events)") for c in _pairs("coupons")])
    + ") AS t(raw, clean, n_rows)",
)
def _(spark, sf_dir):
    cleaned = silver(spark, sf_dir, "coupons")
    counted = quality.row_count(cleaned)
    lines = [F.struct(F.lit(raw).alias("raw"), F.lit(clean).alias("clean")) for raw, clean in quality.clean_pairs(cleaned)]
    return counted.select(F.explode(F.array(*lines)).alias("pair"), "n_rows").select("pair.*", "n_rows")


# Range and consistency rules


def _rule_sql(entity: str) -> list[tuple[str, str, str]]:
    """(rule, column, violated) of an entity, restated in SQL."""
    restated = {
        "id_present": "id IS NULL",
        "quantity_not_negative": "quantity < 0",
        "amount_two_decimals": "round(amount, 2) <> amount",
        "price_not_negative": "price < 0",
        "rating_1_to_5": "rating < 1 OR rating > 5",
        "cost_not_negative": "cost < 0",
        "rating_not_negative": "rating < 0",
    }
    return [(r.name, r.column, restated[r.name]) for r in spec_of(entity).constraints]


_REPAIRED = {"payments": ("amount", "round(amount, 2)"), "suppliers": ("rating", "CASE WHEN rating >= 0 THEN rating END")}

for _entity in ("inventory", "payments", "products", "reviews", "shipping", "suppliers"):
    _column = _rule_sql(_entity)[1][1]
    _value = _REPAIRED.get(_entity, (_column, _column))[1]
    _flags = ", ".join(f"coalesce({v}, false) AS {n}_violated" for n, _, v in _rule_sql(_entity))

    def _rules(spark, sf_dir, entity=_entity, column=_column):
        checked = silver(spark, sf_dir, entity, raw=derive, rules=True)
        flags = [f"{r.name}_violated" for r in spec_of(entity).constraints]
        return portable(checked.select("id", column, *flags), *o.integers_of(spec_of(entity)))

    _integers = [_column] if _column in o.integers_of(spec_of(_entity)) else []
    _sql = o.portable(f"SELECT id, {_value} AS {_column}, {_flags} FROM {silver_sql(_entity)}", *_integers)
    query(f"rules_{_entity}", _sql)(_rules)


_RULED = ["customers", "inventory", "payments", "products", "reviews", "shipping", "suppliers"]


@query(
    "rule_violations",
    " UNION ALL ".join(
        f"""SELECT '{entity}' AS entity, '{name}' AS rule, '{column}' AS "column",
        count(*) FILTER (WHERE {violated}) AS violations, count(*) AS total FROM {silver_sql(entity)}"""
        for entity in _RULED
        for name, column, violated in _rule_sql(entity)
    ),
)
def _(spark, sf_dir):
    found = [
        integrity.rule_violations(silver(spark, sf_dir, e, raw=derive), spec_of(e).constraints).withColumn("entity", F.lit(e))
        for e in _RULED
    ]
    return reduce(DataFrame.unionByName, found)


@query(
    "paid_time",
    f"""SELECT id, paid_at, strftime({o.moment('paid_at')}, '%Y-%m-%d %H:%M:%S') AS paid_at_ts
        FROM ({bronze_sql('payments')}) b""",
)
def _(spark, sf_dir):
    paid = with_paid_time(bronze(spark, sf_dir, "payments"))
    return paid.select("id", "paid_at", F.date_format("paid_at_ts", "yyyy-MM-dd HH:mm:ss").alias("paid_at_ts"))


@query(
    "cast_flags_entity",
    f"""SELECT id, coalesce(stock IS NOT NULL AND trim(stock) <> '' AND lower(trim(stock)) <> 'unlimited'
               AND {o.as_int('stock')} IS NULL, false) AS stock_cast_failed,
               coalesce(trim(price) <> '' AND {o.as_double('price')} IS NULL, false) AS price_cast_failed
        FROM ({bronze_sql('products')}) b""",
)
def _(spark, sf_dir):
    flagged = silver(spark, sf_dir, "products", flags=True)
    return flagged.select("id", "stock_cast_failed", "price_cast_failed")


@query(
    "clean_name_city",
    f"""SELECT id, {o.clean_text('city', "'-.")} AS city_clean, {o.clean_text('name', "'-")} AS name_clean
        FROM ({bronze_sql('customers')}) b""",
)
def _(spark, sf_dir):
    raw = bronze(spark, sf_dir, "customers")
    cleaned = columns.clean_text_column(columns.clean_text_column(raw, "city", keep_chars="'-."), "name")
    return cleaned.select("id", "city_clean", "name_clean")
