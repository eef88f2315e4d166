"""Queries for the nine entities and for cleaning them all in one run."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators import quality
from silverline.plans.transformation import run_cleaning, run_transformation
from workload import oracle as o
from workload.bronze import computed, derive, spec_of
from workload.registry import portable, query

ENTITIES = [
    "customers",
    "coupons",
    "categories",
    "inventory",
    "payments",
    "products",
    "reviews",
    "shipping",
    "suppliers",
]


def silver(spark, sf_dir, entity, raw=computed, **options):
    """The cleaned table of an entity, derived from the given tables.

    Reports that need few columns pass ``raw=derive``: of such a table the other columns are not computed.
    """
    return run_cleaning(raw(spark, sf_dir, entity), spark, spec=spec_of(entity), **options)


def _entity_query(entity):
    def run(spark, sf_dir):
        return portable(silver(spark, sf_dir, entity, audit=False), *o.integers_of(spec_of(entity)))

    return run


for _entity in ENTITIES:
    query(f"entity_{_entity}", o.portable_entity(spec_of(_entity)))(_entity_query(_entity))


def _column_sums(entity: str) -> str:
    """Values, and characters as text, of each cleaned column: what a lost or changed value would show."""
    sums = ", ".join(
        f"{{'column': '{c}_clean', 'n_values': count({c}_clean), 'chars': coalesce(sum(length({c}_clean)), 0)}}"
        for c in spec_of(entity).rules
    )
    return f"SELECT '{entity}' AS entity, n_rows, u.* FROM (SELECT count(*) AS n_rows, unnest([{sums}]) AS u FROM ({o.entity_sql(spec_of(entity))}) s) t"


@query("all_entities", f"""SELECT entity, n_rows, "column", n_values, CAST(chars AS BIGINT) AS chars,
    'ingestion_timestamp, ingestion_date' AS audit_columns FROM ({' UNION ALL '.join(map(_column_sums, ENTITIES))}) a""")
def _(spark, sf_dir):
    """All nine tables cleaned in one run, with the contents of every cleaned column summed up."""
    raw = {entity: computed(spark, sf_dir, entity) for entity in ENTITIES}
    tables = run_transformation(raw, spark)
    # rows are counted without the columns: none has to be derived for that
    counted = run_transformation({entity: derive(spark, sf_dir, entity) for entity in ENTITIES}, spark)
    audit = quality.entity_summary(counted).select("entity", "audit_columns")
    sums = [quality.column_sums(df).select(F.lit(name).alias("entity"), "n_rows", "column", "n_values", "chars") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, sums).join(audit, "entity")
