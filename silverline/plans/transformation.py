"""Bronze to Silver for one entity or for a dictionary of tables."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from functools import partial

from pyspark.sql import DataFrame, SparkSession

from silverline.functions.dates import parse_timestamp
from silverline.operators.integrity import apply_rules
from silverline.operators.lookup import normalize_by_reference
from silverline.plans.entities import ENTITY_SPECS
from silverline.plans.spec import EntitySpec, ReferenceRule
from silverline.sources.countries import country_lookup


def default_lookups(spark: SparkSession, spec: EntitySpec) -> dict[str, DataFrame]:
    """The lookup tables a specification needs."""
    needed = any(isinstance(rule, ReferenceRule) for rule in spec.rules.values())
    return {"country": country_lookup(spark)} if needed else {}


def run_cleaning(
    df: DataFrame,
    spark: SparkSession | None = None,
    *,
    spec: EntitySpec,
    lookups: Mapping[str, DataFrame] | None = None,
    rules: bool = False,
    flags: bool = False,
    audit: bool = True,
) -> DataFrame:
    """Clean one table by its specification; ``rules`` also applies its constraints."""
    spark = spark or df.sparkSession
    lookups = lookups if lookups is not None else default_lookups(spark, spec)
    cleaned = spec.clean(df, lookups, audit=audit, flags=flags)
    return apply_rules(cleaned, spec.constraints) if rules else cleaned


run_customer_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["customers"])
run_coupon_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["coupons"])
run_category_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["categories"])
run_inventory_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["inventory"])
run_payment_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["payments"])
run_product_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["products"])
run_review_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["reviews"])
run_shipping_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["shipping"])
run_supplier_cleaning = partial(run_cleaning, spec=ENTITY_SPECS["suppliers"])

CLEANERS: dict[str, Callable[..., DataFrame]] = {
    name: partial(run_cleaning, spec=spec) for name, spec in ENTITY_SPECS.items()
}


def run_transformation(dataframes: Mapping[str, DataFrame], spark: SparkSession | None = None) -> dict[str, DataFrame]:
    """Clean every known table of the dictionary; others are left out."""
    return {name: clean(dataframes[name], spark) for name, clean in CLEANERS.items() if name in dataframes}


def normalize_country(df: DataFrame, spark: SparkSession | None = None, column: str = "country") -> DataFrame:
    """Add ``{column}_clean`` with the standard country name."""
    return normalize_by_reference(df, column, country_lookup(spark or df.sparkSession))


def with_paid_time(df: DataFrame, column: str = "paid_at") -> DataFrame:
    """Add ``{column}_ts``: the payment time with its time of day, where it has one."""
    return df.withColumn(f"{column}_ts", parse_timestamp(column))
