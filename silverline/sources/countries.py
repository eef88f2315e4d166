"""Country catalogue: ISO 3166 names, official names and codes to one standard name.

The catalogue is the table ``iso3166.tsv`` beside this module, so it changes with the
library and not with the runtime. Pass your own entries to :func:`country_lookup` to use
another one.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import cache
from importlib.resources import files

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

# Common spellings that are neither ISO names nor codes.
COUNTRY_ALIASES = {
    "UK": "United Kingdom",
    "U.K.": "United Kingdom",
    "U.S.A.": "United States",
    "U.S.A": "United States",
    "USA": "United States",
    "EEUU": "United States",
    "US": "United States",
}

@cache
def iso_variants() -> dict[str, str]:
    """Every name, official name and code of the catalogue, with its standard name."""
    lines = files("silverline.sources").joinpath("iso3166.tsv").read_text("utf-8").splitlines()
    variants = {}
    for alpha_2, alpha_3, name, official in (line.split("\t") for line in lines[1:]):
        variants |= {spelling: name for spelling in (name, alpha_2, alpha_3, official) if spelling}
    return variants


def country_names() -> list[str]:
    """The standard names, sorted."""
    return sorted(set(iso_variants().values()))


def country_lookup(
    spark: SparkSession,
    entries: Iterable[tuple[str, str]] | None = None,
    aliases: Mapping[str, str] = COUNTRY_ALIASES,
) -> DataFrame:
    """Lookup table (lookup_variant, lookup_standard), one row per upper-cased variant.

    ``entries`` are (variant, standard name) pairs; the ISO catalogue when left out.
    Aliases win over entries. The table is a local relation of known size, so Spark
    itself checks it against its broadcast threshold.
    """
    pairs = list(entries) if entries is not None else list(iso_variants().items())
    unique = {variant.strip().upper(): standard for variant, standard in [*pairs, *aliases.items()]}
    return spark.createDataFrame(
        pa.table(
            {
                "lookup_variant": pa.array(unique.keys(), pa.string()),
                "lookup_standard": pa.array(unique.values(), pa.string()),
            }
        )
    )
