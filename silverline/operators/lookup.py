"""Normalising a column against a reference table, and suggestions for misses."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import combinations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from silverline.functions.text import UNKNOWN, is_blank, match_key

# Fixed value: the mark of values no lookup knows.
REVIEW = "REVISAR_MANUAL"


def normalized(raw: Column, standard: Column) -> Column:
    """Blank to the sentinel, a hit to its standard name, a miss to the review mark."""
    return F.when(is_blank(raw), F.lit(UNKNOWN)).otherwise(F.coalesce(standard, F.lit(REVIEW)))


def lookup_table(
    entries: DataFrame, variant: str = "variant", standard: str = "standard", priority: str | None = None
) -> DataFrame:
    """One row per upper-cased, trimmed variant: the lookup side of the join.

    Of several standards for one variant the one with the highest priority stays, the
    first in alphabetical order among equals. Unique variants keep the join from adding
    rows. The aggregation is partial before the shuffle.
    """
    rank = F.col(priority) if priority else F.lit(0)
    return (
        entries.filter(~is_blank(F.col(variant)) & F.col(standard).isNotNull())
        .groupBy(match_key(F.col(variant), "upper").alias("lookup_variant"))
        .agg(F.min(F.struct((-rank).alias("rank"), F.col(standard).alias("name")))["name"].alias("lookup_standard"))
    )


def join_lookup(df: DataFrame, column_name: str, lookup: DataFrame) -> DataFrame:
    """Left join on the upper-cased, trimmed value, adding ``lookup_standard``.

    No broadcast hint: a lookup whose size Spark knows to be small is broadcast when
    the plan is made, any other one when its measured size allows it, and a large one
    is joined by sort-merge with skewed keys split by adaptive execution.
    """
    key = match_key(F.col(column_name), "upper")
    return df.join(lookup, key == F.col("lookup_variant"), "left").drop("lookup_variant")


def normalize_by_reference(
    df: DataFrame, column_name: str, lookup: DataFrame, output: str | None = None
) -> DataFrame:
    """Add ``{column}_clean`` from a table made by :func:`lookup_table`."""
    output = output or f"{column_name}_clean"
    joined = join_lookup(df, column_name, lookup)
    return joined.withColumn(output, normalized(F.col(column_name), F.col("lookup_standard"))).drop(
        "lookup_standard"
    )


def suggest_for_unmatched(
    df: DataFrame,
    column_name: str,
    catalogue: DataFrame | Sequence[str],
    max_distance: int = 3,
    clean_name: str | None = None,
) -> DataFrame:
    """Nearest catalogue name per distinct value that was marked for review.

    Equal values are merged first, so each is looked up once however often it occurs.
    ``catalogue`` is a table with a column ``name``, of any size, or a list of names.
    Result: raw value, its row count, suggestion and edit distance, both NULL when no
    name is within ``max_distance``; ties go to the first name in alphabetical order.
    """
    if not isinstance(catalogue, DataFrame):
        catalogue = df.sparkSession.createDataFrame(pa.table({"name": pa.array(sorted(set(catalogue)), pa.string())}))
    clean_name = clean_name or f"{column_name}_clean"
    misses = df.filter(F.col(clean_name) == REVIEW).groupBy(column_name).agg(F.count(F.lit(1)).alias("n_rows"))
    value = match_key(F.col(column_name), "upper")
    sought = misses.select(value.alias("value_")).distinct()
    names = catalogue.select("name", F.upper("name").alias("key_")).distinct()
    short = F.length("key_") <= max_distance
    pairs = _near_pairs(sought, names.where(~short), max_distance).unionByName(_nearest_short(sought, names.where(short), max_distance))
    best = pairs.groupBy("value_").agg(F.min(F.struct("distance", "name")).alias("best"))
    found = misses.join(best, value == F.col("value_"), "left")
    return found.select(
        column_name, "n_rows", F.col("best.name").alias("suggestion"), F.col("best.distance").alias("distance")
    )


def _near_pairs(sought: DataFrame, names: DataFrame, most: int) -> DataFrame:
    """Rows (value_, name, distance) of all pairs within ``most`` edits.

    A name cut into ``most + 1`` pieces keeps at least one of them whole under ``most``
    edits, moved by at most ``most`` places. So only pairs that share a piece, at a name
    length that fits, are compared: an equi-join, whatever the size of the catalogue. Names
    must be longer than ``most``, so that no piece is empty.
    """
    pieces = F.sequence(F.lit(0), F.lit(most))

    def border(length: Column, number: Column) -> Column:
        return F.floor(length * number / (most + 1)).cast("int")

    length = F.length("key_")
    of_names = names.withColumn("length_", length).withColumn("piece_", F.explode(pieces))
    first, after = border(F.col("length_"), F.col("piece_")), border(F.col("length_"), F.col("piece_") + 1)
    of_names = of_names.withColumn("text_", F.substring("key_", first + 1, after - first))

    size = F.length("value_")
    lengths = F.sequence(F.greatest(size - most, F.lit(0)), size + most)
    of_values = sought.withColumn("length_", F.explode(lengths)).withColumn("piece_", F.explode(pieces))
    of_values = of_values.withColumn("moved_", F.explode(F.sequence(F.lit(-most), F.lit(most))))
    of_values = of_values.withColumn("at_", first + F.col("moved_")).withColumn("wide_", after - first)
    of_values = of_values.where((F.col("at_") >= 0) & (F.col("at_") + F.col("wide_") <= size))
    of_values = of_values.withColumn("text_", F.substring("value_", F.col("at_") + 1, F.col("wide_")))
    keys = ["length_", "piece_", "text_"]
    shared = of_values.select("value_", *keys).distinct().join(of_names.select("name", "key_", *keys), keys)
    distance = F.levenshtein("value_", "key_", most)
    compared = shared.select("value_", "name", "key_").distinct().select("value_", "name", distance.alias("distance"))
    return compared.where("distance >= 0")


def alignments(length: int, of_name: int, most: int) -> Iterator[tuple[tuple[int, ...], tuple[int, ...], int]]:
    """The ways to keep letters of a value in a name: their places, how many letters the name has around them, and the edits.

    Between two letters that are kept, a letters of the value become b of the name by max(a, b) edits.
    """
    for kept in range(min(length, of_name) + 1):
        for bars in combinations(range(of_name), kept):
            gaps = tuple(b - a - 1 for a, b in zip((-1, *bars), (*bars, of_name), strict=True))
            for places in combinations(range(length), kept):
                own = (b - a - 1 for a, b in zip((-1, *places), (*places, length), strict=True))
                if (edits := sum(map(max, gaps, own))) <= most:
                    yield tuple(p + 1 for p in places), gaps, edits


def _subsets(length: int) -> Iterator[tuple[tuple[int, ...], tuple[int, ...]]]:
    """The places of every choice of letters of a name, and how many letters stand around them."""
    for kept in range(length + 1):
        for bars in combinations(range(length), kept):
            yield tuple(b + 1 for b in bars), tuple(b - a - 1 for a, b in zip((-1, *bars), (*bars, length), strict=True))


def _alignment_keys(df: DataFrame, column: str, ways: list[tuple[int, tuple[int, ...], tuple[int, ...], int]]) -> DataFrame:
    """Add ``way_``, the letters kept with the gaps of the name around them, and ``edits_``, for every way of a text's length."""
    schema = "length_ int, places_ array<int>, gaps_ array<int>, edits_ int"
    table = df.sparkSession.createDataFrame([(n, list(places), list(gaps), edits) for n, places, gaps, edits in ways], schema)
    joined = df.withColumn("length_", F.length(column)).join(table, "length_")
    gap = lambda n: F.lpad(F.col("gaps_")[n].cast("string"), 2, "0")
    letters = F.transform("places_", lambda place, n: F.concat(gap(n), F.substring(F.col(column), place, F.lit(1))))
    return joined.withColumn("way_", F.concat(F.array_join(letters, ""), gap(F.size("places_"))))


def _nearest_short(sought: DataFrame, names: DataFrame, most: int) -> DataFrame:
    """Rows (value_, name, distance) that hold the nearest, then first name of each value among names of up to ``most`` letters.

    Any two such names are within ``most`` edits, so pairs would be all pairs. Of the names that keep the same letters
    with the same gaps only the first can be an answer: for any value it takes no more edits than the others. So the
    names become one row for each such way, and a value meets as many as there are ways for its length, however many
    names there are.
    """
    own = [(n, places, gaps, 0) for n in range(most + 1) for places, gaps in _subsets(n)]
    first = _alignment_keys(names, "key_", own).groupBy("way_").agg(F.min("name").alias("name"))
    ways = [(n, *way) for n in range(2 * most + 1) for m in range(most + 1) for way in alignments(n, m, most)]
    asked = _alignment_keys(sought, "value_", ways).groupBy("value_", "way_").agg(F.min("edits_").alias("edits_"))
    found = asked.join(first, "way_")
    best = found.groupBy("value_").agg(F.min(F.struct(F.col("edits_").alias("distance"), "name")).alias("best_"))
    return best.select("value_", "best_.name", "best_.distance")


def known_places(
    df: DataFrame,
    city: str = "city_clean",
    country: str = "country_clean",
    least_rows: int = 3,
    least_share: float = 0.1,
    unknown: Sequence[str] = (UNKNOWN, REVIEW),
) -> DataFrame:
    """The countries each city lies in by the table itself: a ``city`` and ``country`` table for :func:`geo_mismatch`.

    A country counts with at least ``least_rows`` rows and ``least_share`` of the city's. Pairs
    are counted before they are compared, so a city that holds a third of all rows sends one
    row per country and map task.
    """
    judged = df.filter(~F.col(country).isin(*unknown) & ~F.col(city).isin(*unknown))
    counts = judged.groupBy(match_key(F.col(city), "upper").alias("city"), F.col(country).alias("country")).agg(F.count(F.lit(1)).alias("n_rows"))
    of_city = F.sum("n_rows").over(Window.partitionBy("city"))
    kept = counts.withColumn("of_city", of_city).where((F.col("n_rows") >= least_rows) & (F.col("n_rows") >= F.lit(least_share) * F.col("of_city")))
    return kept.select("city", "country")


def geo_mismatch(
    df: DataFrame,
    cities: DataFrame,
    city: str = "city_clean",
    country: str = "country_clean",
    unknown: Sequence[str] = (UNKNOWN, REVIEW),
) -> DataFrame:
    """Rows whose country is not one the city is known in, with the expected ones.

    ``cities`` has columns ``city`` and ``country``; a city may be known in several
    countries. Unknown cities and unresolved countries are not judged and take no part
    in the join.
    """
    known = cities.groupBy(match_key(F.col("city"), "upper").alias("lookup_city")).agg(
        F.sort_array(F.collect_set("country")).alias("expected_countries")
    )
    judged = df.filter(~F.col(country).isin(*unknown) & ~F.col(city).isin(*unknown))
    return (
        judged.join(known, match_key(F.col(city), "upper") == F.col("lookup_city"), "inner")
        .filter(~F.array_contains("expected_countries", F.col(country)))
        .drop("lookup_city")
    )
