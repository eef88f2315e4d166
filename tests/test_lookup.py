import random

import pytest

from silverline.operators import lookup
from silverline.plans.transformation import normalize_country
from silverline.sources import countries


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        previous, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            previous, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, previous + (x != y))
    return row[-1]


def clean(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id int, country string")
    return [r.country_clean for r in normalize_country(df, spark).orderBy("id").collect()]


def test_country_names_codes_and_aliases(spark):
    germany = ["germany", " GERMANY ", "DE", "DEU", "Federal Republic of Germany"]
    britain, america = ["UK", "U.K.", "gb"], ["USA", "U.S.A.", "u.s.a", "EEUU", "us", "United States of America"]
    got = clean(spark, germany + britain + america)
    assert got == ["Germany"] * 5 + ["United Kingdom"] * 3 + ["United States"] * 6


def test_iso_spellings(spark):
    pairs = {
        "KR": "Korea, Republic of",
        "Islamic Republic of Iran": "Iran, Islamic Republic of",
        "CIV": "Côte d'Ivoire",
        "lc": "Saint Lucia",
        "BA": "Bosnia and Herzegovina",
        "Hellenic Republic": "Greece",
        "vn": "Viet Nam",
        "Republic of the Philippines": "Philippines",
    }
    assert clean(spark, list(pairs)) == list(pairs.values())


def test_blank_and_unrecognised(spark):
    assert clean(spark, [None, "", "  ", "Atlantis", "South Korea"]) == ["UNKNOWN"] * 3 + ["REVISAR_MANUAL"] * 2


def test_catalogue_has_every_country_once(spark):
    table = countries.country_lookup(spark)
    assert len(countries.country_names()) == 249
    assert table.count() == table.select("lookup_variant").distinct().count()


def test_own_catalogue(spark):
    table = countries.country_lookup(spark, [("Fr", "Frankreich")], aliases={"gallia": "Frankreich"})
    df = spark.createDataFrame([("FR",), ("Gallia",), ("de",)], "c string")
    got = {r.c: r.c_clean for r in lookup.normalize_by_reference(df, "c", table).collect()}
    assert got == {"FR": "Frankreich", "Gallia": "Frankreich", "de": "REVISAR_MANUAL"}


def test_lookup_variants_are_unique(spark):
    entries = spark.createDataFrame(
        [("a", "X", 0), (" A ", "Y", 5), ("b", "Z", 0), ("B", "W", 0), (None, "Q", 0), ("", "Q", 0)],
        "variant string, standard string, rank int",
    )
    got = {r.lookup_variant: r.lookup_standard for r in lookup.lookup_table(entries, priority="rank").collect()}
    assert got == {"A": "Y", "B": "W"}


def test_lookup_join_is_broadcast_and_keeps_rows(spark, sf_dir):
    lineitem = spark.read.parquet(f"{sf_dir}/lineitem.parquet").withColumnRenamed("l_returnflag", "country")
    out = normalize_country(lineitem, spark)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    assert out.count() == lineitem.count()


def test_suggestions(spark):
    values = ["Germny", "Germny", "FRANEC", "XQZ", "Spain"]
    df = spark.createDataFrame([(v, "Spain" if v == "Spain" else "REVISAR_MANUAL") for v in values], "c string, c_clean string")
    got = lookup.suggest_for_unmatched(df, "c", ["Germany", "France", "Spain"], max_distance=2).collect()
    assert {r.c: (r.n_rows, r.suggestion, r.distance) for r in got} == {
        "Germny": (2, "Germany", 1),
        "FRANEC": (1, "France", 2),
        "XQZ": (1, None, None),
    }
    plan = lookup.suggest_for_unmatched(df, "c", ["Germany"])._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_suggestions_agree_with_brute_force(spark):
    names = countries.country_names()
    misses = [n[1:] for n in names[::7]] + [n + "x" for n in names[::11]] + ["zz"]
    df = spark.createDataFrame([(m, "REVISAR_MANUAL") for m in misses], "c string, c_clean string")
    got = {r.c: r.suggestion for r in lookup.suggest_for_unmatched(df, "c", names, max_distance=3).collect()}

    for miss in misses:
        best = min((distance(miss.strip().upper(), n.upper()), n) for n in names)
        assert got[miss] == (best[1] if best[0] <= 3 else None)


def test_suggestions_from_short_long_and_many_names(spark):
    df = spark.createDataFrame([("a", "REVISAR_MANUAL"), ("", "REVISAR_MANUAL"), ("name 7x41", "REVISAR_MANUAL")], "c string, c_clean string")
    assert {r.suggestion for r in lookup.suggest_for_unmatched(df, "c", []).collect()} == {None}
    got = {r.c: (r.suggestion, r.distance) for r in lookup.suggest_for_unmatched(df, "c", ["", "ab", "abcd"]).collect()}
    assert got == {"a": ("", 1), "": ("", 0), "name 7x41": (None, None)}
    many = spark.range(20_000).selectExpr("concat('Name ', id) AS name")
    got = {r.c: (r.suggestion, r.distance) for r in lookup.suggest_for_unmatched(df, "c", many, max_distance=2).collect()}
    assert got["name 7x41"] == ("Name 7041", 1) and got["a"] == (None, None)


def test_suggestions_equal_all_pairs_on_random_words(spark):
    draw = random.Random(6)
    word = lambda: "".join(draw.choices("abé", k=draw.randint(0, 9)))
    names, values = sorted({word() for _ in range(60)}), sorted({word() for _ in range(80)})
    df = spark.createDataFrame([(v, "REVISAR_MANUAL") for v in values], "c string, c_clean string")
    for most in (0, 1, 2, 3):
        got = {r.c: (r.suggestion, r.distance) for r in lookup.suggest_for_unmatched(df, "c", names, max_distance=most).collect()}
        for v in values:
            best = min((distance(v.upper(), n.upper()), n) for n in names)
            assert got[v] == ((best[1], best[0]) if best[0] <= most else (None, None))


def test_geo_mismatch(spark):
    rows = [(1, "Paris", "Germany"), (2, "Paris", "France"), (3, "Nowhere", "Germany"), (4, "Paris", "UNKNOWN"), (5, "UNKNOWN", "Germany")]
    df = spark.createDataFrame(rows, "id int, city_clean string, country_clean string")
    cities = spark.createDataFrame([("paris", "France"), ("Paris", "United States"), ("Unknown", "Peru")], "city string, country string")
    got = lookup.geo_mismatch(df, cities).collect()
    assert [(r.id, r.expected_countries) for r in got] == [(1, ["France", "United States"])]


@pytest.mark.parametrize("most", [0, 1, 2, 3, 4])
def test_short_names_equal_all_pairs(spark, most):
    draw = random.Random(most)
    word = lambda n: "".join(draw.choices("abcé1", k=draw.randint(0, n)))
    names, values = sorted({word(most + 1) for _ in range(40)}), sorted({word(2 * most + 1) for _ in range(120)})
    df = spark.createDataFrame([(v, "REVISAR_MANUAL") for v in values], "c string, c_clean string")
    got = {r.c: (r.suggestion, r.distance) for r in lookup.suggest_for_unmatched(df, "c", names, max_distance=most).collect()}
    for value in values:
        best = min((distance(value.upper(), n.upper()), n) for n in names)
        assert got[value] == ((best[1], best[0]) if best[0] <= most else (None, None)), value


def test_short_names_are_not_compared_in_pairs(spark):
    """All names of two or three letters against as many values: a value meets no more rows than there are ways for its length."""
    letters = "abcdefghijklmnopqrstuvwxyz"[:11]
    words = [a + b for a in letters for b in letters] + [a + b + c for a in letters for b in letters for c in letters]
    names = spark.createDataFrame([(w, w.upper()) for w in words], "name string, key_ string")
    values = spark.createDataFrame([(w.upper()[::-1] + "Z",) for w in words], "value_ string")
    best = lookup._nearest_short(values, names, 3)
    rows = sorted((r.value_, r.name, r.distance) for r in best.collect())
    assert len(rows) == len(words)
    ways = max(sum(1 for m in range(4) for _ in lookup.alignments(n, m, 3)) for n in range(7))
    assert ways < 150 and len(words) > 10 * ways
    met = lookup._alignment_keys(values, "value_", [(n, *w) for n in range(7) for m in range(4) for w in lookup.alignments(n, m, 3)])
    assert met.count() <= ways * len(words)
    for value, name, edits in rows[:: len(rows) // 20]:
        assert (edits, name) == min((distance(value, w.upper()), w) for w in words)


def test_places_known_from_the_table(spark):
    rows = [("Lima", "Peru")] * 8 + [("lima ", "United States")] * 3 + [("Lima", "Chile")] + [("Rome", "Italy")] * 2 + [("Lima", "UNKNOWN")] * 5
    df = spark.createDataFrame(rows, "city_clean string, country_clean string")
    assert sorted(map(tuple, lookup.known_places(df).collect())) == [("LIMA", "Peru"), ("LIMA", "United States")]
    found = lookup.geo_mismatch(df, lookup.known_places(df)).collect()
    assert [(r.city_clean, r.country_clean, r.expected_countries) for r in found] == [("Lima", "Chile", ["Peru", "United States"])]
