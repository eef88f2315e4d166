import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.functions import casts
from silverline.operators import columns


def test_int(evaluate):
    values = ["42", "0", "-5", " 42 ", "abc", "19.99", "", None, "99999999999"]
    assert evaluate(values, casts.to_int) == [42, 0, -5, 42, None, None, None, None, None]
    assert evaluate(["abc", "7"], lambda c: casts.to_int(c, 0)) == [0, 7]


def test_long(evaluate):
    assert evaluate(["99999999999", "x"], casts.to_long) == [99999999999, None]


def test_double(evaluate):
    assert evaluate(["19.99", "1,299", "abc", "1e3", None], casts.to_double) == [19.99, None, None, 1000.0, None]


def test_double_of_typed_columns(evaluate):
    assert evaluate([1.5e10, None], casts.to_double, "double") == [1.5e10, None]
    assert evaluate([7], casts.to_double, "int") == [7.0]


_numbers = st.text(alphabet="0123456789.eE+-dDfFxXpPnaNIinityb, \t_", max_size=9)
_ODD = ["1", "1.5", " 2 ", "\t3\n", "-4.", "+.5", "1e3", "5d", "6D", "NaN", "+nan", "inf", "-INF", "+infinity", "0x1p3",
        "0x1.8p1d", "abc", "1,299", "", "  ", ".", "e5", "--1", "1 2", "١", "1_000", None, "1e400", "\u00a01", "5L",
        "+7", "- 7", "\x0b8\x7f", "00012", "2147483648", "-2147483648", "9223372036854775808", "1.", "٣"]


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(_numbers, min_size=30, max_size=90))
def test_shapes_never_change_a_cast(evaluate, values):
    for cast in (casts.to_int, casts.to_long, casts.to_double):
        quick = evaluate(values + _ODD, lambda c, cast=cast: cast(c, from_text=True))
        assert repr(quick) == repr(evaluate(values + _ODD, cast))


def test_typed_columns_keep_their_own_casts(spark):
    df = spark.createDataFrame([(19.99, 7, True)], "a double, b int, c boolean")
    out = columns.cast_schema(df, {"a": "int", "b": "double", "c": "bool"})
    assert tuple(out.first()) == (19, 7.0, True)


def test_bool(evaluate):
    true, false = ["1", "TRUE", "yes", "t", "Y", "si", " s "], ["0", "FALSE", "no", "f", "n"]
    assert evaluate(true + false, casts.to_bool) == [True] * len(true) + [False] * len(false)
    assert evaluate([None, "maybe"], casts.to_bool) == [False, False]
    assert evaluate([None, "maybe", "no"], lambda c: casts.to_bool(c, default=True)) == [True, True, False]
    assert evaluate([True, None], casts.to_bool, "boolean") == [True, False]


def test_null_tokens(evaluate):
    stock = lambda c: casts.to_int(casts.null_tokens(c, "unlimited"))
    assert evaluate([" Unlimited ", "12", None], stock) == [None, 12, None]


def test_cast_schema(spark):
    df = spark.createDataFrame([("1", "2.5", "si", "2024-01-05", "9")], "a string, b string, c string, d string, e string")
    types = {"a": "int", "b": "double", "c": "bool", "d": "date", "e": "long"}
    assert dict(columns.cast_schema(df, types).dtypes) == {
        "a": "int",
        "b": "double",
        "c": "boolean",
        "d": "date",
        "e": "bigint",
    }


def test_cast_schema_skips_missing_and_refuses_unknown(spark):
    df = spark.createDataFrame([("1",)], "a string")
    with pytest.warns(columns.MissingColumnWarning, match="zip"):
        assert columns.cast_schema(df, {"a": "int", "zip": "int"}).columns == ["a"]
    with pytest.raises(ValueError, match="decimal"):
        columns.cast_schema(df, {"a": "decimal"})


def test_cast_flags(spark):
    rows = [("1", "x", "maybe"), (None, "", None), ("b", "2", "no")]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    flagged = columns.cast_failure_flags(df, {"a": "int", "b": "double", "c": "bool"})
    found = flagged.select(*[f"{c}_cast_failed" for c in "abc"]).collect()
    assert [tuple(r) for r in found] == [(False, True, True), (False, False, False), (True, False, False)]


def test_single_column_casts(spark):
    df = spark.createDataFrame([("5", "x", "2024-01-05", "y", "1.5")], "a string, b string, c string, d string, e string")
    out = columns.safe_cast_int(df, "a")
    out = columns.safe_cast_int(out, "b", null_replacement=0)
    out = columns.safe_cast_date(out, "c")
    out = columns.safe_cast_bool(out, "d")
    out = columns.safe_cast_double(out, "e")
    row = columns.safe_cast_long(out, "a").withColumn("c", F.col("c").cast("string")).first()
    assert tuple(row) == (5, 0, "2024-01-05", True, 1.5)
