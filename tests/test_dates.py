import datetime
import random

import pytest
from hypothesis import HealthCheck, Phase, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from silverline.functions import dates
from silverline.operators import columns

JAN5 = [
    "2024-01-05",
    "2024-01-05 14:30:00",
    "2024-01-05T14:30:00",
    "2024-01-05 14:30:00.123",
    "2024-01-05T14:30:00.000Z",
    "2024/01/05",
    "2024.01.05",
    "20240105",
    "January 5, 2024",
    "Jan 5, 2024",
    "5 Jan 2024",
    "5 January 2024",
    "01/05/2024",
]
XMAS = ["25/12/2024", "12/25/2024", "25-12-2024", "12-25-2024", "25.12.2024", "12.25.2024"]
NOT_DATES = [
    "bad-date",
    "",
    None,
    "2024-1-5",
    "5 ene 2024",
    "2024-02-30",
    "2024-01-05T14:30:00Z",
    "2024-01-05T14:30:00.123456",
    " 2024-01-05 ",
]
DISPUTED = [("01-05-2024", "2024-01-05", "2024-05-01"), ("01.05.2024", "2024-05-01", "2024-01-05"),
            ("5/1/2024", "2024-01-05", "2024-05-01"), ("05/01/2024 14:30:00", "2024-01-05", "2024-05-01")]
ODD = ["+12024-01-05", "2024-01-05t14:30:00", "JANUARY 5, 2024", "005/001/2024", "+120240105", "0/1/2024", "31/11/2024",
       "May 5, 2024", "5 may 2024", "2024-01-05 24:00:00", "2024-01-05 14:30:00.1", "-2024-01-05", "12024-01-05",
       "2024-01-05T14:30:00.000z", "1/1/24", "2024/1/1", "29/02/2023", "29/02/2024", "2024-01-05\n", "٢٠٢٤-٠١-٠٥"]


def unguarded(formats):
    return lambda c: F.coalesce(*[F.try_to_date(c, f) for f in formats])


def test_known_formats(evaluate):
    got = evaluate(JAN5 + XMAS + NOT_DATES, dates.parse_date)
    expected = [datetime.date(2024, 1, 5)] * len(JAN5) + [datetime.date(2024, 12, 25)] * len(XMAS)
    assert got == expected + [None] * len(NOT_DATES)


def test_priority(evaluate):
    values = [raw for raw, _, _ in DISPUTED]
    assert [str(d) for d in evaluate(values, dates.parse_date)] == [first for _, first, _ in DISPUTED]
    last = evaluate(values, lambda c: dates.parse_date(c, precedence="last"))
    assert [str(d) for d in last] == [expected for _, _, expected in DISPUTED]
    with pytest.raises(ValueError, match="precedence"):
        dates.parse_date("v", precedence="middle")


def test_given_format(evaluate):
    assert evaluate(["05/01/2024", "2024-01-05"], lambda c: dates.parse_date(c, "dd/MM/yyyy")) == [
        datetime.date(2024, 1, 5),
        None,
    ]


@pytest.mark.parametrize("precedence", ["first", "last"])
def test_shape_tests_never_change_a_result(evaluate, precedence):
    values = [*JAN5, *XMAS, *NOT_DATES, *[raw for raw, _, _ in DISPUTED], *ODD]
    ordered = dates.KNOWN_DATE_FORMATS if precedence == "first" else dates.KNOWN_DATE_FORMATS[::-1]
    as_text = lambda function: evaluate(values, lambda c: function(c).cast("string"))
    assert as_text(lambda c: dates.parse_date(c, precedence=precedence)) == as_text(unguarded(ordered))


def test_named_column_and_column_object_agree(evaluate):
    values = [*JAN5, *XMAS, *NOT_DATES, *[raw for raw, _, _ in DISPUTED], *ODD]
    for parse in (dates.parse_date, dates.parse_timestamp, dates.format_date_to_iso):
        by_name = evaluate(values, lambda c, parse=parse: parse("v").cast("string"))
        assert by_name == evaluate(values, lambda c, parse=parse: parse(c).cast("string"))


_datelike = st.text(alphabet="0123456789/-. :TZJanFebMy,+", max_size=24)


@settings(max_examples=6, deadline=None, phases=[Phase.generate], suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), _datelike, st.dates().map(str)), min_size=1, max_size=50))
def test_any_text_parses_as_without_shapes(evaluate, values):
    as_text = lambda function: evaluate(values, lambda c: function(c).cast("string"))
    assert as_text(dates.parse_date) == as_text(unguarded(dates.KNOWN_DATE_FORMATS))


def test_formats_with_unknown_fields_are_tried_in_order(evaluate):
    parse = lambda c: dates.parse_date(c, formats=["dd-MM-yy", "yyyy/MM/dd"])
    assert [str(d) for d in evaluate(["05-01-24", "2024/01/05"], parse)] == ["2024-01-05", "2024-01-05"]


def test_timestamp_keeps_time(evaluate):
    got = evaluate(["2024-01-05 14:30:00", "05/01/2024", "x"], lambda c: dates.parse_timestamp(c).cast("string"))
    assert got == ["2024-01-05 14:30:00", "2024-05-01 00:00:00", None]


def test_iso_text(evaluate):
    values = ["01/05/2024", "5 ene 2024", "2024-01-05T14:30:00"]
    assert evaluate(values, dates.format_date_to_iso) == ["2024-01-05", None, "2024-01-05"]


def test_clean_date_columns_skips_missing(spark):
    df = spark.createDataFrame([("2024-01-05",)], "a string")
    with pytest.warns(columns.MissingColumnWarning, match="b") as caught:
        out = columns.clean_date_columns(df, ["a", "b"])
    assert caught[0].message.columns == ["b"]
    assert out.dtypes == [("a", "string"), ("a_clean", "date")]


def test_audit_columns(spark):
    df = spark.createDataFrame([(1, "2020-01-01")], "id int, ingestion_date string")
    out = columns.add_audit_timestamps(df)
    assert out.dtypes == [
        ("id", "int"),
        ("bronze_ingestion_date", "string"),
        ("ingestion_timestamp", "timestamp"),
        ("ingestion_date", "date"),
    ]
    row = out.first()
    assert row["bronze_ingestion_date"] == "2020-01-01"
    assert spark.conf.get("spark.sql.session.timeZone") == "UTC"
    assert columns.add_audit_timestamps(df.select("id"), "loaded_at").columns == ["id", "loaded_at", "ingestion_date"]


def test_plan_grows_linearly_with_formats(spark):
    df = spark.createDataFrame([("x",)], "v string")

    def size(n):
        plan = df.select(dates.parse_date("v", formats=dates.KNOWN_DATE_FORMATS[:n]).alias("d"))
        return plan._jdf.queryExecution().optimizedPlan().toString().count("gettimestamp")

    assert [size(5), size(10), size(22)] == [5, 10, 22]


@pytest.mark.parametrize("fmt", ["yyyy-MM-dd[ HH:mm:ss]", "yyyy['-']MM-dd", "yyyy-MM-dd''HH", "[yyyy/MM/dd][dd.MM.yyyy]"])
def test_shapes_never_change_a_result(spark, fmt):
    texts = ["2024-01-05", "2024-01-05 10:00:00", "2024-01-05'10", "202401-05", "2024/01/05", "05.01.2024", "x", "", None]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    plain = [r[0] for r in df.select(F.try_to_date("v", fmt)).collect()]
    assert any(plain)
    for other in ([fmt], [fmt, "MM/dd/yyyy"]):
        by_name = [r[0] for r in df.select(dates.parse_date("v", formats=other)).collect()]
        by_column = [r[0] for r in df.select(dates.parse_date(F.col("v"), formats=other)).collect()]
        assert by_name == by_column == plain


def test_shapes_of_generated_formats(spark):
    draw = random.Random(8)
    fields, glue = ["yyyy", "MM", "M", "dd", "d", "HH", "mm", "ss"], ["-", "/", ".", " ", ", ", "'T'", ":", "[ ", "] ", "''"]
    texts = ["2024-01-05", "2024/1/5", "05.01.2024 10:20:30", "2024-01-05T10:20", "1/5, 2024", "2024 01", "10:20:30", "2024'01'05", " 2024-01-05"]
    df = spark.createDataFrame([(t,) for t in texts], "v string")
    checks = []
    for _ in range(60):
        fmt = draw.choice(fields) + "".join(draw.choice(glue) + draw.choice(fields) for _ in range(draw.randint(1, 4)))
        try:
            df.select(F.try_to_timestamp("v", F.lit(fmt))).collect()
        except Exception:
            continue  # no format at all
        same = dates.parse_timestamp("v", formats=[fmt]).eqNullSafe(F.try_to_timestamp("v", F.lit(fmt)))
        checks.append(F.count_if(~same).alias(f"c{len(checks)}"))
    assert len(checks) > 10 and set(df.agg(*checks).first()) == {0}
