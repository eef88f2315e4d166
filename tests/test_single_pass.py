"""Steps that every cleaned table goes through: raw rows computed in place, dates by casts, characters by translation."""

from __future__ import annotations

import os
import random

from pyspark.sql import functions as F

from silverline.functions import dates, text
from workload.bronze import bronze, computed
from workload.entity_queries import ENTITIES, silver


def test_cleaning_writes_no_raw_table_first(spark, sf_dir):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    for entity in ENTITIES:
        assert silver(spark, sf_dir, entity).count()
    assert set(os.listdir(root)) == before


def test_computed_rows_are_the_stored_ones(spark, sf_dir):
    for entity in ("shipping", "customers", "products"):
        stored, rows = bronze(spark, sf_dir, entity), computed(spark, sf_dir, entity)
        assert rows.dtypes == stored.dtypes
        assert rows.exceptAll(stored).isEmpty() and stored.exceptAll(rows).isEmpty()


def test_filters_get_no_copy_of_how_raw_columns_are_made(spark, sf_dir):
    failed = silver(spark, sf_dir, "payments").where("paid_at IS NOT NULL AND paid_at_clean IS NULL")
    plan = failed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("bad-date") == 3  # one for each date column


def test_casts_read_dates_as_formatters_do(spark):
    draw = random.Random(5)
    values = ["0000-01-01", "00010101", "2024-02-30", "30.02.2024", "12024-01-05", "+12024-01-05", "-2024-01-05", "2024-01-05\n", "2024-01-05 ",
              "2024-01-05t10:00:00", "2024-01-05T10:00:00.123z", "2024-01-05 24:00:00", "2024-01-05 10:00:00.1", "2024-01-05 10:00:00.12345",
              "MAY 5, 2024", "may 05, 2024", "Sept 5, 2024", "Sep 5, 2024", "ſep 5, 2024", "5 June 2024", "5 JUN 2024", "0005/1/2024", "١٠/01/2024"]
    for _ in range(400):
        moment = f"timestampadd(SECOND, {draw.randrange(-10**10, 10**10)}, TIMESTAMP_NTZ'1995-01-01 00:00:00')"
        values.append(f"={draw.choice(dates.KNOWN_DATE_FORMATS)}={moment}")
    made = [v.split("=", 2)[1:] for v in values if v.startswith("=")]
    spelled = spark.range(1).select(*[F.expr(f"date_format({m}, '{f.replace(chr(39), chr(92) + chr(39))}')") for f, m in made]).first()
    df = spark.createDataFrame([(v,) for v in values if not v.startswith("=")] + [(v,) for v in spelled], "v string")
    plain = F.coalesce(*[F.try_to_date("v", f) for f in dates.KNOWN_DATE_FORMATS])
    timed = F.coalesce(*[F.try_to_timestamp("v", F.lit(f)) for f in dates.KNOWN_DATE_FORMATS])
    differing = df.where(~dates.parse_date("v").eqNullSafe(plain) | ~dates.parse_timestamp("v").eqNullSafe(timed))
    assert [r.v for r in differing.collect()] == []
    of_casts = df.select(dates.parse_date("v").alias("d"))._jdf.queryExecution().analyzed().toString()
    assert of_casts.count("octet_length(v") == 22 + sum(1 for f in dates.KNOWN_DATE_FORMATS if dates._cast_sql("v", f, "try_to_date")) > 22


def test_codes_and_spaces_are_cleaned_as_by_regular_expressions(spark):
    draw = random.Random(6)
    signs = [*map(chr, range(1, 0x180)), " ", " ", "ﬁ", "\U0001f600", " ", " ", "\t", "\n", "a", "Z", "-"]
    df = spark.createDataFrame([("".join(draw.choices(signs, k=draw.randint(0, 12))),) for _ in range(3000)] + [(s,) for s in signs] + [(None,)], "v string")
    v = F.col("v")
    checks = [text.strip_and_normalize_spaces(v).eqNullSafe(F.trim(F.regexp_replace(v, r"\s+", " ")))]
    for keep in ("-", "", "_/ ", "é"):
        pattern = f"[^{text.kept_class(keep, keep_digits=True, spaces=False)}]"
        checks.append(text.clean_code(v, keep).eqNullSafe(text.normalize_to_null(F.upper(F.regexp_replace(v, pattern, "")))))
    assert set(df.agg(*[F.count_if(~same) for same in checks]).first()) == {0}
    plan = df.select(text.clean_code(v))._jdf.queryExecution().optimizedPlan().toString()
    assert "translate(" in plan
