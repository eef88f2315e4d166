import pytest
from pyspark.sql.functions import lit
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from silverline.operators import integrity, quality
from silverline.operators.versions import latest_per_key, latest_raw


@pytest.fixture
def cleaned(spark):
    rows = [
        (1, "ann", "Ann", "2024-01-05", "2024-01-05"),
        (2, None, "UNKNOWN", "bad-date", None),
        (3, "Bob", "Bob", " ", None),
        (4, "xx", "REVISAR_MANUAL", None, None),
    ]
    df = spark.createDataFrame(rows, "id int, name string, name_clean string, at string, at_clean string")
    return df.withColumn("at_clean", df.at_clean.cast("date"))


def test_profiles(cleaned):
    assert quality.clean_pairs(cleaned) == [("name", "name_clean"), ("at", "at_clean")]
    assert quality.row_count(cleaned).first().n_rows == 4
    assert tuple(quality.null_profile(cleaned).first()) == (0, 1, 0, 1, 3)
    assert tuple(quality.change_profile(cleaned).first()) == (3, 2)
    assert tuple(quality.impact_summary(cleaned, "name").first()) == (4, 3, 75.0, 1, 25.0)
    assert quality.sentinel_count(cleaned, "name_clean").first().n_rows == 1
    assert tuple(quality.failed_date_counts(cleaned, ["at"]).first()) == (1,)


def test_impact_of_empty_table(cleaned):
    row = quality.impact_summary(cleaned.filter("id < 0"), "name").first()
    assert (row.total, row.changed_pct) == (0, None)


def test_report_agrees_with_profiles(cleaned):
    rows = {r.column: r.asDict() for r in quality.quality_report(cleaned).collect()}
    assert rows["name"] == {"column": "name", "total": 4, "raw_nulls": 1, "clean_nulls": 0, "changed": 3, "unknown": 1,
                            "review": 1, "failed_dates": 0}
    assert rows["at"] == {"column": "at", "total": 4, "raw_nulls": 1, "clean_nulls": 3, "changed": 2, "unknown": 0,
                          "review": 0, "failed_dates": 1}


def test_report_reads_once(cleaned):
    plan = quality.quality_report(cleaned)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") == 1 and plan.count("Exchange") == 1


def ids(df):
    return sorted(r.id for r in df.collect())


def test_row_filters(cleaned):
    assert ids(quality.changed_rows(cleaned, "name")) == [1, 2, 4]
    assert ids(quality.sentinel_rows(cleaned, "name_clean")) == [2]
    assert ids(quality.failed_dates(cleaned, "at")) == [2]
    assert ids(quality.residual_characters(cleaned, "name_clean")) == [4]
    assert ids(quality.sample(cleaned, 2)) == [1, 2]


def test_value_tables(cleaned):
    assert [tuple(r) for r in quality.distinct_mapping(cleaned, "name").collect()] == [
        (None, "UNKNOWN"), ("Bob", "Bob"), ("ann", "Ann"), ("xx", "REVISAR_MANUAL")]
    assert [tuple(r) for r in quality.frequency(cleaned, "at_clean").collect()][0][1] == 3
    assert quality.distinct_values(cleaned, "at_clean").count() == 2
    assert [tuple(r) for r in quality.review_queue(cleaned, "name").collect()] == [("xx", 1)]
    assert quality.before_after(cleaned, keys=["id"]).columns == [
        "id", "name_before", "name_after", "at_before", "at_after"]


def test_entity_summary_and_schema(spark, cleaned):
    summary = quality.entity_summary({"a": cleaned, "b": cleaned.withColumn("ingestion_date", cleaned.at_clean)})
    assert sorted(tuple(r) for r in summary.collect()) == [("a", 4, ""), ("b", 4, "ingestion_date")]
    report = quality.schema_report(cleaned.select("id", "at_clean")).collect()
    assert [tuple(r) for r in report] == [(0, "id", "int", 4), (1, "at_clean", "date", 1)]
    expected = StructType([StructField("id", StringType()), StructField("zip", IntegerType())])
    found = quality.schema_differences(cleaned.select("id", "at"), expected).collect()
    assert [tuple(r) for r in found] == [("id", "string", "int", 4), ("zip", "int", None, 0), ("at", None, "string", 3)]


def test_kept_for_reports(cleaned):
    kept = quality.keep_for_reports(cleaned)
    assert kept.storageLevel.useMemory and kept.storageLevel.useDisk and kept.count() == 4
    kept.unpersist()


def test_orphans(spark):
    child = spark.createDataFrame([(1, 10), (2, 11), (3, None), (4, 99), (5, 99)], "id int, fk int")
    parent = spark.createDataFrame([(10,), (11,)], "id int")
    assert ids(integrity.orphan_rows(child, "fk", parent)) == [4, 5]
    assert [tuple(r) for r in integrity.orphan_keys(child, "fk", parent).collect()] == [(99, 2)]


def test_self_orphans(spark):
    tree = spark.createDataFrame([(1, None), (2, 1), (3, 7)], "id int, parent_id int")
    assert ids(integrity.self_orphan_rows(tree)) == [3]


def test_duplicates(spark):
    df = spark.createDataFrame([("A",), ("A",), ("UNKNOWN",), ("UNKNOWN",), ("B",)], "code string")
    assert [tuple(r) for r in integrity.duplicate_keys(df, "code", ignore=["UNKNOWN"]).collect()] == [("A", 2)]
    assert integrity.duplicate_keys(df, "code").count() == 2


def test_rules(spark):
    rules = [
        integrity.Rule("positive", "a", "min", (0,)),
        integrity.Rule("small", "a", "between", (1, 5), "nullify"),
        integrity.Rule("cents", "b", "decimals", (2,), "round"),
        integrity.Rule("present", "a", "not_null"),
        integrity.Rule("elsewhere", "zip", "not_null"),
    ]
    df = spark.createDataFrame([(3, 1.25), (-1, 1.256), (9, None), (None, 2.0)], "a int, b double")
    got = [tuple(r) for r in integrity.apply_rules(df, rules).collect()]
    assert got == [
        (3, 1.25, False, False, False, False),
        (None, 1.26, True, True, True, False),
        (None, None, False, True, False, False),
        (None, 2.0, False, False, False, True),
    ]
    counts = {r.rule: (r.violations, r.total) for r in integrity.rule_violations(df, rules).collect()}
    assert counts == {"positive": (1, 4), "small": (2, 4), "cents": (1, 4), "present": (1, 4)}


@pytest.mark.parametrize("bad", [{"check": "like"}, {"check": "min", "policy": "drop"}, {"check": "min", "policy": "round"}])
def test_bad_rules(bad):
    with pytest.raises(ValueError):
        integrity.Rule("r", "c", **bad)


def test_latest_per_key(spark):
    rows = [
        (1, "2024-01-01", "2024-02-01", "r1", "old"),
        (1, "2024-03-01", "2024-02-01", "r1", "new"),
        (2, None, "2024-02-01", "r1", "undated"),
        (2, "2020-01-01", "2024-02-01", "r1", "dated"),
        (3, "2024-01-01", "2024-02-01", "r1", "first run"),
        (3, "2024-01-01", "2024-02-01", "r2", "second run"),
        (4, None, None, None, "only"),
    ]
    df = spark.createDataFrame(
        rows, "id int, updated_at_clean string, bronze_ingestion_date string, run_id string, note string")
    got = latest_per_key(df)
    assert got.columns == df.columns
    assert sorted(r.note for r in got.collect()) == ["dated", "new", "only", "second run"]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "partial_max" in plan and "Window" not in plan


def test_latest_per_key_with_one_hot_key(spark):
    hot = spark.range(0, 20000).selectExpr("IF(id % 3 = 0, -1, id) AS id", "id AS version", "id % 7 AS updated_at_clean")
    got = latest_per_key(hot, order=["updated_at_clean", "version"])
    assert got.count() == hot.select("id").distinct().count()
    newest = got.filter("id = -1").first()
    assert newest.updated_at_clean == 6 and newest.version == max(v for v in range(0, 20000, 3) if v % 7 == 6)


def test_latest_raw_uses_the_time_of_day(spark):
    rows = [
        (1, "2024-01-02 08:00:00", "r1", "morning"),
        (1, "02-01-2024", "r9", "february"),
        (2, "2024-01-02 08:00:00", "r1", "morning"),
        (2, "2024-01-02T20:00:00", "r1", "evening"),
        (3, "bad-date", "r1", "unread"),
        (3, "1999-01-01", "r1", "read"),
        (4, "2024-01-01", "r1", "first"),
        (4, "2024/01/01", "r2", "second"),
    ]
    df = spark.createDataFrame(rows, "id int, updated_at string, run_id string, note string")
    got = latest_raw(df)
    assert got.columns == df.columns
    assert sorted((r.id, r.note) for r in got.collect()) == [(1, "february"), (2, "evening"), (3, "read"), (4, "second")]


def test_repairs_of_one_column_follow_each_other(spark):
    df = spark.createDataFrame([(-1.234,), (1.234,), (None,)], "x double")
    rules = [integrity.Rule("low", "x", "min", (0,), "nullify"), integrity.Rule("fine", "x", "decimals", (2,), "round")]
    assert [tuple(r) for r in integrity.apply_rules(df, rules).collect()] == [(None, True, True), (1.23, False, True), (None, False, False)]
    assert [r.x for r in integrity.apply_rules(df, rules[::-1]).collect()] == [None, 1.23, None]


def test_columns_and_rules_may_be_called_total(spark):
    df = spark.createDataFrame([("a", "A", -1)], "total string, total_clean string, line int")
    (row,) = quality.quality_report(df).collect()
    assert (row.column, row.total, row.changed) == ("total", 1, 1)
    (row,) = integrity.rule_violations(df, [integrity.Rule("total", "line", "min", (0,))]).collect()
    assert (row.rule, row.violations, row.total) == ("total", 1, 1)


def test_rollup_tells_null_groups_from_totals(spark):
    df = spark.createDataFrame([("x", None, "a", "A"), ("x", "k", "b", "b"), (None, "k", None, "UNKNOWN")], "run string, kind string, v string, v_clean string")
    lines = {(r.grouped_by, r.run, r.kind): (r.total, r.changed, r.unknown) for r in quality.quality_rollup(df, ["run", "kind"]).collect()}
    assert lines == {
        ("run,kind", "x", None): (1, 1, 0), ("run,kind", "x", "k"): (1, 0, 0), ("run,kind", None, "k"): (1, 1, 1),
        ("run", "x", None): (2, 1, 0), ("run", None, None): (1, 1, 1), ("", None, None): (3, 2, 1),
    }
    only = quality.quality_rollup(df, ["run", "kind"], [["kind"]]).collect()
    assert {(r.grouped_by, r.run, r.kind, r.total) for r in only} == {("kind", None, None, 1), ("kind", None, "k", 2)}
    plan = quality.quality_rollup(df, ["run", "kind"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Expand") == 1 and "Union" not in plan


def test_kept_table_is_released(spark):
    df = spark.range(10).withColumn("v", lit("x"))
    with pytest.raises(RuntimeError, match="report failed"), quality.kept_for_reports(df) as kept:
        assert kept.count() == 10 and kept.storageLevel.useMemory
        raise RuntimeError("report failed")
    assert not df.storageLevel.useMemory
