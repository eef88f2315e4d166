from pathlib import Path

import pytest
from pyspark.sql import functions as F

from silverline.sources import sinks
from silverline.sources.current import CurrentView, lookup_current, merge_current, read_current, rebuild_current

SCHEMA = "id long, v string, updated_at string, bronze_ingestion_date date, run_id string, ingestion_date date"


def batch(spark, day, *rows):
    made = spark.createDataFrame([(i, v, at) for i, v, at in rows], "id long, v string, updated_at string")
    date = F.lit(f"2024-01-{day:02d}").cast("date")
    return made.select("*", date.alias("bronze_ingestion_date"), F.lit("r").alias("run_id"), date.alias("ingestion_date"))


def held(spark, view):
    return sorted((str(r.id), r.v) for r in read_current(spark, view).collect())


def files(view):
    return {str(p): p.stat().st_mtime_ns for p in Path(view.path).rglob("*.parquet")}


def test_merged_runs_equal_all_runs(spark, tmp_path):
    view, silver = CurrentView(str(tmp_path / "current"), "t", buckets=8), str(tmp_path / "silver")
    runs = [
        batch(spark, 1, *[(i, "a", "2024-01-01") for i in range(40)], (None, "k", None), (None, "k", None)),
        batch(spark, 2, (3, "b", "2024-01-02"), (4, "old", "2023-01-01"), (None, "k", None), (None, "m", "x"), (50, "b", None)),
        batch(spark, 3, (3, "c", "2024-01-03"), (50, "c", "never"), (3, "c0", "2024-01-02 23:00:00")),
    ]
    for n, rows in enumerate(runs):
        sinks.write_silver(rows, silver, "t", run=str(n))
        merge_current(rows, view)
        of_all = sinks.current_silver(spark, silver, "t").collect()
        assert held(spark, view) == sorted((str(r.id), r.v) for r in of_all)
    assert {("3", "c"), ("4", "a"), ("50", "c"), ("None", "k"), ("None", "m")} <= set(held(spark, view))
    before = held(spark, view)
    for day in (4, 5):  # repeated on other days
        merge_current(runs[1].withColumn("ingestion_date", F.lit(f"2024-01-0{day}").cast("date")), view)
        assert held(spark, view) == before
    rebuild_current(spark, view, silver)
    assert held(spark, view) == before


def test_a_run_rewrites_only_the_buckets_it_touches(spark, tmp_path):
    view = CurrentView(str(tmp_path), "t", buckets=16)
    assert len(merge_current(batch(spark, 1, *[(i, "a", None) for i in range(200)]), view)) == 16
    before = files(view)
    change = batch(spark, 2, (7, "b", "2024-01-02"), (7, "b2", "2024-01-03"))
    touched = merge_current(change, view)
    after = files(view)
    gone = {p for p in before if p not in after}
    assert len(touched) == 1 and gone and all(f"/bucket={touched[0]}/" in p for p in gone)
    assert all(after[p] == before[p] for p in before if p in after)
    assert ("7", "b2") in held(spark, view) and len(held(spark, view)) == 200
    assert merge_current(change.where("id > 9"), view) == []
    found = lookup_current(spark, view, [(7,), (8,), (999,)])
    assert sorted((r.id, r.v) for r in found.collect()) == [(7, "b2"), (8, "a")]
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "bucket#" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_bucket_number_is_fixed(spark, tmp_path):
    rows = batch(spark, 1, (1, "a", None))
    merge_current(rows, CurrentView(str(tmp_path), "t", buckets=4))
    with pytest.raises(ValueError, match="has 4 buckets, not 8"):
        merge_current(rows, CurrentView(str(tmp_path), "t", buckets=8))


def test_new_columns_and_several_keys(spark, tmp_path):
    view = CurrentView(str(tmp_path), "t", keys=("id", "v"), buckets=4)
    merge_current(batch(spark, 1, (1, "a", None), (1, "b", None), (2, None, None)), view)
    more = batch(spark, 2, (1, "a", "2024-01-02")).withColumn("note", F.lit("x"))
    merge_current(more, view)
    rows = read_current(spark, view).collect()
    assert sorted(((r.id, r.v, r.note) for r in rows), key=str) == [(1, "a", "x"), (1, "b", None), (2, None, None)]


def test_newest_by_delivery(spark, tmp_path):
    silver = str(tmp_path / "silver")
    sinks.write_silver(batch(spark, 1, (1, "a", "2024-01-01")), silver, "t", run="1")
    sinks.write_silver(batch(spark, 2, (1, "b", "sometime")), silver, "t", run="2")
    assert [r.v for r in sinks.current_silver(spark, silver, "t").collect()] == ["a"]
    assert [r.v for r in sinks.current_silver(spark, silver, "t", by="delivery").collect()] == ["b"]


def test_a_repeated_run_replaces_itself_on_any_day(spark, tmp_path):
    root = str(tmp_path)
    rows = batch(spark, 1, (1, "a", None), (2, "b", None))
    sinks.write_silver(rows, root, "t", run="stream-7")
    sinks.write_silver(batch(spark, 1, (9, "z", None)), root, "t", run="a/b=c")
    sinks.write_silver(rows.withColumn("ingestion_date", F.lit("2024-01-02").cast("date")), root, "t", run="stream-7")
    assert sinks.read_silver(spark, root, "t").count() == 3
    sinks.write_silver(batch(spark, 3, (2, "b", None)), root, "t", run="stream-7")
    stored = sinks.read_silver(spark, root, "t", runs=True).collect()
    assert sorted((r.id, r.silver_run, str(r.ingestion_date)) for r in stored) == [(2, "run-stream-7", "2024-01-03"), (9, "run-a/b=c", "2024-01-01")]
    sinks.write_silver(rows.where("id > 9"), root, "t", run="stream-7")
    assert [r.id for r in sinks.read_silver(spark, root, "t").collect()] == [9]
