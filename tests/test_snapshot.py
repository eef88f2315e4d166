import pytest
from pyspark.sql import functions as F
from test_loads import at

from silverline.sources import bronze, snapshot, watermark
from silverline.sources.current import CurrentView, delete_current, merge_current, read_current

SCHEMA = "id long, v string, w string, updated_at string"


def rows(spark, *values):
    return spark.createDataFrame([(i, v, w, None) for i, v, w in values], SCHEMA)


def statuses(spark, before, after):
    found = snapshot.snapshot_difference(snapshot.digests(after), snapshot.digests(before))
    return sorted([(r.id, r.status) for r in found.collect()], key=str)


def test_difference(spark):
    before = rows(spark, (1, "a", None), (2, "b", None), (3, "c", None), (None, "k", None), (None, "k", None), (None, "m", None), (0, None, None))
    after = rows(spark, (1, "a", None), (2, None, "b"), (4, "d", None), (None, "k", None), (None, "n", None), (0, None, None))
    assert statuses(spark, before, after) == sorted(
        [(1, "unchanged"), (2, "changed"), (3, "deleted"), (4, "inserted"), (None, "unchanged"), (None, "deleted"), (None, "inserted"), (0, "unchanged")], key=str)
    assert statuses(spark, before.where("false"), after.where("false")) == []
    assert {s for _, s in statuses(spark, before, before)} == {"unchanged"}


def test_keys_of_several_columns(spark):
    before, after = rows(spark, (1, "a", "x"), (1, None, "y")), rows(spark, (1, "a", "z"), (1, None, "y"), (1, "-", "y"))
    found = snapshot.snapshot_difference(snapshot.digests(after, ["id", "v"]), snapshot.digests(before, ["id", "v"]), ["id", "v"])
    assert sorted((r.id, str(r.v), r.status) for r in found.collect()) == [(1, "-", "inserted"), (1, "None", "unchanged"), (1, "a", "changed")]


def test_newest_of_a_key_counts(spark):
    old, new = (1, "a", None, "2024-01-01"), (1, "b", None, "2024-02-01")
    both = spark.createDataFrame([old, new], SCHEMA)
    assert statuses(spark, spark.createDataFrame([new], SCHEMA), both) == [(1, "unchanged")]
    difference = snapshot.snapshot_difference(snapshot.digests(both), snapshot.digests(spark.createDataFrame([old], SCHEMA)))
    assert [r.v for r in snapshot.changed_rows(both, difference).collect()] == ["b"]


def test_runs_land_changes_once(spark, tmp_path):
    root, control = str(tmp_path / "bronze"), str(tmp_path / "control")
    run = lambda source, day: snapshot.run_snapshot(spark, "t", source, root, control, now=at(day))
    first = rows(spark, (1, "a", None), (2, "b", None), (None, "k", None), (None, "k", None))
    result = run(first, 1)
    assert (result.since, result.inserted, result.changed, result.deleted, result.unchanged) == (None, 3, 0, 0, 0)
    second = rows(spark, (1, "a", None), (3, "c", None), (None, "k", None))
    result = run(second, 2)
    assert (result.since, result.inserted, result.changed, result.deleted, result.unchanged) == ("2024-01-01 00:00:00", 1, 0, 1, 2)
    assert [r.id for r in snapshot.deletions(spark, root, "t", "id long", "2024-01-02", "000000000000").collect()] == [2]
    result = run(second, 3)
    assert (result.inserted, result.changed, result.deleted, result.unchanged) == (0, 0, 0, 3)
    landed = bronze.read_bronze(spark, root, "t", first.schema).collect()
    assert sorted([(r.id, r.v, str(r.ingestion_date)) for r in landed], key=str) == sorted(
        [(1, "a", "2024-01-01"), (2, "b", "2024-01-01"), (None, "k", "2024-01-01"), (3, "c", "2024-01-02")], key=str)
    with pytest.raises(ValueError, match="done already"):
        run(second, 3)


def test_failed_run_is_repeated_as_if_it_had_not_begun(spark, tmp_path):
    root, control = str(tmp_path / "bronze"), str(tmp_path / "control")
    source = rows(spark, (1, "a", None))
    snapshot.run_snapshot(spark, "t", source, root, control, now=at(1))
    broken = rows(spark, (1, "b", None), (2, "c", None)).withColumn("w", F.when(F.col("id") == 2, F.raise_error(F.lit("source is down"))).otherwise(F.col("w")))
    with pytest.raises(Exception, match="source is down"):
        snapshot.run_snapshot(spark, "t", broken, root, control, now=at(2))
    assert watermark.get_watermark(spark, control, "t#snapshot") == "2024-01-01 00:00:00"
    result = snapshot.run_snapshot(spark, "t", rows(spark, (1, "b", None), (2, "c", None)), root, control, now=at(2))
    assert (result.inserted, result.changed) == (1, 1)


def test_rows_are_not_shuffled_for_the_comparison(spark):
    source = rows(spark, (1, "a", "wide"))
    found = snapshot.snapshot_difference(snapshot.digests(source), snapshot.digests(source))
    plan = found._jdf.queryExecution().executedPlan().toString()
    exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    assert exchanges and not any("w#" in line for line in exchanges)


def test_deletions_leave_the_current_view(spark, tmp_path):
    view = CurrentView(str(tmp_path), "t", buckets=8)
    assert delete_current(rows(spark, (1, "a", None)), view) == []
    merge_current(rows(spark, *[(i, "a", None) for i in range(40)], (None, "k", None)), view)
    assert len(delete_current(rows(spark, (3, "x", None), (None, "k", None), (77, "x", None)), view)) in (1, 2)
    left = sorted((r.id for r in read_current(spark, view).collect()), key=str)
    assert left == sorted([*[i for i in range(40) if i != 3], None], key=str)
    delete_current(rows(spark, *[(i, "x", None) for i in range(40)]), view)  # buckets that lose all rows
    assert [r.v for r in read_current(spark, view).collect()] == ["k"]
    merge_current(rows(spark, (5, "again", None)), view)
    assert sorted(r.v for r in read_current(spark, view).collect()) == ["again", "k"]
