import pytest
from pyspark.sql import functions as F

from silverline.session import scratch_path
from silverline.sources import ledger
from silverline.sources.ledger import LedgerTarget, forget_hidden, load_once, loaded


@pytest.fixture
def target(tmp_path, spark):
    suffix = scratch_path(spark, "t")[-8:]
    return LedgerTarget(location=str(tmp_path), ledger=f"ledger_{suffix}"), f"t_{suffix}"


def ids(spark, target, name):
    return sorted(r.id for r in loaded(spark, target, name).collect())


def test_a_repeated_load_changes_nothing(spark, target):
    target, name = target
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    assert load_once({name: rows}, target, "r1") == load_once({name: rows}, target, "r1") == {name: 2}
    assert load_once({name: rows.where("id = 1")}, target, "r1") == {name: 2}  # that id is done
    assert ids(spark, target, name) == [1, 2]
    assert load_once({name: rows.select("v", "id")}, target, "r2") == {name: 2}
    assert ids(spark, target, name) == [1, 1, 2, 2]
    assert load_once({}, target, "r9") == load_once(None, target, "r9") == {}


def test_a_failed_load_is_not_seen_and_may_be_repeated(spark, target):
    target, name = target
    rows = spark.createDataFrame([(1,), (2,), (3,)], "id int")
    load_once({name: rows.where("id = 1")}, target, "r1")
    ledger.stage(rows, target, name, "r2")  # and then the job died
    assert ids(spark, target, name) == [1]
    broken = rows.withColumn("id", F.when(F.col("id") == 3, F.raise_error(F.lit("source is down"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="source is down"):
        load_once({name: broken}, target, "r2")
    assert ids(spark, target, name) == [1]
    assert load_once({name: rows.where("id = 2")}, target, "r2") == {name: 1}
    assert ids(spark, target, name) == [1, 2]


def test_replace_hides_and_forget_removes(spark, target):
    target, name = target
    rows = spark.createDataFrame([(1,), (2,)], "id int")
    load_once({name: rows}, target, "r1")
    load_once({name: rows.where("id = 2")}, target, "r2", "replace")
    load_once({name: rows.where("id = 1")}, target, "r3")
    ledger.stage(rows, target, name, "r4")
    assert ids(spark, target, name) == [1, 2]
    plan = loaded(spark, target, name)._jdf.queryExecution().executedPlan().toString()
    assert "load_id" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert forget_hidden(spark, target, name) == ["r1", "r4"]
    assert ids(spark, target, name) == [1, 2]
    assert load_once({name: rows}, target, "r1") == {name: 2}, "the ledger remembers it"
    load_once({name: rows.where("false")}, target, "r5", "replace")
    assert ids(spark, target, name) == []


def test_what_is_refused(spark, target):
    target, name = target
    rows = spark.createDataFrame([(1,)], "id int")
    with pytest.raises(ValueError, match="append or replace"):
        load_once({name: rows}, target, "r1", "upsert")
    with pytest.raises(ValueError, match="load id"):
        load_once({name: rows}, target, "r1' OR")
    load_once({name: rows}, target, "r1")
    with pytest.raises(ValueError, match="columns"):
        load_once({name: rows.withColumn("more", F.lit(1))}, target, "r2")


def test_statements_for_a_database():
    assert ledger.ledger_statements("s", "t", ["id", "a"], "r1") == [
        "INSERT INTO load_ledger (table_name, load_id, n_rows) SELECT 't', 'r1', count(*) FROM s",
        "DELETE FROM t WHERE id IN (SELECT id FROM s)",
        "INSERT INTO t (id, a) SELECT DISTINCT id, a FROM s",
        "DROP TABLE s",
    ]
