import json
from datetime import datetime, timezone

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from silverline.operators.versions import latest_per_key
from silverline.plans.entities import ENTITY_SPECS
from silverline.plans.transformation import CLEANERS, run_coupon_cleaning
from silverline.session import scratch_path
from silverline.sources import bronze, incremental, sinks, watermark
from silverline.streaming.bronze_stream import stream_to_silver

COUPONS = ENTITY_SPECS["coupons"].schema


def coupons(spark, *rows):
    values = [{"id": i, "code": code, "updated_at": at} for i, code, at in rows]
    return spark.createDataFrame([tuple(v.get(f.name) for f in COUPONS.fields) for v in values], COUPONS)


def test_array_files_are_read_with_declared_types(spark, tmp_path):
    """The compatibility layout: one indented JSON array per entity and day."""
    for day, records in {
        "2024-01-01": [{"id": 1, "code": "a", "max_uses": 5, "is_active": True}, {"id": 2, "code": None}],
        "2024-01-02": [{"id": 3, "code": "c", "min_order": 19.5, "unknown": "x"}],
    }.items():
        folder = tmp_path / "coupons" / f"ingestion_date={day}"
        folder.mkdir(parents=True)
        (folder / "coupons.json").write_text(json.dumps(records, indent=2))
    df = bronze.read_bronze(spark, str(tmp_path), "coupons", COUPONS, multi_line=True)
    assert df.columns == [*COUPONS.fieldNames(), "ingestion_date", "run_id"]
    rows = {r.id: r for r in df.collect()}
    assert (rows[1].max_uses, rows[1].is_active, rows[3].min_order) == ("5", "true", "19.5")
    assert str(rows[3].ingestion_date) == "2024-01-02" and rows[3].run_id is None
    one_day = df.filter("ingestion_date = DATE'2024-01-01'")
    assert one_day.count() == 2
    scan = one_day._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ingestion_date" in scan
    both = bronze.read_all_bronze(spark, str(tmp_path), {"coupons": COUPONS}, multi_line=True)
    assert both["coupons"].count() == 3


def test_unreadable_records_are_kept(spark, tmp_path):
    folder = tmp_path / "coupons" / "ingestion_date=2024-01-01"
    folder.mkdir(parents=True)
    (folder / "coupons.json").write_text('{"id": 1, "code": "a"}\n{"id": 2, "co\n')
    df = bronze.read_bronze(spark, str(tmp_path), "coupons", COUPONS, corrupt_column="broken").cache()
    assert sorted((r.id, r.broken) for r in df.filter("broken IS NOT NULL OR id = 1").select(
        F.coalesce("id", F.lit(-1)).alias("id"), F.coalesce("broken", F.lit("")).alias("broken")).collect()) == [
        (-1, '{"id": 2, "co'), (1, "")]
    df.unpersist()


def test_pages(spark, tmp_path):
    pages = [{"data": [{"id": 1, "code": "a"}, {"id": 2}], "total": 3}, {"data": [{"id": 3}], "total": 3},
             {"data": [], "total": 3}]
    for n, page in enumerate(pages):
        (tmp_path / f"page{n}.json").write_text(json.dumps(page, indent=1))
    df = bronze.read_pages(spark, str(tmp_path), COUPONS, multi_line=True)
    assert sorted(r.id for r in bronze.page_records(df).collect()) == [1, 2, 3]
    assert tuple(bronze.page_completeness(df).first()) == (3, 3, True)
    assert not bronze.page_completeness(df.filter(F.size("data") != 1)).first().complete


def test_runs_of_one_day_add_up_and_a_repeated_run_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    first, second = coupons(spark, (1, "a", None), (2, "b", None)), coupons(spark, (3, "c", None))
    assert bronze.write_bronze(first, root, "coupons", "2024-01-01", "r1") == 2
    assert bronze.write_bronze(second, root, "coupons", "2024-01-01", "r2") == 1
    assert bronze.write_bronze(first, root, "coupons", "2024-01-01", "r1") == 2
    stored = bronze.read_bronze(spark, root, "coupons", COUPONS)
    assert sorted((r.id, r.run_id) for r in stored.collect()) == [(1, "r1"), (2, "r1"), (3, "r2")]
    assert bronze.write_bronze(first.filter("id > 9"), root, "coupons", "2024-01-02", "r3") == 0
    assert not (tmp_path / "coupons" / "ingestion_date=2024-01-02").exists()


def test_watermark_is_the_one_saved_last(spark, tmp_path):
    control = str(tmp_path / "control")
    assert watermark.get_watermark(spark, control, "coupons") is None
    for text in ("2024-02-01 00:00:00", "2024-01-01 00:00:00"):
        watermark.save_watermark(spark, control, "coupons", text)
    watermark.save_watermark(spark, control, "reviews", "2024-05-05 00:00:00")
    assert watermark.get_watermark(spark, control, "coupons") == "2024-01-01 00:00:00"
    assert watermark.read_watermarks(spark, control).count() == 2


def test_marks_of_many_runs_stay_few_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(watermark, "MOST", 4)
    control = str(tmp_path / "control")
    watermark.save_watermark(spark, control, "t#snapshot", "2024-01-01 00:00:00")
    for n in range(30):
        watermark.save_watermark(spark, control, "coupons", f"2024-01-01 00:00:{n:02d}")
        assert watermark.get_watermark(spark, control, "coupons") == f"2024-01-01 00:00:{n:02d}"
    assert len([p for p in (tmp_path / "control").rglob("*.parquet") if "entity=coupons" in str(p)]) <= 8
    assert watermark.get_watermark(spark, control, "t#snapshot") == "2024-01-01 00:00:00"


def test_changed_since(spark):
    df = coupons(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01 10:00:00"), (3, "c", "bad-date"), (4, "d", "02/01/2024"))

    def ids(**options):
        return sorted(r.id for r in incremental.changed_since(df, "2024-01-01 10:00:00", **options).collect())

    assert ids() == [1, 2, 3, 4]  # the first may have changed at any time of the mark's day
    assert ids(keep_undated=False) == [1, 2, 4]
    assert incremental.changed_since(df, None).count() == 4
    late = coupons(spark, (1, "a", "2023-12-31"), (2, "b", "2024-01-01 09:59:59"), (3, "c", "2024-01-01T10:00:00"))
    assert [r.id for r in incremental.changed_since(late, "2024-01-01 10:00:00").collect()] == [3]


@pytest.mark.parametrize("kind", ["date", "timestamp"])
def test_changed_since_on_typed_columns(spark, tmp_path, kind):
    df = spark.sql(f"SELECT CAST(d AS {kind}) AS updated_at FROM VALUES ('2023-12-31'), ('2024-01-01'), ('2024-01-02'), (NULL) t(d)")
    df.write.parquet(str(tmp_path / "t"))
    recent = incremental.changed_since(spark.read.parquet(str(tmp_path / "t")), "2024-01-01 10:00:00", keep_undated=False)
    assert sorted(str(r.updated_at)[:10] for r in recent.collect()) == (["2024-01-01", "2024-01-02"] if kind == "date" else ["2024-01-02"])
    assert "GreaterThanOrEqual(updated_at" in recent._jdf.queryExecution().executedPlan().toString()


def test_keyless_rows_are_no_versions(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "c", 1), (None, "d", 9)], "id long, v string, at int")
    assert sorted(map(str, latest_per_key(df, order=["at"]).collect())) == sorted(
        map(str, spark.createDataFrame([(1, "b", 2), (None, "c", 1), (None, "c", 1), (None, "d", 9)], df.schema).collect()))
    both = latest_per_key(df, ["id", "v"], order=["at"])
    assert both.count() == 5


def at(day, hour=0):
    return datetime(2024, 1, day, hour, tzinfo=timezone.utc)


def test_incremental_runs_and_latest_version(spark, tmp_path):
    root, control = str(tmp_path / "bronze"), str(tmp_path / "control")
    source = coupons(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01"))
    first = incremental.run_entity(spark, "coupons", source, root, control, at(2))
    assert (first.since, first.run_start, first.rows) == (None, "2024-01-02 00:00:00", 2)
    source = coupons(spark, (1, "a2", "2024-01-02 08:00:00"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02"))
    second = incremental.run_all(spark, {"coupons": source}, root, control, now=at(2, 9))[0]
    assert (second.since, second.rows) == ("2024-01-02 00:00:00", 2)
    third = incremental.run_all(spark, {"coupons": source}, root, control, ["coupons"], at(3))[0]
    # the third row bears the day of the mark only, so it may have changed since
    assert (third.rows, watermark.get_watermark(spark, control, "coupons")) == (1, "2024-01-03 00:00:00")
    assert (first.undated, second.undated) == (0, 0)
    undated = coupons(spark, (4, "d", "bad-date"), (5, "e", "2000-01-01"))
    fourth = incremental.run_entity(spark, "coupons", undated, root, control, at(4))
    assert (fourth.rows, fourth.undated) == (1, 1)
    silver = run_coupon_cleaning(bronze.read_bronze(spark, root, "coupons", COUPONS).where("id < 4"), spark)
    assert sorted((r.id, r.code_clean) for r in latest_per_key(silver).collect()) == [(1, "A2"), (2, "B"), (3, "C")]


def test_failed_run_leaves_the_watermark(spark, tmp_path):
    root, control = str(tmp_path / "bronze"), str(tmp_path / "control")
    watermark.save_watermark(spark, control, "coupons", "2024-01-01 00:00:00")
    broken = coupons(spark, (1, "a", "2024-01-05")).withColumn("code", F.raise_error(F.lit("source is down")))
    with pytest.raises(Exception, match="source is down"):
        incremental.run_entity(spark, "coupons", broken, root, control, at(9))
    assert watermark.get_watermark(spark, control, "coupons") == "2024-01-01 00:00:00"


def test_run_all_follows_the_known_order(spark, tmp_path):
    df = coupons(spark, (1, "a", None))
    results = incremental.run_all(spark, {"coupons": df, "customers": df, "zoo": df}, str(tmp_path / "b"), str(tmp_path / "c"))
    assert [r.entity for r in results] == ["customers", "coupons"]
    assert len(incremental.ENTITIES) == 9 and set(incremental.ENTITIES) == set(CLEANERS)


def test_runs_of_silver_add_up_and_a_repeated_run_replaces_itself(spark, tmp_path):
    root = str(tmp_path)
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], "id int, day string")
    more = spark.createDataFrame([(9, "y")], "id int, day string")
    assert sinks.write_silver(df, root, "t", ["day"], run="1") == 3
    assert sinks.write_silver(more, root, "t", ["day"], rebalance=True, run="2") == 1
    assert sinks.write_silver(more, root, "t", ["day"], run="2") == 1
    assert sorted((r.id, r.day) for r in sinks.read_silver(spark, root, "t").collect()) == [(1, "x"), (2, "y"), (3, "y"), (9, "y")]
    assert {r.silver_run for r in sinks.read_silver(spark, root, "t", runs=True).collect()} == {"run-1", "run-2"}
    assert sinks.write_silver(more, root, "t", ["day"]) == 1
    assert sinks.read_silver(spark, root, "t").count() == 5


def test_current_silver_is_the_newest_version_of_each_key(spark, tmp_path):
    root = str(tmp_path)
    for run, rows in {"1": [(1, "a", "2024-01-01"), (2, "b", None), (None, "k", None)],
                      "2": [(1, "a2", "2024-01-01 10:00:00"), (None, "k", None), (None, "m", "2024-01-01")],
                      "3": [(2, "b2", None), (1, "old", "2023-01-01")]}.items():
        raw = coupons(spark, *[(i or 0, code, at) for i, code, at in rows]).withColumn("id", F.expr("nullif(id, 0)"))
        sinks.write_silver(run_coupon_cleaning(raw, spark), root, "coupons", run=run)
    current = sinks.current_silver(spark, root, "coupons").collect()
    assert sorted((str(r.id), r.code) for r in current) == [("1", "a2"), ("2", "b2"), ("None", "k"), ("None", "m")]


def test_stream_and_batch_write_one_silver(spark, tmp_path):
    spec = ENTITY_SPECS["coupons"]
    root, silver, state = (str(tmp_path / name) for name in ("bronze", "silver", "state"))
    bronze.write_bronze(coupons(spark, (1, "a", None)), root, "coupons", "2024-01-01", "r1")
    stream_to_silver(spark, spec, root, silver, state).awaitTermination()
    sinks.write_silver(run_coupon_cleaning(coupons(spark, (2, "b", None)), spark), silver, "coupons")
    bronze.write_bronze(coupons(spark, (3, "c", None)), root, "coupons", "2024-01-01", "r2")
    stream_to_silver(spark, spec, root, silver, state).awaitTermination()
    assert sorted(r.id for r in sinks.read_silver(spark, silver, "coupons").collect()) == [1, 2, 3]


def test_warehouse_modes(spark, tmp_path):
    target = sinks.CatalogTarget(location=str(tmp_path))
    df = spark.createDataFrame([(1,), (2,)], "id int")
    name = "loads_" + scratch_path(spark, "t")[-8:]
    assert sinks.load_dataframe(df, name, target, "fail") == 2
    with pytest.raises(AnalysisException):
        sinks.load_dataframe(df, name, target, "fail")
    assert sinks.load_dataframe(df, name, target, "append") == 2
    assert spark.table(name).count() == 4
    assert sinks.load_all({name: df}, target, "replace") == {name: 2}
    assert spark.table(name).count() == 2
    with pytest.raises(ValueError, match="if_exists"):
        sinks.load_dataframe(df, name, target, "upsert")
    assert sinks.load_all({}, target) == sinks.load_all(None, target) == {}


def test_jdbc_options():
    target = sinks.JdbcTarget("jdbc:postgresql://db/shop", {"user": "u", "driver": "org.postgresql.Driver"}, connections=4)
    assert target.options("payments", 1000) == {
        "url": "jdbc:postgresql://db/shop",
        "dbtable": "payments",
        "batchsize": "1000",
        "numPartitions": "4",
        "user": "u",
        "driver": "org.postgresql.Driver",
    }


def test_publish_statements():
    assert sinks.publish_statements("s", "t", ["id", "a"]) == [
        "DELETE FROM t WHERE id IN (SELECT id FROM s)",
        "INSERT INTO t (id, a) SELECT DISTINCT id, a FROM s",
        "DROP TABLE s",
    ]


def test_stream_takes_each_file_once(spark, tmp_path):
    spec = ENTITY_SPECS["coupons"]
    root, silver, state = (str(tmp_path / name) for name in ("bronze", "silver", "state"))

    def run():
        stream_to_silver(spark, spec, root, silver, state).awaitTermination()
        return sorted((r.id, r.code_clean, str(r.bronze_ingestion_date)) for r in sinks.read_silver(spark, silver, "coupons").collect())

    bronze.write_bronze(coupons(spark, (1, " a1 ", None)), root, "coupons", "2024-01-01", "r1")
    assert run() == [(1, "A1", "2024-01-01")]
    bronze.write_bronze(coupons(spark, (2, "b", None)), root, "coupons", "2024-01-02", "r1")
    assert run() == [(1, "A1", "2024-01-01"), (2, "B", "2024-01-02")]
    assert run() == [(1, "A1", "2024-01-01"), (2, "B", "2024-01-02")]


def test_stream_joins_the_country_lookup(spark, tmp_path):
    spec = ENTITY_SPECS["suppliers"]
    root, silver, state = (str(tmp_path / name) for name in ("bronze", "silver", "state"))
    raw = spark.createDataFrame([tuple({"id": 1, "country": "de"}.get(f.name) for f in spec.schema.fields)], spec.schema)
    bronze.write_bronze(raw, root, "suppliers", "2024-01-01", "r1")
    stream_to_silver(spark, spec, root, silver, state).awaitTermination()
    assert sinks.read_silver(spark, silver, "suppliers").first().country_clean == "Germany"


def test_scratch_folder_is_a_launch_setting(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    assert scratch_path(spark, "a").startswith(root.rstrip("/") + "/a-")

    class Bare:
        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_path(Bare, "a")
