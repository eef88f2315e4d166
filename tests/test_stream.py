from pyspark.sql import functions as F
from test_loads import coupons


from silverline.plans.entities import ENTITY_SPECS
from silverline.sources import bronze, sinks
from silverline.streaming.bronze_stream import stream_bronze, stream_to_silver, without_repeats

SPEC = ENTITY_SPECS["coupons"]


def folders(tmp_path):
    return (str(tmp_path / name) for name in ("bronze", "silver", "state"))


def test_repeated_rows_are_dropped_over_two_starts(spark, tmp_path):
    root, silver, state = folders(tmp_path)

    def run(remember="1 hour"):
        stream_to_silver(spark, SPEC, root, silver, state, remember=remember, max_files=1).awaitTermination()
        return sorted((r.id, r.code, str(r.bronze_ingestion_date)) for r in sinks.read_silver(spark, silver, "coupons").collect())

    bronze.write_bronze(coupons(spark, (1, "a", None), (1, "a", None), (2, "b", "x")), root, "coupons", "2024-01-02", "r1")
    first = run()
    assert first == [(1, "a", "2024-01-02"), (2, "b", "2024-01-02")]
    bronze.write_bronze(coupons(spark, (1, "a", None), (2, "b2", "x")), root, "coupons", "2024-01-03", "r1")
    bronze.write_bronze(coupons(spark, (3, "late", None), (2, "b", "x")), root, "coupons", "2023-01-01", "r1")  # late
    second = run()
    assert [(i, v) for i, v, _ in second] == [(1, "a"), (2, "b"), (2, "b2"), (3, "late")]
    assert run() == second


def test_values_that_move_between_columns_are_no_repeats(spark, tmp_path):
    root, silver, state = folders(tmp_path)
    rows = coupons(spark, (1, "a", None), (1, None, "a"), (2, None, None))
    bronze.write_bronze(rows, root, "coupons", "2024-01-02", "r1")
    stream_to_silver(spark, SPEC, root, silver, state, remember="1 hour").awaitTermination()
    assert sinks.read_silver(spark, silver, "coupons").count() == 3


def test_by_event_time_late_rows_go_and_state_is_forgotten(spark, tmp_path):
    root, out, state = folders(tmp_path)

    def run():
        rows = stream_bronze(spark, root, "coupons", SPEC.schema, max_files=1).select("id", "code", F.to_timestamp("updated_at").alias("at"))
        kept = without_repeats(rows, "1 day", ["id"], F.col("at"))
        query = kept.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start()
        query.awaitTermination()
        return sorted((r.id, str(r.at)[:10]) for r in spark.read.parquet(out).collect())

    bronze.write_bronze(coupons(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01")), root, "coupons", "2024-01-01", "r1")
    assert run() == [(1, "2024-01-01"), (2, "2024-01-01")]
    bronze.write_bronze(coupons(spark, (1, "a", "2024-01-01"), (9, "z", "2024-01-10")), root, "coupons", "2024-01-02", "r1")
    assert run() == [(1, "2024-01-01"), (2, "2024-01-01"), (9, "2024-01-10")]
    bronze.write_bronze(coupons(spark, (2, "b", "2024-01-11"), (3, "c", "2024-01-02")), root, "coupons", "2024-01-03", "r1")
    assert run() == [(1, "2024-01-01"), (2, "2024-01-01"), (2, "2024-01-11"), (9, "2024-01-10")]  # 2 was forgotten, 3 came too late
