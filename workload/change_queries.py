"""Queries for changes found by comparison, deletions, and streams that drop repeated rows."""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from silverline.plans.transformation import run_cleaning
from silverline.session import scratch_path
from silverline.sources import bronze as landing
from silverline.sources.current import CurrentView, delete_current, merge_current, read_current
from silverline.sources.ledger import LedgerTarget, load_once, loaded, stage
from silverline.sources.sinks import read_silver
from silverline.sources.snapshot import deletions, digests, run_snapshot, snapshot_difference
from silverline.streaming.bronze_stream import stream_to_silver
from workload import oracle as o
from workload.bronze import bronze, bronze_sql, spec_of
from workload.entity_queries import silver
from workload.registry import portable, query

# What happens at the source without its change times telling: keys that come, go, and change.
_COMES, _GOES, _CHANGES = "id % 19 = 4", "id % 17 = 3", "id % 7 = 1"
_AMOUNT = "'77.5'"


def _after_sql(raw: str) -> str:
    return f"SELECT * REPLACE (CASE WHEN {_CHANGES} THEN {_AMOUNT} ELSE amount END AS amount) FROM ({raw}) b WHERE NOT ({_GOES})"


def _states(spark, sf_dir):
    """The source before and after; most change times of its rows cannot be read or do not move."""
    raw = bronze(spark, sf_dir, "payments")
    after = raw.where(f"NOT ({_GOES})").withColumn("amount", F.expr(f"CASE WHEN {_CHANGES} THEN {_AMOUNT} ELSE amount END"))
    return raw.where(f"NOT ({_COMES})"), after


_STATUS_SQL = f"""
    SELECT CAST(id AS BIGINT) AS id,
        CASE WHEN {_COMES} AND NOT ({_GOES}) THEN 'inserted' WHEN {_GOES} THEN 'deleted'
            WHEN {_CHANGES} AND amount IS DISTINCT FROM {_AMOUNT} THEN 'changed' ELSE 'unchanged' END AS status
    FROM ({bronze_sql('payments')}) b WHERE NOT ({_COMES} AND {_GOES})"""


@query("snapshot_difference", _STATUS_SQL)
def _(spark, sf_dir):
    """Every key of two states of a source, and what became of it."""
    before, after = _states(spark, sf_dir)
    return snapshot_difference(digests(after), digests(before)).select("id", "status")


_STARTS = [datetime(2024, 6, 1, 10, tzinfo=timezone.utc), datetime(2024, 6, 2, 10, tzinfo=timezone.utc), datetime(2024, 6, 3, 10, tzinfo=timezone.utc)]


def _snapshot_runs(spark, sf_dir):
    """Three runs: all rows, what has changed, and nothing. Gives the folder of Bronze and what each run says it found."""
    bronze_root, control = scratch_path(spark, "landing"), scratch_path(spark, "control")
    before, after = _states(spark, sf_dir)
    results = [run_snapshot(spark, "payments", source, bronze_root, control, now=now) for source, now in zip([before, after, after], _STARTS, strict=True)]
    return bronze_root, results


@query(
    "snapshot_runs",
    f"""WITH s AS ({_STATUS_SQL}), n AS (SELECT count(*) AS n FROM ({bronze_sql('payments')}) b WHERE NOT ({_COMES}))
    SELECT 1 AS run, 'inserted' AS status, n AS n_keys, n AS n_landed FROM n
    UNION ALL SELECT 2, status, count(*), CASE WHEN status IN ('inserted', 'changed') THEN count(*) ELSE 0 END FROM s GROUP BY status
    UNION ALL SELECT 3, 'unchanged', count(*), 0 FROM s WHERE status <> 'deleted'""",
)
def _(spark, sf_dir):
    """What each run found, and how many rows of it lie in Bronze: rows that did not change are landed once."""
    bronze_root, results = _snapshot_runs(spark, sf_dir)
    found = [(n + 1, str(r.run_start[:10]), status, getattr(r, status)) for n, r in enumerate(results) for status in ("inserted", "changed", "deleted", "unchanged")]
    told = spark.createDataFrame([f for f in found if f[3]], "run int, day string, status string, n_keys long")
    landed = landing.read_bronze(spark, bronze_root, "payments", spec_of("payments").schema)
    per_day = landed.select(F.col("ingestion_date").cast("string").alias("day"), "id", (F.col("amount") == F.expr(_AMOUNT)).alias("new"))
    before, _ = _states(spark, sf_dir)
    known = before.select("id", F.lit(True).alias("known"))
    status = F.when((F.col("day") == "2024-06-01") | F.col("known").isNull(), "inserted").otherwise("changed")
    counted = per_day.join(known, "id", "left").groupBy("day", status.alias("status")).agg(F.count(F.lit(1)).alias("n_landed"))
    return told.join(counted, ["day", "status"], "left").select("run", "status", "n_keys", F.coalesce("n_landed", F.lit(0)).alias("n_landed"))


@query("current_after_deletions", o.portable(o.entity_sql(spec_of("payments"), _after_sql(bronze_sql("payments"))), *o.integers_of(spec_of("payments"))))
def _(spark, sf_dir):
    """Changes and deletions found by comparison, brought into the kept view: it is the cleaned source as it stands."""
    bronze_root, results = _snapshot_runs(spark, sf_dir)
    spec, view = spec_of("payments"), CurrentView(scratch_path(spark, "current"), "payments", by="delivery", buckets=16)
    for now, result in zip(_STARTS, results, strict=True):
        run = (now.date().isoformat(), now.strftime("%H%M%S%f"))
        if result.inserted or result.changed:
            batch = landing.read_bronze(spark, bronze_root, "payments", spec.schema)
            batch = batch.where((F.col("ingestion_date") == F.lit(run[0]).cast("date")) & (F.col("run_id") == run[1]))
            merge_current(run_cleaning(batch, spark, spec=spec), view)
        if result.deleted:
            delete_current(deletions(spark, bronze_root, "payments", "id long", *run), view)
    current = read_current(spark, view).drop("ingestion_timestamp", "ingestion_date", "bronze_ingestion_date", "run_id")
    return portable(current, *o.integers_of(spec))


@query("stream_deduplicated", o.portable_entity(spec_of("customers")))
def _(spark, sf_dir):
    """A stream started twice, fed with files that repeat rows of former ones, some of them late: every row is there once."""
    bronze_root, silver_root, state = (scratch_path(spark, name) for name in ("landing", "silver", "checkpoint"))
    raw = bronze(spark, sf_dir, "customers")
    deliveries = [
        [("2024-06-01", "000001", "id % 3 = 0"), ("2024-06-01", "000002", "id % 3 = 1 OR id % 6 = 0")],
        [("2024-06-02", "000001", "id % 2 = 0 OR id % 3 = 2"), ("2024-05-01", "000001", "id % 5 = 0"), ("2024-06-02", "000002", "id >= 0")],
    ]
    for files in deliveries:
        for day, run, rows in files:
            landing.write_bronze(raw.where(rows), bronze_root, "customers", day, run)
        stream_to_silver(spark, spec_of("customers"), bronze_root, silver_root, state, max_files=2, remember="7 days").awaitTermination()
    stored = read_silver(spark, silver_root, "customers")
    return portable(stored.drop("ingestion_timestamp", "ingestion_date", "bronze_ingestion_date", "run_id"))


_LOADED = {"payments": "transaction_id_clean", "coupons": "code_clean"}


@query(
    "warehouse_reload",
    " UNION ALL ".join(
        f"""SELECT '{e}' AS entity, id, {value} AS value, 1 AS stored, (SELECT count(*) FROM ({bronze_sql(e)}) b) AS loaded
        FROM ({o.entity_sql(spec_of(e))}) s"""
        for e, value in _LOADED.items()
    ),
)
def _(spark, sf_dir):
    """A load that replaced an older one, was staged once before it failed, and was repeated when done: every row is there once."""
    path = scratch_path(spark, "reload")
    suffix = path.rsplit("-", 1)[1]
    target = LedgerTarget(location=path, ledger=f"ledger_{suffix}")
    tables = {f"{e}_{suffix}": silver(spark, sf_dir, e).select("id", F.col(value).alias("value")) for e, value in _LOADED.items()}
    older = {name: df.where("id % 2 = 0") for name, df in tables.items()}
    load_once(older, target, "monday")
    for name, df in tables.items():
        stage(df.where("id % 3 = 0"), target, name, "tuesday")  # and then the job died
    load_once(tables, target, "tuesday", "replace")
    counts = load_once(tables, target, "tuesday", "replace")
    stored = []
    for name, n in counts.items():
        rows = loaded(spark, target, name).groupBy("id", "value").agg(F.count(F.lit(1)).cast("int").alias("stored"))
        stored.append(rows.select(F.lit(name.removesuffix(f"_{suffix}")).alias("entity"), "id", "value", "stored", F.lit(n).cast("bigint").alias("loaded")))
    return stored[0].unionByName(stored[1])
