"""Queries for landing, incremental runs, versions, Silver, the warehouse and the stream."""

from __future__ import annotations

from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.operators.versions import latest_per_key, latest_raw
from silverline.plans.transformation import run_cleaning
from silverline.session import scratch_path
from silverline.sources import bronze as landing
from silverline.sources.current import CurrentView, merge_current, read_current
from silverline.sources.incremental import changed_since, run_all
from silverline.sources.sinks import CatalogTarget, current_silver, load_all, read_silver, write_silver
from silverline.sources.watermark import get_watermark, read_watermarks, save_watermark
from silverline.streaming.bronze_stream import stream_to_silver
from workload import oracle as o
from workload.bronze import bronze, bronze_sql, derive, spec_of
from workload.entity_queries import ENTITIES, silver
from workload.registry import portable, query

_DAY, _RUN = "2024-06-01", "000001"
_SINCE = "1999-06-01 00:00:00"


def _raw_sql(entity: str) -> str:
    names = ", ".join(f"{'CAST(id AS BIGINT) AS id' if f.name == 'id' else f.name}" for f in spec_of(entity).schema.fields)
    return f"SELECT {names} FROM ({bronze_sql(entity)}) b"


def _raw_columns(entity: str) -> list[str]:
    return [f.name for f in spec_of(entity).schema.fields]


@query("bronze_roundtrip", f"SELECT *, '{_DAY}' AS ingestion_date, '{_RUN}' AS run_id FROM ({_raw_sql('payments')}) r")
def _(spark, sf_dir):
    root = scratch_path(spark, "landing")
    landing.write_bronze(bronze(spark, sf_dir, "payments"), root, "payments", _DAY, _RUN)
    return portable(landing.read_bronze(spark, root, "payments", spec_of("payments").schema))


@query(
    "bronze_scan_all",
    " UNION ALL ".join(
        f"""SELECT '{e}' AS entity, count(*) AS n_rows, count(updated_at) AS n_updated,
        CAST(sum(length(created_at)) AS BIGINT) AS created_chars FROM ({bronze_sql(e)}) b"""
        for e in ENTITIES
    ),
)
def _(spark, sf_dir):
    """Nine tables landed at once: each computed where it is landed, and compressed, as all of them stay on disk together."""
    root = scratch_path(spark, "landing")
    for entity in ENTITIES:
        landing.write_bronze(derive(spark, sf_dir, entity), root, entity, _DAY, _RUN, compression="gzip")
    scans = landing.read_all_bronze(spark, root, {e: spec_of(e).schema for e in ENTITIES})
    counts = [
        df.agg(
            F.count("id").alias("n_rows"),
            F.count("updated_at").alias("n_updated"),
            F.sum(F.length("created_at")).alias("created_chars"),
        ).select(F.lit(e).alias("entity"), "n_rows", "n_updated", "created_chars")
        for e, df in scans.items()
    ]
    return reduce(DataFrame.unionByName, counts)


_ARRAY = 1000  # records an array file


def write_array_files(df, root, entity):
    """One indented JSON array per entity and day, the layout of the extraction job."""
    record = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.floor(F.col("id") / _ARRAY).cast("int"))
    arrays = df.groupBy(day.alias("ingestion_date")).agg(F.collect_list(record).alias("records"))  # _ARRAY at most
    text = F.concat(F.lit("[\n"), F.array_join("records", ",\n"), F.lit("\n]"))
    arrays.select(text.alias("value"), "ingestion_date").write.partitionBy("ingestion_date").text(landing.bronze_path(root, entity))


@query(
    "bronze_array_files",
    f"""SELECT *, CAST(DATE '2024-01-01' + CAST(floor(id / {_ARRAY}) AS INTEGER) AS VARCHAR) AS ingestion_date
        FROM ({_raw_sql('customers')}) r""",
)
def _(spark, sf_dir):
    root = scratch_path(spark, "arrays")
    write_array_files(bronze(spark, sf_dir, "customers"), root, "customers")
    stored = landing.read_bronze(spark, root, "customers", spec_of("customers").schema, multi_line=True)
    return portable(stored.drop("run_id"))


def _pages(spark, sf_dir, path):
    """Save the coupons as API pages of up to 100 records, one page per line."""
    records = bronze(spark, sf_dir, "coupons")
    total = records.count()
    record = F.struct(*_raw_columns("coupons"))
    pages = records.groupBy(F.floor(F.col("id") / 100)).agg(F.collect_list(record).alias("data"))
    pages.select("data", F.lit(total).alias("total")).write.json(path)
    return landing.read_pages(spark, path, spec_of("coupons").schema)


@query("envelope_records", _raw_sql("coupons"))
def _(spark, sf_dir):
    return landing.page_records(_pages(spark, sf_dir, scratch_path(spark, "pages")))


@query(
    "envelope_completeness",
    "SELECT count(*) AS received, count(*) AS announced, true AS complete FROM events",
)
def _(spark, sf_dir):
    return landing.page_completeness(_pages(spark, sf_dir, scratch_path(spark, "pages")))


@query(
    "incremental_since",
    f"""SELECT id, updated_at FROM ({_raw_sql('payments')}) r
        WHERE coalesce({o.moment('updated_at')} >= TIMESTAMP '{_SINCE}', true)""",
)
def _(spark, sf_dir):
    return changed_since(bronze(spark, sf_dir, "payments"), _SINCE).select("id", "updated_at")


@query(
    "incremental_since_dated",
    f"""SELECT id, updated_at FROM ({_raw_sql('inventory')}) r
        WHERE {o.moment('updated_at')} >= TIMESTAMP '{_SINCE}'""",
)
def _(spark, sf_dir):
    recent = changed_since(bronze(spark, sf_dir, "inventory"), _SINCE, keep_undated=False)
    return recent.select("id", "updated_at")


@query(
    "incremental_runs",
    f"""WITH r AS ({_raw_sql('payments')})
    SELECT 1 AS run, 'none' AS since, count(*) AS n_rows FROM r
    UNION ALL SELECT 2, '{_SINCE}', count(*) FROM r
        WHERE coalesce({o.moment('updated_at')} >= TIMESTAMP '{_SINCE}', true)
    UNION ALL SELECT 3, '2999-01-01 00:00:00', 0 FROM (SELECT count(*) FROM r) n""",
)
def _(spark, sf_dir):
    """A full run, a run since a mark, and a run that finds nothing new, as landed."""
    bronze_root, control = scratch_path(spark, "landing"), scratch_path(spark, "control")
    payments = bronze(spark, sf_dir, "payments")
    starts = [datetime(1999, 6, 1, tzinfo=timezone.utc), datetime(2999, 1, 1, tzinfo=timezone.utc),
              datetime(2999, 1, 2, tzinfo=timezone.utc)]
    dated = payments.filter(F.col("updated_at").isNotNull() & (F.trim("updated_at") != "") & (F.col("updated_at") != "bad-date"))
    results = [
        run_all(spark, {"payments": source}, bronze_root, control, ["payments"], now)[0]
        for source, now in zip([payments, payments, dated], starts, strict=True)
    ]
    runs = [(n + 1, result.since or "none") for n, result in enumerate(results)]
    landed = landing.read_bronze(spark, bronze_root, "payments", spec_of("payments").schema)
    per_run = landed.groupBy("ingestion_date").agg(F.count(F.lit(1)).alias("n_rows"))
    days = spark.createDataFrame(
        [(run, since, now.date()) for (run, since), now in zip(runs, starts, strict=True)],
        "run int, since string, ingestion_date date",
    )
    return days.join(per_run, "ingestion_date", "left").select(
        "run", "since", F.coalesce("n_rows", F.lit(0)).alias("n_rows")
    )


@query(
    "watermarks",
    """SELECT 'orders' AS entity, strftime(max(o_orderdate), '%Y-%m-%d %H:%M:%S') AS last_successful_run FROM orders
    UNION ALL SELECT 'lineitem', strftime(max(l_shipdate), '%Y-%m-%d %H:%M:%S') FROM lineitem
    UNION ALL SELECT 'events', NULL FROM (SELECT count(*) FROM events) e""",
)
def _(spark, sf_dir):
    """Marks saved twice per entity; the one saved last is in force."""
    control = scratch_path(spark, "control")
    marks = {"orders": "o_orderdate", "lineitem": "l_shipdate"}
    for name, column in marks.items():
        newest = spark.read.parquet(f"{sf_dir}/{name}.parquet").agg(F.max(column).alias("at"))
        text = newest.select(F.date_format("at", "yyyy-MM-dd HH:mm:ss")).first()[0]
        save_watermark(spark, control, name, "1990-01-01 00:00:00")
        save_watermark(spark, control, name, text)
    absent = spark.createDataFrame([("events", get_watermark(spark, control, "events"))],
                                   "entity string, last_successful_run string")
    return read_watermarks(spark, control).unionByName(absent)


@query(
    "latest_per_key",
    f"""WITH v AS (SELECT CAST(event_id AS BIGINT) AS event_id, user_id AS id, event_type,
        value, strftime(ts, '%Y-%m-%d') AS updated_at_clean FROM events)
    SELECT id, updated_at_clean, event_id, event_type, value FROM (
        SELECT *, row_number() OVER (PARTITION BY id ORDER BY updated_at_clean DESC NULLS LAST, event_id DESC) AS r FROM v) t
    WHERE r = 1""",
)
def _(spark, sf_dir):
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    versions = events.select(
        F.col("user_id").alias("id"),
        F.date_format("ts", "yyyy-MM-dd").alias("updated_at_clean"),
        "event_id",
        "event_type",
        "value",
    )
    return latest_per_key(versions, order=["updated_at_clean", "event_id"])


@query(
    "latest_payments",
    f"""SELECT CAST(order_id AS VARCHAR) AS order_id, id, amount, updated_at_clean FROM (
        SELECT *, row_number() OVER (PARTITION BY order_id ORDER BY updated_at_clean DESC NULLS LAST, id DESC) AS r
        FROM ({o.entity_sql(spec_of('payments'))}) s) t WHERE r = 1 OR order_id IS NULL""",
)
def _(spark, sf_dir):
    versions = silver(spark, sf_dir, "payments").select("order_id", "id", "amount", "updated_at_clean")
    return portable(latest_per_key(versions, "order_id", order=["updated_at_clean", "id"]), "order_id")


@query(
    "latest_raw_versions",
    f"""SELECT warehouse, id, updated_at FROM (
        SELECT *, row_number() OVER (PARTITION BY warehouse ORDER BY {o.moment('updated_at')} DESC NULLS LAST, id DESC) AS r
        FROM ({_raw_sql('inventory')}) b) t WHERE r = 1 OR warehouse IS NULL""",
)
def _(spark, sf_dir):
    """Few keys, each with very many versions."""
    versions = bronze(spark, sf_dir, "inventory").select("warehouse", "id", "updated_at")
    return latest_raw(versions, "warehouse")


@query("silver_roundtrip", o.portable_entity(spec_of("inventory")))
def _(spark, sf_dir):
    root = scratch_path(spark, "silver")
    write_silver(silver(spark, sf_dir, "inventory"), root, "inventory")
    stored = read_silver(spark, root, "inventory")
    return portable(stored.drop("ingestion_timestamp", "ingestion_date"), *o.integers_of(spec_of("inventory")))


@query("silver_by_status", f"SELECT id, status_clean, carrier_clean FROM ({o.entity_sql(spec_of('shipping'))}) s")
def _(spark, sf_dir):
    """Silver partitioned by a skewed column, rows brought together per partition first."""
    root = scratch_path(spark, "silver")
    write_silver(silver(spark, sf_dir, "shipping"), root, "shipping", ["status_clean"], rebalance=True)
    return read_silver(spark, root, "shipping").select("id", "status_clean", "carrier_clean")


@query(
    "warehouse_load",
    " UNION ALL ".join(
        f"""SELECT '{e}' AS entity, id, {value} AS value, 2 AS stored, (SELECT count(*) FROM ({bronze_sql(e)}) b) AS loaded
        FROM ({o.entity_sql(spec_of(e))}) s"""
        for e, value in (("payments", "transaction_id_clean"), ("coupons", "code_clean"))
    ),
)
def _(spark, sf_dir):
    """Two tables replaced, then appended to, in the catalog: every row is stored twice, as reported."""
    path = scratch_path(spark, "warehouse")
    target = CatalogTarget(location=path)
    suffix = path.rsplit("-", 1)[1]
    tables = {f"{e}_{suffix}": silver(spark, sf_dir, e) for e in ("payments", "coupons")}
    load_all(tables, target, if_exists="replace")
    loaded = load_all(tables, target, if_exists="append")
    values = {"payments": "transaction_id_clean", "coupons": "code_clean"}
    stored = []
    for name, rows in loaded.items():
        entity = name.removesuffix(f"_{suffix}")
        counted = spark.table(name).groupBy("id", F.col(values[entity]).alias("value")).agg(F.count(F.lit(1)).cast("int").alias("stored"))
        stored.append(counted.select(F.lit(entity).alias("entity"), "id", "value", "stored", F.lit(rows).cast("bigint").alias("loaded")))
    return stored[0].unionByName(stored[1])


_BEYOND = 3_000_000_000


@query(
    "keys_beyond_32_bits",
    f"""SELECT id + {_BEYOND} AS id, CASE WHEN id % 3 = 0 THEN 'late' ELSE method END AS method
        FROM ({_raw_sql('payments')}) r""",
)
def _(spark, sf_dir):
    """Keys above 2^31, landed twice for a third of the rows, read with the declared schema."""
    root = scratch_path(spark, "landing")
    raw = bronze(spark, sf_dir, "payments").withColumn("id", F.col("id") + _BEYOND).withColumn("updated_at", F.lit("2024-01-01"))
    late = raw.where((F.col("id") - _BEYOND) % 3 == 0).withColumns({"method": F.lit("late"), "updated_at": F.lit("2024-01-02")})
    landing.write_bronze(raw, root, "payments", _DAY, _RUN)
    landing.write_bronze(late, root, "payments", _DAY, "000002")
    return latest_raw(landing.read_bronze(spark, root, "payments", spec_of("payments").schema)).select("id", "method")


# What changes at the source between runs: condition on the key, and the new values of some columns.
_CHANGES = [
    ("id % 7 = 1", {"status": "'paid'", "updated_at": "'2024-06-01'"}),  # a day only, the day of the mark
    ("id % 11 = 2", {"amount": "'77.5'", "updated_at": "'2024-06-02 07:30:00'"}),
]
_KEYLESS = "id % 13 = 0"
_RUNS = [datetime(2024, 6, 1, 10), datetime(2024, 6, 1, 15), datetime(2024, 6, 2, 8), datetime(2024, 6, 2, 9)]


def _state_sql(changes: int) -> str:
    """The source after so many changes; rows of some keys have lost them."""
    sql = bronze_sql("payments")
    for condition, values in _CHANGES[:changes]:
        replaced = ", ".join(f"CASE WHEN {condition} THEN {value} ELSE {c} END AS {c}" for c, value in values.items())
        sql = f"SELECT * REPLACE ({replaced}) FROM ({sql}) b"
    return f"SELECT * REPLACE (CASE WHEN {_KEYLESS} THEN NULL ELSE id END AS id) FROM ({sql}) b"


def _state(raw, changes):
    for condition, values in _CHANGES[:changes]:
        raw = raw.withColumns({c: F.expr(f"CASE WHEN {condition} THEN {value} ELSE {c} END") for c, value in values.items()})
    return raw.withColumn("id", F.expr(f"CASE WHEN {_KEYLESS} THEN NULL ELSE id END"))


_CURRENT_SQL = o.portable(
    f"""SELECT * FROM ({o.entity_sql(spec_of('payments'), _state_sql(2))}) s WHERE id IS NOT NULL
    UNION ALL SELECT * FROM (
        {' UNION '.join(f"SELECT * FROM ({o.entity_sql(spec_of('payments'), _state_sql(n))}) s WHERE id IS NULL" for n in range(3))}) k""",
    *o.integers_of(spec_of("payments")), "id",
)


def _silver_runs(spark, sf_dir, silver_root):
    """A full run, a run of the same day, one of the next day and one that finds nothing new, each written to Silver.

    Gives the cleaned batch and the name of each run that landed something.
    """
    bronze_root, control = scratch_path(spark, "landing"), scratch_path(spark, "control")
    spec, raw = spec_of("payments"), bronze(spark, sf_dir, "payments")
    for now, changes in zip(_RUNS, (0, 1, 2, 2), strict=True):
        now = now.replace(tzinfo=timezone.utc)
        result = run_all(spark, {"payments": _state(raw, changes)}, bronze_root, control, ["payments"], now)[0]
        if result.rows:
            batch = landing.read_bronze(spark, bronze_root, "payments", spec.schema)
            batch = batch.where((F.col("ingestion_date") == F.lit(now.date())) & (F.col("run_id") == now.strftime("%H%M%S%f")))
            cleaned, run = run_cleaning(batch, spark, spec=spec), now.strftime("%Y%m%d%H%M%S")
            write_silver(cleaned, silver_root, "payments", run=run)
            yield cleaned, run


def _next_day(cleaned):
    return cleaned.withColumns({"ingestion_date": F.date_add("ingestion_date", 1), "ingestion_timestamp": F.expr("ingestion_timestamp + INTERVAL 1 DAY")})


def _without_delivery(current):
    current = current.drop("ingestion_timestamp", "ingestion_date", "bronze_ingestion_date", "run_id")
    return portable(current, *o.integers_of(spec_of("payments")), "id")


@query("incremental_to_silver", _CURRENT_SQL)
def _(spark, sf_dir):
    """Several runs, the last of them repeated on another day.

    The current view must be the source as it stands, and hold every content that rows without a key have had.
    """
    silver_root = scratch_path(spark, "silver")
    for cleaned, run in _silver_runs(spark, sf_dir, silver_root):
        last = cleaned, run
    write_silver(_next_day(last[0]), silver_root, "payments", run=last[1])
    return _without_delivery(current_silver(spark, silver_root, "payments"))


@query("silver_current_kept", _CURRENT_SQL)
def _(spark, sf_dir):
    """The current view kept in buckets: each run is merged into it, the last once more on another day."""
    silver_root = scratch_path(spark, "silver")
    view = CurrentView(scratch_path(spark, "current"), "payments", buckets=16)
    for cleaned, _ in _silver_runs(spark, sf_dir, silver_root):
        merge_current(cleaned, view)
    merge_current(_next_day(cleaned), view)
    return _without_delivery(read_current(spark, view))


@query(
    "silver_run_repeated",
    f"""SELECT count(*) AS n_rows, count(DISTINCT id) AS n_ids, 1 AS n_days FROM ({_raw_sql('coupons')}) r WHERE id % 3 = 0""",
)
def _(spark, sf_dir):
    """A run repeated on another day with fewer rows: only the repeat is left."""
    root = scratch_path(spark, "silver")
    cleaned = silver(spark, sf_dir, "coupons").withColumn("ingestion_date", F.lit("2024-06-01").cast("date"))
    write_silver(cleaned, root, "coupons", run="stream-7")
    write_silver(cleaned.where("id % 3 = 0").withColumn("ingestion_date", F.date_add("ingestion_date", 1)), root, "coupons", run="stream-7")
    stored = read_silver(spark, root, "coupons")
    return stored.agg(
        F.count(F.lit(1)).alias("n_rows"), F.countDistinct("id").alias("n_ids"), F.countDistinct("ingestion_date").cast("int").alias("n_days")
    )


@query("stream_to_silver", o.portable_entity(spec_of("customers")))
def _(spark, sf_dir):
    """Landed files cleaned by a stream that stops when it has caught up."""
    bronze_root, silver_root = scratch_path(spark, "landing"), scratch_path(spark, "silver")
    raw = bronze(spark, sf_dir, "customers")
    for run, rest in enumerate(("id % 2 = 0", "id % 2 = 1")):
        landing.write_bronze(raw.filter(rest), bronze_root, "customers", _DAY, f"{run:06d}")
    stream = stream_to_silver(
        spark, spec_of("customers"), bronze_root, silver_root, scratch_path(spark, "checkpoint"), max_files=1
    )
    stream.awaitTermination()
    stored = read_silver(spark, silver_root, "customers")
    return portable(stored.drop("ingestion_timestamp", "ingestion_date", "bronze_ingestion_date", "run_id"))


@query("bronze_to_silver", o.portable_entity(spec_of("reviews")))
def _(spark, sf_dir):
    """From raw JSON on storage to the cleaned table, whole texts included."""
    root = scratch_path(spark, "landing")
    landing.write_bronze(bronze(spark, sf_dir, "reviews"), root, "reviews", _DAY, _RUN)
    raw = landing.read_bronze(spark, root, "reviews", spec_of("reviews").schema)
    cleaned = run_cleaning(raw, spark, spec=spec_of("reviews"), audit=False)
    return portable(cleaned.drop("ingestion_date", "run_id"), *o.integers_of(spec_of("reviews")))
