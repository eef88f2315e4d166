"""Bronze batches that are landed compressed, and the scan of all entities that lands them so."""

from __future__ import annotations

import os
import random
from pathlib import Path

import pytest

from silverline.plans.entities import ENTITY_SPECS
from silverline.sources import bronze
from workload import load_queries  # noqa: F401  (registers queries)
from workload.bronze import derive
from workload.entity_queries import ENTITIES
from workload.registry import QUERIES

COUPONS = ENTITY_SPECS["coupons"].schema
TABLES = {
    "customer": "c_custkey bigint",
    "supplier": "s_suppkey bigint, s_name string",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": "o_orderkey bigint, o_totalprice double, o_orderdate timestamp_ntz",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_quantity double, l_extendedprice double, l_shipdate timestamp_ntz",
    "events": "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double",
    "documents": "doc_id bigint, text string, lang string, source string",
}


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """A folder of the given tables, 3000 rows each, some keys more than once."""
    draw, folder = random.Random(7), str(tmp_path_factory.mktemp("tables"))
    words = ["green", "o'neil", 'a "b"', "line\nbreak", "münchen", ""]
    value = {
        "bigint": lambda: draw.randrange(2500),
        "int": lambda: draw.randrange(50),
        "double": lambda: round(draw.uniform(0, 1000), 2),
        "string": lambda: " ".join(draw.choices(words, k=3)),
        "timestamp_ntz": lambda: f"199{draw.randrange(10)}-0{draw.randrange(1, 10)}-{draw.randrange(10, 28)} 00:00:00",
    }
    for name, columns in TABLES.items():
        kinds = [column.split() for column in columns.split(", ")]
        rows = [[str(value[kind]()) for _, kind in kinds] for _ in range(3000)]
        texts = spark.createDataFrame(rows, ", ".join(f"{column} string" for column, _ in kinds))
        texts.selectExpr(*[f"CAST({c} AS {kind}) AS {c}" for c, kind in kinds]).write.parquet(f"{folder}/{name}.parquet")
    return folder


def files(path):
    return [p for p in Path(path).rglob("*") if p.is_file() and p.name[0] not in "._"]


def test_compressed_batches_are_read_as_others(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bronze, "RECORDS_A_COMPRESSED_FILE", 3)
    rows = [(None if i == 4 else i // 2, ["a", None, "b\r\nc", 'é "d"', ""][i % 5], *[None] * (len(COUPONS.fields) - 2)) for i in range(10)]
    batch = spark.createDataFrame(rows, ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in COUPONS.fields)).coalesce(1)
    plain, packed = str(tmp_path / "plain"), str(tmp_path / "packed")
    for run in ("r1", "r2"):
        assert bronze.write_bronze(batch, plain, "coupons", "2024-01-01", run) == 10
        assert bronze.write_bronze(batch, packed, "coupons", "2024-01-01", run, compression="gzip") == 10
    assert sorted(p.name.split(".", 1)[1] for p in files(packed)) == ["json.gz"] * 8  # of each run 3, 3, 3 and 1
    expected, stored = (bronze.read_bronze(spark, root, "coupons", COUPONS) for root in (plain, packed))
    assert stored.schema == expected.schema and stored.count() == 20
    assert stored.exceptAll(expected).isEmpty() and expected.exceptAll(stored).isEmpty()


def test_scan_of_all_entities_writes_each_once_and_compressed(spark, tables, tmp_path):
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root))
    scanned = {row["entity"]: tuple(row)[1:] for row in QUERIES["bronze_scan_all"](spark, tables).collect()}
    [landed] = set(os.listdir(root)) - before
    for entity in ENTITIES:
        raw = derive(spark, tables, entity)
        assert scanned[entity] == tuple(raw.selectExpr("count(id)", "count(updated_at)", "sum(length(created_at))").first())
        stored = bronze.read_bronze(spark, f"{root}/{landed}", entity, ENTITY_SPECS[entity].schema)
        assert stored.count() == 3000
        raw.write.json(f"{tmp_path}/{entity}")
        packed, plain = (sum(p.stat().st_size for p in files(f"{folder}/{entity}")) for folder in (f"{root}/{landed}", tmp_path))
        assert packed < plain / 3
    assert all(p.name.endswith(".json.gz") for p in files(f"{root}/{landed}"))
