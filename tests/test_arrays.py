import json

import pytest
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from silverline.sources import bronze

NESTED = StructType([
    StructField("id", LongType()),
    StructField("code", StringType()),
    StructField("tags", ArrayType(StructType([StructField("k", StringType()), StructField("v", ArrayType(LongType()))]))),
])

TRICKY = [
    {"id": 1, "code": 'a "},\n  {" b', "tags": [{"k": "}", "v": [1, 2]}, {"k": "x"}]},
    {"id": 2, "code": "\n  },\n  {\n", "tags": []},
    {"id": 3, "code": "]\n]", "tags": [{"k": "],", "v": []}]},
    {"id": 4, "code": "back\\slash\\", "tags": None, "unknown": {"deep": [{"er": [{}]}]}},
    {"id": 5, "code": "ümläut ✓", "tags": [{"k": None, "v": [9]}]},
]


def written(folder, name, text):
    folder.mkdir(parents=True, exist_ok=True)
    (folder / name).write_bytes(text.encode())


def read(spark, root, **options):
    """The table read whole, which must be that read in parts."""
    parts = bronze.read_arrays(spark, f"{root}/t", NESTED, split=True).select(*bronze.batch_schema(NESTED).fieldNames())
    rows = bronze.read_bronze(spark, str(root), "t", NESTED, multi_line=True, **options)
    assert rows.schema == parts.schema
    assert sorted(map(str, rows.collect())) == sorted(map(str, parts.collect()))
    return sorted(((r.id, r.code, r.tags and [(t.k, t.v) for t in r.tags], str(r.ingestion_date), r.run_id) for r in rows.collect()), key=str)


def expected(records, day="2024-01-01", run=None):
    out = []
    for r in records:
        tags = r.get("tags")
        out.append((r.get("id"), r.get("code"), tags and [(t.get("k"), t.get("v")) for t in tags], day, run))
    return sorted([(a, b, [] if c == [] else c, d, e) for a, b, c, d, e in out], key=str)


@pytest.mark.parametrize("indent", [0, 1, 2, 4, "\t"])
@pytest.mark.parametrize("newline", ["\n", "\r\n"])
def test_records_of_any_content(spark, tmp_path, indent, newline):
    text = json.dumps(TRICKY, indent=indent, ensure_ascii=False).replace("\n", newline)
    written(tmp_path / "t" / "ingestion_date=2024-01-01", "t.json", text + newline)
    assert read(spark, tmp_path) == expected(TRICKY)


def test_files_of_several_kinds(spark, tmp_path):
    days = {
        "2024-01-01": json.dumps(TRICKY * 50, indent=2),
        "2024-01-02": json.dumps(TRICKY, indent=4),
        "2024-01-03": json.dumps(TRICKY),
        "2024-01-04": "[]",
        "2024-01-05": "",
        "2024-01-06": json.dumps(TRICKY[:1], indent=2),
        "2024-01-07": json.dumps(TRICKY[0], indent=2),
    }
    for day, text in days.items():
        written(tmp_path / "t" / f"ingestion_date={day}" / "run_id=000001", "t.json", text)
    wanted = expected(TRICKY * 50, run="000001") + expected(TRICKY, "2024-01-02", "000001") + expected(TRICKY, "2024-01-03", "000001")
    wanted += expected(TRICKY[:1], "2024-01-06", "000001") + expected(TRICKY[:1], "2024-01-07", "000001")
    assert read(spark, tmp_path) == sorted(wanted, key=str)


def test_compact_files_are_read_whole(spark, tmp_path):
    written(tmp_path / "t" / "ingestion_date=2024-01-01", "t.json", json.dumps(TRICKY))
    assert read(spark, tmp_path) == expected(TRICKY)


def test_a_broken_record_is_kept_alone(spark, tmp_path):
    text = json.dumps(TRICKY, indent=2).replace('"id": 3', '"id": 3,,')
    written(tmp_path / "t" / "ingestion_date=2024-01-01", "t.json", text)
    rows = bronze.read_bronze(spark, str(tmp_path), "t", NESTED, multi_line=True, corrupt_column="broken").collect()
    assert sorted(r.id or 0 for r in rows) == [0, 1, 2, 4, 5]
    split = bronze.read_arrays(spark, f"{tmp_path}/t", NESTED, split=True).collect()
    assert sorted(r.id or 0 for r in split) == [0, 1, 2, 4, 5]
    assert [r.id for r in rows if r.broken] == [None] and '"id": 3,,' in next(r.broken for r in rows if r.broken)


def test_one_file_is_split(spark, tmp_path):
    written(tmp_path / "t" / "ingestion_date=2024-01-01", "t.json", json.dumps(TRICKY * 400, indent=2))
    spark.conf.set("spark.sql.files.maxPartitionBytes", 20_000)
    try:
        rows = bronze.read_bronze(spark, str(tmp_path), "t", NESTED, multi_line=True)
        assert rows.rdd.getNumPartitions() > 4
        assert read(spark, tmp_path) == expected(TRICKY * 400)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_sizes_as_settings_spell_them():
    assert [bronze._bytes(x) for x in ("128MB", "16m", "1g", "2048", "64kb", "134217728b")] == [2**27, 2**24, 2**30, 2048, 2**16, 2**27]
