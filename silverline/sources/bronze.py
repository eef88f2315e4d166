"""Bronze: raw JSON batches, one folder per entity, ingestion date and run."""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DateType, LongType, StringType, StructField, StructType

BATCH_FIELDS = [StructField("ingestion_date", DateType()), StructField("run_id", StringType())]


def bronze_path(root: str, entity: str) -> str:
    return f"{root.rstrip('/')}/{entity}"


def batch_schema(schema: StructType, corrupt_column: str | None = None) -> StructType:
    """Declared columns, the batch columns, and optionally one for unreadable records."""
    extra = [StructField(corrupt_column, StringType())] if corrupt_column else []
    return StructType([*schema.fields, *extra, *BATCH_FIELDS])


def read_bronze(
    spark: SparkSession,
    root: str,
    entity: str,
    schema: StructType,
    multi_line: bool = False,
    corrupt_column: str | None = None,
) -> DataFrame:
    """Scan all batches of an entity with its declared schema.

    No inference pass runs. Line-delimited files, which :func:`write_bronze` makes, are
    split over tasks unless compressed; ``multi_line`` reads files that hold one JSON array each, by
    :func:`read_arrays`. Filter on ``ingestion_date`` or ``run_id`` to read only those folders.
    """
    declared = batch_schema(schema, corrupt_column)
    if multi_line:
        return read_arrays(spark, bronze_path(root, entity), schema, corrupt_column).select(*declared.fieldNames())
    reader = spark.read.schema(declared)
    if corrupt_column:
        reader = reader.option("columnNameOfCorruptRecord", corrupt_column)
    return reader.json(bronze_path(root, entity)).select(*declared.fieldNames())


def _bytes(size: str) -> int:
    """A size as settings spell it, such as ``128MB``."""
    number, unit = re.fullmatch(r"(\d+)\s*([a-z]?)b?", size.strip().lower()).groups()
    return int(number) << {"": 0, "b": 0, "k": 10, "m": 20, "g": 30, "t": 40}[unit]


def _head(text: DataFrame) -> list[Row]:
    """The first lines of the first file of the first task, which is one of the largest."""
    meta = [F.col(f"_metadata.{name}") for name in ("file_block_start", "file_size")]
    return text.select(F.left("value", F.lit(200)).alias("value"), *meta).limit(20).collect()


def _record_ends(head: list[Row]) -> tuple[str, str] | None:
    """How lines end and how records are indented; None if that does not tell records apart."""
    lines = [row["value"] for row in head if row["file_block_start"] == 0]
    depth = lambda line: len(line) - len(line.lstrip())
    for line, inner in zip(lines, lines[1:], strict=False):
        if line.strip() == "{":  # what stands deeper than its record cannot be taken for the end of one
            indent = line[: line.index("{")]
            return ("\r\n" if line.endswith("\r") else "\n", indent) if depth(inner) > len(indent) else None
    return None


def read_arrays(
    spark: SparkSession, path: str, schema: StructType, corrupt_column: str | None = None, split: bool | None = None
) -> DataFrame:
    """Files that hold one JSON array of records each.

    Indented files can be split over tasks like lines: JSON has no line break within a
    string, so a line that is a record's indentation and ``},`` ends a record and nothing
    else, and serves as the separator of lines. A file that is indented otherwise than the
    first, or not at all, comes as one line. Of a record that cannot be read the columns are
    NULL and ``corrupt_column`` is its text.

    Splitting costs about twice the time of reading a file whole, and spares one task from
    reading a large one alone; by default it is done where a file is larger than what a task
    should read, or where ``corrupt_column`` asks which record is broken. A file read whole
    that has a broken record is one row of NULLs; ``split=True`` confines that to the record.
    """
    lines = spark.read.text(path)
    found = [f.name for f in BATCH_FIELDS if f.name in lines.columns]
    head = _head(lines)
    if split is None:
        share = spark.conf.get("spark.sql.files.maxPartitionBytes")
        split = corrupt_column is not None or any(row["file_size"] > _bytes(share) for row in head)
    ends = _record_ends(head) if split else None
    if ends is None:
        reader = spark.read.schema(batch_schema(schema, corrupt_column)).option("multiLine", True)
        return (reader.option("columnNameOfCorruptRecord", corrupt_column) if corrupt_column else reader).json(path)
    newline, indent = ends
    stored = StructType([StructField("value", StringType()), *[f for f in BATCH_FIELDS if f.name in found]])
    parts = spark.read.schema(stored).option("lineSep", f"{newline}{indent}}},{newline}").text(path)

    value = F.col("value")
    opening = F.when(value.startswith("["), "").otherwise("[")
    parsed = lambda end: F.from_json(F.concat(opening, value, F.lit(end)), ArrayType(schema))
    last = F.right(value, F.lit(len(indent) + 20)).rlike(rf"\n{indent}\}}\s*\]\s*$")
    # the last record of a file is whole, others have lost their end; then files that were not split, and lone records
    records = F.when(last, parsed("")).otherwise(F.coalesce(parsed("}]"), parsed(""), parsed("]")))
    none = F.array(F.lit(None).cast(schema))
    rows = parts.where(value.rlike(r"\S")).select("*", F.explode(F.coalesce(records, none)).alias("record_"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in BATCH_FIELDS if f.name not in found]
    corrupt = [F.when(F.col("record_").isNull(), value).alias(corrupt_column)] if corrupt_column else []
    return rows.select("record_.*", *corrupt, *found, *missing)


def read_all_bronze(
    spark: SparkSession, root: str, schemas: Mapping[str, StructType], multi_line: bool = False
) -> dict[str, DataFrame]:
    return {entity: read_bronze(spark, root, entity, schema, multi_line) for entity, schema in schemas.items()}


def read_pages(
    spark: SparkSession, path: str | Iterable[str], schema: StructType, multi_line: bool = False
) -> DataFrame:
    """Saved API pages: ``{"data": [records], "total": n}``, one per row."""
    envelope = StructType([StructField("data", ArrayType(schema)), StructField("total", LongType())])
    paths = path if isinstance(path, str) else list(path)
    return spark.read.schema(envelope).option("multiLine", multi_line).json(paths)


def page_records(pages: DataFrame) -> DataFrame:
    """The records of all pages as rows; an empty page gives none."""
    return pages.select(F.explode("data").alias("record")).select("record.*")


def page_completeness(pages: DataFrame) -> DataFrame:
    """Records received, records the server announced, and whether they agree."""
    return pages.agg(
        F.coalesce(F.sum(F.size("data")), F.lit(0)).alias("received"),
        F.coalesce(F.max("total"), F.lit(0)).alias("announced"),
    ).withColumn("complete", F.col("received") == F.col("announced"))


def write_bronze(
    df: DataFrame, root: str, entity: str, ingestion_date: str, run_id: str, compression: str | None = None
) -> int:
    """Land one batch and return its row count; an empty batch writes nothing."""
    return write_bronze_counted(df, root, entity, ingestion_date, run_id, compression=compression)["rows"]


# Compressed files cannot be split over tasks: none holds more records than one task reads well.
RECORDS_A_COMPRESSED_FILE = 500_000


def write_bronze_counted(
    df: DataFrame,
    root: str,
    entity: str,
    ingestion_date: str,
    run_id: str,
    counts: Mapping[str, Column] | None = None,
    compression: str | None = None,
) -> dict[str, int]:
    """Land one batch and return its number of ``rows`` and the named aggregates.

    Each run has its own folder, so a second run of the day adds to the first, and a
    repeated run replaces only itself. Rows are counted while they are written. Whether
    there are any is asked first, up to the first row; persist a selective batch before.

    With a ``compression`` such as ``gzip`` the records take about a sixth of the disk, and
    are read as others are. A task writes a file for every ``RECORDS_A_COMPRESSED_FILE`` records.
    """
    if df.isEmpty():
        return dict.fromkeys(["rows", *(counts or {})], 0)
    counted = Observation()
    aggregates = [F.count(F.lit(1)).alias("rows"), *[c.alias(name) for name, c in (counts or {}).items()]]
    writer = df.observe(counted, *aggregates).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression).option("maxRecordsPerFile", RECORDS_A_COMPRESSED_FILE)
    writer.json(f"{bronze_path(root, entity)}/ingestion_date={ingestion_date}/run_id={run_id}")
    return counted.get
