"""Benchmark decontamination with an FM-index for every shard of the training texts.

A task cuts its documents into shards of a bounded number of words and indexes each (:mod:`silverline.llm.fm_index`);
texts that repeat within a shard are indexed once, and a text longer than a shard is cut into pieces that overlap by a
window less one word. The index is a table of its own, one row a shard, written to the shared folder: it does not depend
on the benchmark and needs no shuffle. The benchmark's windows of ``WINDOW`` consecutive words are searched in blocks of
a bounded number of windows, each sent to all shards; an item of fewer words is one window. Backward search gives the
suffixes that begin with a window, sampled places tell where they are, and spans that overlap are merged.

Words are what stands between bytes that are neither digits nor letters nor beyond ASCII, with A-Z in lower case, and are
told apart by 64-bit hashes. Defined cases: a null text has no words; each row is a document, also where ids repeat or
are null; an item without words, or without a text, has no windows; repeated items are one; an item without an id marks
words but is not listed; an empty benchmark marks nothing; an empty table of documents gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from silverline.llm.common import checkpointed, shared_folder
from silverline.llm.fm_index import FmIndex
from silverline.llm.hashing import hashed_words

WINDOW = 10  # words
SHARD_WORDS = 1 << 20
BLOCK = 200_000  # windows of items searched at a time: at most 80 bytes each, beside the ids of items

# Bytes between words: all but digits, letters and what lies beyond ASCII.
_APART = np.ones(256, dtype=bool)
_APART[[*b"0123456789abcdefghijklmnopqrstuvwxyz", *range(0x80, 0x100)]] = False

_LISTED = ("keys", "doc_ids", "text_hashes", "n_words")
_PARTS = "starts vocabulary base zeros marks mark_counts samples planes counts".split()


def _hashes(column) -> Iterator[np.ndarray]:
    """The word hashes of each text of an Arrow column, a few texts at a time."""
    for at in range(0, len(column), 500):
        texts = [value.as_py() or b"" for value in column.slice(at, 500).cast("binary")]
        yield from hashed_words([t.lower() for t in texts], _APART)


class _Shard:
    """Documents of a task until they are enough for an index."""

    def __init__(self):
        self.listed, self.members, self.numbers, self.texts, self.firsts, self.held = [], [], {}, [], [], 0

    def add(self, key: int, words: np.ndarray, first: int) -> None:
        content = (first, hashlib.blake2b(words.tobytes(), digest_size=16).digest())
        number = self.numbers.setdefault(content, len(self.texts))
        if number == len(self.texts):
            self.texts.append(words)
            self.firsts.append(first)
            self.held += len(words) + 1
        self.members.append((key, number))

    def row(self) -> dict:
        index = FmIndex.build(self.texts) if self.texts else None
        row = dict(zip(_LISTED, map(list, zip(*self.listed, strict=True)), strict=True)) if self.listed else {}
        row |= {"member_keys": [k for k, _ in self.members], "member_texts": [t for _, t in self.members], "firsts": self.firsts}
        return row | {"size": index.n if index else 0} | (index.to_columns() if index else {})


def build_index(docs: DataFrame, overlap: int = WINDOW - 1) -> DataFrame:
    """A row for each shard: its documents, the texts they have, and the FM-index of those texts.

    A text of ``overlap`` words or more beyond a shard's size stands in pieces that share so many words.
    """
    most = SHARD_WORDS  # as it is when the job is planned
    kind = docs.schema["doc_id"].dataType.simpleString()
    ddl = f"keys array<long>, doc_ids array<{kind}>, text_hashes array<long>, n_words array<long>, member_keys array<long>, member_texts array<int>, firsts array<long>, size long, "
    schema = StructType.fromDDL(ddl + ", ".join(f"{part} binary" for part in _PARTS))

    def shards(batches: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema

        to = to_arrow_schema(schema)
        key = TaskContext.get().partitionId() << 40  # documents of a task are numbered from here
        shard = _Shard()

        def done() -> Iterator:
            nonlocal shard
            row, shard = shard.row(), _Shard()
            yield pa.RecordBatch.from_pylist([row], to)

        for batch in batches:
            for doc_id, text_hash, words in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist(), _hashes(batch.column(1)), strict=True):
                shard.listed.append((key, doc_id, text_hash, len(words)))
                for first in range(0, max(1, len(words) - overlap), most - overlap) if len(words) > most else (0,):
                    piece = words[first : first + most]
                    if shard.held and shard.held + len(piece) >= most:
                        yield from done()
                    if len(piece):
                        shard.add(key, piece, first)
                key += 1
                if len(shard.listed) >= most:
                    yield from done()
        if shard.listed or shard.members:
            yield from done()

    return docs.select("doc_id", "text", F.xxhash64("text")).mapInArrow(shards, schema)


def item_windows(benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """Distinct rows ``(item, words)``: the windows of each item as the hashes of their words."""

    def windows(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for item, words in zip(batch.column(0).to_pylist(), _hashes(batch.column(1)), strict=True):
                size = min(window, len(words))
                if not size:
                    continue
                for at in range(0, len(words) - size + 1, 100_000):
                    found = np.unique(np.lib.stride_tricks.sliding_window_view(words[at : at + 100_000 + size - 1], size), axis=0)
                    columns = [pa.array([item] * len(found), pa.string()), pa.array([row.tobytes() for row in found], pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, ["item", "words"])

    asked = benchmark.select(F.col("item_id").cast("string"), "text").where("text IS NOT NULL")
    return asked.mapInArrow(windows, "item string, words binary").distinct()


def _phrases(rows, window: int) -> dict:
    """A block of windows: distinct phrases, right aligned, and the items of each."""
    words = rows.column("words").combine_chunks().dictionary_encode()
    phrases = words.dictionary.to_pylist()
    aligned, lengths = np.zeros((len(phrases), window), np.uint64), np.array([len(p) // 8 for p in phrases], np.int64)
    for row, phrase in zip(aligned, phrases, strict=True):
        row[window - len(phrase) // 8 :] = np.frombuffer(phrase, np.uint64)
    number = words.indices.to_numpy()
    by = np.argsort(number, kind="stable")
    items = rows.column("item").combine_chunks().dictionary_encode()
    which = items.indices.fill_null(-1).to_numpy()[by]
    return {"aligned": aligned, "lengths": lengths, "borders": np.searchsorted(number[by], np.arange(len(phrases) + 1)), "items": which, "names": items.dictionary.to_pylist()}


def _stretch(first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers ``first, first + 1, ...``, as many as ``size`` says, one stretch after the other."""
    before = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(first - before, size)


def _found(row: dict, block: dict) -> Iterator[tuple[int, list, list]]:
    """For each text of a shard with a window in it: its number, its merged spans and the items found."""
    index = FmIndex.from_columns(row["size"], row)
    first, last = index.rows(block["aligned"], block["lengths"])
    phrase = np.repeat(np.arange(len(first)), last - first)
    at = index.places(_stretch(first, last - first))
    text = np.searchsorted(index.starts, at, side="right") - 1
    start = at - index.starts[text] + np.asarray(row["firsts"], np.int64)[text]
    order = np.lexsort((start, text))
    text, start, phrase = text[order], start[order], phrase[order]
    end = start + block["lengths"][phrase]
    # items of each text, each once
    pairs = np.unique(text * len(first) + phrase)
    counts = np.diff(block["borders"])[pairs % len(first)]
    items = block["items"][_stretch(block["borders"][pairs % len(first)], counts)]
    known = np.unique(np.stack([np.repeat(pairs // len(first), counts), items], 1)[items >= 0], axis=0)
    # spans that touch are one
    borders = np.flatnonzero(np.r_[True, text[1:] != text[:-1], True]) if len(text) else np.zeros(1, int)
    for low, high in zip(borders[:-1], borders[1:], strict=True):
        reach = np.maximum.accumulate(end[low:high])
        new = np.flatnonzero(np.r_[True, start[low + 1 : high] > reach[:-1]])
        spans = np.stack([start[low:high][new], reach[np.r_[new[1:] - 1, high - low - 1]]], 1)
        own = known[slice(*np.searchsorted(known[:, 0], [text[low], text[low] + 1])), 1]
        yield int(text[low]), spans.tolist(), [block["names"][i] for i in own]


def search(index: DataFrame, windows: DataFrame, window: int = WINDOW) -> DataFrame:
    """Rows ``(key, spans, items)`` of documents of the index that hold windows: one for each piece and block of windows."""
    spark = index.sparkSession
    schema = "key long, spans array<struct<start:long,end:long>>, items array<string>"
    windows = checkpointed(windows)
    blocks = -(-windows.count() // BLOCK)
    found = spark.createDataFrame([], schema)
    for number in range(blocks):
        rows = windows.where(F.pmod(F.xxhash64("words", "item"), F.lit(blocks)) == number)
        block = spark.sparkContext.broadcast(_phrases(rows.toArrow(), window))  # BLOCK rows or so, however large the benchmark

        def occurrences(batches: Iterator, block=block) -> Iterator:
            import pyarrow as pa

            kind = pa.struct([("start", pa.int64()), ("end", pa.int64())])
            for batch in batches:
                for at in range(batch.num_rows):
                    row = {name: batch.column(name)[at].as_py() for name in batch.schema.names}
                    if not row["size"] or not len(block.value["lengths"]):
                        continue
                    members: dict[int, list[int]] = {}
                    for key, text in zip(row["member_keys"], row["member_texts"], strict=True):
                        members.setdefault(text, []).append(key)
                    for text, spans, items in _found(row, block.value):
                        keys = members[text]
                        spans = [{"start": a, "end": b} for a, b in spans]
                        for low in range(0, len(keys), 1000):
                            part = keys[low : low + 1000]
                            columns = [pa.array(part, pa.int64()), pa.array([spans] * len(part), pa.list_(kind)), pa.array([items] * len(part), pa.list_(pa.string()))]
                            yield pa.RecordBatch.from_arrays(columns, ["key", "spans", "items"])

        held = index.select("size", "member_keys", "member_texts", "firsts", *_PARTS)
        found = found.unionByName(held.mapInArrow(occurrences, schema))
    return found


def merged_spans(found: DataFrame) -> DataFrame:
    """Rows ``(key, n_hit, spans, items)``, one for each document found: spans that overlap or touch are one."""
    along = Window.partitionBy("key").orderBy("start", "end")
    before = along.rowsBetween(Window.unboundedPreceding, -1)
    each = found.select("key", F.explode("spans").alias("span")).select("key", "span.start", "span.end")
    begins = F.coalesce(F.col("start") > F.max("end").over(before), F.lit(True))
    islands = each.withColumn("begins", begins).withColumn("island", F.count_if("begins").over(along))
    spans = islands.groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    spans = spans.groupBy("key").agg(
        F.sum(F.col("end") - F.col("start")).alias("n_hit"), F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")
    )
    items = found.groupBy("key").agg(F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    return spans.join(items, "key")


def find_contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """For each document ``n_words``, ``n_hit``, the merged ``spans`` of words to remove and the ``items`` found in it."""
    spark: SparkSession = docs.sparkSession
    path = f"{shared_folder(spark)}/fm-index-{uuid.uuid4().hex}"
    build_index(docs, window - 1).write.parquet(path)
    index = spark.read.parquet(path)
    documents = index.select(F.explode(F.arrays_zip(*_LISTED)).alias("d")).select(
        *[F.col(f"d.{held}").alias(name) for held, name in zip(_LISTED, ("key", "doc_id", "text_hash", "n_words"), strict=True)]
    )
    hits = merged_spans(checkpointed(search(index, item_windows(benchmark, window), window)))  # read twice
    none = F.array().cast("array<string>")
    return documents.join(hits, "key", "left").select(
        "doc_id",
        "text_hash",
        "n_words",
        F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
        F.coalesce("spans", F.array().cast("array<struct<start:long,end:long>>")).alias("spans"),
        F.coalesce("items", none).alias("items"),
    )


def digest(found: DataFrame) -> DataFrame:
    """The numbers and checksum of what was found, beside the spans."""
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def without_spans(text: str | None, spans: list[tuple[int, int]]) -> str:
    """A text without the words of some merged spans and what stands between them; the rest of it is unchanged."""
    from silverline.llm.hashing import word_spans

    data = (text or "").encode("utf-8", "surrogatepass")
    starts, ends = word_spans(np.frombuffer(data.lower(), np.uint8), _APART)
    kept, at = [], 0
    for first, last in spans:
        kept.append(data[at : starts[first]])
        at = int(ends[last - 1])
    return b"".join([*kept, data[at:]]).decode("utf-8", "surrogatepass")


def remove_spans(docs: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without the words of the spans found in them; all other columns and texts stay as they are."""
    cut = F.udf(lambda text, spans: without_spans(text, [(s["start"], s["end"]) for s in spans or []]), "string", useArrow=True)
    spans = found.where("n_hit > 0").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash"), F.col("spans").alias("__spans"))
    spans = spans.dropDuplicates(["__id", "__hash"])  # rows of one id and text have equal spans
    joined = docs.join(spans, F.col("doc_id").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash")), "left")
    text = F.when(F.col("__spans").isNotNull(), cut("text", "__spans")).otherwise(F.col("text"))
    return joined.withColumn("text", text).select(*docs.columns)
