"""Best-two-fit packing of documents into token sequences.

A sequence is filled greedily, longest fitting piece first. Then its smallest piece gives way to the two unpacked
pieces that together fit the gap it leaves more tightly, if there are such. Pieces of one length are alike, so the
plan is made on how many pieces each length has: a table of at most ``capacity`` rows, whatever the corpus. A way to
fill a sequence is used as often as the counts allow, which gives what filling one sequence after another would.
Spark then ranks the pieces of each length and looks up the place of each rank.

Defined cases: a null or empty text is one piece holding the end token; repeated rows and equal ids are packed each;
pieces of one length may swap places only if equal in id, number and checksum; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed, running_total
from silverline.llm.tokens import word_tokenizer

CAPACITY = 2048
END = b"\0\0\0\0"


def default_vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False) -> DataFrame:
    """The pieces of every document: its ids and an end token, cut after each ``capacity`` ids."""
    path = vocabulary or default_vocabulary()

    def cut(batches: Iterator) -> Iterator:
        import pyarrow as pa

        tokenizer = word_tokenizer(path)
        for batch in batches:
            ids, rows = batch.column(0), {"row": [], "piece": [], "start": [], "length": [], "ids_crc32": [], "ids": []}
            for i, text in enumerate(batch.column(1)):
                tokens = tokenizer.ids(text.as_py() or "") + END
                for start in range(0, len(tokens), 4 * capacity):
                    piece = tokens[start : start + 4 * capacity]
                    rows["row"].append(i)
                    rows["piece"].append(start // (4 * capacity))
                    rows["start"].append(start // 4)
                    rows["length"].append(len(piece) // 4)
                    rows["ids_crc32"].append(zlib.crc32(piece))
                    rows["ids"].append(piece if with_ids else b"")
            out = {
                "doc_id": ids.take(pa.array(rows["row"], pa.int64())),
                "piece": pa.array(rows["piece"], pa.int32()),
                **{c: pa.array(rows[c], pa.int64()) for c in ("start", "length", "ids_crc32")},
            }
            if with_ids:
                out["ids"] = pa.array(rows["ids"], pa.binary())
            yield pa.RecordBatch.from_pydict(out)

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return docs.select("doc_id", "text").mapInArrow(cut, schema)


def fill_one(counts: np.ndarray, capacity: int) -> dict[int, int]:
    """One sequence: how many pieces of which length, longest first."""
    free = np.flatnonzero(counts)
    lengths = free.tolist()
    taken: dict[int, int] = {}
    gap = capacity
    while gap > 0 and (at := bisect_right(lengths, gap)):
        length = lengths[at - 1]
        number = min(gap // length, int(counts[length]))
        taken[length] = number
        gap -= number * length
        lengths = lengths[: at - 1]
    smallest = min(taken)
    room = gap + smallest
    if gap and sum(taken.values()) > 1:
        left = counts.copy()
        for length, number in taken.items():
            left[length] -= number
        free = np.flatnonzero(left)
        free = free[free < room]
        if len(free):
            at = np.searchsorted(free, room - free, "right") - 1
            twice = (at >= 0) & (free[at] == free) & (left[free] < 2)
            at = np.where(twice, at - 1, at)
            fit = np.where(at >= 0, free + free[at], 0)
            best = int(np.argmax(fit))
            if fit[best] > smallest:
                taken[smallest] -= 1
                for length in (int(free[best]), int(free[at[best]])):
                    taken[length] = taken.get(length, 0) + 1
    return {length: taken[length] for length in sorted(taken, reverse=True) if taken[length]}


def packing_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Rows ``(length, first rank, end of ranks, pieces a sequence, first sequence, offset)``.

    The piece of rank r in its length goes to sequence ``first + (r - first rank) / pieces`` at
    ``offset + (r - first rank) % pieces * length``. At least one length runs short with each way of filling, so there
    are some thousand rows for a capacity of 2048.
    """
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, number in histogram.items():
        counts[length] = number
    ranks = np.zeros(capacity + 1, dtype=np.int64)
    rows, sequence = [], 0
    while counts.any():
        taken = fill_one(counts, capacity)
        times = min(int(counts[length]) // number for length, number in taken.items())
        offset = 0
        for length, number in taken.items():
            first = int(ranks[length])
            rows.append((length, first, first + times * number, number, sequence, offset))
            ranks[length] += times * number
            counts[length] -= times * number
            offset += number * length
        sequence += times
    return rows


def pack_documents(docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of all documents with their sequence and their offset in it."""
    spark = docs.sparkSession
    pieces = checkpointed(token_pieces(docs, vocabulary, capacity))
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most
    parts = spark.createDataFrame(
        [(length, math.isqrt(n)) for length, n in histogram.items()], "__length long, __parts int"
    )
    plan = spark.createDataFrame(
        packing_plan(histogram, capacity), "__length long, __from long, __until long, __number long, __sequence long, __offset0 long"
    )
    spread = pieces.join(F.broadcast(parts), F.col("length") == F.col("__length")).drop("__length")
    bucket = F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.col("__parts")).cast("int")
    order = [F.col("doc_id"), F.col("piece"), F.col("ids_crc32")]
    ranked = running_total(spread, ["length"], bucket, order, F.lit(1).cast("long"), "__rank")
    at = F.col("__rank") - F.col("__from")
    held = (F.col("length") == F.col("__length")) & (F.col("__rank") >= F.col("__from")) & (F.col("__rank") < F.col("__until"))
    placed = ranked.join(F.broadcast(plan), held)  # some thousand rows, bounded by the capacity
    return placed.select(
        "doc_id", "piece", "start", "length", "ids_crc32",
        (F.col("__sequence") + F.floor(at / F.col("__number"))).alias("sequence_id"),
        (F.col("__offset0") + F.pmod(at, F.col("__number")) * F.col("length")).alias("offset"),
    )


def packed_sequences(docs: DataFrame, packing: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY) -> DataFrame:
    """The sequences themselves: ``sequence_id`` and the ids of its pieces one after another, little-endian 32-bit."""
    keys = ["doc_id", "piece", "ids_crc32"]
    ids = token_pieces(docs, vocabulary, capacity, with_ids=True).dropDuplicates(keys)
    same = [packing[k].eqNullSafe(ids[k]) for k in keys]
    parts = packing.join(ids, same).select("sequence_id", F.struct("offset", "ids").alias("part"))
    ordered = F.sort_array(F.collect_list("part"))  # capacity ids at most
    joined = F.aggregate(ordered, F.lit(b"").cast("binary"), lambda all_ids, part: F.concat(all_ids, part["ids"]))
    return parts.groupBy("sequence_id").agg(joined.alias("ids"))
