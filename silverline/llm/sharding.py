"""Hierarchical weighted hash tree: rows descend region, rack and shard by weighted hash draws.

At each level every child draws ``-ln(u) / weight`` from a hash of the key and the child's path; the smallest draw
wins, so a child is taken in proportion to its weight, and a child whose weight changes only gains or loses rows
itself. Weights of inner nodes are the sums of their shards' weights. A change below one node moves rows inside
that subtree and between it and its siblings, never among the siblings.

Draws read the key alone: no shuffle, no state, the same answer on every run. Null keys are one key. A shard of
weight zero or less gets no rows.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import hash_bucket, running_total, split_count


@dataclass(frozen=True)
class Shard:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def shard_tree(shards: int, racks_per_region: int = 2, shards_per_rack: int = 2, base: int = 8) -> list[Shard]:
    """The tree of a shard count: ``base`` shards fill regions; every later shard founds a region of its own.

    So from ``base`` shards on, the tree of one more shard has one more region and all other weights unchanged, and
    rows move only into it.
    """
    per_region = racks_per_region * shards_per_rack
    tree = []
    for s in range(min(shards, base)):
        tree.append(Shard(s // per_region, s % per_region // shards_per_rack, s))
    founded = -(-base // per_region)
    tree += [Shard(founded + s - base, 0, s) for s in range(base, shards)]
    return tree


def _draw(key: Column, path: tuple[int, ...], weight: float) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, *[F.lit(p) for p in path]), 11)
    uniform = (bits.cast("double") + 0.5) * F.lit(2.0**-53)
    return -F.log(uniform) / F.lit(weight)


def _descend(key: Column, shards: list[Shard], level: int, path: tuple[int, ...]) -> Column:
    if level == 3:
        return F.lit(shards[0].shard)
    children: dict[int, list[Shard]] = {}
    for s in shards:
        children.setdefault((s.region, s.rack, s.shard)[level], []).append(s)
    below = {c: _descend(key, rows, level + 1, (*path, c)) for c, rows in children.items()}
    if len(children) == 1:
        return next(iter(below.values()))
    draws = [
        F.struct(_draw(key, (*path, c), sum(s.weight for s in rows)).alias("draw"), F.lit(c).alias("child"))
        for c, rows in children.items()
    ]
    winner = F.least(*draws)["child"]
    chosen = None
    for c, shard in below.items():
        chosen = F.when(winner == c, shard) if chosen is None else chosen.when(winner == c, shard)
    return chosen


def shard_of(key: Column, tree: Iterable[Shard]) -> Column:
    """The shard a key falls into."""
    live = sorted((s for s in tree if s.weight > 0), key=lambda s: (s.region, s.rack, s.shard))
    if not live:
        raise ValueError("a tree needs a shard of positive weight")
    return _descend(key, live, 0, ())


def assign_shards(docs: DataFrame, shards: int, key: str = "doc_id") -> DataFrame:
    """One row per document: its size, checksum, shard, place in the shard and shard after one more shard joins.

    A null text counts one byte and has the checksum of the empty text. Repeated rows go to the same shard and get
    slots of their own; rows that are equal in all of key, size and checksum may swap theirs. Other columns of the
    input are not read. An empty table gives an empty table.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    sized = docs.select(
        F.col(key).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"),
    )
    placed = sized.select(
        "*",
        F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), shard_tree(shards)).alias("shard"),
        shard_of(F.col("doc_id"), shard_tree(shards + 1)).alias("grown_shard"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    bucket = hash_bucket(split_count(docs.count()), "doc_id", "text_crc32", "size")
    slotted = running_total(placed, ["shard"], bucket, order, F.lit(1).cast("long"), "slot")
    return slotted.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
