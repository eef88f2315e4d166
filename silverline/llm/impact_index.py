"""Exact top-k by inner product over an impact-ordered index, score at a time.

Components are quantised to integers ``floor(256 * x)``, their impacts. The index holds, for each block of vectors,
one segment per level of impact: the postings (dimension, vector, impact) whose absolute impact has that bit length.
A block is searched level by level, largest impacts first. The impacts not yet seen of a vector have a known norm, so
by Cauchy and Schwarz its score lies within ``|query| * norm`` of the sum so far. Once few vectors can still be among
the best k of the block, processing stops; those are scored exactly. Nothing else ends the search but the last level.

Defined cases: rows without an id, with a null vector or a null, NaN or infinite component take no part; rows of one
id count once; vectors of different length compare as if filled up with zeros; ties go to the smaller id; scores
beyond a long stop at its ends; an empty table or a table without queries gives an empty result.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed
from silverline.llm.tiles import best_of, block_count, every, in_block, matrix, merged, tiled, usable_vectors, widen

BLOCK, QUERIES_A_BLOCK, BATCH = 8192, 4096, 256
INDEX_SCHEMA = "block int, level int, size int, dims binary, places binary, impacts binary"
_FEW = 8  # vectors a query, times k, that are scored without another level
_LONG = 2**63


def build_index(quantised: DataFrame, blocks: int) -> DataFrame:
    """Segments of ``(vec_id, vector)`` rows; level -1 holds the ids of the block's vectors."""

    def segments(table):
        import pyarrow as pa

        vectors = matrix(table.column("vector"))
        rows = [(-1, b"", b"", table.column("vec_id").to_numpy().astype(np.int64).tobytes())]
        levels = np.frexp(np.abs(vectors))[1] * (vectors != 0)
        for level in range(int(levels.max(initial=0)), 0, -1):
            places, dims = np.nonzero(levels == level)
            if len(dims):
                rows.append((level, dims.astype(np.int32).tobytes(), places.astype(np.int32).tobytes(), vectors[places, dims].tobytes()))
        level, dims, places, impacts = zip(*rows, strict=True)
        n = len(rows)
        block = pa.array([table.column("block")[0].as_py()] * n, pa.int32())
        columns = [block, pa.array(level, pa.int32()), pa.array([len(vectors)] * n, pa.int32())]
        columns += [pa.array(x, pa.binary()) for x in (dims, places, impacts)]
        return pa.Table.from_arrays(columns, ["block", "level", "size", "dims", "places", "impacts"])

    blocked = quantised.withColumn("block", in_block(blocks))
    return blocked.groupBy("block").applyInArrow(segments, INDEX_SCHEMA)


def _read_block(table) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ids of a block and its levels, largest first, each as a matrix (dimension, vector)."""
    rows = sorted(table.select(["level", "size", "dims", "places", "impacts"]).to_pylist(), key=lambda r: -r["level"])
    ids = np.frombuffer(next(r["impacts"] for r in rows if r["level"] == -1), np.int64)
    parts = [[np.frombuffer(r[c], t) for c, t in (("dims", np.int32), ("places", np.int32), ("impacts", np.float64))] for r in rows if r["level"] >= 0]
    width = max((int(dims.max()) + 1 for dims, _, _ in parts), default=0)
    levels = []
    for dims, places, impacts in parts:
        level = np.zeros((width, len(ids)))
        level[dims, places] = impacts
        levels.append(level)
    return ids, levels


def score_at_a_time(queries: np.ndarray, own: np.ndarray, ids: np.ndarray, levels: list[np.ndarray], k: int):
    """Pairs (query, vector) that hold the best ``k`` of every query for certain, ``own`` ids apart, and levels used."""
    total = np.zeros((len(queries), len(ids)))
    other = own[:, None] != ids[None, :]
    left = sum((level * level).sum(0) for level in levels) if levels else np.zeros(len(ids))
    norms = np.sqrt((queries * queries).sum(1)) * (1 + 1e-9)
    alive, used = other, 0
    for level in levels:
        total += queries @ level
        left = left - (level * level).sum(0)
        used += 1
        reach = norms[:, None] * np.sqrt(np.maximum(left, 0))[None, :]
        reach += np.abs(total) * 1e-9
        if len(ids) > k + 1:
            sure = np.where(other, total - reach, -np.inf)
            least = np.partition(sure, len(ids) - k, axis=1)[:, len(ids) - k]
            alive = other & (total + reach >= least[:, None])
            if alive.sum() <= _FEW * k * len(queries):
                break
    return (*np.nonzero(alive), used)


def exact_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of paired rows; in Python integers where doubles would not hold them."""
    if not len(a) or np.abs(a).max(initial=0) * np.abs(b).max(initial=0) * max(1, a.shape[1]) < 2**53:
        return np.rint((a * b).sum(1)).astype(np.int64)
    sums = [sum(int(x) * int(y) for x, y in zip(p, q, strict=True)) for p, q in zip(a, b, strict=True)]
    return np.array([min(max(s, -_LONG), _LONG - 1) for s in sums], dtype=np.int64)


def search(index: DataFrame, queries: DataFrame, blocks: int, query_blocks: int, k: int) -> DataFrame:
    """The best ``k`` vectors of each query ``(vec_id, vector)``."""

    def tile(key, left, right):
        import pyarrow as pa

        out = [[], [], []]
        if left.num_rows and right.num_rows:
            ids, levels = _read_block(left)
            asked, q_ids = matrix(right.column("vector")), right.column("vec_id").to_numpy().astype(np.int64)
            width = max(asked.shape[1], levels[0].shape[0] if levels else 0)
            asked = widen(asked, width)
            levels = [widen(level.T, width).T for level in levels]
            vectors = sum(levels).T if levels else np.zeros((len(ids), width))
            for at in range(0, len(asked), BATCH):
                part, own = asked[at : at + BATCH], q_ids[at : at + BATCH]
                rows, cols, _ = score_at_a_time(part, own, ids, levels, k)
                for cut in np.array_split(np.arange(len(rows)), max(1, len(rows) // 100_000)):
                    r, c = rows[cut], cols[cut]
                    scores = exact_scores(part[r], vectors[c])
                    # an array part may divide a query's pairs; the merge over blocks puts them together
                    best = best_of(r, ids[c], scores, k)
                    for to, values in zip(out, (own[r[best]], ids[c[best]], scores[best]), strict=True):
                        to.append(values)
        names = ["query_id", "vec_id", "score"]
        return pa.Table.from_arrays([pa.array(np.concatenate(x) if x else [], pa.int64()) for x in out], names)

    left = index.withColumn("__q", every(query_blocks)).withColumnRenamed("block", "__v")
    right = queries.select("vec_id", "vector", in_block(query_blocks).alias("__q"), every(blocks).alias("__v"))
    found = tiled(left, right, tile, "query_id long, vec_id long, score long")
    return merged(found, k)


def impact_top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256) -> DataFrame:
    """For each row that ``is_query`` (a condition on ``vec_id``) the ``k`` other rows of highest integer inner product."""
    # floor() gives a long; doubles too large for that are integers already
    whole = lambda x: F.when(F.abs(x) < 2**52, F.floor(x)).cast("double")
    scaled = F.transform("vector", lambda x: x.cast("double") * scale)
    floors = F.transform(scaled, lambda x: F.coalesce(whole(x), x))
    usable = checkpointed(usable_vectors(vectors).select(F.col("vec_id").cast("long").alias("vec_id"), floors.alias("vector")))
    queries = usable.where(is_query)
    blocks, query_blocks = block_count(usable.count(), BLOCK), block_count(queries.count(), QUERIES_A_BLOCK)
    return search(build_index(usable, blocks), queries, blocks, query_blocks, k)

