"""Nearest neighbours by inner product as a block matrix join.

A block of queries meets a block of vectors as one product of int8 codes. Each vector is ``scale * code + rest`` with
a rest of known norm, so the product of the codes gives the inner product within
``|coded query| * |rest of vector| + |rest of query| * |vector|``. Pairs that may be among a query's best k by these
bounds are computed again in double precision, kept in a heap per query, and merged over the blocks. Nothing is lost
on the way: recall is 1.

Defined cases: rows without an id, with a null or zero vector or a null, NaN or infinite component take no part; rows
of one id count once; vectors of different length compare as if filled up with zeros; ties go to the smaller id; an
empty table or a table without queries gives an empty result.
"""

from __future__ import annotations

import heapq

import numpy as np
from pyspark.sql import Column, DataFrame

from silverline.llm.common import checkpointed
from silverline.llm.tiles import block_count, every, in_block, matrix, merged, tiled, usable_vectors, widen

BLOCK, QUERIES_A_BLOCK, BATCH = 8192, 4096, 256


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes, scales, norms of what the codes stand for, and norms of the rests (rounded up)."""
    scale = np.abs(vectors).max(1, initial=0) / 127
    scale = np.where(scale > 0, scale, 1.0)
    codes = np.rint(vectors / scale[:, None]).astype(np.int8)
    coded = codes * scale[:, None]
    norm = lambda x: np.sqrt((x * x).sum(1)) * (1 + 1e-9)
    return codes, scale, norm(coded), norm(vectors - coded)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added from the first component to the last."""
    total = np.zeros(len(a))
    for d in range(a.shape[1]):
        total += a[:, d] * b[:, d]
    return total


def possible(queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, ids: np.ndarray, coded_vectors, k: int):
    """Pairs (query, vector) that hold every query's best ``k`` for certain."""
    q_codes, q_scale, q_norm, q_rest = encode(queries)
    codes, scale, _, rest = coded_vectors
    exact = np.float32 if queries.shape[1] <= 1024 else np.float64  # sums of int8 products are whole numbers it can hold
    products = (q_codes.astype(exact) @ codes.astype(exact).T).astype(np.float64)
    near = products * q_scale[:, None] * scale[None, :]
    norms = np.sqrt((vectors * vectors).sum(1)) * (1 + 1e-9)
    reach = q_norm[:, None] * rest[None, :] + q_rest[:, None] * norms[None, :] + np.abs(near) * 1e-9
    other = own[:, None] != ids[None, :]
    if len(ids) <= k + 1:
        return np.nonzero(other)
    sure = np.where(other, near - reach, -np.inf)
    least = np.partition(sure, len(ids) - k, axis=1)[:, len(ids) - k]
    return np.nonzero(other & (near + reach >= least[:, None]))


def block_nearest(vectors: DataFrame, is_query: Column, k: int = 20) -> DataFrame:
    """For each row that ``is_query`` (a condition on ``vec_id``) the ``k`` other rows of largest inner product."""
    usable = usable_vectors(vectors, nonzero=True)
    usable = checkpointed(usable.select(usable["vec_id"].cast("long").alias("vec_id"), "vector"))
    queries = usable.where(is_query)
    blocks, query_blocks = block_count(usable.count(), BLOCK), block_count(queries.count(), QUERIES_A_BLOCK)

    def tile(key, left, right):
        import pyarrow as pa

        out = [[], [], []]
        if left.num_rows and right.num_rows:
            q_ids, ids = (t.column("vec_id").to_numpy().astype(np.int64) for t in (left, right))
            asked, held = matrix(left.column("vector")), matrix(right.column("vector"))
            asked, held = widen(asked, held.shape[1]), widen(held, asked.shape[1])
            coded = encode(held)
            for at in range(0, len(asked), BATCH):
                part, own = asked[at : at + BATCH], q_ids[at : at + BATCH]
                rows, cols = possible(part, own, held, ids, coded, k)
                heaps = [[] for _ in own]
                for cut in np.array_split(np.arange(len(rows)), max(1, len(rows) // 100_000)):
                    scores = inner_products(part[rows[cut]], held[cols[cut]])
                    for row, score, vec_id in zip(rows[cut].tolist(), scores.tolist(), (-ids[cols[cut]]).tolist(), strict=True):
                        if len(heaps[row]) < k:
                            heapq.heappush(heaps[row], (score, vec_id))
                        else:
                            heapq.heappushpop(heaps[row], (score, vec_id))
                for query, heap in zip(own.tolist(), heaps, strict=True):
                    for score, vec_id in heap:
                        for to, value in zip(out, (query, -vec_id, score), strict=True):
                            to.append(value)
        arrays = [pa.array(out[0], pa.int64()), pa.array(out[1], pa.int64()), pa.array(out[2], pa.float64())]
        return pa.Table.from_arrays(arrays, ["query_id", "vec_id", "score"])

    left = queries.select("vec_id", "vector", in_block(query_blocks).alias("__q"), every(blocks).alias("__v"))
    right = usable.select("vec_id", "vector", in_block(blocks).alias("__v"), every(query_blocks).alias("__q"))
    return merged(tiled(left, right, tile, "query_id long, vec_id long, score double"), k)
