"""Clustering around centroids with ns-bounds.

A vector keeps, for each centroid, the distance last evaluated and the round of that evaluation; the centroids of all
rounds are kept. In a later round the distance from centroid ``j`` has changed by no more than the norm of its whole
displacement since then, ``|c_j(now) - c_j(then)|``, which is never more than the sum of its steps and often much less.
Where the loosened distance from the own centroid stays below those from all others nothing is evaluated; else first the
own distance is, then those that it still does not beat. Evaluations are whole numbers, so the result is that of
evaluating everything. Each round is one pass over the vectors, which carry their bounds along, and one aggregation of
their sums, of which a row for each centroid comes to the driver.

Components are ``floor(scale * x)``; beyond 2^27 they stop there, so that every squared distance is a long. Defined
cases: vectors that are null, of another length, or hold null or non-finite components take no part; rows that repeat an
id are vectors of their own, and so are rows without one, whose hash is that of an empty id; first centroids of equal hash
stand in order of their components; with fewer vectors than centroids each is one; an empty centroid stays where it was;
an inertia beyond a long stops at its end; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed

MOST = 2**27  # components stop here
_ROUND = 1e-9  # more than what rounding can change in a distance, as a share of it


def whole_vectors(vectors: DataFrame, dim: int = 64, scale: int = 64) -> DataFrame:
    """Rows ``(vec_id, x)`` of the vectors that take part."""
    v = F.col("embedding")
    finite = F.forall(v, lambda y: y.isNotNull() & ~F.isnan(y) & (F.abs(y) < float("inf")))
    bounded = lambda y: F.greatest(F.lit(-float(MOST)), F.least(F.lit(float(MOST)), y.cast("double") * scale))
    kept = vectors.where(v.isNotNull() & (F.size(v) == dim) & finite)
    return kept.select("vec_id", F.transform(v, lambda y: F.floor(bounded(y)).cast("int")).alias("x"))


def first_centroids(kept: DataFrame, number: int = 16, salt: str = "1:") -> np.ndarray:
    """The vectors of the smallest hashes of their ids, as rows of a matrix."""
    key = F.sha2(F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    rows = kept.select(key.alias("key"), "x").orderBy("key", "x").limit(number).collect()
    return np.array([r.x for r in rows], np.int64)


def squares(x: np.ndarray, centroid: np.ndarray) -> np.ndarray:
    apart = x - centroid
    return np.einsum("ij,ij->i", apart, apart)


def assign(x: np.ndarray, history: list[np.ndarray], own: np.ndarray, known: np.ndarray, rounds: np.ndarray, everywhere: bool):
    """Nearest centroids of the last round of ``history``, squared distances where evaluated (else -1), and evaluations.

    ``known`` and ``rounds`` hold the distance last evaluated for each centroid and its round, and are brought up to
    date. ``own`` is the nearest centroid so far, -1 in the first round. ``everywhere`` evaluates the own distance also
    where the bounds hold without it.
    """
    now, centroids = len(history) - 1, history[-1]
    count = len(centroids)
    drift = np.stack([np.sqrt(((centroids - c).astype(float) ** 2).sum(1)) for c in history], 1) * (1 + _ROUND)
    n, each = len(x), np.arange(len(x))
    exact = np.full((n, count), -1, np.int64)
    fresh = own < 0
    old = np.where(fresh, 0, own)
    moved = drift[np.arange(count)[None, :], rounds]
    below = known * (1 - _ROUND) - moved
    below[each, old] = np.inf
    below[fresh] = -1
    above = known[each, old] * (1 + _ROUND) + moved[each, old]
    open_ = fresh | (above >= below.min(1, initial=np.inf)) | everywhere
    for j in range(count):
        at = np.flatnonzero(open_ & (old == j))
        exact[at, j] = squares(x[at], centroids[j])
    reached = np.sqrt(np.maximum(exact[each, old], 0)) * (1 + _ROUND)
    failed = open_[:, None] & (reached[:, None] >= below)
    for j in range(count):
        at = np.flatnonzero(failed[:, j])
        exact[at, j] = squares(x[at], centroids[j])
    seen = exact >= 0
    nearest = np.where(seen, exact, np.iinfo(np.int64).max).argmin(1)  # ties: the first
    own = np.where(open_, nearest, old)
    known[seen] = np.sqrt(exact[seen])
    rounds[seen] = now
    return own, exact[each, own], seen.sum(1)


def _assigned(vectors: DataFrame, history: list[np.ndarray], last: bool) -> DataFrame:
    kind = vectors.schema["vec_id"].dataType.simpleString()
    schema = f"vec_id {kind}, x array<int>, cluster int, distance long, known array<double>, rounds array<int>, evaluated long"
    count, dim = history[0].shape
    first = len(history) == 1

    def work(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lists = lambda a, kind: pa.ListArray.from_arrays(pa.array(np.arange(len(a) + 1) * a.shape[1], pa.int32()), pa.array(a.ravel(), kind))
        for batch in batches:
            n = batch.num_rows
            values = lambda name, width, batch=batch, n=n: batch.column(name).flatten().to_numpy(zero_copy_only=False).reshape(n, width)
            x = values("x", dim).astype(np.int64)
            if first:
                own, known, rounds, evaluated = np.full(n, -1), np.zeros((n, count)), np.zeros((n, count), np.int64), 0
            else:
                own = batch.column("cluster").to_numpy().astype(np.int64)
                known, rounds = values("known", count).copy(), values("rounds", count).astype(np.int64)
                evaluated = batch.column("evaluated").to_numpy()
            own, distance, more = assign(x, history, own, known, rounds, last)
            columns = [batch.column("vec_id"), batch.column("x"), pa.array(own, pa.int32()), pa.array(distance, pa.int64()), lists(known, pa.float64())]
            columns += [lists(rounds, pa.int32()), pa.array(evaluated + more, pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "x", "cluster", "distance", "known", "rounds", "evaluated"])

    return vectors.mapInArrow(work, schema)


def moved_centroids(assigned: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """The means of the vectors of each centroid, rounded down; centroids without any stay."""
    dim = centroids.shape[1]
    sums = [F.sum(F.col("x")[i].cast("long")).alias(f"s{i}") for i in range(dim)]
    out = centroids.copy()
    for row in assigned.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # one row a centroid
        out[row.cluster] = [row[f"s{i}"] // row.n for i in range(dim)]
    return out


def cluster(vectors: DataFrame, number: int = 16, rounds: int = 3, dim: int = 64, scale: int = 64, salt: str = "1:") -> tuple[DataFrame, list[np.ndarray]]:
    """Rows ``(vec_id, x, cluster, distance, evaluated)`` after so many rounds and a last assignment, and all centroids.

    ``evaluated`` counts the distances taken for a vector; without bounds it would be ``number * (rounds + 1)``.
    """
    state = checkpointed(whole_vectors(vectors, dim, scale))
    history = [first_centroids(state, number, salt)]
    if not len(history[0]):
        empty = state.select("vec_id", "x", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"), F.lit(0).cast("long").alias("evaluated"))
        return empty, history
    for _ in range(rounds):
        state = checkpointed(_assigned(state, list(history), False))
        history.append(moved_centroids(state, history[-1]))
    state = checkpointed(_assigned(state, list(history), True))
    return state.select("vec_id", "x", "cluster", "distance", "evaluated"), history


def with_inertia(found: DataFrame, centroids: np.ndarray) -> DataFrame:
    """Clusters with the distances summed over each and over all, and the checksum of its centroid."""
    rows = found.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()  # one row a centroid
    sums = {r.cluster: int(r.s) for r in rows}
    whole = lambda s: F.lit(min(s, 2**63 - 1)).cast("long")
    hashes = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    of = lambda values: F.element_at(F.array(*values), F.col("cluster") + 1) if values else F.lit(None)
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        of([whole(sums.get(j, 0)) for j in range(len(centroids))]).cast("long").alias("cluster_inertia"),
        whole(sum(sums.values())).alias("inertia"),
        of([F.lit(h) for h in hashes]).cast("string").alias("centroid_sha256"),
    )
