"""Quality of documents by attention-based multiple-instance learning.

A document is a bag of passages of equal length, some 512 bytes each, over its whole text. Each passage is encoded
(how often which kinds of characters follow each other, how its words repeat), gated attention weighs the passages,
and the weighted sum gives the document's score. Only documents carry labels; the attention learns from them which
passages tell. Label, language, source and id are no inputs of a score.

Learning takes at most ``sample`` labelled documents, those of smallest id hash, and at most ``bag`` of a document's
passages, evenly spread; scoring reads every passage of every document.

Defined cases: a null or empty text is one passage of nothing; equal texts have equal scores; without labelled
documents every score is 0.5; of several labels of one id the smallest counts; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from silverline.llm.hashing import SPACES, groups, word_hashes, word_spans

PASSAGE, SAMPLE, BAG, THRESHOLD = 512, 4096, 64, 0.3
HIDDEN, GATES, EPOCHS, BATCH, STEP, DECAY = 24, 12, 25, 256, 0.01, 1e-4
_KINDS = ["aeiouy", "bcdfghjklmnpqrstvwxz", "AEIOUYBCDFGHJKLMNPQRSTVWXZ", "0123456789", " \t", "\n\r\x0b\x0c", ".,;:?'\"", "!", "-()/", "#$%&*@", "|+=<>~^_\\[]{}`"]
_KIND = np.full(256, len(_KINDS), dtype=np.int32)  # the last kind: all other bytes, so letters beyond ASCII
for _number, _letters in enumerate(_KINDS):
    _KIND[list(_letters.encode())] = _number
_N = len(_KINDS) + 1
WIDTH = _N * _N + 4


def encode_passages(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The features of all passages and the number of the text each belongs to."""
    features, owners = [], []
    for numbers, parts in groups(texts):
        data = np.frombuffer(b"\n".join(parts) + b"\n", dtype=np.uint8)
        sizes = np.array([len(p) + 1 for p in parts])
        counts = np.maximum(1, -(-(sizes - 1) // PASSAGE))
        owner = np.repeat(np.array(numbers), counts)
        first = np.cumsum(sizes) - sizes
        index = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
        begin = np.repeat(first, counts) + index * np.repeat(sizes, counts) // np.repeat(counts, counts)
        length = np.diff(np.r_[begin, len(data)])
        passage = np.repeat(np.arange(len(owner)), length)
        kind = _KIND[data]
        pair = kind * _N
        pair[:-1] += kind[1:]
        pair[np.cumsum(sizes) - 1] = kind[np.cumsum(sizes) - 1] * _N  # what follows a text is no part of it
        pairs = np.bincount(passage * (_N * _N) + pair, minlength=len(owner) * _N * _N).reshape(len(owner), -1)
        starts, ends = word_spans(data)
        words = passage[starts]
        n_words = np.bincount(words, minlength=len(owner))
        keys = word_hashes(data, starts, ends) * np.uint64(2 * 1_000_003 + 1) + words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        seen = np.unique(keys, return_index=True)[1]
        distinct = np.bincount(words[seen], minlength=len(owner))
        letters = np.bincount(words, weights=ends - starts, minlength=len(owner))
        some = np.maximum(n_words, 1)
        rest = np.stack([distinct / some, letters / some / 10, n_words / length * 5, np.log1p(length) / 6], axis=1)
        features.append(np.hstack([np.sqrt(pairs / length[:, None]), rest]).astype(np.float32))
        owners.append(owner)
    if not features:
        return np.empty((0, WIDTH), np.float32), np.empty(0, int)
    return np.concatenate(features), np.concatenate(owners)


def _by_bag(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, first, axis=0)


def _forward(m: dict, x: np.ndarray, bag: np.ndarray, first: np.ndarray) -> dict:
    h = np.tanh(x @ m["W"] + m["b"])
    t, s = np.tanh(h @ m["V"]), 1 / (1 + np.exp(-(h @ m["U"])))
    e = (t * s) @ m["w"]
    e = np.exp(e - np.maximum.reduceat(e, first)[bag])
    a = e / _by_bag(e, first)[bag]
    z = _by_bag(a[:, None] * h, first)
    return {"h": h, "t": t, "s": s, "a": a, "z": z, "logit": z @ m["c"] + m["c0"][0]}


def _gradients(m: dict, x: np.ndarray, bag: np.ndarray, first: np.ndarray, y: np.ndarray) -> dict:
    f = _forward(m, x, bag, first)
    h, t, s, a = f["h"], f["t"], f["s"], f["a"]
    d = (1 / (1 + np.exp(-f["logit"])) - y) / len(y)
    dz = d[:, None] * m["c"]
    da = (h * dz[bag]).sum(1)
    de = a * (da - _by_bag(a * da, first)[bag])
    dt, ds = de[:, None] * m["w"] * s * (1 - t * t), de[:, None] * m["w"] * t * s * (1 - s)
    dh = (a[:, None] * dz[bag] + dt @ m["V"].T + ds @ m["U"].T) * (1 - h * h)
    return {"W": x.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "U": h.T @ ds, "w": (t * s).T @ de, "c": f["z"].T @ d, "c0": np.array([d.sum()])}


def train(x: np.ndarray, bag: np.ndarray, y: np.ndarray) -> dict:
    """Fit the model to passages ``x`` of bags 0, 1, … (sorted) with labels ``y``; the same rows give the same model."""
    mean, spread = x.mean(0), x.std(0) + 1e-3
    x = (x - mean) / spread
    draw = np.random.default_rng(7)
    shape = {"W": (WIDTH, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATES), "U": (HIDDEN, GATES), "w": (GATES,), "c": (HIDDEN,), "c0": (1,)}
    m = {k: draw.normal(0, 1 / np.sqrt(n[0]), n) if k not in ("b", "c0") else np.zeros(n) for k, n in shape.items()}
    moment, square, steps = {k: np.zeros(n) for k, n in shape.items()}, {k: np.zeros(n) for k, n in shape.items()}, 0
    begin = np.searchsorted(bag, np.arange(len(y) + 1))
    for _ in range(EPOCHS):
        order = draw.permutation(len(y))
        for at in range(0, len(y), BATCH):
            chosen = order[at : at + BATCH]
            sizes = begin[chosen + 1] - begin[chosen]
            first = np.cumsum(sizes) - sizes
            rows = np.repeat(begin[chosen] - first, sizes) + np.arange(sizes.sum())
            grad = _gradients(m, x[rows], np.repeat(np.arange(len(chosen)), sizes), first, y[chosen])
            steps += 1
            for k, g in grad.items():
                moment[k] = 0.9 * moment[k] + 0.1 * g
                square[k] = 0.999 * square[k] + 0.001 * g * g
                m[k] = m[k] * (1 - STEP * DECAY) - STEP * (moment[k] / (1 - 0.9**steps)) / (np.sqrt(square[k] / (1 - 0.999**steps)) + 1e-8)
    return m | {"mean": mean, "spread": spread}


def scores(model: dict | None, texts: list[bytes]) -> np.ndarray:
    if model is None or not texts:
        return np.full(len(texts), 0.5)
    x, bag = encode_passages(texts)
    first = np.searchsorted(bag, np.arange(len(texts)))
    out = _forward(model, (x - model["mean"]) / model["spread"], bag, first)["logit"]
    return 1 / (1 + np.exp(-np.clip(out, -500, 500)))


def held_out(doc_id: Column | str) -> Column:
    """Documents that nothing is learned from: a fifth, by checksum of the id."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def _texts(column) -> Iterator[list[bytes]]:
    """The texts of an Arrow column as bytes, a few megabytes at a time."""
    some, held = [], 0
    for value in column.cast("binary"):
        some.append(value.as_py() or b"")
        held += len(some[-1])
        if held > 1 << 22:
            yield some
            some, held = [], 0
    if some:
        yield some


def fit(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, bag: int = BAG) -> dict | None:
    """Learn from a bounded sample of labelled documents, one of each id; None if there are none."""
    marks = labels.where(F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("__id")).agg(F.min("quality").alias("__quality"))
    there = docs.select(F.col("doc_id").alias("__id")).where(F.col("__id").isNotNull() & ~held_out("__id"))
    chosen = marks.join(there, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(sample)

    def encoded(batches):
        import pyarrow as pa

        for batch in batches:
            rows = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False)
            at = 0
            for some in _texts(batch.column(2)):
                x, owner = encode_passages(some)
                begin = np.searchsorted(owner, np.arange(len(some) + 1))
                for i in range(len(some)):
                    n = begin[i + 1] - begin[i]
                    kept = begin[i] + np.unique(np.arange(min(n, bag)) * n // min(n, bag))
                    yield pa.RecordBatch.from_pydict({"id": pa.array([int(rows[0][at])]), "quality": pa.array([int(rows[1][at])]), "x": pa.array([x[kept].tobytes()])})
                    at += 1

    known = docs.select(F.col("doc_id").alias("__id"), "text").join(F.broadcast(chosen), "__id")  # ``sample`` ids
    first = F.min(F.struct(F.xxhash64("text").alias("key"), "text")).alias("first")
    once = known.groupBy("__id", "__quality").agg(first).select("__id", "__quality", "first.text")
    rows = once.select(F.col("__id").cast("long"), F.col("__quality").cast("long"), "text").mapInArrow(encoded, "id long, quality long, x binary").collect()
    if not rows:
        return None
    rows.sort(key=lambda r: (r.id, r.x))
    bags = [np.frombuffer(r.x, np.float32).reshape(-1, WIDTH) for r in rows]
    return train(np.concatenate(bags).astype(np.float64), np.repeat(np.arange(len(bags)), [len(b) for b in bags]), np.array([float(r.quality > 0) for r in rows]))


def score_column(model: dict | None, text: Column | str) -> Column:
    @F.arrow_udf("double")
    def score(column):
        import pyarrow as pa

        return pa.array(np.concatenate([scores(model, some) for some in _texts(column)] or [np.empty(0)]), pa.float64())

    return score(text)


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: score and prediction, and whether learning could not have seen it."""
    scored = docs.select("doc_id", "text").withColumn("score", score_column(fit(docs, labels), "text"))
    return scored.select("doc_id", held_out("doc_id").alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not rejected, with all their columns."""
    scored = docs.withColumn("__score", score_column(fit(docs, labels), "text"))
    return scored.where(F.col("__score") >= THRESHOLD).select(*[F.col(f"`{c}`") for c in docs.columns])
