import zlib

import numpy as np
import pytest
from helpers import documents, odd_rows

from silverline.llm import quality_mil as mil


def labels(spark, rows):
    return spark.createDataFrame([(*r, 0) for r in rows], "doc_id long, quality int, toxic int")


def in_fifth(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 5 == 0


def test_gradients():
    draw = np.random.default_rng(0)
    x, bag, y = draw.normal(0, 1, (9, mil.WIDTH)), np.array([0, 0, 0, 1, 2, 2, 2, 2, 3]), np.array([0.0, 1, 1, 0])
    first = np.array([0, 3, 4, 8])
    shape = {"W": (mil.WIDTH, 5), "b": (5,), "V": (5, 4), "U": (5, 4), "w": (4,), "c": (5,), "c0": (1,)}
    m = {k: draw.normal(0, 0.4, n) for k, n in shape.items()}

    def loss():
        z = mil._forward(m, x, bag, first)["logit"]
        return np.mean(np.logaddexp(0, z) - y * z)

    grad = mil._gradients(m, x, bag, first, y)
    for k in shape:
        at = tuple(draw.integers(0, n) for n in shape[k])
        before = m[k][at]
        m[k][at] = before + 1e-6
        up = loss()
        m[k][at] = before - 1e-6
        assert (up - loss()) / 2e-6 == pytest.approx(grad[k][at], abs=1e-6)
        m[k][at] = before


def test_every_passage_is_encoded_alike_in_any_company():
    texts = [b"", b"a", b"Hello World!! " * 100, "é".encode() * 700, b"x y z " * 400_000]
    together, owner = mil.encode_passages(texts)
    for i, text in enumerate(texts):
        alone, _ = mil.encode_passages([text])
        assert np.allclose(together[owner == i], alone)
        assert len(alone) >= max(1, len(text) // mil.PASSAGE)
    assert together.shape[1] == mil.WIDTH


def test_held_out_accuracy(spark):
    docs, marks = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    rows = {r.doc_id: r for r in mil.classify(docs, marks).collect()}
    texts = {r.doc_id: (r.text or "").encode() for r in docs.collect()}
    assert len(rows) == len(texts)
    model = mil.fit(docs, marks)
    expected = mil.scores(model, [texts[i] for i in sorted(texts)])
    assert np.allclose([rows[i].score for i in sorted(texts)], expected)  # the whole text, the same model
    assert all(r.held_out == in_fifth(i) and r.predicted == (r.score >= 0.3) for i, r in rows.items())
    unseen = [(rows[r.doc_id], r.quality) for r in marks.collect() if rows[r.doc_id].held_out]
    good, bad = ([r.score for r, q in unseen if q == want] for want in (1, 0))
    assert np.mean([g > b for g in good for b in bad]) > 0.97
    assert np.mean([r.predicted for r, q in unseen if q == 1]) > 0.95


def test_labels_of_the_held_out_change_nothing(spark, sf_dir):
    docs, marks = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("documents", "labels"))
    rows = [(r.doc_id, 1 - r.quality if in_fifth(r.doc_id) else r.quality) for r in marks.collect()]
    a, b = mil.fit(docs, marks), mil.fit(docs, labels(spark, rows))
    assert all(np.array_equal(a[k], b[k]) for k in a)


def test_odd_rows(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    marks = labels(spark, [(1, 1), (1, 0), (3, None), (None, 1), (5, 1), (6, 0), (77, 1)])
    found = mil.classify(docs, marks).collect()
    assert len(found) == len(rows) and all(0 <= r.score <= 1 for r in found)
    assert {r.held_out for r in found if r.doc_id is None} == {False}
    empty = {r.score for r in found if r.doc_id in (3, 4)}
    assert len(empty) == 1
    kept = mil.keep_good(docs, marks)
    assert kept.columns == docs.columns and kept.count() == sum(r.predicted for r in found)
    assert mil.classify(documents(spark, []), marks).collect() == []


def test_without_labels_nothing_is_rejected(spark):
    docs = documents(spark, odd_rows())
    assert {(r.score, r.predicted) for r in mil.classify(docs, labels(spark, [])).collect()} == {(0.5, 1)}


def test_one_document_of_each_id_is_learned_from(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(mil, "train", lambda x, bag, y: seen.append((x.shape, len(y))))
    open_ids = [i for i in range(20) if not in_fifth(i)]
    rows = [(open_ids[0], f"text number {i} of the id that repeats " * 3, "a") for i in range(300)] + [(i, f"text {i}", "a") for i in range(20)]
    for some in (rows, rows[::-1]):
        mil.fit(documents(spark, some), labels(spark, [(i, i % 2) for i in range(20)]))
    assert seen[0] == seen[1] and seen[0][1] == len(open_ids)
