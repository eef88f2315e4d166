import itertools
import random

import numpy as np
import pyarrow as pa
import pytest
from helpers import documents, odd_rows
from pyspark.sql import functions as F

from silverline.llm import jaccard_join as join
from silverline.llm.components import components
from silverline.llm.hashing import cut_bytes, hashed_words


def shingles(text):
    words = (text or "").encode().lower().split()
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4)) if len(words) >= 5 else frozenset([tuple(words)] if words else [])


def brute(rows):
    """(doc_id, size, component) of every row, comparing all pairs."""
    sets = [shingles(text) for _, text, *_ in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
            parent[root(i)] = root(j)
    low = {}
    for i, row in enumerate(rows):
        if row[0] is not None:
            low[root(i)] = min(low.get(root(i), row[0]), row[0])
    return sorted(((row[0], len(sets[i]), low.get(root(i), row[0])) for i, row in enumerate(rows)), key=str)


def found(df):
    return sorted(map(tuple, join.jaccard_components(df).collect()), key=str)


def near_copies(seed, groups, size, words):
    """Groups whose members differ by a few words each, so that many pairs are close to the threshold."""
    draw = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(4000)]
    passage = " ".join(draw.choices(vocabulary, k=60))
    rows = []
    for g in range(groups):
        origin = draw.choices(vocabulary, k=draw.choice(words))
        for _ in range(draw.randint(1, size)):
            text = origin[:]
            for _ in range(draw.randint(0, max(1, len(text) // 45))):
                text[draw.randrange(len(text))] = draw.choice(vocabulary)
            if draw.random() < 0.2:
                text = text[: max(1, int(len(text) * draw.uniform(0.75, 1)))]
            if draw.random() < 0.3:
                text += passage.split()
            rows.append((len(rows), " ".join(text).upper() if draw.random() < 0.3 else " ".join(text), f"s{g % 3}"))
    draw.shuffle(rows)
    return rows


@pytest.mark.parametrize(("short", "part"), [(32, 4096), (3, 8)])
def test_equals_all_pairs(spark, monkeypatch, short, part):
    monkeypatch.setattr(join, "SHORT_LIST", short)
    monkeypatch.setattr(join, "PART", part)
    monkeypatch.setattr(join, "TILE", part)
    rows = near_copies(short, 25, 12, [3, 5, 6, 12, 40, 150])
    assert found(documents(spark, rows)) == brute(rows)


def test_few_long_lists_known_by_name(spark, monkeypatch):
    monkeypatch.setattr(join, "SHORT_LIST", 2)
    monkeypatch.setattr(join, "LONG_LISTS", 5)
    rows = near_copies(8, 12, 20, [10, 60])
    assert found(documents(spark, rows)) == brute(rows)


def test_pairs_that_meet_through_short_and_long_lists(spark, monkeypatch):
    monkeypatch.setattr(join, "SHORT_LIST", 1000)
    monkeypatch.setattr(join, "PART", 8)
    draw = random.Random(5)
    words = lambda n: draw.choices([f"w{i}" for i in range(100_000)], k=n)
    rows = []
    for there in (10, 12, 14, 20, 25, 30):
        passage = words(100)
        for _ in range(there // 2):  # 15 words of 200 differ: shared members come to 0.82, half of them from the passage
            origin = words(85)
            rows += [passage + origin + words(15), passage + origin + words(15)]
    rows = [(i, " ".join(text), "s") for i, text in enumerate(rows)]
    expected = brute(rows)
    assert len({c for _, _, c in expected}) == len(rows) // 2
    assert found(documents(spark, rows)) == expected


def test_odd_rows(spark):
    rows = odd_rows()
    docs = documents(spark, rows)
    assert found(docs) == brute(rows)
    assert found(documents(spark, [])) == []
    kept = join.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted((r.doc_id for r in kept.collect()), key=str) == sorted([1, 3, 4, None, None, 5, 6, 7], key=str)


def test_keeps_one_of_each_group(spark):
    rows = near_copies(4, 15, 6, [8, 50])
    kept = [r.doc_id for r in join.keep_one(documents(spark, [*rows, rows[0]])).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute(rows)})


def test_threshold_is_exact():
    for m in range(1, 80):
        for n in range(1, 80):
            least = join.least_overlap(m, n)
            assert 100 * least >= 80 * (m + n - least) and 100 * (least - 1) < 80 * (m + n - least + 1)
            if 100 * min(m, n) >= 80 * max(m, n):
                assert least > max(m - join.prefix_size(m), n - join.prefix_size(n))


def test_shared_runs_across_batches():
    draw = random.Random(1)
    for _ in range(200):
        rows = sorted(((draw.randint(0, 12), draw.randint(0, 3), 1) for _ in range(draw.randint(1, 60))), key=lambda r: r[0])
        nodes = {t: {n for x, n, _ in rows if x == t} for t, _, _ in rows}
        cuts = sorted(draw.choices(range(len(rows) + 1), k=draw.randint(0, 8)))
        batches = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)], strict=True)]
        made = [pa.RecordBatch.from_arrays([pa.array([r[i] for r in b], pa.int64()) for i in range(3)], ["token", "node", "n"]) for b in batches]
        out = {(t, n) for b in join._shared(iter(made)) for t, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)}
        assert out == {(t, n) for t, there in nodes.items() if len(there) > 1 for n in there}


def test_words_are_hashed_alike_wherever_they_stand():
    texts = [b"", b"a", b" the quick  brown\tfox ", b"x" * 100, b"the quick brown fox", b"w " * 700_000 + b"end"]
    hashes = list(hashed_words(texts))
    assert [len(h) for h in hashes] == [len(t.split()) for t in texts]
    assert hashes[2].tolist() == hashes[4].tolist() and hashes[5][-1] == next(hashed_words([b"end"]))[0]
    words = [f"{a}{b}".encode() for a in range(300) for b in "abcdefghij"]
    assert len(np.unique(next(hashed_words([b" ".join(words)])))) == len(words)
    assert b"".join(cut_bytes(b"ab cd " * 9, 7)) == b"ab cd " * 9


def test_components(spark):
    path = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (98, 100), (7, 7), (200, 201)]
    draw = random.Random(0)
    names = list(range(300))
    draw.shuffle(names)
    links = spark.createDataFrame([(names[a], names[b]) for a, b in path], "a long, b long")
    groups = {}
    for r in components(links).collect():
        groups.setdefault(r.component, set()).add(r.node)
    expected = [{names[i] for i in range(41)}, {names[i] for i in (98, 99, 100)}, {names[200], names[201]}]
    assert groups == {min(g): g for g in expected}
    assert components(links.where(F.lit(False))).collect() == []
