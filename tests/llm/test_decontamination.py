import hashlib
import re

import numpy as np
import pytest
from helpers import documents, odd_rows
from hypothesis import given, settings
from hypothesis import strategies as st

from silverline.llm import decontamination, fm_index

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, window=10):
    windows = {}
    for item, text in items:
        words = words_of(text)
        size = min(window, len(words))
        for i in range(len(words) - size + 1 if size else 0):
            windows.setdefault(tuple(words[i : i + size]), set()).add(item)
    out = []
    for doc_id, text, _ in docs:
        words, hit, found = words_of(text), set(), set()
        for size in {len(w) for w in windows}:
            for i in range(len(words) - size + 1):
                if (at := tuple(words[i : i + size])) in windows:
                    hit |= set(range(i, i + size))
                    found |= windows[at]
        listed = sorted(str(i) for i in found if i is not None)
        checksum = hashlib.sha256(",".join(listed).encode()).hexdigest()
        out.append((doc_id, len(words), len(hit), len(listed), checksum, bool(hit)))
    return sorted(out, key=str)


def found(spark, docs, items, kind="long"):
    benchmark = spark.createDataFrame([(i, t, 7, 7, "x") for i, t in items], f"item_id {kind}, text string, key long, start long, spans string")
    return decontamination.find_contamination(documents(spark, docs), benchmark)


def digest(spark, docs, items, kind="long"):
    rows = decontamination.digest(found(spark, docs, items, kind))
    assert rows.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    return sorted(map(tuple, rows.collect()), key=str)


def passages():
    draw = np.random.default_rng(3)
    text = lambda n: " ".join(f"w{x}" for x in draw.integers(0, 12, n))
    items = [(i, text(n)) for i, n in enumerate((10, 11, 25, 40, 3, 1, 9, 12))]
    items += [(8, items[2][1]), (8, "Ganz kurz!"), (9, ""), (10, None), (11, " .,; "), (None, text(14)), (2, items[2][1]), (100, "naïve Ünï"), (20, items[3][1].upper())]
    docs = [(i, text(n), "a") for i, n in enumerate((0, 1, 5, 9, 10, 30, 200, 2000))]
    for i, item in enumerate(items):
        docs.append((100 + i, f"{text(7)} -- {item[1]}, {text(6)}", "b"))
        docs.append((100 + i, f"{text(7)} -- {item[1]}, {text(6)}", "b"))  # the same row again
        docs.append((200 + i, item[1], "b"))
    return docs + odd_rows(), items


@pytest.mark.parametrize(("shard", "block"), [(1 << 20, 200_000), (400, 7), (37, 200_000)])
def test_equals_brute_force(spark, monkeypatch, shard, block):
    monkeypatch.setattr(decontamination, "SHARD_WORDS", shard)
    monkeypatch.setattr(decontamination, "BLOCK", block)
    docs, items = passages()
    if shard < 400:
        docs = [d for d in docs if len(d[1] or "") < 100_000]  # thousands of shards of one text
    assert digest(spark, docs, items) == brute(docs, items)


def test_item_ids_sort_as_strings(spark):
    items = [("b,c", "eins zwei drei"), ("B", "zwei drei"), ("10", "drei"), ("9", "drei"), ("ä", "eins")]
    docs = [(1, "eins zwei drei vier", "a")]
    assert digest(spark, docs, items, "string") == brute(docs, items)
    assert found(spark, docs, items, "string").first()["items"] == ["10", "9", "B", "b,c", "ä"]


def test_empty_tables(spark):
    docs, items = [(1, "eins zwei", "a"), (None, None, None)], [(1, "eins")]
    assert digest(spark, [], items) == []
    assert digest(spark, docs, []) == brute(docs, [])
    assert digest(spark, [(1, None, None), (2, "", None)], items) == brute([(1, None, None), (2, "", None)], items)


def test_spans_are_removed(spark):
    passage = "this exact passage of the test set must not be trained on"
    docs = [(1, f"Before it. {passage.title()}! After it.", "a"), (1, "Before it.", "a"), (2, passage, "a"), (3, None, "a"), (None, f"x {passage}", "a")]
    hits = found(spark, docs, [(7, passage)])
    table = documents(spark, docs)
    kept = decontamination.remove_spans(table, hits)
    assert kept.columns == table.columns
    assert sorted([(r.doc_id, r.text) for r in kept.collect()], key=str) == sorted(
        [(1, "Before it. ! After it."), (1, "Before it."), (2, ""), (3, None), (None, "x ")], key=str
    )


SHORT = st.lists(st.lists(st.integers(0, 3), max_size=12), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(SHORT, st.lists(st.lists(st.integers(0, 4), min_size=1, max_size=4), min_size=1, max_size=6))
def test_backward_search_finds_all_places(texts, phrases):
    hashed = lambda words: np.array(words, np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    index = fm_index.FmIndex.build([hashed(t) for t in texts])
    index = fm_index.FmIndex.from_columns(index.n, index.to_columns())
    aligned = np.zeros((len(phrases), 4), np.uint64)
    for row, phrase in zip(aligned, phrases, strict=True):
        row[4 - len(phrase) :] = hashed(phrase)
    first, last = index.rows(aligned, np.array([len(p) for p in phrases]))
    for low, high, phrase in zip(first, last, phrases, strict=True):
        expected = [int(index.starts[n]) + i for n, t in enumerate(texts) for i in range(len(t) - len(phrase) + 1) if t[i : i + len(phrase)] == phrase]
        assert sorted(index.places(np.arange(low, high)).tolist()) == expected


@pytest.mark.parametrize("most", [1, 2**60])
def test_suffixes_in_order(most):
    text = np.r_[np.random.default_rng(5).integers(2, 4, 300), 0, np.full(200, 2), 1] * most
    text[[300, 501]] = 0, 1
    order = fm_index.suffix_order(text)
    assert order.tolist() == sorted(range(len(text)), key=lambda i: text[i:].tolist())
