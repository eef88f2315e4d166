import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from helpers import documents, odd_rows

from silverline.llm import packing
from silverline.llm.tokens import WordTokenizer, _Recent, slices


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(packing.default_vocabulary())


def ids(tokenizer, text):
    return [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]


def test_words_have_the_ids_of_whole_texts(tokenizer, spark, sf_dir):
    mine = WordTokenizer(packing.default_vocabulary(), bound=50)
    texts = [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("text").limit(60).collect()]
    texts += ["", "don't I'LL 3.5% ÀÉß x<|endoftext|>y", "a\x1cb  c", "Σίσυφος ΣΑΣ İ ǅ", "é ́x", "１２ ½ ²", "a　b c᠎d", "_-'s'", "x" * 300]
    draw = random.Random(5)
    texts += ["a <|endoftext|> b", "a<|EndOfText|>b", "<|startoftext|><|endoftext|>", "ß<|endoftext|>中 x", "<|endoftext", "<|endoftext|>" * 3, "\x1c<|startoftext|>"]
    texts += ["".join(draw.choices(["<|endoftext|>", "<|startoftext|>", "<|", "|>", "a ", "é", "中", "\n", "B"], k=12)) for _ in range(300)]
    texts += ["".join(draw.choices("aB'st 1.é\n\tß́中", k=40)) for _ in range(300)]
    for text in texts:
        assert np.frombuffer(mine.ids(text), "<u4").tolist() == tokenizer.encode(text, add_special_tokens=False).ids, text


def test_slices_divide_no_word():
    text = "abc  defgh\n" * 300_000
    parts = list(slices(text))
    assert len(parts) > 2 and "".join(parts) == text and all(p[0].isspace() for p in parts[1:])


def test_recent_keeps_what_is_used():
    made = []
    recent = _Recent(lambda key: made.append(key) or key * 2, 3)
    for i in range(30):
        assert recent[0] == 0 and recent[i] == 2 * i
        assert len(recent) <= 3
    assert made.count(0) == 1


def test_smallest_gives_way_to_two_that_fit_better():
    counts = np.zeros(11, dtype=np.int64)
    counts[[7, 2, 1]] = 1  # greedily 7, 2, 1
    assert packing.fill_one(counts, 10) == {7: 1, 2: 1, 1: 1}
    counts = np.zeros(101, dtype=np.int64)
    counts[[60, 30, 25, 14]] = 1  # greedily 60, 30; instead of 30: 25 and 14
    assert packing.fill_one(counts, 100) == {60: 1, 25: 1, 14: 1}
    counts[13] = 0
    counts[[25, 14]] = 0
    counts[20] = 2  # two of one length
    assert packing.fill_one(counts, 100) == {60: 1, 20: 2}


def one_after_another(histogram, capacity):
    counts = np.zeros(capacity + 1, dtype=np.int64)
    for length, n in histogram.items():
        counts[length] = n
    bins = []
    while counts.any():
        taken = packing.fill_one(counts, capacity)
        bins.append(tuple(taken.items()))
        for length, n in taken.items():
            counts[length] -= n
    return bins


def test_plan_is_that_of_filling_one_after_another():
    draw = random.Random(3)
    for _ in range(30):
        capacity = draw.choice([8, 50, 200])
        histogram = dict(Counter(draw.randint(1, capacity) for _ in range(draw.randint(0, 300))))
        plan = packing.packing_plan(histogram, capacity)
        places = defaultdict(list)
        for length, first, until, number, sequence, offset in plan:
            for rank in range(first, until):
                at = rank - first
                places[sequence + at // number].append((offset + at % number * length, length))
        bins = one_after_another(histogram, capacity)
        assert sorted(map(sorted, ([length for _, length in p] for p in places.values()))) == sorted(sorted(x for x, n in b for _ in range(n)) for b in bins)
        for parts in places.values():
            parts.sort()
            assert [p for p, _ in parts] == np.cumsum([0, *[n for _, n in parts]])[:-1].tolist()
            assert sum(n for _, n in parts) <= capacity


def check(rows, docs, tokenizer, capacity):
    found = Counter()
    for r in rows:
        found[(r.doc_id, r.piece, r.start, r.length, r.ids_crc32)] += 1
    expected = Counter()
    for i, text in docs:
        whole = ids(tokenizer, text)
        for start in range(0, len(whole), capacity):
            part = whole[start : start + capacity]
            expected[(i, start // capacity, start, len(part), zlib.crc32(np.array(part, "<u4").tobytes()))] += 1
    assert found == expected
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_every_piece_has_its_place(spark, tokenizer, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = packing.pack_documents(docs).collect()
    used = check(rows, [(r.doc_id, r.text) for r in docs.collect()], tokenizer, packing.CAPACITY)
    assert used <= -(-sum(r.length for r in rows) // packing.CAPACITY) + 1


def test_odd_rows(spark, tokenizer):
    rows = [*odd_rows(), (8, "one<|endoftext|>two " * 50, "a")]
    docs = documents(spark, rows)
    packed = packing.pack_documents(docs, capacity=64)
    check(packed.collect(), [(i, text) for i, text, _ in rows], tokenizer, 64)


def test_sequences_hold_the_ids(spark, tokenizer):
    docs = documents(spark, odd_rows()[:6])
    packed = packing.pack_documents(docs, capacity=64)
    texts = {(r.doc_id, r.piece, r.ids_crc32): r for r in packing.token_pieces(docs, capacity=64, with_ids=True).collect()}
    whole = {r.sequence_id: bytes(r.ids) for r in packing.packed_sequences(docs, packed, capacity=64).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == bytes(texts[r.doc_id, r.piece, r.ids_crc32].ids)


def test_empty_table(spark):
    assert packing.pack_documents(documents(spark, [])).collect() == []
