"""An FM-index over words: a shard of texts that can be searched backwards and tells where it found something.

The words of a shard's texts are numbered, each text is closed by a symbol of its own, and the suffixes of the whole are
sorted by doubling what they are compared by; only suffixes that are still equal are compared again. The symbol before
each suffix makes the Burrows-Wheeler text, held as a wavelet matrix: a plane of bits for each bit of a symbol, with
counts of ones before every 64 bits. A phrase is searched from its last word to its first, two ranks a word. Every
``SAMPLE``-th place of the text is kept with its suffix; other places are found by walking back to one of them.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

SAMPLE = 16  # places of a text for each that is kept


def _sorted(key: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """The order of some keys from 0 to ``most``, ties in any order, and the keys in it.

    Sorting numbers is much faster than sorting places, so a key and its place are one number where they fit into one.
    """
    shift = max(1, (len(key) - 1).bit_length())
    if most.bit_length() + shift > 63:
        order = np.argsort(key)
        return order, key[order]
    both = (key << shift) | np.arange(len(key))
    both.sort()
    return both & ((1 << shift) - 1), both >> shift


def suffix_order(text: np.ndarray) -> np.ndarray:
    """Starts of the suffixes in order. Equal stretches of two suffixes must end before the text does."""
    n = len(text)
    bits = max(1, int(text.max(initial=0)).bit_length())
    reach = min(n, max(1, (63 - n.bit_length()) // bits))
    key = np.zeros(n, np.int64)
    for j in range(reach):
        key <<= bits
        key[: n - j] |= text[j:]
    order, key = _sorted(key, (1 << bits * reach) - 1)
    rank = np.empty(n, np.int64)
    slots, rows = np.arange(n), order
    while True:
        first = np.r_[True, key[1:] != key[:-1]]
        rank[rows] = slots[np.maximum.accumulate(np.where(first, np.arange(len(slots)), 0))]
        tied = ~(first & np.r_[first[1:], True])
        slots = slots[tied]
        if not len(slots):
            return order
        rows = order[slots]
        by, key = _sorted(rank[rows] * n + rank[rows + reach], n * n - 1)
        rows = rows[by]
        order[slots] = rows
        reach *= 2


def _numbered(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct words in order, and the number of each word among them."""
    import pyarrow as pa

    coded = pa.array(words).dictionary_encode()
    distinct = coded.dictionary.to_numpy()
    order = np.argsort(distinct)
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    return distinct[order], number[coded.indices.to_numpy()]


def _plane(bits: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bits packed 64 to a word, and the ones before each word; one word more than needed, so that the end has a rank."""
    packed = np.zeros((len(bits) // 64 + 1) * 8, np.uint8)
    packed[: -(-len(bits) // 8)] = np.packbits(bits, bitorder="little")
    words = packed.view(np.uint64)
    return words, np.r_[0, np.cumsum(np.bitwise_count(words[:-1]), dtype=np.int64)].astype(np.int32)


def _ones(words: np.ndarray, counts: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Ones before each place."""
    word = at >> 6
    below = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
    return counts[word] + np.bitwise_count(words[word] & below)


def _bit(words: np.ndarray, at: np.ndarray) -> np.ndarray:
    return ((words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1)).astype(bool)


@dataclass
class FmIndex:
    """``vocabulary``: hashes of the words in order; their symbols follow those of the ``starts`` of texts."""

    n: int
    starts: np.ndarray
    vocabulary: np.ndarray
    base: np.ndarray  # for each symbol, what leads from its place in the last plane to its row
    planes: list[np.ndarray]
    counts: list[np.ndarray]
    zeros: np.ndarray
    marks: np.ndarray
    mark_counts: np.ndarray
    samples: np.ndarray

    FIELDS = {"starts": np.int32, "vocabulary": np.uint64, "base": np.int32, "zeros": np.int32, "marks": np.uint64, "mark_counts": np.int32, "samples": np.int32}

    @classmethod
    def build(cls, texts: list[np.ndarray]) -> FmIndex:
        """Index the word hashes of some texts, at least one."""
        lengths = np.array([len(t) for t in texts], np.int64)
        ends = np.cumsum(lengths + 1) - 1
        n, closing = int(ends[-1]) + 1, len(texts)
        text = np.empty(n, np.int64)
        words = np.ones(n, bool)
        words[ends] = False
        vocabulary, numbers = _numbered(np.concatenate(texts))
        text[ends] = np.arange(closing)
        text[words] = numbers + closing
        del numbers, words
        order = suffix_order(text)
        left = text[order - 1].astype(np.int32)
        symbols = closing + len(vocabulary)
        before = np.r_[0, np.cumsum(np.bincount(text, minlength=symbols))[:-1]]
        marks, mark_counts = _plane(order % SAMPLE == 0)
        samples = order[order % SAMPLE == 0].astype(np.int32)
        del text, order
        levels = max(1, (symbols - 1).bit_length())
        planes, counts, zeros = [], [], []
        for level in reversed(range(levels)):
            ones = ((left >> level) & 1).astype(bool)
            words, ranks = _plane(ones)
            planes.append(words)
            counts.append(ranks)
            zeros.append(n - int(ones.sum()))
            left = np.concatenate([left[~ones], left[ones]])
        index = cls(n, (ends - lengths).astype(np.int32), vocabulary, np.zeros(symbols, np.int32), planes, counts, np.array(zeros, np.int32), marks, mark_counts, samples)
        first = index._descend(np.arange(symbols), np.zeros(symbols, np.int64))
        index.base = (before - first).astype(np.int32)
        return index

    def to_columns(self) -> dict[str, bytes]:
        held = {name: getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS.items()}
        return held | {"planes": np.concatenate(self.planes).tobytes(), "counts": np.concatenate(self.counts).tobytes()}

    @classmethod
    def from_columns(cls, n: int, row: dict[str, bytes]) -> FmIndex:
        held = {name: np.frombuffer(row[name], kind) for name, kind in cls.FIELDS.items()}
        levels = len(held["zeros"])
        planes = np.frombuffer(row["planes"], np.uint64).reshape(levels, -1)
        counts = np.frombuffer(row["counts"], np.int32).reshape(levels, -1)
        return cls(n=n, planes=list(planes), counts=list(counts), **held)

    def _descend(self, symbols: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Where places among all symbols come to lie among equal symbols in the last plane."""
        top = len(self.planes) - 1
        for level, (words, counts) in enumerate(zip(self.planes, self.counts, strict=True)):
            ones = _ones(words, counts, at)
            at = np.where((symbols >> (top - level)) & 1, self.zeros[level] + ones, at - ones)
        return at

    def rows(self, phrases: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows ``[first, last)`` of the suffixes that begin with each phrase: a row of word hashes, of which the last ``lengths`` count."""
        closing, width = len(self.starts), phrases.shape[1]
        first, last = np.zeros(len(phrases), np.int64), np.zeros(len(phrases), np.int64)
        known = np.searchsorted(self.vocabulary, phrases)
        found = np.zeros(phrases.shape, bool)
        if len(self.vocabulary):
            found = self.vocabulary[np.minimum(known, len(self.vocabulary) - 1)] == phrases
        unused = np.arange(width) < width - lengths[:, None]
        alive = np.flatnonzero((found | unused).all(1) & (lengths > 0))
        last[alive] = self.n
        for back in range(1, width + 1):
            alive = alive[(lengths[alive] >= back) & (last[alive] > first[alive])]
            if not len(alive):
                break
            symbol = known[alive, width - back] + closing
            step = self._descend(np.r_[symbol, symbol], np.r_[first[alive], last[alive]]) + np.tile(self.base[symbol], 2)
            first[alive], last[alive] = np.split(step, 2)
        return first, last

    def places(self, rows: np.ndarray) -> np.ndarray:
        """Places in the text where the suffixes of some rows start."""
        out, waiting, at, steps = np.empty(len(rows), np.int64), np.arange(len(rows)), rows.astype(np.int64), 0
        while len(waiting):
            kept = _bit(self.marks, at)
            out[waiting[kept]] = self.samples[_ones(self.marks, self.mark_counts, at[kept])] + steps
            waiting, at, steps = waiting[~kept], self._before(at[~kept]), steps + 1
        return out

    def _before(self, at: np.ndarray) -> np.ndarray:
        """The row of the suffix that starts one place earlier."""
        symbol = np.zeros(len(at), np.int64)
        for words, counts, zeros in zip(self.planes, self.counts, self.zeros, strict=True):
            bit, ones = _bit(words, at), _ones(words, counts, at)
            symbol = symbol * 2 + bit
            at = np.where(bit, zeros + ones, at - ones)
        return at + self.base[symbol]
