"""Hashes of the words of many texts at once."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

GROUP = 1 << 20  # bytes worked on at a time
SPACES = np.zeros(256, dtype=bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
_SEED = np.random.default_rng(20240601)
_BYTE = _SEED.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.array([pow(_BASE, i, 2**64) for i in range(64)], dtype=np.uint64)
_MIX = np.uint64(0xC2B2AE3D27D4EB4F)


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(29))


def powers(n: int) -> np.ndarray:
    if n <= len(_POWERS):
        return _POWERS
    steps = np.full(n, _BASE, dtype=np.uint64)
    steps[0] = 1
    return np.multiply.accumulate(steps)


def cut_bytes(data: bytes, most: int = GROUP) -> Iterator[bytes]:
    """A text in parts of about ``most`` bytes, cut at ASCII white space so that no word is divided."""
    start = 0
    while len(data) - start > most:
        at = start + most
        while at < len(data) and not SPACES[data[at]]:
            at += 1
        yield data[start:at]
        start = at
    yield data[start:] if start else data


def groups(texts: list[bytes], most: int = GROUP) -> Iterator[tuple[list[int], list[bytes]]]:
    """Texts, long ones in parts, in groups of about ``most`` bytes: the number of each part's text, and the parts."""
    numbers, parts, held = [], [], 0
    for i, text in enumerate(texts):
        for part in cut_bytes(text, most):
            if parts and held + len(part) > most:
                yield numbers, parts
                numbers, parts, held = [], [], 0
            numbers.append(i)
            parts.append(part)
            held += len(part) + 1
    if parts:
        yield numbers, parts


def word_spans(data: np.ndarray, spaces: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray]:
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~spaces[data]
    edge = np.diff(word)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the words between the given places: a polynomial in the bytes, mixed."""
    if not len(starts):
        return np.empty(0, dtype=np.uint64)
    lengths = ends - starts
    until = np.cumsum(lengths)
    first = until - lengths
    place = np.arange(until[-1]) - np.repeat(first, lengths)
    letters = data[np.repeat(starts, lengths) + place]
    values = _BYTE[letters] * powers(int(lengths.max()))[place]
    return mixed(np.add.reduceat(values, first) + lengths.astype(np.uint64))


def hashed_words(texts: list[bytes], spaces: np.ndarray = SPACES) -> Iterator[np.ndarray]:
    """The word hashes of each text in turn; words are what stands between the bytes marked in ``spaces``."""
    at, pieces = 0, []
    for numbers, parts in groups(texts):
        data = np.frombuffer(b"\n".join(parts), dtype=np.uint8)
        starts, ends = word_spans(data, spaces)
        hashes = word_hashes(data, starts, ends)
        borders = np.cumsum([0, *[len(p) + 1 for p in parts]])
        cuts = np.searchsorted(starts, borders)
        for k, number in enumerate(numbers):
            while at < number:
                yield np.concatenate(pieces) if len(pieces) > 1 else pieces[0]
                at, pieces = at + 1, []
            pieces.append(hashes[cuts[k] : cuts[k + 1]])
    if pieces:
        yield np.concatenate(pieces) if len(pieces) > 1 else pieces[0]
