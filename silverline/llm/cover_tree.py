"""A cover tree for inner products: what lies in a window of scores is found without looking at all candidates.

A candidate ``x`` gets one more component, ``sqrt(M^2 - |x|^2)`` with ``M`` the largest norm, and a query a zero, so that
a larger inner product is a smaller distance. A node covers candidates around one of them. Its children are a net of
them, the node's own centre first: no two are nearer than the level's covering radius, half of what the node reaches,
and every candidate goes to its nearest child. Nodes know how far they reach, the lone label below them, if any, and a
leaf's candidates stand together. With distance ``d`` of the query from the centre and reach ``r``, the inner products
below a node lie between ``(|q|^2 + M^2 - (d + r)^2) / 2`` and ``(|q|^2 + M^2 - max(0, d - r)^2) / 2``, and within
``|q| r`` of that of the centre.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np

LEAF = 32  # candidates that are not divided any further
CHUNK = 256
LOWEST, HIGHEST = -(2**63), 2**63 - 1
_ROUND = 1e-9  # more than what rounding can change, as a share of the squared norms


def _squares(points: np.ndarray, norms: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Squared distances of points, with their squared norms, from some of them."""
    return np.maximum(norms[:, None] + (centres * centres).sum(1)[None, :] - 2 * points @ centres.T, 0)


def net(points: np.ndarray, first: int, radius: float) -> np.ndarray:
    """Points further than ``radius`` from each other and so near to all others: ``first``, then in order."""
    norms, chosen, limit = (points * points).sum(1), [first], radius * radius
    for at in range(0, len(points), CHUNK):
        part = points[at : at + CHUNK]
        far = np.ones(len(part), bool)
        for low in range(0, len(chosen), 4096):
            far &= (_squares(part, norms[at : at + CHUNK], points[chosen[low : low + 4096]]) > limit).all(1)
        places = np.flatnonzero(far)
        if not len(places):
            continue
        apart = _squares(part[places], norms[at + places], part[places]) > limit
        open_ = np.ones(len(places), bool)
        for i in range(len(places)):
            if open_[i]:
                chosen.append(at + int(places[i]))
                open_ &= apart[i]
    return np.array(chosen)


def nearest(points: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each point and its distance."""
    norms = (points * points).sum(1)
    which, far = np.empty(len(points), np.int64), np.empty(len(points))
    for at in range(0, len(points), CHUNK):
        squares = _squares(points[at : at + CHUNK], norms[at : at + CHUNK], centres)
        which[at : at + CHUNK] = squares.argmin(1)
        far[at : at + CHUNK] = np.sqrt(squares.min(1))
    return which, far


@dataclass
class CoverTree:
    """Candidates in tree order with ids, labels and rows; nodes so that the children of each stand together."""

    ids: np.ndarray
    labels: np.ndarray
    rows: np.ndarray
    vectors: np.ndarray
    centres: np.ndarray  # of each node: the place of its centre
    reach: np.ndarray
    label: np.ndarray  # the only label below, or -1 beside ``mixed``
    mixed: np.ndarray
    begin: np.ndarray  # candidates below the node
    end: np.ndarray
    child: np.ndarray  # children, none for a leaf
    child_end: np.ndarray

    FIELDS = {
        "ids": np.int64, "labels": np.int64, "rows": np.int64, "vectors": np.float64, "centres": np.int64, "reach": np.float64, "label": np.int64,
        "mixed": np.bool_, "begin": np.int64, "end": np.int64, "child": np.int64, "child_end": np.int64,
    }

    @classmethod
    def build(cls, ids: np.ndarray, labels: np.ndarray, rows: np.ndarray, vectors: np.ndarray) -> CoverTree:
        squares = (vectors * vectors).sum(1)
        most = squares.max(initial=0)
        points = np.c_[vectors, np.sqrt(np.maximum(most - squares, 0))]
        none = np.sqrt(most * 1e-12)  # a reach that is nothing but rounding
        order = np.arange(len(ids))
        far = nearest(points, points[:1])[1] if len(ids) else np.empty(0)
        centre, reach, begin, end, child, child_end = [0], [far.max(initial=0)], [0], [len(ids)], [0], [0]
        at = 0
        while at < len(centre):
            low, high = begin[at], end[at]
            if high - low > LEAF and reach[at] > none:
                members = order[low:high].copy()
                own = points[members]
                first = int(np.flatnonzero(members == centre[at])[0])
                chosen = net(own, first, reach[at] / 2)
                which, distance = nearest(own, own[chosen])
                which[chosen] = np.arange(len(chosen))  # rounding must not empty a child
                by = np.argsort(which, kind="stable")
                order[low:high] = members[by]
                borders = np.searchsorted(which[by], np.arange(len(chosen) + 1))
                child[at], child_end[at] = len(centre), len(centre) + len(chosen)
                centre += members[chosen].tolist()
                reach += np.maximum.reduceat(distance[by], borders[:-1]).tolist()
                begin += (low + borders[:-1]).tolist()
                end += (low + borders[1:]).tolist()
                child += [0] * len(chosen)
                child_end += [0] * len(chosen)
            at += 1
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        begin, end, labels = np.array(begin), np.array(end), labels[order]
        changes = np.r_[0, np.cumsum(labels[1:] != labels[:-1])] if len(ids) else np.zeros(1, np.int64)
        some = end > begin
        mixed = np.zeros(len(begin), bool)
        mixed[some] = changes[end[some] - 1] > changes[begin[some]]
        label = np.full(len(begin), -1)
        label[some] = labels[begin[some]]
        where = place[np.array(centre)] if len(ids) else np.zeros(1, np.int64)
        radius = np.array(reach) * (1 + 1e-9) + none
        return cls(ids[order], labels, rows[order], vectors[order], where, radius, label, mixed, begin, end, np.array(child), np.array(child_end))

    def to_columns(self) -> dict[str, bytes]:
        return {name: getattr(self, name).astype(kind).tobytes() for name, kind in self.FIELDS.items()}

    @classmethod
    def from_columns(cls, row: dict[str, bytes]) -> CoverTree:
        held = {name: np.frombuffer(row[name], kind) for name, kind in cls.FIELDS.items()}
        held["vectors"] = held["vectors"].reshape(len(held["ids"]), -1) if len(held["ids"]) else np.zeros((0, 0))
        return cls(**held)


class Best:
    """The best ``k`` candidates of one window of scores: highest first, ties to the smaller id."""

    def __init__(self, low: int, high: int, k: int):
        self.low, self.high, self.k = low, high, k
        self.scores, self.ids = np.empty(0, np.int64), np.empty(0, np.int64)

    def least(self) -> int:
        """Scores below this no longer count."""
        return int(self.scores[-1]) if len(self.scores) == self.k else self.low

    def add(self, scores: np.ndarray, ids: np.ndarray) -> None:
        fits = (scores >= self.least()) & (scores <= self.high)
        if fits.any():
            scores, ids = np.r_[self.scores, scores[fits]], np.r_[self.ids, ids[fits]]
            best = np.lexsort((ids, ~scores))[: self.k]  # ~s falls as s rises, at the ends of a long too
            self.scores, self.ids = scores[best], ids[best]


class Search:
    """Searches in one tree; ``visited`` counts the candidates and centres whose scores were taken."""

    def __init__(self, tree: CoverTree):
        self.tree, self.visited = tree, 0
        self.norm = (tree.vectors * tree.vectors).sum(1).max(initial=0)
        self.largest = np.abs(tree.vectors).max(initial=0)
        self.centres = tree.vectors[tree.centres] if len(tree.ids) else tree.vectors

    def _safe(self, query: np.ndarray) -> bool:
        """Whether doubles hold all scores of the query exactly."""
        return bool(np.abs(query).max(initial=0) * self.largest * max(1, len(query)) < 2**53)

    def exact(self, query: np.ndarray, places: slice) -> np.ndarray:
        """Inner products as whole numbers; scores beyond a long stop at its ends."""
        vectors = self.tree.vectors[places]
        if self._safe(query):
            return (vectors @ query).astype(np.int64)
        whole = [int(x) for x in query]
        sums = [sum(int(x) * y for x, y in zip(v, whole, strict=True)) for v in vectors]
        return np.array([min(max(s, LOWEST), HIGHEST) for s in sums], np.int64)

    def run(self, query: np.ndarray, row: int, label: int, same: bool, windows: list[Best]) -> None:
        """Fill the windows with candidates, ``row`` itself apart, of the same label or of others, best nodes first."""
        tree = self.tree
        if not len(tree.ids) or not windows:
            return
        square = float(query @ query)
        length, slack = np.sqrt(square), _ROUND * (square + self.norm)
        high = np.array([w.high for w in windows], float)
        safe = self._safe(query)

        def take(scores: np.ndarray, ids: np.ndarray, rows: np.ndarray, labels: np.ndarray) -> None:
            fits = (rows != row) & ((labels == label) == same)
            if fits.any():
                for window in windows:
                    window.add(scores[fits], ids[fits])

        def wanted(nodes: slice) -> list[tuple[float, int, float]]:
            """Nodes that may hold something for some window, with their bounds; lone candidates are taken at once."""
            scores = self.centres[nodes] @ query
            self.visited += len(scores)
            lone = (tree.end[nodes] - tree.begin[nodes] == 1) & safe
            if lone.any():
                places = tree.centres[nodes][lone]
                take(scores[lone].astype(np.int64), tree.ids[places], tree.rows[places], tree.labels[places])
            distance = np.sqrt(np.maximum(square + self.norm - 2 * scores, 0))
            reach = tree.reach[nodes]
            above = np.minimum(scores + length * reach, (square + self.norm - np.maximum(distance - reach, 0) ** 2) / 2) + slack
            below = np.maximum(scores - length * reach, (square + self.norm - (distance + reach) ** 2) / 2) - slack
            least = np.array([w.least() for w in windows], float)
            useful = ~lone & ((above[:, None] >= least) & (below[:, None] <= high)).any(1)
            useful &= (tree.label[nodes] == label) | tree.mixed[nodes] if same else (tree.label[nodes] != label) | tree.mixed[nodes]
            places = np.flatnonzero(useful)
            return list(zip((-above[places]).tolist(), (places + nodes.start).tolist(), (below[places]).tolist(), strict=True))

        heap = wanted(slice(0, 1))
        while heap:
            above, node, below = heapq.heappop(heap)
            least = [w.least() for w in windows]
            if -above < min(least):
                break  # all that is left is worse
            if not any(-above >= t and below <= w.high for t, w in zip(least, windows, strict=True)):
                continue
            if tree.child_end[node] > tree.child[node]:
                for found in wanted(slice(int(tree.child[node]), int(tree.child_end[node]))):
                    heapq.heappush(heap, found)
                continue
            leaf = slice(int(tree.begin[node]), int(tree.end[node]))
            self.visited += leaf.stop - leaf.start
            take(self.exact(query, leaf), tree.ids[leaf], tree.rows[leaf], tree.labels[leaf])
