"""N-gram Jaccard join by T-occurrence search with DivideSkip, and the groups it links.

A document is the set of its word 5-gram hashes. Two sets of sizes m and n are similar if they share at least
``T = ceil(s * (m + n) / (1 + s))`` members. Members are put in one order for all: those of long inverted lists last.
A document looks only at its first ``n - ceil(s * n) + 1`` members, its short lists; the rest, where the long lists
are, can hold at most ``T - 1`` of the members a similar document shares. The short lists are merged with a heap, and
documents that occur often enough, ``T`` less the members not looked at, are candidates. The long lists are not read:
the candidate's sorted set is probed for the remaining members by binary search, which gives the exact overlap.

What keeps this small at any size:
- Documents with equal sets are one node, and nothing is done per copy.
- Large groups of near copies would make all their lists long. A first round links the members of such groups to one
  in their middle, verified exactly; after it, only documents of different groups need to be compared.
- Lists that only one document is in are dropped, and large ones that only one group is in. A list of more than
  ``PART`` documents is divided by hash, and its parts meet in pairs, so none is ever held whole by one task. Where a
  document stands in such a list, its counting is divided too, by the hash of the other document: into as many ways for
  all its lists, so all occurrences of a pair are counted in one place, through whichever lists the two meet.
- Which lists are long is counted over all documents. At most ``LONG_LISTS`` of them are known by name, the longest;
  any other list is read like a short one, whatever its length, so no candidate is lost.

Set members and nodes are 64-bit hashes; two different sets of one hash would be taken for copies. Defined cases: a
null text or a text without words has no members and links with nothing; a text of fewer than five words is one
member; repeated rows are copies; null ids link like others and are never the smallest of a group unless all are
null; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from itertools import groupby

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from silverline.llm.common import checkpointed
from silverline.llm.components import components
from silverline.llm.hashing import hashed_words, mixed

SHINGLE, PERCENT = 5, 80
SHORT_LIST = 16  # documents in a list that is not long
LONG_LISTS = 1 << 16  # long lists known by name: half a megabyte
MARKS = 4  # members with long lists by which the first round finds large groups
PART = 4096  # documents in the part of a list that a task holds
TILE = 512  # documents of a block whose sets a task holds
ROW = 256  # members of a list in one row
BROADCAST_ROWS = 1_000_000
_STEP = np.uint64(0x9E3779B97F4A7C15)


def shingle_sets(texts: list[bytes]) -> Iterator[np.ndarray]:
    """The sorted set of 5-gram hashes of each text."""
    for words in hashed_words([t.lower() for t in texts]):
        if not len(words):
            yield words
            continue
        size = min(SHINGLE, len(words))
        total = np.full(len(words) - size + 1, size, dtype=np.uint64)
        for i in range(size):
            total = total * _STEP + words[i : len(words) - size + 1 + i]
        yield np.unique(mixed(total))


def node_of(members: np.ndarray) -> int | None:
    """The identity of a set."""
    import xxhash

    return int(np.uint64(xxhash.xxh3_64_intdigest(members.tobytes())).view(np.int64)) if len(members) else None


def prefix_size(n: int) -> int:
    return n - -(-PERCENT * n // 100) + 1


def least_overlap(m, n):
    """Members that sets of sizes m and n must share."""
    return -(-PERCENT * (m + n) // (100 + PERCENT))


def _texts(batch, column: int, size: int = 500) -> Iterator[tuple]:
    """Parts of a batch with the texts of a column as bytes."""
    for at in range(0, batch.num_rows, size):
        part = batch.slice(at, size)
        yield part, [value.as_py() or b"" for value in part.column(column).cast("binary")]


class _Seen(set):
    """Remembers what it was asked about; forgets all when it holds too much."""

    def new(self, item) -> bool:
        if item in self:
            return False
        if len(self) >= 200_000:
            self.clear()
        self.add(item)
        return True


def _lists(arrays: list[np.ndarray]):
    import pyarrow as pa

    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    values = np.concatenate(arrays).view(np.int64) if arrays else np.empty(0, np.int64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, pa.int64()))


def _is_long(members: np.ndarray, long: np.ndarray) -> np.ndarray:
    if not len(long) or not len(members):
        return np.zeros(len(members), dtype=bool)
    return long[np.minimum(np.searchsorted(long, members), len(long) - 1)] == members


def set_table(docs: DataFrame, long: np.ndarray) -> DataFrame:
    """Rows ``(doc_id, text_key, node, n, held, marks)``: a document's set, its size, how many of its members have
    long lists, and the smallest hashes of those."""

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            for part, texts in _texts(batch, 2):
                members = list(shingle_sets(texts))
                far = [m[_is_long(m, long)] for m in members]
                columns = [
                    part.column(0), part.column(1), pa.array([node_of(m) for m in members], pa.int64()),
                    pa.array([len(m) for m in members], pa.int64()), pa.array([len(m) for m in far], pa.int64()),
                    _lists([m[:MARKS] for m in far]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_key", "node", "n", "held", "marks"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    keyed = docs.select("doc_id", F.xxhash64("text").alias("text_key"), "text")
    return keyed.mapInArrow(sets, f"doc_id {kind}, text_key long, node long, n long, held long, marks array<long>")


class _Forest:
    """Groups of linked nodes; of all links only those that join two groups are kept."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, node: int) -> int:
        parent = self.parent
        while (up := parent.setdefault(node, node)) != node:
            parent[node] = parent[up]
            node = up
        return node

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        self.parent[max(a, b)] = min(a, b)
        return a != b


def _tiled_requests(batches: Iterator) -> Iterator:
    """Rows ``(g, i, j, kind, node, others)``: what is to be compared in which tile (1), and which sets that needs (0).

    All that concerns one block comes to one task, so each need is named once.
    """
    import pyarrow as pa

    needed = _Seen()
    for batch in batches:
        g, i, j, kind, nodes, lists = [], [], [], [], [], []
        for node, others, group, own, blocks in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
            by_block: dict[int, list[int]] = {}
            for other in others:
                by_block.setdefault(other % blocks, []).append(other)
            for block, wanted in by_block.items():
                rows = [(1, node, wanted)] + [(0, n, None) for n in (node, *wanted) if needed.new((group, own, block, n))]
                for k, n, w in rows:
                    g.append(group)
                    i.append(own)
                    j.append(block)
                    kind.append(k)
                    nodes.append(n)
                    lists.append(w)
        if g:
            arrays = [pa.array(g, pa.int64()), pa.array(i, pa.int32()), pa.array(j, pa.int32()), pa.array(kind, pa.int32())]
            arrays += [pa.array(nodes, pa.int64()), pa.array(lists, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(arrays, ["g", "i", "j", "kind", "node", "others"])


def _compared(batches: Iterator) -> Iterator:
    """Exact overlaps in each tile: its sets come first, then what is to be compared. Yields links that join groups."""
    import pyarrow as pa

    tile, sets, forest = None, {}, _Forest()
    for batch in batches:
        left, right = [], []
        keys = zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)
        for key, kind, node, members, others in zip(keys, *(batch.column(c) for c in range(3, 7)), strict=True):
            if key != tile:
                tile, sets, forest = key, {}, _Forest()
            node = node.as_py()
            if kind.as_py() == 0:
                sets[node] = np.frombuffer(members.as_py(), np.uint64)
                continue
            own, wanted = sets[node], [o for o in others.as_py() if forest.root(o) != forest.root(node)]
            for at in range(0, len(wanted), 256):
                some = wanted[at : at + 256]
                sizes = np.array([len(sets[o]) for o in some])
                probed = np.concatenate([sets[o] for o in some])
                hit = own[np.minimum(np.searchsorted(own, probed), len(own) - 1)] == probed
                shared = np.add.reduceat(hit.astype(np.int64), np.cumsum(sizes) - sizes)
                for other, ok in zip(some, (shared >= least_overlap(len(own), sizes)).tolist(), strict=True):
                    if ok and forest.join(node, other):
                        left.append(node)
                        right.append(other)
        if left:
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], ["a", "b"])


def verified_links(docs: DataFrame, nodes: DataFrame, asked: DataFrame) -> DataFrame:
    """Links among the pairs asked for, by probing one sorted set with the other; enough of them to join every group.

    ``asked`` has rows ``(node, others, label)``: ``others`` to compare with ``node``, or a ``label`` of a node that is
    the same for many that are compared with each other. Nodes of a label work in one place, in blocks if they are many,
    so a set travels once or a few times, not once per pair.
    """

    def sets(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = _Seen()
        for batch in batches:
            for _, texts in _texts(batch, 0, 200):
                found = [(node_of(m), m) for m in shingle_sets(texts)]
                found = [(node, m) for node, m in found if node is not None and seen.new(node)]
                columns = [pa.array([node for node, _ in found], pa.int64()), pa.array([m.tobytes() for _, m in found], pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, ["node", "members"])

    asked = checkpointed(asked)
    labels = asked.where("label IS NOT NULL").groupBy("node").agg(F.min("label").alias("label"))
    sizes = labels.groupBy("label").agg(F.count("*").alias("there"))
    bins = max(1, labels.count() // TILE)
    blocks = F.ceil(F.col("there") / TILE).cast("int")
    group = F.when(blocks > 1, F.col("label")).otherwise(F.pmod(F.xxhash64("label"), F.lit(bins)))
    homes = labels.join(sizes, "label").select("node", group.alias("g"), blocks.alias("blocks"))
    block = F.pmod("node", "blocks").cast("int").alias("i")
    requests = asked.where("others IS NOT NULL").join(homes, "node").select("node", "others", "g", block, "blocks")
    schema = "g long, i int, j int, kind int, node long, others array<long>"
    tiled = checkpointed(requests.repartition("g", "i").mapInArrow(_tiled_requests, schema))
    needs = tiled.where("kind = 0").select("g", "i", "j", "kind", "node").distinct()
    wanted = checkpointed(nodes.join(needs.select("node").distinct(), "node").select("text_key").distinct())
    wanted = F.broadcast(wanted) if wanted.count() <= BROADCAST_ROWS else wanted  # a checked size
    texts = docs.select(F.xxhash64("text").alias("text_key"), "text").join(wanted, "text_key", "left_semi").select("text")
    known = texts.mapInArrow(sets, "node long, members binary").dropDuplicates(["node"])
    keys = ["g", "i", "j"]
    given = needs.join(known, "node").select(*keys, "kind", "node", "members", F.lit(None).cast("array<long>").alias("others"))
    put = tiled.where("kind = 1").select(*keys, "kind", "node", F.lit(None).cast("binary").alias("members"), "others")
    together = given.unionByName(put).repartition(*keys).sortWithinPartitions(*keys, "kind")
    return together.mapInArrow(_compared, "a long, b long")


def large_group_pairs(nodes: DataFrame) -> DataFrame:
    """Nodes of large groups with a node in the middle of their group.

    The members that a group shares have long lists, the changed ones of its documents have not. So of the documents
    with one mark, the one with the largest share of long lists stands in the middle. Marks are long lists known by
    name, so there are at most ``LONG_LISTS`` such documents, some megabytes: they are sent to the marked ones, whose most
    common marks would else land in one task.
    """
    marked = nodes.withColumn("token", F.explode("marks"))
    middle = F.max(F.struct((F.col("held") / F.col("n")).alias("share"), "n", "held", "node")).alias("middle")
    leaders = marked.groupBy("token").agg(middle).select(
        "token", F.col("middle.node").alias("leader"), F.col("middle.n").alias("n_leader"), F.col("middle.held").alias("held_leader")
    )
    met = marked.join(F.broadcast(leaders), "token").where("node <> leader")
    fits = F.least("n", "n_leader") * 100 >= F.greatest("n", "n_leader") * PERCENT
    found = met.where(fits).groupBy("node").agg(F.collect_set("leader").alias("others"))  # MARKS at most
    pairs = found.select("node", "others", F.array_min("others").alias("label"))
    middles = pairs.select(F.explode("others").alias("node"), "label").distinct()
    return pairs.unionByName(middles.select("node", F.lit(None).cast("array<long>").alias("others"), "label"))


def long_lists(docs: DataFrame) -> np.ndarray:
    """The members of the most documents' prefixes, counted over all documents; at most ``LONG_LISTS``, sorted.

    A task brings only the first document of a node it meets. The numbers decide an order, not a result.
    """
    tokens = postings(docs, np.empty(0, np.uint64)).select(F.explode("short").alias("token"))
    counts = tokens.groupBy("token").count().where(F.col("count") > SHORT_LIST)
    rows = counts.orderBy(F.desc("count"), "token").limit(LONG_LISTS).collect()
    return np.sort(np.array([r.token for r in rows], dtype=np.int64).view(np.uint64))


def postings(docs: DataFrame, long: np.ndarray) -> DataFrame:
    """Rows ``(node, n, short, long)``: the first members of each set in the common order, by kind of list."""

    def ordered(batches: Iterator) -> Iterator:
        import pyarrow as pa

        seen = _Seen()
        for batch in batches:
            for _, texts in _texts(batch, 0):
                nodes, sizes, short, far = [], [], [], []
                for members in shingle_sets(texts):
                    node = node_of(members)
                    if node is None or not seen.new(node):
                        continue
                    known = _is_long(members, long)
                    size = prefix_size(len(members))
                    near = members[~known][:size]
                    nodes.append(node)
                    sizes.append(len(members))
                    short.append(near)
                    far.append(members[known][: size - len(near)])
                if nodes:
                    columns = [pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()), _lists(short), _lists(far)]
                    yield pa.RecordBatch.from_arrays(columns, ["node", "n", "short", "far"])

    return docs.select("text").where("text IS NOT NULL").mapInArrow(ordered, "node long, n long, short array<long>, far array<long>")


def _shared(batches: Iterator) -> Iterator:
    """Of rows ``(token, node, n)`` sorted by token, those whose token has more than one node.

    A run of one token may span many batches; only its first row is held back.
    """
    import pyarrow as pa

    first, passed = None, False  # the first row of the last token, and whether that token has been passed on
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(3)]
        token, node, _ = columns
        start = np.flatnonzero(np.concatenate([[True], token[1:] != token[:-1]]))
        run = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(token))))
        heads = node[start].copy()
        goes_on = first is not None and token[0] == first[0]
        if goes_on:
            heads[0] = first[1]
        several = np.logical_or.reduceat(node != heads[run], start)
        front = [first] if goes_on and several[0] and not passed else []
        if goes_on and passed:
            several[0] = True
        keep = several[run]
        rows = [np.concatenate([np.array([f[i] for f in front], dtype=np.int64), column[keep]]) for i, column in enumerate(columns)]
        if len(rows[0]):
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in rows], ["token", "node", "n"])
        if len(start) > 1 or not goes_on:
            first = tuple(int(column[start[-1]]) for column in columns)
        passed = bool(several[-1])


def _partners(batches: Iterator) -> Iterator:
    """For each document in a list, the smaller similar-sized documents of other groups in it.

    Takes rows sorted by token and tile; a tile holds one part of a list, or two, whose documents then meet crosswise.
    """
    held = None
    for batch in batches:
        columns = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(8)]
        if held is not None:
            columns = [np.concatenate(x) for x in zip(held, columns, strict=True)]
        token, first, second = columns[:3]
        if not len(token):
            continue
        begun = np.flatnonzero((token != token[-1]) | (first != first[-1]) | (second != second[-1]))
        done = begun[-1] + 1 if len(begun) else 0  # the last tile may go on in the next batch
        held = [x[done:] for x in columns]
        yield from _met([x[:done] for x in columns])
    if held is not None:
        yield from _met(held)


def _met(columns: list[np.ndarray], most: int = 1 << 18) -> Iterator:
    import pyarrow as pa

    if not len(columns[0]):
        return
    token, first, second, node, n, own, part, ways = columns
    new = (token[1:] != token[:-1]) | (first[1:] != first[:-1]) | (second[1:] != second[:-1])
    tile = np.cumsum(np.concatenate([[0], new]))
    order = np.lexsort((node, tile))
    tile, node, n, own, part, ways, cross = (x[order] for x in (tile, node, n, own, part, ways, first != second))
    single = np.concatenate([[True], (tile[1:] != tile[:-1]) | (node[1:] != node[:-1])])
    tile, node, n, own, part, ways, cross = (x[single] for x in (tile, node, n, own, part, ways, cross))
    start = np.flatnonzero(np.concatenate([[True], tile[1:] != tile[:-1]]))
    size = np.diff(np.append(start, len(tile)))
    begin, there = np.repeat(start, size), np.repeat(size, size)
    until = np.cumsum(there)
    cuts = np.unique(np.searchsorted(until, np.arange(0, until[-1] + most, most)))
    for low, high in zip(cuts, np.append(cuts[1:], len(tile)), strict=True):
        if low >= high:
            continue
        wide = there[low:high]
        i = np.repeat(np.arange(low, high), wide)
        j = np.repeat(begin[low:high] - (np.cumsum(wide) - wide), wide) + np.arange(wide.sum())
        ok = (n[j] < n[i]) | ((n[j] == n[i]) & (node[j] < node[i]))
        ok &= (100 * n[j] >= PERCENT * n[i]) & ((own[j] == 0) | (own[j] != own[i])) & (~cross[i] | (part[i] != part[j]))
        i, j = i[ok], j[ok]
        if len(i):
            way = node[j] & (ways[i] - 1)  # depends on the two documents only, not on the list
            if way.any():
                by_way = np.lexsort((way, i))
                i, j, way = i[by_way], j[by_way], way[by_way]
            place = np.arange(len(i))
            begun = np.concatenate([[True], (i[1:] != i[:-1]) | (way[1:] != way[:-1])])
            place -= np.maximum.accumulate(np.where(begun, place, 0))
            at = np.flatnonzero(place % ROW == 0)  # long lists go in rows of a bounded size
            offsets = pa.array(np.append(at, len(i)).astype(np.int32))
            others, sizes = (pa.ListArray.from_arrays(offsets, pa.array(x)) for x in (node[j], n[j].astype(np.int32)))
            columns = [pa.array(node[i[at]]), pa.array(n[i[at]]), pa.array(way[at].astype(np.int32)), others, sizes]
            yield pa.RecordBatch.from_arrays(columns, ["node", "n", "way", "others", "sizes"])


def _merged(batches: Iterator) -> Iterator:
    """Heap-merge the short lists of each document and keep those that occur often enough to be similar.

    Takes rows ``(node, n, way, others, sizes)`` sorted by node and way, one for each list. Rows ``(node, others, label)``: candidates of a node, and at the end the smallest node each is connected with here.
    """
    import pyarrow as pa

    forest = _Forest()
    schema = pa.schema([("node", pa.int64()), ("others", pa.list_(pa.int64())), ("label", pa.int64())])
    key, n, lists, size_of = None, 0, [], {}

    def candidates_of(node: int) -> list[int]:
        rest = n - prefix_size(n)
        least = {m: least_overlap(n, m) - max(rest, m - prefix_size(m)) for m in set(size_of.values())}
        others = [other for other, met in groupby(heapq.merge(*lists)) if sum(1 for _ in met) >= least[size_of[other]]]
        for other in others:
            forest.join(node, other)
        return others

    def rows(found: list[tuple[int, list[int]]]):
        found = [(node, others) for node, others in found if others]
        columns = [pa.array([node for node, _ in found], pa.int64()), pa.array([others for _, others in found], pa.list_(pa.int64()))]
        return pa.RecordBatch.from_arrays([*columns, pa.nulls(len(found), pa.int64())], schema=schema)

    for batch in batches:
        found = []
        for node, size, way, others, sizes in zip(*(batch.column(i) for i in range(5)), strict=True):
            at = (node.as_py(), way.as_py())
            if at != key:
                if key is not None:
                    found.append((key[0], candidates_of(key[0])))
                key, n, lists, size_of = at, size.as_py(), [], {}
            lists.append(others.as_py())
            size_of.update(zip(lists[-1], sizes.as_py(), strict=True))
        yield rows(found)
    if key is not None:
        yield rows([(key[0], candidates_of(key[0]))])
    ends = list(forest.parent)
    for at in range(0, len(ends), 10_000):
        some = ends[at : at + 10_000]
        labels = pa.array([forest.root(node) for node in some], pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int64()), pa.nulls(len(some), pa.list_(pa.int64())), labels], schema=schema)


def candidates(posts: DataFrame, groups: DataFrame) -> DataFrame:
    """Nodes of different groups that share enough of their short lists, as :func:`verified_links` takes them."""
    short = posts.select(F.explode("short").alias("token"), "node", "n")
    by_token = short.repartition("token").sortWithinPartitions("token").mapInArrow(_shared, "token long, node long, n long")
    rows = by_token.unionByName(posts.select(F.explode("far").alias("token"), "node", "n"))
    rows = checkpointed(rows.join(groups, "node", "left").select("token", "node", "n", "component"))
    group = F.coalesce("component", "node")
    stats = rows.groupBy("token").agg(F.count("*").alias("there"), F.min(group).alias("low"), F.max(group).alias("high"))
    large = checkpointed(stats.where(F.col("there") > PART))
    large = F.broadcast(large) if large.count() <= BROADCAST_ROWS else large  # a checked size
    # powers of two: the parts of a longer list divide those of a shorter one
    parts = F.when(F.col("there") > PART, F.pow(F.lit(2), F.ceil(F.log2(F.col("there") / PART)))).otherwise(1).cast("int")
    wide = rows.join(large.where("low <> high"), "token").groupBy("node").agg(F.max(parts).alias("ways"))
    wide = checkpointed(wide)
    wide = F.broadcast(wide) if wide.count() <= BROADCAST_ROWS else wide
    live = rows.join(large, "token", "left").where("there IS NULL OR low <> high").withColumn("parts", parts)
    live = live.join(wide, "node", "left").withColumn("part", F.pmod("node", "parts").cast("int"))
    tiles = live.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    tiles = tiles.select(
        "token", F.least("part", "other").alias("first"), F.greatest("part", "other").alias("second"),
        "node", "n", F.coalesce("component", F.lit(0)).alias("own"), "part", F.coalesce("ways", F.lit(1)).alias("ways"),
    )
    keys = ["token", "first", "second"]
    schema = "node long, n long, way int, others array<long>, sizes array<int>"
    met = tiles.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(_partners, schema)
    by_node = met.repartition("node", "way").sortWithinPartitions("node", "way")
    return by_node.mapInArrow(_merged, "node long, others array<long>, label long")


def linked_groups(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The documents ``(doc_id, text_key, node, n)`` and the rows ``(node, component)`` of nodes that link with others."""
    long = long_lists(docs)
    sets = checkpointed(set_table(docs, long))
    known = sets.where("node IS NOT NULL")
    once = [F.first(c).alias(c) for c in ("n", "held", "marks")]  # equal in all documents of a node
    nodes = checkpointed(known.groupBy("node").agg(F.min("text_key").alias("text_key"), *once))
    early = checkpointed(verified_links(docs, nodes, large_group_pairs(nodes)))
    late = verified_links(docs, nodes, candidates(postings(docs, long), components(early)))
    return sets.select("doc_id", "text_key", "node", "n"), components(early.union(late))


def jaccard_components(docs: DataFrame) -> DataFrame:
    """One row per document: the size of its set and the smallest id among the documents it is linked with."""
    sets, groups = linked_groups(docs)
    of_node = sets.where("node IS NOT NULL").groupBy("node").agg(F.min("doc_id").alias("low"))
    placed = of_node.join(groups, "node", "left").withColumn("component", F.coalesce("component", "node"))
    lowest = placed.groupBy("component").agg(F.min("low").alias("component_id"))
    of_document = placed.join(lowest, "component").select("node", "component_id")
    joined = sets.join(of_document, "node", "left")
    return joined.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each group, that of the smallest id, with all its columns. Documents without words all stay."""
    sets, groups = linked_groups(docs)
    placed = sets.where("node IS NOT NULL").join(groups, "node", "left")
    placed = placed.select("doc_id", "text_key", F.coalesce("component", "node").alias("component"))
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_key")).alias("first")
    kept = placed.groupBy("component").agg(first).select("component", "first.*")
    same = placed["component"] == kept["component"]
    other = ~(placed["doc_id"].eqNullSafe(kept["doc_id"]) & (placed["text_key"] == kept["text_key"]))
    dropped = placed.join(kept, same).where(other).select(placed["doc_id"].alias("__id"), placed["text_key"].alias("__key")).distinct()
    dropped = checkpointed(dropped)
    dropped = F.broadcast(dropped) if dropped.count() <= BROADCAST_ROWS else dropped
    keyed = docs.withColumn("__text_key", F.xxhash64("text"))
    away = keyed["doc_id"].eqNullSafe(dropped["__id"]) & (keyed["__text_key"] == dropped["__key"])
    left = keyed.join(dropped, away, "left_anti")
    repeated = sets.where("node IS NOT NULL").groupBy("doc_id", "text_key").count().where("count > 1").limit(1).count()
    if repeated:  # equal rows are copies too
        worded = F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))
        left = left.where(worded).dropDuplicates(["doc_id", "__text_key"]).unionByName(left.where(~worded))
    return left.select(*[F.col(f"`{c}`") for c in docs.columns])
