"""Jaccard join of documents' word n-grams by prefix trees."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.graph import components
from tallyloom.llm.store import broadcast_if_small, materialize
from tallyloom.llm.words import LOWER, SPACE, blocks, mix, window_hashes, word_hashes

WIDTH = 5  # words of a shingle
HASHES = 1 << 19  # shingles that one group of the counting steps holds, on average
PIVOTS = 16  # sets of a large component that all others of it are compared with first
GROUP_BYTES = 8 << 20  # of sets that one trie task holds, on average
_LAST_ID = (1 << 63) - 1  # stands for a NULL id, which comes last
_SHORT = np.uint64(0x2545F4914F6CDD1D)

# Two sets are linked from a Jaccard index of 3/4 on, which means that 7 times their
# overlap is at least 3 times the sum of their sizes.


def need(n):
    """The least overlap with any partner: three quarters of the size, rounded up."""
    return (3 * n + 3) // 4


def head(n):
    """How many of a set's smallest hashes are compared to find out if it can have partners.

    The first ``n - need(n) + e`` hashes of both of two linked sets hold their ``e``
    smallest common ones; ``e`` is a tenth of the size here.
    """
    return np.minimum(n, n - need(n) + (n + 9) // 10)


def shared(n):
    """How many of these at least are in a partner's, whose size is ``need(n)`` or more."""
    return (need(n) + 9) // 10


def shingle_sets(texts: pa.Array) -> Iterator[np.ndarray]:
    """For each text the sorted hashes of its distinct shingles.

    A text of fewer words than a shingle is one shingle; one without words is empty.
    """
    for _, data, offsets in blocks(texts):
        words, first = word_hashes(data, offsets, SPACE, LOWER)
        windows = window_hashes(words, WIDTH)
        for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if b - a >= WIDTH:
                yield np.unique(windows[a : b - WIDTH + 1])
            elif b > a:
                odd = np.arange(1, b - a + 1, dtype=np.uint64) * np.uint64(2) + np.uint64(b - a) * _SHORT
                yield mix(np.array([(words[a:b] * odd).sum()], np.uint64))
            else:
                yield np.zeros(0, np.uint64)


def set_id(hashes: np.ndarray) -> int:
    """The id of a set: equal sets have equal ids."""
    return int.from_bytes(hashlib.blake2b(hashes.tobytes(), digest_size=8).digest(), "little", signed=True)


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sets = [(len(s), set_id(s) if len(s) else None) for s in shingle_sets(batch.column(3))]
        sizes, ids = zip(*sets, strict=True) if sets else ([], [])
        arrays = [*batch.columns[:3], pa.array(sizes, pa.int64()), pa.array(ids, pa.int64())]
        yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "id", "hash", "n", "sid"])


BLOBS = "part int, h binary, i binary, ids binary, ns binary"


def _blobs(parts: int, of: Callable[[np.ndarray], np.ndarray], limit: int = 600_000):
    """Sets, many at a time, dealt out by hash: for each part its hashes, and whose they are."""

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = [pa.int32(), *[pa.binary()] * 4]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
        return pa.RecordBatch.from_arrays(columns, ["part", "h", "i", "ids", "ns"])

    def flush(sets: dict[int, np.ndarray], sizes: list[int]) -> Iterator[pa.RecordBatch]:
        ids, ns = np.array(list(sets), np.int64), np.array(sizes, np.int64)
        h = np.concatenate(list(sets.values()))
        own = np.repeat(np.arange(len(ids), dtype=np.uint32), [len(s) for s in sets.values()])
        part = (h % np.uint64(parts)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        h, own = h[order], own[order]
        edges = np.searchsorted(part[order], np.arange(parts + 1))
        rows: list[tuple] = []
        for p in range(parts):
            a, b = int(edges[p]), int(edges[p + 1])
            if b > a:
                used, inverse = np.unique(own[a:b], return_inverse=True)
                inverse = inverse.astype(np.uint32)
                blobs = (h[a:b], inverse, ids[used], ns[used])
                rows.append((p, *(x.tobytes() for x in blobs)))
            if len(rows) == 64:
                yield batch_of(rows)
                rows = []
        if rows:
            yield batch_of(rows)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets: dict[int, np.ndarray] = {}
        sizes: list[int] = []
        total = 0
        for batch in batches:
            for hashes in shingle_sets(batch.column(0)):
                if len(hashes) and (sid := set_id(hashes)) not in sets:
                    sets[sid] = of(hashes)
                    sizes.append(len(hashes))
                    total += len(sets[sid])
                if total >= limit:
                    yield from flush(sets, sizes)
                    sets, sizes, total = {}, [], 0
        if sets:
            yield from flush(sets, sizes)

    return run


def _gathered(table: pa.Table) -> tuple[np.ndarray, ...]:
    """Distinct (hash, set, size) of a part, sorted, and the number of sets that have the hash."""
    parts = []
    for h, i, ids, ns in zip(*(table.column(c).to_pylist() for c in ("h", "i", "ids", "ns")), strict=True):
        own = np.frombuffer(i, np.uint32)
        ids, ns = np.frombuffer(ids, np.int64)[own], np.frombuffer(ns, np.int64)[own]
        parts.append((np.frombuffer(h, np.uint64), ids, ns))
    h, sid, n = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.lexsort((sid, h))
    h, sid, n = h[order], sid[order], n[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (sid[1:] != sid[:-1])
    h, sid, n = h[new], sid[new], n[new]
    starts = np.flatnonzero(np.concatenate([[True], h[1:] != h[:-1]]))
    counts = np.diff(np.append(starts, len(h)))
    return h, sid, n, np.repeat(counts, counts)


COUNTS = "owner int, sid binary, k binary"


def _owner(sid: np.ndarray, owners: int) -> np.ndarray:
    return (mix(sid.view(np.uint64)) % np.uint64(owners)).astype(np.int64)


def _dealt(schema: str, owner: np.ndarray, owners: int, columns: list[np.ndarray]) -> pa.Table:
    """One row per owner with its values of the columns, each as bytes."""
    order = np.argsort(owner, kind="stable")
    columns = [c[order] for c in columns]
    edges = np.searchsorted(owner[order], np.arange(owners + 1))
    rows = [
        (o, *(c[edges[o] : edges[o + 1]].tobytes() for c in columns))
        for o in range(owners)
        if edges[o + 1] > edges[o]
    ]
    lists = list(zip(*rows, strict=True)) or [[]] * (1 + len(columns))
    types = [pa.int32(), *[pa.binary()] * len(columns)]
    names = [part.split()[0] for part in schema.split(", ")]
    return pa.table([pa.array(c, t) for c, t in zip(lists, types, strict=True)], names)


def _count_shared(owners: int) -> Callable[[pa.Table], pa.Table]:
    """How many hashes of each set of a part another set has too, dealt out by set."""

    def run(table: pa.Table) -> pa.Table:
        _, sid, _, count = _gathered(table)
        ids, found = np.unique(sid[count > 1], return_counts=True)
        return _dealt(COUNTS, _owner(ids, owners), owners, [ids, found.astype(np.int64)])

    return run


def _summed(table: pa.Table) -> pa.Table:
    """The counts of each set over all parts."""
    sid, k = (
        np.concatenate([np.frombuffer(x, np.int64) for x in table.column(name).to_pylist()])
        for name in ("sid", "k")
    )
    ids, at = np.unique(sid, return_inverse=True)
    return pa.table({"sid": ids, "k": np.bincount(at, k, len(ids)).astype(np.int64)})


FOUND = "owner int, sid binary, n binary, h binary, d binary"


def _frequencies(owners: int) -> Callable[[pa.Table], pa.Table]:
    """The hashes of a part that several sets have, dealt out by set, with the sets' number."""

    def run(table: pa.Table) -> pa.Table:
        h, sid, n, count = _gathered(table)
        several = count > 1
        columns = [x[several] for x in (sid, n, h, count.astype(np.int64))]
        return _dealt(FOUND, _owner(columns[0], owners), owners, columns)

    return run


def _ordered(table: pa.Table) -> pa.Table:
    """Sets that can still have partners, their shared hashes rarest first."""
    kinds = {"sid": np.int64, "n": np.int64, "h": np.uint64, "d": np.int64}
    sid, n, h, d = (
        np.concatenate([np.frombuffer(x, kind) for x in table.column(name).to_pylist()])
        for name, kind in kinds.items()
    )
    order = np.lexsort((h, d, sid))
    sid, n, h, d = sid[order], n[order], h[order], d[order]
    starts = np.flatnonzero(np.concatenate([[True], sid[1:] != sid[:-1]]))
    ends = np.append(starts[1:], len(sid))
    spans = [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= need(n[a])]
    return pa.table(
        {
            "sid": pa.array([sid[a] for a, _ in spans], pa.int64()),
            "n": pa.array([n[a] for a, _ in spans], pa.int64()),
            "h": pa.array([h[a:b].tobytes() for a, b in spans], pa.binary()),
            "d": pa.array([d[a:b].tobytes() for a, b in spans], pa.binary()),
        }
    )


def _prefixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(hash, size band, set) of each set's prefix of rare hashes.

    Linked sets have a hash of both prefixes in common. Sizes that can be linked are in
    one band or in neighbouring ones, so each set stands in its own and the one below.
    """
    for batch in batches:
        hashes, bands, sids = [], [], []
        for sid, n, h in zip(*(c.to_pylist() for c in batch.columns[:3]), strict=True):
            own = np.frombuffer(h, np.uint64)
            own = own[: len(own) - need(n) + 1].view(np.int64)
            band = int(np.log(n) / np.log(1.34))
            hashes += [own, own]
            bands += [np.full(len(own), band), np.full(len(own), band - 1)]
            sids.append(np.full(2 * len(own), sid))
        if hashes:
            columns = [np.concatenate(x) for x in (hashes, bands, sids)]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["h", "band", "sid"])


class Forest:
    """Union-find over 0 to n - 1; the root is the smallest member."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = x = self.up[self.up[x]]
        return x

    def union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


class Trie:
    """A compressed prefix tree of sequences of ascending ranks, with bounds below each node.

    Node ``k`` holds ranks ``start[k]`` to ``end[k]`` of the sequence ``member[k]``, the
    sequences that end there, and of all sequences below the least and largest set
    size and the longest way to an end.
    """

    def __init__(self, ranks: list[np.ndarray], sizes: list[int]) -> None:
        self.ranks, self.sizes = ranks, sizes
        self.start, self.end, self.member = [0], [0], [-1]
        self.children: list[list[int]] = [[]]
        self.leaves: list[list[int]] = [[]]
        order = sorted(range(len(ranks)), key=lambda s: ranks[s].astype(">u4").tobytes())
        path, before = [0], None
        for s in order:
            common = 0 if before is None else self._common(ranks[before], ranks[s])
            below = None
            while self.end[path[-1]] > common:
                below = path.pop()
            if self.end[path[-1]] < common:
                middle = self._node(self.end[path[-1]], common, self.member[below])
                self.children[path[-1]][-1] = middle
                self.children[middle].append(below)
                self.start[below] = common
                path.append(middle)
            if len(ranks[s]) > common:
                node = self._node(common, len(ranks[s]), s)
                self.children[path[-1]].append(node)
                path.append(node)
            self.leaves[path[-1]].append(s)
            before = s
        self._bounds()

    def _node(self, start: int, end: int, member: int) -> int:
        self.start.append(start)
        self.end.append(end)
        self.member.append(member)
        self.children.append([])
        self.leaves.append([])
        return len(self.start) - 1

    @staticmethod
    def _common(a: np.ndarray, b: np.ndarray) -> int:
        n = min(len(a), len(b))
        differ = a[:n] != b[:n]
        return int(differ.argmax()) if differ.any() else n

    def _bounds(self) -> None:
        n = len(self.start)
        self.least, self.most, self.tail = [1 << 60] * n, [0] * n, [0] * n
        order, stack = [], [0]
        while stack:
            order.append(k := stack.pop())
            stack += self.children[k]
        for k in reversed(order):
            for s in self.leaves[k]:
                self.least[k] = min(self.least[k], self.sizes[s])
                self.most[k] = max(self.most[k], self.sizes[s])
            for c in self.children[k]:
                self.least[k] = min(self.least[k], self.least[c])
                self.most[k] = max(self.most[k], self.most[c])
                self.tail[k] = max(self.tail[k], self.end[c] - self.start[c] + self.tail[c])
        self.first = [
            np.array([self.ranks[self.member[c]][self.start[c]] for c in own]) if len(own) > 8 else None
            for own in self.children
        ]
        self.bounds = [
            np.array([[self.end[c] - self.start[c] + self.tail[c], self.least[c]] for c in own]).T
            if len(own) > 8
            else None
            for own in self.children
        ]
        # A member of each node whose sequences are known to be in one component.
        self.one: list[int | None] = [None] * n

    def link(self, a: int, marked: np.ndarray, forest: Forest) -> None:
        """Join ``a`` with the sets of its size or less that it is linked with.

        A subtree is left out if its sizes do not fit, if the overlap so far and what
        remains on both sides cannot reach the least overlap, or if all of it is in the
        component of ``a`` already.
        """
        own, size, least_n = self.ranks[a], self.sizes[a], need(self.sizes[a])
        marked[own] = True
        stack = [(0, 0, 0)]
        while stack:
            k, overlap, place = stack.pop()
            if overlap < 0:
                self._unite(k, forest)
                continue
            if self.most[k] < least_n or self.least[k] > size:
                continue
            if self.one[k] is not None and forest.find(self.one[k]) == forest.find(a):
                continue
            if self.end[k] > self.start[k]:
                run = self.ranks[self.member[k]][self.start[k] : self.end[k]]
                overlap += int(np.count_nonzero(marked[run]))
                place = int(np.searchsorted(own, run[-1], "right"))
            reach = overlap + min(len(own) - place, self.tail[k])
            if 7 * reach < 3 * (size + max(self.least[k], least_n)):
                continue
            for s in self.leaves[k]:
                if s != a and self.sizes[s] <= size and 7 * overlap >= 3 * (size + self.sizes[s]):
                    forest.union(a, s)
            below = self.children[k]
            stack.append((k, -1, 0))
            if self.first[k] is not None:
                length, least = self.bounds[k]
                passed = np.searchsorted(own, self.first[k])
                reach = overlap + np.minimum(len(own) - passed, length)
                fit = 7 * reach >= 3 * (size + np.maximum(least, least_n))
                below = [below[c] for c in np.flatnonzero(fit).tolist()]
            stack += [(c, overlap, place) for c in below]
        marked[own] = False

    def _unite(self, k: int, forest: Forest) -> None:
        roots = {forest.find(s) for s in self.leaves[k]}
        for c in self.children[k]:
            if self.one[c] is None or len(roots) > 1:
                return
            roots.add(forest.find(self.one[c]))
        if len(roots) == 1:
            self.one[k] = roots.pop()


def link_sets(
    hashes: list[np.ndarray], counts: list[np.ndarray], sizes: list[int], known: list[int] | None = None
) -> list[int]:
    """For each set the smallest index that it is linked with, directly or over others.

    Sets with equal ``known`` labels are linked already.

    The sets' shared hashes are ordered by their count in the corpus, most frequent
    first, so that sets of one origin share long paths.
    """
    all_h, at = np.unique(np.concatenate(hashes), return_index=True)
    order = np.lexsort((all_h, -np.concatenate(counts)[at]))
    rank_of = np.empty(len(all_h), np.int64)
    rank_of[order] = np.arange(len(all_h))
    ranks = [np.sort(rank_of[np.searchsorted(all_h, h)]) for h in hashes]
    trie, forest = Trie(ranks, sizes), Forest(len(sizes))
    first: dict[int, int] = {}
    for a, label in enumerate(known or ()):
        forest.union(a, first.setdefault(label, a))
    marked = np.zeros(len(all_h), bool)
    for a in range(len(sizes)):
        trie.link(a, marked, forest)
    return [forest.find(a) for a in range(len(sizes))]


def _link_group(table: pa.Table) -> pa.Table:
    """(set, root) of the sets of a group, component by component of the candidates."""
    table = table.sort_by([("root", "ascending"), ("sid", "ascending")])
    roots = table.column("root").to_numpy()
    sids = table.column("sid").to_numpy()
    sizes = table.column("n").to_pylist()
    labels = table.column("label").to_pylist()
    edges = [0, *(np.flatnonzero(roots[1:] != roots[:-1]) + 1).tolist(), len(roots)]
    out: list[np.ndarray] = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        h = [np.frombuffer(x, np.uint64) for x in table.column("h")[a:b].to_pylist()]
        d = [np.frombuffer(x, np.int64) for x in table.column("d")[a:b].to_pylist()]
        out.append(sids[a:b][link_sets(h, d, sizes[a:b], labels[a:b])])
    return pa.table({"node": sids, "root": np.concatenate(out)})


def _key(id_col: str, text_col: str) -> dict[str, Column]:
    return {
        "id": F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)),
        "hash": F.xxhash64(F.col(text_col)),
    }


def _parts(total: int | None) -> int:
    return max(1, -(-int(total or 0) // HASHES))


def _linked(texts: DataFrame, classes: DataFrame, group_bytes: int) -> DataFrame:
    """(node, root) of all sets that are linked with another."""
    n_head = F.col("n") - F.floor((3 * F.col("n") + 3) / 4) + F.floor((F.col("n") + 9) / 10)
    total = classes.agg(F.sum(n_head)).first()[0]
    parts = _parts(total)
    heads = texts.select("text").mapInArrow(_blobs(parts, lambda s: s[: head(len(s))]), BLOBS)
    counts = heads.groupBy("part").applyInArrow(_count_shared(parts), COUNTS)
    summed = counts.groupBy("owner").applyInArrow(_summed, "sid long, k long")
    least = F.floor((F.floor((3 * F.col("n") + 3) / 4) + 9) / 10)
    may_link = materialize(
        summed.join(classes, "sid").where(F.col("k") >= least).select("sid", "n", "key.id", "key.hash"),
        "sets",
    )

    total = may_link.agg(F.sum("n")).first()[0]
    some = broadcast_if_small(may_link.select("id", "hash"))
    parts = _parts(total)
    full = texts.join(some, ["id", "hash"]).select("text").mapInArrow(_blobs(parts, lambda s: s), BLOBS)
    shared_by = full.groupBy("part").applyInArrow(_frequencies(parts), FOUND)
    sets = materialize(
        shared_by.groupBy("owner").applyInArrow(_ordered, "sid long, n long, h binary, d binary"),
        "sets",
    )

    places = materialize(sets.mapInArrow(_prefixes, "h long, band long, sid long"), "prefixes")
    leaders = places.groupBy("h", "band").agg(F.min("sid").alias("leader"), F.count("*").alias("m"))
    pairs = places.join(leaders.where("m > 1"), ["h", "band"]).where("sid <> leader")
    near = components(pairs.select("sid", "leader"), "sid", "leader")

    grouped = sets.join(near.select(F.col("node").alias("sid"), "root"), "sid")
    grouped = materialize(grouped, "sets")
    weights = grouped.groupBy("root").agg(F.sum(F.length("h") * 2).alias("bytes"))
    weights = materialize(
        weights.withColumn("blocks", F.ceil(F.col("bytes") / group_bytes)), "weights"
    )
    total, most = weights.agg(F.sum("bytes"), F.max("blocks")).first()
    tasks = max(1, -(-int(total or 0) // group_bytes))
    # A component of one block shares a task with others; larger ones are taken apart.
    block = F.pmod(F.xxhash64("sid"), F.col("blocks"))
    with_blocks = grouped.join(weights.select("root", "blocks"), "root").withColumns(
        {"block": block, "label": F.col("sid")}
    )
    small = with_blocks.where("blocks = 1").withColumn(
        "task", F.pmod(F.xxhash64("root"), F.lit(tasks)).cast("string")
    )
    if (most or 0) <= 1:
        return materialize(_links(small), "links")
    return _link_large(small, with_blocks.where("blocks > 1"), group_bytes)


def _links(rows: DataFrame) -> DataFrame:
    """(node, root) of the sets that are linked within a task."""
    found = rows.select("task", "root", "sid", "n", "h", "d", "label").groupBy("task")
    return found.applyInArrow(_link_group, "node long, root long").where("node <> root")


def _link_large(small: DataFrame, large: DataFrame, group_bytes: int) -> DataFrame:
    """(node, root) of all linked sets, where some components are of several blocks.

    Each block is linked first, together with the same few pivots of its component, so
    that what is close to a pivot is one group over all blocks. Two sets of the largest
    group need not meet any more; every other set then meets all sets. So the work is
    linear in a component whose sets are mostly alike, and no pair is missed in any.
    """
    salt = F.pmod(F.xxhash64("sid", F.lit(1)), F.lit(PIVOTS))
    pivots = large.groupBy("root", salt).agg(F.min("sid").alias("sid")).select("sid")
    everywhere = (
        large.join(broadcast_if_small(materialize(pivots, "pivots")), "sid")
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .where("other <> block")
        .withColumn("block", F.col("other"))
        .drop("other")
    )
    dealt = large.unionByName(everywhere).withColumn("task", F.concat_ws(":", "root", "block"))
    near = materialize(_links(small.unionByName(dealt)), "links")
    groups = components(near, "node", "root").select(F.col("node").alias("sid"), F.col("root").alias("label"))
    labels = materialize(
        large.select("root", "sid", (F.length("h") * 2).alias("bytes"))
        .join(groups, "sid", "left")
        .withColumn("label", F.coalesce("label", "sid")),
        "labels",
    )
    by_label = labels.groupBy("root", "label").agg(F.sum("bytes").alias("bytes"))
    largest = by_label.groupBy("root").agg(
        F.max(F.struct("bytes", "label")).alias("most"), F.sum("bytes").alias("total")
    )
    n_blocks = lambda size: F.ceil(size / group_bytes)
    largest = materialize(
        largest.select(
            "root",
            F.col("most.label").alias("main"),
            n_blocks(F.col("most.bytes")).alias("main_blocks"),
            n_blocks(F.col("total") - F.col("most.bytes")).alias("rest_blocks"),
        ).where("rest_blocks > 0"),
        "largest",
    )
    if largest.isEmpty():
        return components(near, "node", "root")
    known = labels.select("sid", "label")
    open_ = large.drop("label", "blocks", "block").join(known, "sid").join(broadcast_if_small(largest), "root")
    # Every block of the rest meets every block of the largest group, and every other of the rest.
    count = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    in_main, in_rest = (F.pmod(F.xxhash64("sid"), F.col(f"{n}_blocks")) for n in ("main", "rest"))
    main = open_.where("label = main").withColumns({"x": count("rest_blocks")})
    main = main.withColumn("task", F.concat_ws(":", F.lit("m"), "root", "x", in_main))
    rest = open_.where("label <> main").withColumn("own", in_rest)
    to_main = rest.withColumn("x", count("main_blocks"))
    to_main = to_main.withColumn("task", F.concat_ws(":", F.lit("m"), "root", "own", "x"))
    to_rest = rest.withColumn("x", count("rest_blocks")).where("x <> own")
    to_rest = to_rest.withColumn(
        "task", F.concat_ws(":", F.lit("r"), "root", F.least("own", "x"), F.greatest("own", "x"))
    )
    far = _links(main.unionByName(to_main.drop("own")).unionByName(to_rest.drop("own")))
    return components(near.unionByName(far), "node", "root")


def _grouped(
    docs: DataFrame, id_col: str, text_col: str, group_bytes: int
) -> tuple[DataFrame, DataFrame]:
    """(doc_id, id, hash, n, sid) of each row, and (sid, first), its component's least key."""
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text")
    ).withColumns(_key("doc_id", "text"))
    rows = materialize(
        texts.select("doc_id", "id", "hash", "text").mapInArrow(
            _ids, "doc_id long, id long, hash long, n long, sid long"
        ),
        "ids",
    )
    classes = materialize(
        rows.where("n > 0").groupBy("sid").agg(F.min(F.struct("id", "hash")).alias("key"), F.max("n").alias("n")),
        "classes",
    )
    linked = _linked(texts, classes, group_bytes)
    roots = linked.select("node", "root").unionByName(
        linked.select(F.col("root").alias("node"), "root").distinct()
    ).distinct()
    inside = roots.join(classes.select(F.col("sid").alias("node"), "key"), "node")
    firsts = inside.groupBy("root").agg(F.min("key").alias("first"))
    of_set = roots.join(firsts, "root").select(F.col("node").alias("sid"), "first")
    found = classes.join(of_set, "sid", "left").select(
        "sid", F.coalesce("first", "key").alias("first")
    )
    return rows, materialize(found, "classes")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """One row per document with the size of its shingle set and its component.

    A document's set is its distinct runs of :data:`WIDTH` words, A-Z lower-cased.
    Documents are linked if their sets' Jaccard index is 0.75 or more; ``component_id``
    is the smallest id that links lead to. The result is exact up to equal 64-bit
    hashes of different shingles or sets.

    Equal sets are one class from the start. Of each class the smallest hashes, a
    third of the set, are dealt out to count which stand in other sets too; a set of
    which too few do has no partner. The others' sets are counted whole, and those
    that share a hash of their rare prefixes and fit in size are gathered, by stars
    around one of them, into components of candidates. In each component the sets,
    most frequent shingle first, make a prefix tree, which every set is taken through:
    overlaps of common paths are counted once, and a subtree is pruned by the bounds
    on what remains, by size, or when it is already in the set's component. A
    component beyond ``group_bytes`` is split into blocks, see :func:`_link_large`.

    A NULL or empty text, or one of separators alone, has an empty set and is linked
    with nothing. Rows without an id are linked like others and come last: a component
    of such rows alone has no id. Repeated rows are linked and each has its row. An
    empty table gives none; other columns are not read.
    """
    rows, classes = _grouped(docs, id_col, text_col, group_bytes)
    least = F.col("first.id")
    component = F.when(least != _LAST_ID, least).alias("component_id")
    found = rows.where("n > 0").join(classes, "sid").select("doc_id", F.col("n").alias("n_shingles"), component)
    return found.unionByName(
        rows.where("n = 0").select(
            "doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id")
        )
    )


def keep_one_of_each(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", group_bytes: int = GROUP_BYTES
) -> DataFrame:
    """The documents, with all their columns, but of each component only the one of least id.

    Documents without words stay, each row of them. Of other rows that agree in id and
    text one stays, of rows of one id with other texts that of the least hash.
    """
    rows, classes = _grouped(docs, id_col, text_col, group_bytes)
    worded = rows.where("n > 0")
    others = (
        worded.join(classes, "sid")
        .where((F.col("id") != F.col("first.id")) | (F.col("hash") != F.col("first.hash")))
        .select(F.col("id").alias("__id"), F.col("hash").alias("__hash"))
        .distinct()
    )
    others = materialize(others, "others")
    key = {f"__{name}": c for name, c in _key(id_col, text_col).items()}
    kept = docs.withColumns(key).join(broadcast_if_small(others), ["__id", "__hash"], "left_anti")
    if not worded.groupBy("id", "hash").count().where("count > 1").isEmpty():
        has_words = F.coalesce(F.col(text_col), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
        copy = F.when(~has_words, F.monotonically_increasing_id())  # NULL, one group, if worded
        kept = kept.withColumn("__copy", copy).dropDuplicates(["__id", "__hash", "__copy"])
    return kept.drop("__id", "__hash", "__copy")
