"""Benchmark decontamination by spaced-seed hashing of words."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize
from tallyloom.llm.words import LOWER, PUNCTUATION, blocks, mix, powers, word_hashes

#: A 1 is a word that must match, a 0 one that may differ.
MASKS = ("111011011", "1101010111", "110010110101")
BLOCK_BYTES = 16 << 20  # of benchmark text that is sent to the executors at a time
_BASE = 0x9E3779B97F4A7C15  # odd, so its powers have inverses among the 64-bit numbers


def _seed_hashes(words: np.ndarray, mask: str) -> np.ndarray:
    """The hash of the masked words for each place where the mask fits."""
    n = len(words) - len(mask) + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, len(mask) * 1_000_003, np.uint64)
    for k in range(len(mask)):
        if mask[k] == "1":
            total += words[k : k + n] * mix(np.array([k + 1], np.uint64))
    return mix(total)


def _group_masks(width: int, spare: int) -> list[list[tuple[int, int]]]:
    """Masks over ``width`` words, as the spans that must match, of which one survives any
    ``spare`` substitutions: two more groups of words than these, all but ``spare`` kept."""
    spare = min(spare, width - 1)
    groups = min(spare + 2, width)
    edges = [width * g // groups for g in range(groups + 1)]
    spans = list(zip(edges[:-1], edges[1:], strict=True))
    return [list(kept) for kept in combinations(spans, groups - spare)]


class _Rolling:
    """Hashes of spans of words behind each place, from prefix sums of a polynomial."""

    def __init__(self, words: np.ndarray) -> None:
        sums = np.cumsum(words * powers(_BASE, len(words)), dtype=np.uint64)
        self.sums = np.concatenate([np.zeros(1, np.uint64), sums])
        self.back = powers(pow(_BASE, -1, 1 << 64), len(words))

    def spans(self, width: int, kept: list[tuple[int, int]]) -> np.ndarray:
        """The hash of the kept spans for each place where ``width`` words fit."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        total = np.zeros(n, np.uint64)
        for a, b in kept:
            total += self.sums[b : b + n] - self.sums[a : a + n]
        return total * self.back[:n]


class Seeds:
    """A block of benchmark items: their words, and the sorted seeds that find them.

    Items of ``window`` words or more are found by the masks, laid on each place. A shorter
    item is found by masks as wide as itself, of which one holds whenever ``min_share`` of
    its words agree, so none is missed. So is each window of an item no mask fits on.
    """

    def __init__(
        self, ids: list[int], texts: pa.Array, masks: tuple[str, ...], window: int, min_share: float
    ) -> None:
        self.ids = np.array(ids, np.int64)
        words: list[np.ndarray] = []
        for _, data, offsets in blocks(texts):
            hashes, first = word_hashes(data, offsets, PUNCTUATION, LOWER)
            words += [hashes[a:b] for a, b in zip(first[:-1], first[1:], strict=True)]
        self.words = words
        laid: dict[str, list[tuple[int, np.ndarray]]] = {}
        whole: dict[tuple[int, int], list[tuple[int, np.ndarray]]] = {}
        for item, own in enumerate(words):
            fitting = [m for m in masks if len(m) <= len(own)]
            if len(own) >= window and fitting:
                for mask in fitting:
                    laid.setdefault(mask, []).append((item, _seed_hashes(own, mask)))
            elif len(own):
                width = min(window, len(own))
                rolling = _Rolling(own)
                for k, kept in enumerate(_group_masks(width, _spare(width, min_share))):
                    whole.setdefault((width, k), []).append((item, rolling.spans(width, kept)))
        self.laid = {mask: _index(found) for mask, found in laid.items()}
        self.whole: dict[int, list[tuple]] = {}
        for (width, k), found in sorted(whole.items()):
            kept = _group_masks(width, _spare(width, min_share))[k]
            self.whole.setdefault(width, []).append((kept, _index(found)))

    def candidates(self, words: np.ndarray) -> np.ndarray:
        """Distinct (item, shift) that share a seed with the words; the shift aligns them."""
        pairs = [np.zeros((0, 2), np.int64)]
        for mask, index in self.laid.items():
            pairs.append(_hits(_seed_hashes(words, mask), *index))
        rolling = _Rolling(words) if self.whole else None
        for width, family in self.whole.items():
            for kept, index in family:
                pairs.append(_hits(rolling.spans(width, kept), *index))
        return np.unique(np.concatenate(pairs), axis=0)

    def overlap(self, words: np.ndarray, item: int, shift: int, window: int) -> float:
        """The best share of equal words in a window of the item laid over the text."""
        own = self.words[item]
        width = min(window, len(own))
        low, high = max(0, -shift), min(len(own), len(words) - shift)
        if high - low < width:
            return 0.0
        same = np.concatenate([[0], np.cumsum(own[low:high] == words[low + shift : high + shift])])
        return float((same[width:] - same[:-width]).max() / width)


def _spare(width: int, min_share: float) -> int:
    """How many of ``width`` words may differ."""
    return next(d for d in range(width, -1, -1) if d == 0 or (width - d) / width >= min_share)


def _index(found: list[tuple[int, np.ndarray]]) -> tuple[np.ndarray, ...]:
    """Sorted hashes with their items and places, and which first 16 bits occur."""
    hashes = np.concatenate([h for _, h in found])
    items = np.repeat([i for i, _ in found], [len(h) for _, h in found])
    places = np.concatenate([np.arange(len(h)) for _, h in found])
    order = np.argsort(hashes, kind="stable")
    known = np.zeros(1 << 16, bool)
    known[hashes >> np.uint64(48)] = True
    return hashes[order], items[order], places[order], known


def _hits(
    own: np.ndarray, hashes: np.ndarray, items: np.ndarray, places: np.ndarray, known: np.ndarray
) -> np.ndarray:
    """(item, shift) of each place's hash that an item has too."""
    at = np.flatnonzero(known[own >> np.uint64(48)])
    low = np.searchsorted(hashes, own[at], "left")
    count = np.searchsorted(hashes, own[at], "right") - low
    hit = np.flatnonzero(count)
    total = int(count[hit].sum())
    ends = np.cumsum(count[hit])
    inner = np.arange(total) - np.repeat(ends - count[hit], count[hit])
    entry = np.repeat(low[hit], count[hit]) + inner
    return np.stack([items[entry], np.repeat(at[hit], count[hit]) - places[entry]], 1)


def _seed_blocks(
    docs: DataFrame,
    benchmark: DataFrame,
    item_col: str,
    text_col: str,
    masks: tuple[str, ...],
    block_bytes: int,
    window: int,
    min_share: float,
) -> Iterator[tuple[Broadcast, bool]]:
    """The benchmark's seeds block by block, of ``block_bytes`` of text on average, one at
    least, and whether the block is the last."""
    items = benchmark.select(
        F.col(item_col).cast("long").alias("item"),
        F.coalesce(F.col(text_col), F.lit("")).alias("text"),
    ).where("item is not null and text <> ''").distinct()
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // block_bytes) or 1
    for block in range(n):
        table = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(n)) == block).toArrow()
        texts = table.column("text").combine_chunks()
        seeds = Seeds(table.column("item").to_pylist(), texts, masks, window, min_share)
        yield docs.sparkSession.sparkContext.broadcast(seeds), block == n - 1


SCHEMA = "doc_id long, contaminated boolean, n_items long, item_ids array<long>, best_overlap double"


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 20,
    min_share: float = 0.8,
    masks: tuple[str, ...] = MASKS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document with the benchmark items that it contains.

    Words are runs of letters, digits and non-ASCII characters, A-Z lower-cased. A
    document and an item that agree on the 1-words of a mask somewhere are laid over
    each other there and compared word by word: the item is contained if ``window``
    successive words of it (all, if it has fewer) agree in at least ``min_share``, so
    substituted words are tolerated in the seed and in the check. An item of fewer than
    ``window`` words is never missed; of a longer one, a seed can miss a copy with as many
    substitutions as the check admits.

    The benchmark is the query set. Its seeds go to the executors in blocks of
    ``block_bytes`` of text, one pass over the documents each. Each pass but the last
    is written to the shared folder before its block is given up for the next, so one
    block at a time is held; documents are never shuffled or paired with each other.

    A NULL or empty text or item matches nothing, as does an item without an id;
    items with one id count once. Repeated documents give repeated rows, an empty
    table gives none, other columns are not read.
    """
    found = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    found = found.withColumns(
        {"found": F.array().cast("array<long>"), "best": F.lit(0.0).cast("double")}
    )
    sends = _seed_blocks(
        docs, benchmark, item_col, item_text_col, masks, block_bytes, window, min_share
    )
    for sent, last in sends:
        found = found.mapInArrow(
            lambda batches, sent=sent, last=last: _scan(batches, sent.value, window, min_share, last),
            SCHEMA if last else found.schema,
        )
        if not last:
            found = materialize(found, "scanned")
            sent.destroy()
    return found


def decontaminate(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = 20,
    min_share: float = 0.8,
    masks: tuple[str, ...] = MASKS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The documents, with all their columns, in which :func:`contamination` finds no item."""
    place = docs.columns.index(text_col)
    sends = _seed_blocks(
        docs, benchmark, item_col, item_text_col, masks, block_bytes, window, min_share
    )
    for sent, last in sends:

        def rows(batches: Iterator[pa.RecordBatch], sent: Broadcast = sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                items, _ = _found(batch.column(place), sent.value, window, min_share)
                yield batch.filter(pa.array([not x for x in items], pa.bool_()))

        docs = docs.mapInArrow(rows, docs.schema)
        if not last:
            docs = materialize(docs, "scanned")
            sent.destroy()
    return docs


def _found(
    texts: pa.Array, seeds: Seeds, window: int, min_share: float
) -> tuple[list[list[int]], np.ndarray]:
    """For each text the ids of the items it contains, and the best overlap with any."""
    items: list[list[int]] = [[] for _ in range(len(texts))]
    best = np.zeros(len(texts))
    for row, data, offsets in blocks(texts):
        words, first = word_hashes(data, offsets, PUNCTUATION, LOWER)
        for item, shift in seeds.candidates(words).tolist():
            # The words of all rows stand in line; an item touches the rows it is laid over.
            touched = range(
                max(0, int(np.searchsorted(first, max(shift, 0), "right")) - 1),
                min(int(np.searchsorted(first, shift + len(seeds.words[item]))), len(first) - 1),
            )
            for r in touched:
                a, b = first[r], first[r + 1]
                share = seeds.overlap(words[a:b], item, shift - a, window)
                best[row + r] = max(best[row + r], share)
                if share >= min_share:
                    items[row + r].append(int(seeds.ids[item]))
    return items, best


def _scan(
    batches: Iterator[pa.RecordBatch], seeds: Seeds, window: int, min_share: float, last: bool
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        new, shares = _found(batch.column(1), seeds, window, min_share)
        old = batch.column(2).to_pylist()
        items = [sorted({*a, *b}) for a, b in zip(old, new, strict=True)]
        best = np.maximum(batch.column(3).to_numpy(zero_copy_only=False), shares)
        found = pa.array(items, pa.list_(pa.int64()))
        if last:
            flags = pa.array([bool(x) for x in items], pa.bool_())
            counts = pa.array([len(x) for x in items], pa.int64())
            arrays = [batch.column(0), flags, counts, found, pa.array(best, pa.float64())]
            names = [part.split()[0] for part in SCHEMA.split(", ")]
        else:
            arrays = [batch.column(0), batch.column(1), found, pa.array(best, pa.float64())]
            names = ["doc_id", "text", "found", "best"]
        yield pa.RecordBatch.from_arrays(arrays, names)
