"""Packing as a cutting-stock problem, solved by column generation over lengths."""

from __future__ import annotations

import itertools
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize
from tallyloom.llm.token_packing import best_fit_decreasing
from tallyloom.llm.tokens import document_ids, encoder

LENGTH = 1024
GRAIN = 64  # a document's rest is cut once more, at a multiple of this
SALTS = 64  # parts in which the documents of one length are ranked
TOLERANCE = 1e-5  # of the padded length above its lower bound
MANY = 256  # sizes from which on single ones are too far from any good packing to start with
PATIENCE = 200  # columns in which the padded length must come down by ...
PROGRESS = 1e-3  # ... this share of the sum of lengths

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def padded(tokens: int, length: int) -> int:
    """A sequence's length with its padding: none at a power of two."""
    return tokens if tokens & (tokens - 1) == 0 else length


def pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    grain: int = GRAIN,
    tokenizer: tuple[str | None, str | None] = (None, None),
) -> DataFrame:
    """The pieces of at most ``length`` ids into which each document is cut, without the ids.

    The cuts are at each multiple of ``length`` and at the last multiple of ``grain``.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(*tokenizer)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = document_ids(encode, text.as_py())
                raw = memoryview(ids.astype("<u4", copy=False)).cast("B")
                cuts = [*range(0, len(ids), length), len(ids)]
                if 0 < len(ids) % grain < len(ids) - cuts[-2]:
                    cuts.insert(-1, len(ids) - len(ids) % grain)
                for start, end in itertools.pairwise(cuts):
                    crc = zlib.crc32(raw[4 * start : 4 * end])
                    rows.append((doc_id, start, end - start, crc, len(ids)))
            if rows:
                columns = [pa.array(c, pa.int64()) for c in zip(*rows, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, [p.split()[0] for p in PIECES.split(", ")])

    return docs.select(docs[id_col].cast("long"), text_col).mapInArrow(run, PIECES)


class _Knapsack:
    """Unbounded knapsack over exact fillings, by dynamic programming."""

    def __init__(self, sizes: np.ndarray, length: int) -> None:
        self.sizes, self.length = sizes, length
        self.fits = np.searchsorted(sizes, np.arange(length + 1), "right")

    def solve(self, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each filling the best value (-inf if out of reach) and the last item put in."""
        best = np.full(self.length + 1, -np.inf)
        best[0] = 0
        last = np.zeros(self.length + 1, np.int64)
        for c in range(int(self.sizes[0]), self.length + 1):
            own = values[: self.fits[c]] + best[c - self.sizes[: self.fits[c]]]
            last[c] = k = int(own.argmax())
            best[c] = own[k]
        return best, last

    def pattern(self, last: np.ndarray, filling: int) -> np.ndarray:
        counts = np.zeros(len(self.sizes))
        while filling > 0:
            counts[last[filling]] += 1
            filling -= int(self.sizes[last[filling]])
        return counts


def first_basis(sizes: np.ndarray, demand: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """A column per size, and its use: from the largest size down, as many copies of it
    as fit, filled up with the largest smaller sizes of which enough is left.

    Each column holds its own size and smaller ones, so the matrix is triangular.
    """
    left = demand.astype(float).copy()
    basis, used = np.zeros((len(sizes), len(sizes))), np.zeros(len(sizes))
    for i in range(len(sizes) - 1, -1, -1):
        copies = length // int(sizes[i])
        basis[i, i] = copies
        used[i] = times = left[i] / copies
        left[i], room = 0, length - copies * int(sizes[i])
        while times > 0 and room >= sizes[0]:
            fit = int(np.searchsorted(sizes[:i], room, "right"))
            enough = np.flatnonzero(left[:fit] >= times)
            if not len(enough):
                break
            j = int(enough[-1])
            more = min(room // int(sizes[j]), int(left[j] / times))
            basis[j, i] = more
            left[j] = max(0.0, left[j] - more * times)
            room -= more * int(sizes[j])
    return basis, used


def solve(sizes: np.ndarray, demand: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """Patterns (one row each, counts per size) and how often each is used, not rounded.

    The linear program chooses patterns so that each size is met exactly and the
    padded length is least. It starts from patterns of one size each, as many as
    fit, or with more than :data:`MANY` sizes from :func:`first_basis`, and is carried on by a
    revised simplex method; the knapsack over the prices of the sizes gives the
    column that enters, for full sequences and for each power of two. It ends when no
    column improves, when the padded length is within :data:`TOLERANCE` of the sum of
    all lengths, which no packing undercuts, or when it comes down too slowly (:data:`PATIENCE`); any
    end is a valid solution. Its size depends on ``length`` alone.
    """
    m = len(sizes)
    knapsack = _Knapsack(sizes, length)
    powers = [1 << k for k in range(length.bit_length()) if 1 << k < length]
    if m > MANY:
        basis, used = first_basis(sizes, demand, length)
    else:
        copies = length // sizes
        basis, used = np.diag(copies.astype(float)), demand / copies
    inverse = np.linalg.inv(basis)
    cost = np.array([padded(int(t), length) for t in sizes @ basis.astype(np.int64)], float)
    floor = float(sizes @ demand)
    before = np.inf
    for step in itertools.count():
        if cost @ used <= floor * (1 + TOLERANCE):
            break
        if step % PATIENCE == 0:
            if before - cost @ used <= floor * PROGRESS:
                break
            before = cost @ used
        prices = cost @ inverse
        best, last = knapsack.solve(prices)
        options = [(best[p] / p, p, float(p)) for p in powers]
        full = int(best.argmax())
        options.append((best[full] / length, full, float(length)))
        gain, filling, price = max(options)
        if gain <= 1 + 1e-9:
            break
        column = knapsack.pattern(last, filling)
        step_ = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratio = np.where(step_ > 1e-9, used / step_, np.inf)
        out = int(ratio.argmin())
        used = used - ratio[out] * step_
        used[out] = ratio[out]
        used[used < 0] = 0
        row = inverse[out] / step_[out]
        inverse -= np.outer(step_, row)
        inverse[out] = row
        basis[:, out], cost[out] = column, price
        if step % 200 == 199:
            inverse = np.linalg.inv(basis)
            used = np.maximum(inverse @ demand, 0)
    return basis.T, used


def plan(lengths: np.ndarray, counts: np.ndarray, length: int) -> list[tuple[dict[int, int], int]]:
    """Patterns ({piece length: copies}, sequences) that hold exactly the counted pieces.

    The program's solution is rounded down; the pieces left over, fewer than fit one
    sequence of each pattern, are packed best-fit decreasing.
    """
    inner = lengths < length
    out = [({int(length): 1}, int(counts[~inner].sum()))] if (~inner).any() else []
    sizes, left = lengths[inner].astype(np.int64), counts[inner].astype(np.int64)
    if len(sizes):
        patterns, used = solve(sizes, left.astype(float), length)
        for pattern, times in zip(np.rint(patterns).astype(np.int64), used, strict=True):
            some = pattern > 0
            times = min(int(times + 1e-6), int((left[some] // pattern[some]).min()))
            if times > 0:
                left = left - times * pattern
                out.append((dict(zip(sizes[some].tolist(), pattern[some].tolist(), strict=True)), times))
        rest = np.repeat(sizes, left)
        bins, _, filled = best_fit_decreasing(rest, length)
        alike: dict[tuple, int] = {}
        order = np.argsort(bins, kind="stable")
        for members in np.split(rest[order], np.cumsum(np.bincount(bins, minlength=len(filled)))[:-1]):
            if len(members):
                key = tuple(zip(*(x.tolist() for x in np.unique(members, return_counts=True)), strict=True))
                alike[key] = alike.get(key, 0) + 1
        out += [(dict(key), times) for key, times in alike.items()]
    return out


def slots(patterns: list[tuple[dict[int, int], int]]) -> list[tuple[int, int, int, int, int, int]]:
    """(piece length, first rank, end rank, copies per sequence, first sequence, offset)."""
    rows, sequence, taken = [], 0, {}
    for pattern, times in patterns:
        offset = 0
        for size, copies in sorted(pattern.items(), reverse=True):
            low = taken.get(size, 0)
            taken[size] = low + copies * times
            rows.append((size, low, taken[size], copies, sequence, offset))
            offset += size * copies
        sequence += times
    return rows


def pack_cutting_stock(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    grain: int = GRAIN,
    tokenizer: tuple[str | None, str | None] = (None, None),
) -> DataFrame:
    """One row per piece of a document with its sequence and its offset there.

    Each document, its ids and the id 0, is cut every ``length`` ids, and its rest at
    the last multiple of ``grain``, which leaves few lengths to combine and almost no
    padding; ``grain=1`` leaves the rest whole. The counts of the pieces' lengths, at most ``length`` numbers, are all that the driver sees; the
    linear program over them gives patterns, each with a range of ranks per length.
    Pieces of one length are ranked by document in :data:`SALTS` independent parts,
    so a length that very many pieces share is sorted in parts, and rank by rank they
    take the places of the patterns. Ids are not shuffled; only pieces are, as a few
    numbers each.

    A NULL or empty text is the id 0 alone. NULL ids stay NULL, repeated rows are
    packed again, an empty table gives no rows, and other columns are not read.
    """
    spark = docs.sparkSession
    cut = materialize(pieces(docs, id_col, text_col, length, grain, tokenizer), "pieces")
    salt = F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(SALTS))
    cut = cut.withColumn("salt", salt)
    counts = cut.groupBy("length", "salt").count()
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    # At most length x SALTS rows.
    base = materialize(
        counts.select(
            "length", "salt", "count", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("base")
        ),
        "lengths",
    )
    histogram = base.groupBy("length").agg(F.sum("count").alias("n")).orderBy("length").collect()
    table = slots(
        plan(
            np.array([r["length"] for r in histogram], np.int64),
            np.array([r["n"] for r in histogram], np.int64),
            length,
        )
    )
    places = spark.createDataFrame(
        table, "length long, low long, high long, copies long, first long, at long"
    )
    within = Window.partitionBy("length", "salt").orderBy("doc_id", "start", "doc_tokens", "ids_crc32")
    ranked = (
        cut.withColumn("row", F.row_number().over(within) - 1)
        .join(F.broadcast(base.select("length", "salt", "base")), ["length", "salt"])
        .withColumn("rank", F.col("base") + F.col("row"))
        .alias("p")
    )
    there = F.col("p.rank") - F.col("s.low")
    found = ranked.join(
        F.broadcast(places).alias("s"),
        (F.col("p.length") == F.col("s.length"))
        & (F.col("p.rank") >= F.col("s.low"))
        & (F.col("p.rank") < F.col("s.high")),
    )
    return found.select(
        "doc_id",
        "start",
        "p.length",
        "ids_crc32",
        "doc_tokens",
        (F.col("first") + F.floor(there / F.col("copies"))).cast("long").alias("sequence_id"),
        (F.col("at") + there % F.col("copies") * F.col("p.length")).alias("offset"),
    )
