"""Hard negatives by exact search in an inverted multi-index.

A vector's two halves are coded by a codebook each, and the pair of codes is its cell. For
a query, a half's score with anything under a code is at most its score with the
codeword plus the query half's length times the code's radius. Summed over the halves
that bounds every score in a cell. A heap over the two sorted lists of half bounds
(the multi-sequence algorithm) gives cells from the highest bound down, and the search stops
where no cell left can change the answer, so results are exact whatever the codebooks. A
cell whose least possible score is above all windows is passed over.

The index is one table, dealt to tasks by ranges of cells that are cut within a cell where it is large.
Anchors are held by all tasks one block of a fixed size at a time; each task searches its rows
in pieces of a fixed size, and only the best few rows per anchor and piece are shuffled.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize, shuffle_partitions

CODES = 32  # codewords for each half
SAMPLE = 8192  # vectors that the codebooks are fitted on
ROUNDS = 10  # of k-means
PIECE_BYTES = 32 << 20  # of vectors that a task searches at a time
BLOCK_BYTES = 8 << 20  # of anchors that all tasks hold at a time
BATCH = 2048  # rows that are scored before the heap's stop is looked at again
LIMIT = (1 << 63) - 1


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    scale: int = 256,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    codes: int = CODES,
    sample: int = SAMPLE,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Negatives that score between ``low`` and ``high`` per cent of a positive's score.

    ``anchors`` is a condition on ``id_col``. Components become ``floor(scale * x)``, and a
    score is the integer inner product with the anchor; higher is better, ties go to the
    smaller id. An anchor's positives are its first ``positives`` other rows of its label. One
    row (anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each
    of the first ``negatives`` rows of another label in each positive's window.

    Rows with a NULL id, label or vector, or with a NULL or non-finite component, take no part.
    Repeated rows count once; rows of one id that differ are rows of their own, each an anchor where the id is
    one, and none is a positive or negative of its own id. A shorter vector is taken
    as if zeros followed. Scores are exact; one beyond 64 bits is given as the largest or
    smallest long. Other columns are left out. An empty table gives no row.
    """
    index, books = build_index(
        vectors, id_col, vector_col, label_col, scale, codes, sample
    )
    if books is None:
        return index.sparkSession.createDataFrame([], RESULT)
    results = []
    for block in _anchor_blocks(index, anchors, id_col, books, block_bytes):
        results.append(_mine(index, block, books, positives, negatives, low, high))
    if not results:
        return index.sparkSession.createDataFrame([], RESULT)
    return reduce(DataFrame.unionByName, results)


RESULT = (
    "anchor_id long, positive_id long, rank int, negative_id long, "
    "positive_score long, negative_score long"
)
_ROW = "id long, label long, v array<bigint>"
_CODED = f"{_ROW}, cell int, r1 double, r2 double"


class Books:
    """Codebooks of the halves, the radii of their codes, and the type scores are exact in."""

    def __init__(self, sample: np.ndarray, codes: int):
        self.width = sample.shape[1]
        self.codes = tuple(_k_means(half, codes) for half in self.halves(sample))
        self.radii = [np.zeros(len(book)) for book in self.codes]
        self.kind: type = np.float64

    def halves(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return x[..., : self.width // 2], x[..., self.width // 2 :]


def build_index(
    vectors: DataFrame,
    id_col: str,
    vector_col: str,
    label_col: str,
    scale: int = 256,
    codes: int = CODES,
    sample: int = SAMPLE,
) -> tuple[DataFrame, Books | None]:
    """The coded rows (id, label, v, cell, r1, r2) as a written table, and the codebooks.

    The codebooks are fitted on the ``sample`` rows of the smallest id hashes; every row is indexed.
    """
    vector = F.col(f"`{vector_col}`")
    good = F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    )
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{label_col}`").cast("long").alias("label"),
        F.when(good, F.transform(vector, lambda x: F.floor(x.cast("double") * scale))).alias("v"),
    )
    rows = materialize(rows.dropna().dropDuplicates(), "vectors")
    width = rows.agg(F.max(F.size("v"))).first()[0]
    if width is None:
        return rows, None
    picked = rows.orderBy(F.xxhash64("id"), "id").limit(sample).select("v").toArrow()
    books = Books(_matrix(picked.column("v").combine_chunks(), width, np.float64), codes)
    coded = rows.mapInArrow(_coder(books), _CODED)
    parts = shuffle_partitions(rows)
    index = materialize(
        coded.repartitionByRange(parts, "cell", F.xxhash64("id")).sortWithinPartitions("cell"),
        "index",
    )
    n = len(books.codes[1])
    for half, code in enumerate((F.expr(f"cell div {n}"), F.expr(f"cell % {n}"))):
        # At most one row for each codeword.
        found = index.groupBy(code.alias("code")).agg(F.max(f"r{half + 1}").alias("r")).collect()
        for row in found:
            books.radii[half][row["code"]] = row["r"]
    square = F.aggregate("v", F.lit(0.0), lambda t, x: t + x.cast("double") * x.cast("double"))
    largest = index.agg(F.max(square)).first()[0]
    # Every partial sum of a product stays under the largest squared length.
    books.kind = np.float32 if largest < 1 << 23 else np.float64 if largest < 1 << 52 else object
    return index, books


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    """Lists as rows of ``width``, the shorter ones with zeros at their ends."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    flat = flat.astype(kind) if kind is not object else flat.astype(np.int64).astype(object)
    if (lengths == width).all():
        return flat.reshape(len(column), width)
    out = np.zeros((len(column), width), kind)
    out[np.arange(width) < lengths[:, None]] = flat
    return out


def _k_means(x: np.ndarray, codes: int) -> np.ndarray:
    """Codewords by Lloyd's rounds, from rows that lie farthest from those before."""
    chosen, far = [0], ((x - x[0]) ** 2).sum(1)
    while len(chosen) < codes and far.any():
        chosen.append(int(far.argmax()))
        far = np.minimum(far, ((x - x[chosen[-1]]) ** 2).sum(1))
    book = x[chosen]
    for _ in range(ROUNDS):
        code = _nearest(x, book)
        for k in range(len(book)):
            if (mine := code == k).any():
                book[k] = x[mine].mean(0)
    return book


def _nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    if not book.shape[1]:
        return np.zeros(len(x), np.int64)
    return (x @ (-2 * book.T) + (book**2).sum(1)).argmin(1)


def _coder(books: Books) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def code(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column("v"), books.width, np.float64)
            found = []
            for half, book in zip(books.halves(x), books.codes, strict=True):
                near = _nearest(half, book)
                found.append((near, np.sqrt(((half - book[near]) ** 2).sum(1))))
            cell = found[0][0] * len(books.codes[1]) + found[1][0]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cell.astype(np.int32)), *[pa.array(f[1]) for f in found]],
                ["id", "label", "v", "cell", "r1", "r2"],
            )

    return code


def _anchor_blocks(
    index: DataFrame, anchors: Column, id_col: str, books: Books, block_bytes: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(ids, labels, vectors) of the anchors, ``block_bytes`` at a time on average."""
    chosen = index.select(F.col("id").alias(id_col), "label", "v").where(anchors)
    n = chosen.count()
    parts = -(-n * (8 * books.width + 16) // block_bytes)
    dealt = F.pmod(F.xxhash64(F.col(id_col)), F.lit(max(parts, 1)))
    for k in range(parts):
        table = chosen.where(dealt == k).toArrow()
        if table.num_rows:
            vectors = _matrix(table.column("v").combine_chunks(), books.width, books.kind)
            yield table.column(id_col).to_numpy(), table.column("label").to_numpy(), vectors


def _mine(index, block, books, positives, negatives, low, high) -> DataFrame:
    """The result rows of one block of anchors, written."""
    found = index.mapInArrow(
        _searcher(block, books, lambda n: _Best(n, positives)), "anchor int, slot int, id long, score long"
    )
    best = _first(found, positives).collect()  # at most ``positives`` rows for each anchor of the block
    ids, windows = block[0], {}
    for row in best:
        windows.setdefault(row["anchor"], []).append((row["score"], row["id"], row["rank"]))
    bounds = {
        a: [(-(-s * low // 100), s * high // 100) for s, _, _ in sorted(ws, key=lambda w: w[2])]
        for a, ws in windows.items()
    }
    found = index.mapInArrow(
        _searcher(block, books, lambda n: _Window(bounds.get(n, []), negatives)),
        "anchor int, slot int, id long, score long",
    )
    ranked = _first(found, negatives)
    places = [
        (a, slot, int(ids[a]), i, s)
        for a, ws in windows.items()
        for slot, (s, i, _) in enumerate(sorted(ws, key=lambda w: w[2]))
    ]
    schema = "anchor int, slot int, anchor_id long, positive_id long, positive_score long"
    given = F.broadcast(index.sparkSession.createDataFrame(places, schema))
    joined = ranked.join(given, ["anchor", "slot"])
    return materialize(
        joined.select(
            "anchor_id",
            "positive_id",
            "rank",
            F.col("id").alias("negative_id"),
            "positive_score",
            F.col("score").alias("negative_score"),
        ),
        "mined",
    )


def _first(found: DataFrame, n: int) -> DataFrame:
    """The first ``n`` of the rows that tasks found for each anchor and slot."""
    order = Window.partitionBy("anchor", "slot").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= n)


class _Best:
    """The best ``n`` rows of the anchor's own label."""

    same = True

    def __init__(self, _: int, n: int):
        self.n, self.ids, self.scores = n, np.zeros(0, np.int64), np.zeros(0, np.int64)

    ceiling = np.inf  # a cell whose scores are all above has nothing to add

    def floor(self) -> float:
        """A cell whose scores are all under this has nothing to add."""
        return self.scores[-1] if len(self.scores) == self.n else -np.inf

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        if len(self.scores) == self.n:
            near = scores >= self.scores[-1]
            ids, scores = ids[near], scores[near]
        if len(ids):
            ids, scores = np.concatenate([self.ids, ids]), np.concatenate([self.scores, scores])
            order = np.lexsort((ids, -scores))[: self.n]
            self.ids, self.scores = ids[order], scores[order]

    def found(self) -> list[tuple[int, int, int]]:
        return [(0, i, s) for i, s in zip(self.ids, self.scores, strict=True)]


class _Window:
    """The best ``n`` rows of other labels in each of several windows of scores."""

    same = False

    def __init__(self, windows: list[tuple[int, int]], n: int):
        # A window's rows are the best of those it lets in.
        self.windows = [(lo, hi, _Best(0, n)) for lo, hi in windows]
        self.ceiling = max((hi for _, hi in windows), default=-np.inf)

    def floor(self) -> float:
        return min((max(lo, best.floor()) for lo, hi, best in self.windows if lo <= hi), default=np.inf)

    def add(self, ids: np.ndarray, scores: np.ndarray) -> None:
        for lo, hi, best in self.windows:
            inside = (scores >= max(lo, best.floor())) & (scores <= hi)
            if inside.any():
                best.add(ids[inside], scores[inside])

    def found(self) -> list[tuple[int, int, int]]:
        return [(k, i, s) for k, w in enumerate(self.windows) for _, i, s in w[2].found()]


def _searcher(block, books: Books, aim: Callable[[int], _Best | _Window]):
    """Search the task's rows for each anchor of the block, a piece of rows at a time."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            held.append(batch)
            size += batch.num_rows * books.width * 8
            if size >= PIECE_BYTES:
                yield _search(pa.Table.from_batches(held), block, books, aim)
                held, size = [], 0
        if size or held:
            yield _search(pa.Table.from_batches(held), block, books, aim)

    return search


def _search(table: pa.Table, block, books: Books, aim) -> pa.RecordBatch:
    piece = _Piece(table, books)
    out: list[tuple[int, int, int, int]] = []
    for anchor, (own, label, query) in enumerate(zip(*block, strict=True)):
        aims = aim(anchor)
        piece.visit(own, label, query, aims)
        out += [(anchor, *row) for row in aims.found()]
    columns = list(zip(*out, strict=True)) or [(), (), (), ()]
    clipped = [max(-LIMIT - 1, min(LIMIT, int(s))) for s in columns[3]]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(columns[0], pa.int32()),
            pa.array(columns[1], pa.int32()),
            pa.array([int(i) for i in columns[2]], pa.int64()),
            pa.array(clipped, pa.int64()),
        ],
        ["anchor", "slot", "id", "score"],
    )


class _Piece:
    """Some rows of the index, by cell."""

    def __init__(self, table: pa.Table, books: Books):
        cell = table.column("cell").to_numpy()
        order = np.argsort(cell, kind="stable")
        self.books, self.cell = books, cell[order]
        self.ids = table.column("id").to_numpy()[order]
        self.labels = table.column("label").to_numpy()[order]
        vectors = _matrix(table.column("v").combine_chunks(), books.width, books.kind)
        self.vectors = vectors[order]
        cells, starts = np.unique(self.cell, return_index=True)
        ends = np.append(starts[1:], len(cell))
        self.ranges = dict(zip(cells.tolist(), zip(starts.tolist(), ends.tolist(), strict=True), strict=True))
        n = len(books.codes[1])
        self.present = [np.unique(cells // n), np.unique(cells % n)]

    def visit(self, own: int, label: int, query: np.ndarray, aims: _Best | _Window) -> None:
        """Give ``aims`` the rows of cells from the highest bound down, until its floor is above."""
        n, lists = len(self.books.codes[1]), []
        real = query.astype(np.float64)
        for half, book, radii, present in zip(
            self.books.halves(real), self.books.codes, self.books.radii, self.present, strict=True
        ):
            reach = np.sqrt(half @ half) * radii[present]
            bound = book[present] @ half + reach
            order = np.argsort(-bound, kind="stable")
            lists.append([a[order].tolist() for a in (bound, present, 2 * reach)])
        (top, first, width), (side, second, depth) = lists
        slack = 1e-6 * (1.0 + abs(top[0]) + abs(side[0]) + float(real @ real))
        heap, waiting, rows = [(-(top[0] + side[0]), 0, 0)], [], 0
        floor = aims.floor()
        while heap:
            bound, i, j = heapq.heappop(heap)
            if slack - bound < floor:
                break
            # Column 0 opens the next row, and each row goes on by itself: no pair comes twice.
            if j == 0 and i + 1 < len(first):
                heapq.heappush(heap, (-(top[i + 1] + side[0]), i + 1, 0))
            if j + 1 < len(second):
                heapq.heappush(heap, (-(top[i] + side[j + 1]), i, j + 1))
            if -bound - width[i] - depth[j] - slack > aims.ceiling:
                continue
            if span := self.ranges.get(first[i] * n + second[j]):
                waiting.append(span)
                rows += span[1] - span[0]
                if rows >= BATCH:
                    self._score(waiting, own, label, query, aims)
                    waiting, rows, floor = [], 0, aims.floor()
        if waiting:
            self._score(waiting, own, label, query, aims)

    def _score(self, spans, own, label, query, aims) -> None:
        scores = np.concatenate([self.vectors[a:b] @ query for a, b in spans])
        ids = np.concatenate([self.ids[a:b] for a, b in spans])
        labels = np.concatenate([self.labels[a:b] for a, b in spans])
        good = (ids != own) & ((labels == label) == aims.same)
        kind = object if self.books.kind is object else np.int64
        aims.add(ids[good], scores[good].astype(kind))
