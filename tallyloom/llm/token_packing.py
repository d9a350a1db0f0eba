"""Token ids packed into rows of a fixed length by best-fit decreasing."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tallyloom.llm.tokens import document_ids, encoder

LENGTH = 2048
BLOCK_TOKENS = 4 << 20  # that one task packs together


class Capacities:
    """A segment tree over free lengths; finds the smallest that still holds a piece."""

    def __init__(self, length: int) -> None:
        self.size = 1 << length.bit_length()
        self.open = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(self.size)]

    def put(self, free: int, bin_: int) -> None:
        self.bins[free].append(bin_)
        node = free + self.size
        while node:
            self.open[node] += 1
            node >>= 1

    def take(self, need: int) -> tuple[int, int] | None:
        """The (free, bin) with the least free length of ``need`` or more, taken out."""
        node, open_ = need + self.size, self.open
        if not open_[node]:
            # Up to the first ancestor with an open right sibling, then down its left edge.
            while node > 1 and not (node % 2 == 0 and open_[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.size:
                node = 2 * node + (not open_[2 * node])
        free = node - self.size
        while node:
            open_[node] -= 1
            node >>= 1
        return free, self.bins[free].pop()


def best_fit_decreasing(lengths: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """(bin of each piece, its offset there, filled length of each bin)."""
    bins = np.zeros(len(lengths), np.int64)
    offsets = np.zeros(len(lengths), np.int64)
    filled: list[int] = []
    tree = Capacities(length)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[piece])
        found = tree.take(need) if need < length else None
        free, bin_ = found or (length, len(filled))
        if not found:
            filled.append(0)
        bins[piece], offsets[piece] = bin_, length - free
        filled[bin_] += need
        if free > need:
            tree.put(free - need, bin_)
    return bins, offsets, filled


MATRIX = (
    "sequence_id long, n_tokens int, ids binary, positions binary, cu_lengths array<int>, "
    "doc_ids array<long>, starts array<long>"
)
PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, "
    "offset long, sequence_tokens long, ids binary, positions binary, cu_lengths array<int>"
)


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


class _Block:
    """The pieces that a task has cut and not yet packed."""

    def __init__(self, length: int) -> None:
        self.length, self.tokens = length, 0
        self.pieces: list[tuple[int | None, int, int, np.ndarray]] = []

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        for start in range(0, len(ids), self.length):
            self.pieces.append((doc_id, start, len(ids), ids[start : start + self.length]))
        self.tokens += len(ids)

    def pack(self) -> tuple[np.ndarray, np.ndarray, list[int]]:
        return best_fit_decreasing(np.array([len(p[3]) for p in self.pieces], np.int64), self.length)

    def sequences(self, pad_id: int) -> Iterator[list[tuple]]:
        """Some hundred sequences at a time: (place, pieces, padded ids, positions, cumulative lengths)."""
        bins, offsets, filled = self.pack()
        order = np.lexsort((offsets, bins))
        edges = np.searchsorted(bins[order], np.arange(len(filled) + 1))
        for low in range(0, len(filled), 512):
            made: list[tuple] = []
            for b in range(low, min(low + 512, len(filled))):
                members = [self.pieces[p] for p in order[edges[b] : edges[b + 1]]]
                ids = np.full(self.length, pad_id, "<u4")
                positions = np.zeros(self.length, "<u4")
                ends = [0]
                for _, _, _, own in members:
                    stop = ends[-1] + len(own)
                    ids[ends[-1] : stop] = own
                    positions[ends[-1] : stop] = np.arange(len(own))
                    ends.append(stop)
                made.append((b, members, ids, positions, ends))
            yield made

    def rows(self, base: int, pad_id: int) -> Iterator[tuple[pa.RecordBatch, int]]:
        """One row per piece, read from its sequence's row, and the number of sequences so far."""
        for made in self.sequences(pad_id):
            rows: list[tuple] = []
            for b, members, ids, positions, ends in made:
                for k, (doc, start, total, _) in enumerate(members):
                    own = ids[ends[k] : ends[k + 1]]
                    row = (doc, start, len(own), zlib.crc32(own.tobytes()), total, base + b, ends[k], ends[-1])
                    rows.append((*row, *((None,) * 3 if k else (ids.tobytes(), positions.tobytes(), ends))))
            types = [pa.int64()] * 8 + [pa.binary(), pa.binary(), pa.list_(pa.int32())]
            yield _record(PIECES, rows, types), made[-1][0] + 1

    def matrices(self, base: int, pad_id: int) -> Iterator[tuple[pa.RecordBatch, int]]:
        """One row per sequence, and the number of sequences so far."""
        for made in self.sequences(pad_id):
            rows: list[tuple] = []
            for b, members, ids, positions, ends in made:
                docs, starts = [m[0] for m in members], [m[1] for m in members]
                rows.append((base + b, ends[-1], ids.tobytes(), positions.tobytes(), ends, docs, starts))
            types = [pa.int64(), pa.int32(), pa.binary(), pa.binary(), pa.list_(pa.int32())]
            types += [pa.list_(pa.int64())] * 2
            yield _record(MATRIX, rows, types), made[-1][0] + 1


def _record(schema: str, rows: list[tuple], types: list[pa.DataType]) -> pa.RecordBatch:
    arrays = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)]
    return pa.RecordBatch.from_arrays(arrays, _names(schema))


def pack_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = LENGTH,
    pad_id: int = 0,
    matrices: bool = True,
    tokenizer: tuple[str | None, str | None] = (None, None),
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """Documents as token ids, in rows of ``length`` ids that hold whole pieces.

    A document's ids, with the id that ends it, are cut every ``length`` ids, without
    loss; then the pieces of a block go, longest first, to the row with the least
    room that still takes them. With ``matrices`` the result has one row per
    sequence: the padded ids and their positions, which start again at each piece, as
    little-endian unsigned 32-bit numbers, the cumulative lengths, and where each
    piece comes from. Otherwise it has one row per piece, with its place and the
    checksum of its ids there, and the sequence's ids, positions and cumulative lengths
    in the row of its first piece (offset 0).

    Each task packs what it reads, ``block_tokens`` at a time, so no text is shuffled,
    memory is bounded by a block and the longest document, and only the last rows
    of a block are padded much. A sequence's id is made of its partition and place.

    A NULL or empty text is the end id alone. NULL ids stay NULL, repeated rows are
    packed again, an empty table gives no rows, and other columns are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encode = encoder(*tokenizer)
        base = TaskContext.get().partitionId() << 33
        block = _Block(length)

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal base, block
            if block.pieces:
                used = 0
                made = block.matrices if matrices else block.rows
                for batch, used in made(base, pad_id):
                    yield batch
                base, block = base + used, _Block(length)

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                block.add(doc_id, document_ids(encode, text.as_py()))
                if block.tokens >= block_tokens:
                    yield from flush()
        yield from flush()

    return docs.select(docs[id_col].cast("long"), text_col).mapInArrow(
        run, MATRIX if matrices else PIECES
    )


def write_packed(docs: DataFrame, path: str, **options: object) -> None:
    """Write the packed matrices of :func:`pack_tokens` as Parquet."""
    pack_tokens(docs, **options).write.parquet(path)
