"""A factorisation machine that tells text of good quality."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.words import (
    LOWER,
    SPACE,
    blocks,
    prefix_sums,
    range_hash,
    word_bounds,
)

FOLDS = 5
SAMPLE = 6_000  # labelled documents that the model is fitted on, at most
WORD_BUCKETS = 1 << 14
FACTORS = 8
EPOCHS = 12
THRESHOLD = 0.3

STATISTICS = (
    "log words", "log characters", "word length", "upper", "digit", "symbol", "mark", "call",
    "line", "other", "distinct words", "commonest word", "capital words",
)
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_MARKS = np.isin(np.arange(256), np.frombuffer(b".,;:?'\"()-", np.uint8))
_UPPER = (np.arange(256) >= 65) & (np.arange(256) <= 90)
_DIGITS = (np.arange(256) >= 48) & (np.arange(256) <= 57)


def fold(doc_id: Column) -> Column:
    """The fold of a document; fold 0 is held out of learning."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


@dataclass
class Rows:
    """Sparse rows: row r has ``index`` and ``value`` from ``starts[r]`` to ``starts[r + 1]``."""

    starts: np.ndarray
    index: np.ndarray
    value: np.ndarray


def features(data: np.ndarray, offsets: np.ndarray, n_chars: np.ndarray) -> Rows:
    """Hashed words by weight, then the statistics, of each row of a block of text."""
    n = len(offsets) - 1
    starts, ends, first = word_bounds(data, offsets, SPACE)
    hashes = range_hash(prefix_sums(data, LOWER), starts, ends)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words)
    key = row * WORD_BUCKETS + (hashes >> np.uint64(50)).astype(np.int64)
    found, counts = np.unique(key, return_counts=True)
    owner, bucket = found // WORD_BUCKETS, found % WORD_BUCKETS
    weight = np.log1p(counts)
    norm = np.sqrt(np.bincount(owner, weight * weight, n))
    weight = weight / np.maximum(norm, 1e-12)[owner]

    size = np.maximum(1, np.diff(offsets))
    per_word = np.maximum(1, words)

    def share(table: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(table[data])])
        return (sums[offsets[1:]] - sums[offsets[:-1]]) / size

    most = np.zeros(n)
    np.maximum.at(most, owner, counts)
    capital = np.bincount(row, _UPPER[data[starts]], n) if len(starts) else np.zeros(n)
    codes = np.arange(256)
    columns = [
        np.log1p(words),
        np.log1p(n_chars),
        np.bincount(row, ends - starts, n) / per_word,
        share(_UPPER),
        share(_DIGITS),
        share(_SYMBOLS),
        share(_MARKS),
        share(codes == ord("!")),
        share(codes == ord("\n")),
        share(codes >= 128),
        np.bincount(owner, minlength=n) / per_word,
        most / per_word,
        capital / per_word,
    ]
    owner = np.concatenate([owner, np.repeat(np.arange(n), len(columns))])
    index = np.concatenate([bucket, np.tile(WORD_BUCKETS + np.arange(len(columns)), n)])
    value = np.concatenate([weight, np.stack(columns, 1).ravel()])
    order = np.argsort(owner, kind="stable")
    edges = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])
    return Rows(edges, index[order], value[order])


@dataclass
class Model:
    """Bias, weights and factors; ``mean`` and ``scale`` make the statistics comparable."""

    bias: float
    weights: np.ndarray
    factors: np.ndarray
    mean: np.ndarray
    scale: np.ndarray

    def standardised(self, rows: Rows) -> Rows:
        value = rows.value.copy()
        own = rows.index >= WORD_BUCKETS
        which = rows.index[own] - WORD_BUCKETS
        value[own] = np.clip((value[own] - self.mean[which]) / self.scale[which], -3, 3) / 3
        return Rows(rows.starts, rows.index, value)

    def margins(self, rows: Rows) -> tuple[np.ndarray, np.ndarray]:
        """Each row's sum before the logistic function, and its factor sums.

        The pairwise part is half of (square of the sum - sum of the squares), so it
        takes one pass over the row's features.
        """
        at, x = rows.starts[:-1], rows.value
        scaled = self.factors[rows.index] * x[:, None]
        sums = np.add.reduceat(scaled, at, axis=0)
        squares = np.add.reduceat((scaled * scaled).sum(axis=1), at)
        linear = np.add.reduceat(self.weights[rows.index] * x, at)
        return self.bias + linear + 0.5 * ((sums * sums).sum(axis=1) - squares), sums

    def scores(self, rows: Rows) -> np.ndarray:
        if len(rows.starts) < 2:
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.margins(self.standardised(rows))[0], -30, 30)))


def _taken(rows: Rows, which: np.ndarray) -> Rows:
    sizes = np.diff(rows.starts)[which]
    starts = np.concatenate([[0], np.cumsum(sizes)])
    at = np.arange(starts[-1]) + np.repeat(rows.starts[which] - starts[:-1], sizes)
    return Rows(starts, rows.index[at], rows.value[at])


def train(rows: Rows, labels: np.ndarray, epochs: int = EPOCHS, batch: int = 128) -> Model:
    """Logistic loss by Adam with fixed seeds; without both labels, the share of label 1."""
    size, n = WORD_BUCKETS + len(STATISTICS), len(labels)
    share = (labels.sum() + 1) / (n + 2)
    model = Model(
        float(np.log(share / (1 - share))),
        np.zeros(size),
        np.zeros((size, FACTORS)),
        np.zeros(len(STATISTICS)),
        np.ones(len(STATISTICS)),
    )
    if len(np.unique(labels)) < 2:
        return model
    own = rows.index >= WORD_BUCKETS
    stats = rows.value[own].reshape(n, -1)
    model.mean, model.scale = stats.mean(axis=0), np.maximum(stats.std(axis=0), 1e-6)
    rows = model.standardised(rows)
    rng = np.random.default_rng(7)
    model.factors = rng.normal(0, 0.05, (size, FACTORS))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.factors)]
    step, rate, decay = 0, 0.02, 1e-4
    for _ in range(epochs):
        order = rng.permutation(n)
        for low in range(0, n, batch):
            which = order[low : low + batch]
            part = _taken(rows, which)
            margin, sums = model.margins(part)
            slope = (1 / (1 + np.exp(-np.clip(margin, -30, 30))) - labels[which]) / len(which)
            owner = np.repeat(np.arange(len(which)), np.diff(part.starts))
            pull = slope[owner] * part.value
            inner = sums[owner] - model.factors[part.index] * part.value[:, None]
            gradients = [
                np.bincount(part.index, pull, size) + decay * model.weights,
                np.stack(
                    [np.bincount(part.index, pull * inner[:, k], size) for k in range(FACTORS)], 1
                )
                + decay * model.factors,
            ]
            step += 1
            model.bias -= rate * float(slope.sum())
            for p, g, (m, v) in zip((model.weights, model.factors), gradients, state, strict=True):
                m += 0.1 * (g - m)
                v += 0.001 * (g * g - v)
                p -= rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return model


def _characters(batch: pa.RecordBatch, text: int, chars: int) -> np.ndarray:
    given = np.array(batch.column(chars).cast(pa.float64()).to_pylist(), float)
    length = np.array(pc.utf8_length(batch.column(text)).to_pylist(), float)
    return np.nan_to_num(np.where(np.isnan(given) | (given < 0), length, given))


def fit(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
    label_col: str = "quality",
    sample: int = SAMPLE,
) -> Model:
    """Learn from at most ``sample`` labelled documents of the folds other than 0.

    The sample is the documents whose hashed ids come first; it alone reaches the
    driver, as features. A document labelled more than once has the label of most.
    """
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("y"))
        .where("id is not null and y is not null")
        .where(fold(F.col("id")) != 0)
        .groupBy("id")
        .agg((F.avg("y") >= 0.5).cast("int").alias("y"))
        .orderBy(F.xxhash64("id"), "id")
        .limit(sample)
    )
    texts = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(chars_col).alias("chars")
    )
    joined = texts.join(F.broadcast(known), "id").select("id", "text", "chars", "y")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chars = _characters(batch, 1, 2)
            index, value = [], []
            for row, data, offsets in blocks(batch.column(1)):
                found = features(data, offsets, chars[row : row + len(offsets) - 1])
                for a, b in zip(found.starts[:-1], found.starts[1:], strict=True):
                    index.append(found.index[a:b].astype("<i4").tobytes())
                    value.append(found.value[a:b].astype("<f4").tobytes())
            arrays = [batch.column(0).cast(pa.int64()), pa.array(index, pa.binary())]
            arrays += [pa.array(value, pa.binary()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(arrays, ["id", "index", "value", "y"])

    found = joined.mapInArrow(rows, "id long, index binary, value binary, y int")
    table = found.dropDuplicates(["id"]).toArrow().sort_by("id")
    index = [np.frombuffer(x, "<i4") for x in table.column("index").to_pylist()]
    value = [np.frombuffer(x, "<f4") for x in table.column("value").to_pylist()]
    starts = np.concatenate([[0], np.cumsum([len(x) for x in index])]).astype(np.int64)
    empty = [np.zeros(0)]
    all_rows = Rows(
        starts,
        np.concatenate(index or empty).astype(np.int64),
        np.concatenate(value or empty).astype(float),
    )
    return train(all_rows, np.array(table.column("y").to_pylist(), float))


def _batch_scores(model: Model, batch: pa.RecordBatch, text: int, chars: int) -> np.ndarray:
    given = _characters(batch, text, chars)
    scores = [
        model.scores(features(data, offsets, given[row : row + len(offsets) - 1]))
        for row, data, offsets in blocks(batch.column(text))
    ]
    return np.concatenate(scores) if scores else np.zeros(0)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int"


def score(
    docs: DataFrame,
    model: Model,
    id_col: str = "doc_id",
    text_col: str = "text",
    chars_col: str = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """One row per document with the model's score and whether it was held out of learning.

    The score reads the text and its length only: hashed words, statistics of its
    structure and the count of characters (counted anew where it is NULL). The model
    has a fixed size and goes along with the task; documents are not shuffled.

    A NULL or empty text is scored by its statistics. Rows without an id are not held
    out. Repeated rows give repeated results, an empty table gives none, other
    columns are not read.
    """

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = _batch_scores(model, batch, 2, 3)
            predicted = pa.array((scores >= threshold).astype(np.int32), pa.int32())
            arrays = [batch.column(0), batch.column(1), pa.array(scores), predicted]
            yield pa.RecordBatch.from_arrays(arrays, [p.split()[0] for p in SCHEMA.split(", ")])

    held_out = F.coalesce(fold(F.col(id_col)) == 0, F.lit(False))
    columns = [F.col(id_col).cast("long"), held_out, F.col(text_col), F.col(chars_col)]
    return docs.select(*columns).mapInArrow(rows, SCHEMA)


def keep_good(
    docs: DataFrame,
    model: Model,
    text_col: str = "text",
    chars_col: str = "n_chars",
    threshold: float = THRESHOLD,
) -> DataFrame:
    """The documents, with all their columns, that score ``threshold`` or more."""
    text, chars = docs.columns.index(text_col), docs.columns.index(chars_col)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = _batch_scores(model, batch, text, chars) >= threshold
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(rows, docs.schema)
