"""Phrases that stand together more often than their parts, counted over a prefix-free parse.

A document's words are cut into chunks wherever the rolling hash of two successive words hits
a trigger, so equal passages are cut alike wherever they stand. A chunk carries the three
words after it, so every phrase of up to four words lies whole in the chunk that its
first word belongs to, and is counted there only. Equal chunks become one entry of
a dictionary with their frequency in the parse, and phrases are counted within entries,
weighted by it: a passage in a million documents is counted once.

Phrases are counted length by length, since one can be frequent only where both its
shorter parts are. They are first counted by a 64-bit hash, which can only overstate;
those that reach the bound are then counted by their text, which is exact. What carries
the frequent hashes to the tasks is a bit array of a fixed size, and it only saves work.

Counts go to the group that adds them up by ranges of the hash, as one row for each task, range
and language instead of one for each phrase. A group returns what reaches the bound.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize
from tallyloom.llm.words import (
    LOWER,
    blocks,
    mix,
    prefix_sums,
    range_hash,
    text_bytes,
    window_hashes,
    word_bounds,
)

MOST = 4  # words of a phrase
TRIGGER = 16  # one in so many places ends a chunk
OWN = 512  # words of a chunk at most, where nothing triggers
BITS = 27  # the bit array has 2 ** BITS bits at most, 16 MB
BLOCK = 1 << 20  # bytes of text that a task counts at a time
HELD = 1 << 20  # hashes that a task holds before it adds up equal ones
HELD_TEXTS = 8 << 20  # bytes of phrases that a task holds before it adds up equal ones
GROUP = 1 << 19  # words of the dictionary, or 8 times as many bytes, for each range of hashes
RANGES = 4  # ranges that a task adds up, about
SALTS = 64  # parts that a language is ranked in first

#: ``[.,;:!?\x0A-\x0D]`` ends a piece, and with ``[\x20\x09]`` a word.
CUT = np.zeros(256, bool)
CUT[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = True
SEPARATORS = CUT.copy()
SEPARATORS[[0x20, 0x09]] = True

#: Sums ``n`` of hashes ``h``, or of the ``phrases`` of a language between line feeds.
PACKED = "part long, lang string, phrases string, h binary, n binary"
FOUND = "lang string, phrase string, h long, a long"


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    least: int = 30,
    top: int = 2000,
    inside: int = 80,
    scale: int = 2_000_000,
) -> DataFrame:
    """The first ``top`` phrases of each language: (lang, rank, phrase, a, l, r, n, score).

    A candidate has 2 to 4 words of one piece and stands ``a >= least`` times. Of its cuts into a
    first and a second part, standing l and r times, the one counts whose score
    ``scale * a / (l + r)``, rounded down, is least; ties go to the shorter first part. A
    candidate is dropped if a longer one that contains it has at least ``inside``
    per cent of its count. The order is by score and ``a``, highest first, then by phrase. ``n``
    is the language's number of words.

    A NULL text is empty, a NULL language is ``und``. Repeated rows count each time. Other columns
    are left out, so their names cannot clash; an empty table gives no row. Sums are
    64-bit integers, products are decimals.
    """
    entries = dictionary(docs, text_col, lang_col)
    sizes = [F.sum(F.expr("own * freq")), F.sum("own"), F.sum(F.octet_length("chunk"))]
    sizes = [c.alias(name) for c, name in zip(sizes, ("n", "words", "bytes"), strict=True)]
    totals = materialize(entries.groupBy("lang").agg(*sizes), "totals")
    words, size_bytes = totals.agg(F.sum("words"), F.sum("bytes")).first()
    ranges = max(words or 0, (size_bytes or 0) // 8) // GROUP + 1
    frequent, bits = [], None
    for size in range(1, MOST + 2):
        # One pass takes the texts of the last length and the hashes of the next.
        counts = _counted(entries, size, bits, ranges, least)
        found = materialize(counts, f"phrases{size}")
        if size > 1:
            exact = found.where("phrase is not null")
            frequent.append(exact.withColumn("size", F.lit(size - 1)))
        if size <= MOST:
            bits = _bits(found.where("phrase is null"))
    columns = ["lang", "phrase", "a", "size"]
    known = reduce(DataFrame.unionByName, [f.select(columns) for f in frequent])
    return _ranked(materialize(known, "frequent"), totals.select("lang", "n"), top, inside, scale)


def dictionary(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The distinct chunks (lang, chunk, own, freq), written.

    ``chunk`` has its words with one space between them, or a line feed where a
    piece ends; the first ``own`` words are its own, up to three more follow.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"),
        F.col(f"`{text_col}`").alias("text"),
    ).where("text is not null")
    chunks = rows.mapInArrow(_parse, "lang string, chunk string, own int, n long")
    return materialize(
        chunks.groupBy("lang", "chunk", "own").agg(F.sum("n").alias("freq")), "dictionary"
    )


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column("lang").to_pylist()
        for row, data, offsets in blocks(batch.column("text"), BLOCK // 2):
            data, offsets = _plain(data, offsets)
            starts, ends, first = word_bounds(data, offsets, SEPARATORS)
            if not len(starts):
                continue
            owner = np.repeat(np.arange(len(first) - 1), np.diff(first))
            hashes = range_hash(prefix_sums(data), starts, ends)
            # A chunk begins at each document's first word and after a trigger.
            begins = np.zeros(len(starts), bool)
            pair = mix(hashes[:-1] * np.uint64(3) + hashes[1:])
            begins[1:] = pair % np.uint64(TRIGGER) == 0
            begins[first[:-1][np.diff(first) > 0]] = True
            begins = _cut_long(begins)
            at = np.flatnonzero(begins)
            to = np.append(at[1:], len(starts))
            tail = np.minimum(to + MOST - 1, first[owner[at] + 1])
            buffer = data.tobytes()
            spans = zip(starts[at].tolist(), ends[tail - 1].tolist(), strict=True)
            texts = pa.array([buffer[a:b] for a, b in spans], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([langs[row + i] for i in owner[at]], pa.string()),
                    texts,
                    pa.array((to - at).astype(np.int32)),
                    pa.array(np.ones(len(at), np.int64)),
                ],
                ["lang", "chunk", "own", "n"],
            )


def _plain(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower case, with one byte between words: a line feed where a piece ends, else a space."""
    starts, _, first = word_bounds(data, offsets, SEPARATORS)
    out = LOWER[data]
    keep = ~SEPARATORS[data]
    later = np.ones(len(starts), bool)
    later[first[:-1][np.diff(first) > 0]] = False
    gap = starts[later] - 1
    cuts = np.zeros(len(data) + 1, np.int64)
    np.cumsum(CUT[data], out=cuts[1:])
    before = starts[np.flatnonzero(later) - 1]
    out[gap] = np.where(cuts[starts[later]] > cuts[before], 0x0A, 0x20)
    keep[gap] = True
    kept = np.zeros(len(data) + 1, np.int64)
    np.cumsum(keep, out=kept[1:])
    return out[keep], kept[offsets]


def _cut_long(begins: np.ndarray) -> np.ndarray:
    """No chunk of more than ``OWN`` own words."""
    at = np.flatnonzero(begins)
    lengths = np.diff(np.append(at, len(begins)))
    for start, length in zip(at[lengths > OWN], lengths[lengths > OWN], strict=True):
        begins[start : start + length : OWN] = True
    return begins


def _counted(
    entries: DataFrame, size: int, bits: np.ndarray | None, ranges: int, least: int
) -> DataFrame:
    """(lang, phrase, h, a): weighted counts over the dictionary of ``least`` or more.

    Phrases of one word less than ``size`` whose hash is among ``bits`` are counted by text, and
    those of ``size`` words whose two shorter parts are among them by hash alone, which the
    language is part of. At ``size`` 1 these are all words.
    """
    packed = entries.mapInArrow(_counter(size, bits, ranges), PACKED)
    # Tasks grow in number with the ranges, not in size.
    packed = packed.repartition(ranges // RANGES + 1, "part")
    return packed.groupBy("part").applyInArrow(_adder(least), FOUND)


def _bits(counts: DataFrame) -> np.ndarray:
    """A bit for each hash ``h``, in an array that grows with their number up to ``2 ** BITS``.

    Beyond that more hashes share a bit, and more phrases are counted that are not
    frequent; what is returned stays the same.
    """
    n = max(counts.count(), 1)
    bits = 1 << min(BITS, max(16, (16 * n).bit_length()))
    one = F.expr(f"shiftleft(1L, cast(pmod(h, {bits}) % 64 as int))")
    # At most one row for each 64 bits of the array.
    table = counts.groupBy(F.expr(f"pmod(h, {bits}) div 64").alias("at")).agg(F.bit_or(one).alias("b"))
    table = table.toArrow()
    out = np.zeros(bits // 64, np.int64)
    out[table.column("at").to_numpy()] = table.column("b").to_numpy()
    return out.view(np.uint64)


def _among(h: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = h & np.uint64(len(bits) * 64 - 1)
    return (bits[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1


def _counter(
    size: int, bits: np.ndarray | None, ranges: int
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        texts: list[pa.Table] = []
        for table in _joined(batches):
            block = _Block(table)
            if size > 1:
                texts.append(block.texts(size - 1, bits))
                if sum(t.nbytes for t in texts) > HELD_TEXTS:
                    texts = [_merged_texts(texts)]
                    if texts[0].nbytes > HELD_TEXTS // 2:
                        yield from _packed_texts(texts.pop(), ranges)
            if size <= MOST:
                held.append(block.counted(size, bits))
                if sum(len(h) for h, _ in held) > HELD:
                    held = [_merged(held)]
                    if len(held[0][0]) > HELD // 2:
                        yield from _packed_hashes(held.pop(), ranges)
        if texts:
            yield from _packed_texts(_merged_texts(texts), ranges)
        if held:
            yield from _packed_hashes(_merged(held), ranges)

    return count


def _adder(least: int) -> Callable[[pa.Table], pa.Table]:
    def add(table: pa.Table) -> pa.Table:
        by_text = pc.is_valid(table.column("phrases"))
        hashes, texts = table.filter(pc.invert(by_text)), table.filter(by_text)
        h, n, _ = _summed(_unpacked(hashes.column("h"), np.uint64), _unpacked(hashes.column("n")))
        h, n = h[n >= least], n[n >= least]
        nothing = pa.nulls(len(h), pa.string())
        found = [[nothing, nothing, pa.array(h.view(np.int64)), pa.array(n)]]
        if len(texts):
            phrases = pc.split_pattern(texts.column("phrases").combine_chunks(), "\n")
            langs = texts.column("lang").combine_chunks().take(pc.list_parent_indices(phrases))
            columns = [langs, phrases.flatten(), pa.array(_unpacked(texts.column("n")))]
            summed = _summed_texts(pa.table(columns, ["lang", "phrase", "a"]))
            summed = summed.filter(pc.greater_equal(summed.column("a"), least))
            found.append([*summed.columns[:2], pa.nulls(len(summed), pa.int64()), summed.column("a")])
        names = ["lang", "phrase", "h", "a"]
        return pa.concat_tables([pa.table(columns, names) for columns in found])

    return add


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Batches put together to blocks, since larger ones have more equal phrases."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= BLOCK:
            yield pa.Table.from_batches(held)
            held, size = [], 0
    if size:
        yield pa.Table.from_batches(held)


def _summed(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct hashes in order, their sums, and where one of each stands."""
    order = np.argsort(h)
    ordered = h[order]
    new = np.ones(len(h), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    at = np.flatnonzero(new)
    sums = np.add.reduceat(n[order], at) if len(at) else np.zeros(0, np.int64)
    return ordered[at], sums, order[at]


def _merged(held: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    h, n = (np.concatenate(column) for column in zip(*held, strict=True))
    return _summed(h, n)[:2]


def _summed_texts(table: pa.Table) -> pa.Table:
    """Equal rows as one, with the sum of their ``a``, which is the last column."""
    keys = table.column_names[:-1]
    summed = table.group_by(keys, use_threads=False).aggregate([("a", "sum")])
    return summed.select([*keys, "a_sum"]).rename_columns([*keys, "a"])


def _merged_texts(texts: list[pa.Table]) -> pa.Table:
    return _summed_texts(pa.concat_tables(texts)) if len(texts) > 1 else texts[0]


def _ranges(h: np.ndarray, ranges: int) -> np.ndarray:
    """The range of each hash, which rises with the hash."""
    return ((h >> np.uint64(32)) * np.uint64(ranges) >> np.uint64(32)).astype(np.int64)


def _packed_hashes(
    counts: tuple[np.ndarray, np.ndarray], ranges: int
) -> Iterator[pa.RecordBatch]:
    """One row for each range of the ordered hashes."""
    h, n = counts
    part = _ranges(h, ranges)
    at = _runs(part)
    nothing = pa.nulls(len(at) - 1, pa.string())
    columns = [pa.array(part[at[:-1]]), nothing, nothing, _pieces(h, at), _pieces(n, at)]
    yield pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "h", "n"])


def _packed_texts(texts: pa.Table, ranges: int) -> Iterator[pa.RecordBatch]:
    """One row for each language and range of hashes."""
    langs = texts.column("lang").combine_chunks().dictionary_encode()
    part = _ranges(texts.column("h").to_numpy(), ranges)
    key = langs.indices.to_numpy() * np.int64(ranges) + part
    order = np.argsort(key)
    at = _runs(key[order])
    phrases = texts.column("phrase").combine_chunks().take(pa.array(order))
    phrases = pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), phrases)
    first = order[at[:-1]]
    columns = [
        pa.array(part[first]),
        texts.column("lang").combine_chunks().take(pa.array(first)),
        pc.binary_join(phrases, "\n"),
        pa.nulls(len(first), pa.binary()),
        _pieces(texts.column("a").to_numpy()[order], at),
    ]
    yield pa.RecordBatch.from_arrays(columns, ["part", "lang", "phrases", "h", "n"])


def _runs(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    new = np.flatnonzero(keys[1:] != keys[:-1]) + 1
    return np.concatenate([np.zeros(min(len(keys), 1), np.int64), new, [len(keys)]])


def _pieces(numbers: np.ndarray, at: np.ndarray) -> pa.Array:
    """The bytes of the 64-bit numbers from each place to the next."""
    buffers = [None, pa.py_buffer((at * 8).astype(np.int32)), pa.py_buffer(numbers)]
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, buffers)


def _unpacked(column: pa.ChunkedArray, kind: type = np.int64) -> np.ndarray:
    return text_bytes(column)[0].view(kind)


def _gathered(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The texts from each start to its end."""
    offsets = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(ends - starts, out=offsets[1:])
    place = np.arange(offsets[-1])
    place += np.repeat(starts - offsets[:-1], ends - starts)
    buffers = [None, pa.py_buffer(offsets), pa.py_buffer(data[place])]
    return pa.Array.from_buffers(pa.large_string(), len(starts), buffers).cast(pa.string())


class _Block:
    """The words of some entries of the dictionary."""

    def __init__(self, table: pa.Table):
        self.langs = table.column("lang").combine_chunks()
        self.freq = table.column("freq").to_numpy()
        data, offsets = text_bytes(table.column("chunk"))
        self.data = data
        self.starts, self.ends, first = word_bounds(data, offsets, SEPARATORS)
        self.owner = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        place = np.arange(len(self.starts)) - first[self.owner]
        self.own = place < table.column("own").to_numpy()[self.owner]
        # A piece begins with an entry and after a line feed.
        begins = (place == 0) | (data[self.starts - 1] == 0x0A)
        self.piece = np.cumsum(begins)
        langs = self.langs.dictionary_encode()
        codes = [zlib.crc32(lang.encode()) for lang in langs.dictionary.to_pylist()]
        lang = np.array(codes, np.uint64)[langs.indices.to_numpy()]
        words = range_hash(prefix_sums(data), self.starts, self.ends)
        self.words = mix(words ^ mix(lang + np.uint64(1))[self.owner])

    def hashes(self, length: int) -> np.ndarray:
        """The hash of the phrase that begins at each word, of any value where none does."""
        out = np.zeros(len(self.words), np.uint64)
        found = window_hashes(self.words, length) if length > 1 else self.words
        out[: len(found)] = found
        return out

    def whole(self, length: int) -> np.ndarray:
        """Whether a phrase of the entry's own begins at each word."""
        out = np.zeros(len(self.words), bool)
        n = max(len(out) - length + 1, 0)
        out[:n] = self.own[:n] & (self.piece[:n] == self.piece[length - 1 : length - 1 + n])
        return out

    def counted(self, size: int, bits: np.ndarray | None) -> tuple[np.ndarray, np.ndarray]:
        """Hashes and counts of the phrases of ``size`` words whose shorter parts are in ``bits``."""
        at = np.flatnonzero(self.whole(size))
        if size > 1:
            part = _among(self.hashes(size - 1), bits)
            at = at[part[at] & part[at + 1]]
        return self.hashes(size)[at], self.freq[self.owner[at]]

    def texts(self, length: int, bits: np.ndarray) -> pa.Table:
        """The phrases of ``length`` words in ``bits`` with hash and count, equal ones as one row."""
        h = self.hashes(length)
        at = np.flatnonzero(self.whole(length))
        at = at[_among(h[at], bits)]
        distinct, sums, first = _summed(h[at], self.freq[self.owner[at]])
        at = at[first]
        phrases = _gathered(self.data, self.starts[at], self.ends[at + length - 1])
        langs = self.langs.take(pa.array(self.owner[at]))
        return pa.table([langs, phrases, pa.array(distinct), pa.array(sums)], ["lang", "phrase", "h", "a"])


def _ranked(
    frequent: DataFrame, totals: DataFrame, top: int, inside: int, scale: int
) -> DataFrame:
    """Score the candidates among the frequent phrases, drop contained ones, rank the rest."""
    words = frequent.where("size > 1").withColumn("words", F.split("phrase", " "))
    parts = frequent.select("lang", "phrase", "a")

    def joined(first: Column, length: Column) -> Column:
        return F.array_join(F.slice("words", first, length), " ")

    cuts = words.withColumn("k", F.explode(F.sequence(F.lit(1), F.col("size") - 1)))
    cuts = cuts.withColumns(
        {
            "first": joined(F.lit(1), F.col("k")),
            "rest": joined(F.col("k") + 1, F.col("size") - F.col("k")),
        }
    ).drop("words")
    cuts = cuts.join(parts.toDF("lang", "first", "l"), ["lang", "first"])
    cuts = cuts.join(parts.toDF("lang", "rest", "r"), ["lang", "rest"])
    wide = {c: f"cast({c} as decimal(19, 0))" for c in "alr"}
    score = F.expr(f"(cast({scale} as decimal(10, 0)) * {wide['a']}) div ({wide['l']} + {wide['r']})")
    least = F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("cut")
    scored = cuts.groupBy("lang", "phrase", "a").agg(least)

    spans = F.expr(
        "flatten(transform(sequence(2, size - 1), "
        "m -> transform(sequence(1, size - m + 1), i -> array_join(slice(words, i, m), ' '))))"
    )
    longer = words.where("size > 2").select("lang", F.explode(spans).alias("phrase"), "a")
    longer = longer.groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    big = {c: F.col(c).cast("decimal(19, 0)") for c in ("a", "longer")}
    contained = big["longer"] * 100 >= big["a"] * F.lit(inside)
    kept = scored.join(longer, ["lang", "phrase"], "left").where(
        F.col("longer").isNull() | ~contained
    )
    # A hot language is cut down in parts, so one task gets ``SALTS * top`` rows of it at most.
    order = [F.desc("cut.score"), F.desc("a"), "phrase"]
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS))
    ranked = kept.withColumn("salt", salt)
    for by in (["lang", "salt"], ["lang"]):
        rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
        ranked = ranked.withColumn("rank", rank).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", "rank", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"
    )
