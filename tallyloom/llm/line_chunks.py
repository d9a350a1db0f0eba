"""Line deduplication by content-defined chunks of lines.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.store import broadcast_if_small, materialize

#: First hexadecimal digits of a rolling hash that end a chunk (5 of 16).
ENDS = "01234"
_LAST_ID = (1 << 63) - 1  # stands for a NULL id, which comes last


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside of lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _chunks(text: Column) -> Column:
    """Structs (pos, from, n, worded, hash) of the chunks of a text's lines, in order.

    A line ends a chunk if the hash of its own hash and that of the line before it
    begins with one of :data:`ENDS`. Boundaries follow from two lines alone, so lines
    put in or taken out elsewhere do not shift them.
    """

    def with_hashes(lines: Column) -> Column:
        hashes = F.transform(lines, lambda x: F.md5(x.cast("binary")))
        return _let(hashes, lambda h: with_ends(lines, h))

    def with_ends(lines: Column, hashes: Column) -> Column:
        rolling = F.transform(
            hashes,
            lambda h, i: F.md5(F.concat(F.coalesce(F.get(hashes, i - 1), F.lit("")), h).cast("binary")),
        )
        ends = F.filter(
            F.transform(
                rolling,
                lambda r, i: F.when(
                    (F.instr(F.lit(ENDS), F.substring(r, 1, 1)) > 0) | (i == F.size(hashes) - 1), i
                ),
            ),
            lambda i: i.isNotNull(),
        )
        return _let(ends, lambda e: F.transform(e, lambda end, k: chunk(lines, hashes, e, end, k)))

    def chunk(lines: Column, hashes: Column, ends: Column, end: Column, k: Column) -> Column:
        start = F.when(k == 0, 0).otherwise(F.get(ends, k - 1) + 1)
        n = end - start + 1
        own = F.slice(lines, start + 1, n)
        return F.struct(
            k.alias("pos"),
            start.alias("from"),
            n.alias("n"),
            F.size(F.filter(own, lambda x: F.trim(x) != "")).alias("worded"),
            F.md5(F.array_join(F.slice(hashes, start + 1, n), "").cast("binary")).alias("hash"),
        )

    return _let(F.split(text, "\n", -1), with_hashes)


def dedup_lines(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_lines: int = 2
) -> DataFrame:
    """The documents without the chunks of lines that stand earlier elsewhere.

    A chunk of ``min_lines`` or more lines that are not blank is removed wherever the
    same bytes stood before it, in a document of a smaller id or further up in the
    same one; the first one stays. All columns are kept, with the new text, and
    ``n_lines``, ``n_removed_lines`` and ``n_removed_chunks`` are added (columns of
    these names are replaced). A document may end up with an empty text.

    Counting moves one hash per chunk. Only the text of chunks whose hash repeats is
    moved for the comparison of bytes, combined before its shuffle, so a chunk of very
    many documents is one row a task; removals come back to the documents by id,
    broadcast if they measure small, else by a shuffle.

    A NULL text has no lines and stays NULL, an empty one has one line and stays. A
    NULL id comes after all others. Rows that agree in id and text are one document:
    they are treated alike and never remove each other's chunks; rows of one id with
    other texts are ordered by a hash of the text. An empty table gives none.
    """
    added = ("n_lines", "n_removed_lines", "n_removed_chunks")
    docs = docs.drop(*added)
    key = {
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)),
        "__hash": F.xxhash64(F.col(text_col)),
    }
    rows = docs.withColumns(key)
    lines = rows.where(F.col(text_col).isNotNull())
    found = lines.select("__id", "__hash", F.explode(_chunks(F.col(text_col))).alias("c"))
    found = found.where(F.col("c.worded") >= min_lines)
    repeated = materialize(
        found.select(F.col("c.hash").alias("hash")).groupBy("hash").count().where("count > 1").select("hash"),
        "chunks",
    )
    cut = lines.select(
        "__id",
        "__hash",
        F.split(text_col, "\n", -1).alias("lines"),
        _chunks(F.col(text_col)).alias("chunks"),
    )
    chunks = cut.select("__id", "__hash", "lines", F.explode("chunks").alias("c")).where(
        F.col("c.worded") >= min_lines
    )
    texts = chunks.select(
        "__id",
        "__hash",
        F.col("c.pos").alias("pos"),
        F.col("c.hash").alias("hash"),
        F.array_join(F.slice("lines", F.col("c.from") + 1, F.col("c.n")), "\n").alias("bytes"),
    ).join(broadcast_if_small(repeated), "hash")
    texts = materialize(texts, "chunks")
    place = F.struct("__id", "__hash", "pos")
    first = texts.groupBy("hash", "bytes").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    later = texts.join(first.where("n > 1"), ["hash", "bytes"]).where(place > F.col("first"))
    removals = materialize(
        later.groupBy("__id", "__hash").agg(F.sort_array(F.collect_set("pos")).alias("__gone")), "chunks"
    )
    joined = rows.join(broadcast_if_small(removals), ["__id", "__hash"], "left")

    def cut_out(chunks: Column) -> Column:
        """The removed chunks, and the lines of the others; linear in both."""
        every = F.sequence(F.lit(0), F.size(chunks) - 1)
        return _let(
            F.split(text_col, "\n", -1),
            lambda lines: F.struct(
                F.transform("__gone", lambda p: F.get(chunks, p)).alias("out"),
                F.array_join(
                    F.flatten(
                        F.transform(
                            F.transform(F.array_except(every, "__gone"), lambda p: F.get(chunks, p)),
                            lambda c: F.slice(lines, c["from"] + 1, c["n"]),
                        )
                    ),
                    "\n",
                ).alias("text"),
            ),
        )

    parts = F.when(F.col("__gone").isNotNull(), _let(_chunks(F.col(text_col)), cut_out))
    joined = joined.withColumn("__parts", parts)
    joined = joined.withColumns({"__out": F.col("__parts.out"), "__left": F.col("__parts.text")})
    n_out = F.coalesce(F.size("__out"), F.lit(0)).cast("long")
    lines_out = F.coalesce(
        F.aggregate("__out", F.lit(0).cast("long"), lambda a, c: a + c["n"]), F.lit(0).cast("long")
    )
    n_lines = F.coalesce(F.size(F.split(text_col, "\n", -1)), F.lit(0)).cast("long")
    return joined.select(
        *[
            F.when(F.col("__out").isNotNull(), F.col("__left")).otherwise(F.col(c)).alias(c)
            if c == text_col
            else F.col(f"`{c}`")
            for c in docs.columns
        ],
        F.when(F.col(text_col).isNull(), F.lit(0).cast("long")).otherwise(n_lines).alias("n_lines"),
        lines_out.alias("n_removed_lines"),
        F.when(F.col("__out").isNull(), F.lit(0).cast("long")).otherwise(n_out).alias("n_removed_chunks"),
    )


def _pairs(text: Column) -> Column:
    """Structs (from, n, bytes, hash) of a text's pairs: a worded line up to the next worded one."""

    def with_worded(lines: Column) -> Column:
        places = F.filter(
            F.transform(lines, lambda x, i: F.when(F.trim(x) != "", i)), lambda i: i.isNotNull()
        )
        return _let(places, lambda w: F.transform(F.slice(w, 2, F.size(w)), lambda end, k: pair(lines, w, end, k)))

    def pair(lines: Column, worded: Column, end: Column, k: Column) -> Column:
        start = F.get(worded, k)
        n = end - start + 1
        return _let(
            F.array_join(F.slice(lines, start + 1, n), "\n"),
            lambda own: F.struct(
                start.alias("from"), n.alias("n"), own.alias("bytes"), F.xxhash64(own).alias("hash")
            ),
        )

    return _let(F.split(text, "\n", -1), with_worded)


def dedup_line_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without the runs of two or more worded lines that stand earlier.

    A pair is a line that is not blank, the next such line, and the blank ones between.
    All lines of a pair go wherever the same bytes stood before it, in a document of a
    smaller id or further up in the same one, so a repeated run goes from its first
    worded line to its last whatever stands around it. All pairs of the input count,
    also those that go themselves; the first place of a line always stays. All columns
    are kept, with the new text, and ``n_lines``, ``n_removed_lines`` and
    ``n_removed_runs`` are added (columns of these names are replaced).

    Counting moves one hash per pair; bytes move for pairs whose hash repeats. NULL and
    empty texts, NULL ids and rows of one id are treated as in :func:`dedup_lines`.
    """
    docs = docs.drop("n_lines", "n_removed_lines", "n_removed_runs")
    key = {
        "__id": F.coalesce(F.col(id_col).cast("long"), F.lit(_LAST_ID)),
        "__hash": F.xxhash64(F.col(text_col)),
    }
    rows = docs.withColumns(key)
    pairs = rows.where(F.col(text_col).isNotNull()).select(
        "__id", "__hash", F.explode(_pairs(F.col(text_col))).alias("p")
    )
    hashes = pairs.select(F.col("p.hash").alias("hash"))
    repeated = materialize(hashes.groupBy("hash").count().where("count > 1").select("hash"), "pairs")
    texts = pairs.select("__id", "__hash", "p.*").join(broadcast_if_small(repeated), "hash")
    texts = materialize(texts, "pairs")
    place = F.struct("__id", "__hash", "from")
    first = texts.groupBy("hash", "bytes").agg(F.min(place).alias("first"), F.max(place).alias("last"))
    first = first.where("last > first").select("hash", "bytes", "first")
    later = texts.join(first, ["hash", "bytes"]).where(place > F.col("first"))
    places = later.select("__id", "__hash", F.explode(F.sequence("from", F.col("from") + F.col("n") - 1)).alias("i"))
    removals = places.groupBy("__id", "__hash").agg(F.collect_set("i").alias("__gone"))
    removals = materialize(removals, "pairs")
    joined = rows.join(broadcast_if_small(removals), ["__id", "__hash"], "left")

    def left(lines: Column) -> Column:
        kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__gone"))
        return F.array_join(F.transform(kept, lambda i: F.get(lines, i)), "\n")

    split = F.split(text_col, "\n", -1)
    new = F.when(F.col("__gone").isNull(), F.col(text_col)).otherwise(_let(split, left))

    def count(value: Column) -> Column:
        return F.when(value.isNull(), F.lit(0)).otherwise(F.size(value)).cast("long")

    runs = F.array_except("__gone", F.transform("__gone", lambda i: i + 1))
    return joined.select(
        *[new.alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns],
        count(split).alias("n_lines"),
        count(F.col("__gone")).alias("n_removed_lines"),
        count(runs).alias("n_removed_runs"),
    )
