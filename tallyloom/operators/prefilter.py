"""A Bloom filter of a table's keys, built and asked by DataFrame functions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.operators.names import column_of, free_name

_WORDS = 64  # of 64 bits, in a row of the filter
_BITS_PER_KEY = 16
#: Types whose equal values have equal hashes.
HASHABLE = ("tinyint", "smallint", "int", "bigint", "string", "date", "timestamp")


class KeyFilter:
    """Which keys a table may have: all that it has, and few others.

    The filter is a table of rows of 64 words; a key has three bits in one word, so asking
    for a key reads one row. It is broadcast, of ``max_bytes`` at most: beyond that
    (16 bits a key) :attr:`fits` is false and :meth:`keep` leaves the rows as they are, as
    it does where the two keys' types differ or equal values may have different hashes.
    Only rows that an inner join would drop are ever filtered, so results do not depend
    on it. A NULL key is in no table.
    """

    def __init__(self, df: DataFrame, key: str, max_bytes: int = 64 << 20) -> None:
        keys = df.select(column_of(df, key).alias("key")).where("key is not null")
        self.kind = keys.schema["key"].dataType.simpleString()
        n_keys = keys.agg(F.approx_count_distinct("key")).first()[0] if self.kind in HASHABLE else 0
        self.n_rows = max(1, -(-n_keys * _BITS_PER_KEY // (64 * _WORDS)))
        self.fits = self.kind in HASHABLE and self.n_rows * _WORDS * 8 <= max_bytes
        self.keys = keys

    def _bits(self, key: Column) -> tuple[Column, Column, Column]:
        """The row of a key, the word in it and the bits of that word."""
        places = F.xxhash64(key, F.lit(1))

        def part(k: int) -> Column:
            return F.shiftrightunsigned(places, 6 * k).bitwiseAND(F.lit(63)).cast("int")

        one = F.lit(1).cast("long")
        bits = [F.call_function("shiftleft", one, part(k)) for k in (1, 2, 3)]
        row = F.pmod(F.xxhash64(key), F.lit(self.n_rows).cast("long"))
        return row, part(0), bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2])

    def table(self) -> DataFrame:
        """``(row, words)``: the filter itself, its keys combined before they are shuffled."""
        row, word, bits = self._bits(F.col("key"))
        words = self.keys.select(row.alias("row"), word.alias("word"), bits.alias("bits"))
        words = words.groupBy("row", "word").agg(F.bit_or("bits").alias("bits"))
        by_word = F.map_from_entries(F.collect_list(F.struct("word", "bits")))
        rows = words.groupBy("row").agg(by_word.alias("words"))
        every = F.sequence(F.lit(0), F.lit(_WORDS - 1))
        empty = F.lit(0).cast("long")
        return rows.select(
            "row", F.transform(every, lambda w: F.coalesce(F.col("words")[w], empty)).alias("words")
        )

    def keep(self, df: DataFrame, key: str) -> DataFrame:
        """The rows of ``df`` whose key the table may have."""
        asked = column_of(df, key)
        if not self.fits or df.select(asked).schema[0].dataType.simpleString() != self.kind:
            return df
        row, word, bits = self._bits(asked)
        names = [free_name(name, df.columns) for name in ("__row", "__words")]
        table = F.broadcast(self.table().toDF(*names))
        met = df.join(table, (row == F.col(names[0])) & asked.isNotNull())
        return met.where(F.get(F.col(names[1]), word).bitwiseAND(bits) == bits).drop(*names)
