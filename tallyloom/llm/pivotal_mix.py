"""Mixing sources to target weights by pivotal dependent rounding, with DataFrame functions.

Every document gets ``target / size of its source`` copies on average. The whole part is
certain; the fraction is rounded by pivotal steps: two documents meet, words go from
one to the other by a fair lottery until one of them is in or out, and the other
goes on with the rest. The words expected of the two together never change, so a source
ends within one document of its target, and each document keeps its own probability.

The steps form a tree. Documents are dealt to blocks of a bounded number by a hash, a block is
rounded within one aggregate and leaves one residual, and the residuals of many blocks
meet a level higher, until a source has one, which is drawn. A source of any size is spread
over its blocks. Long documents are rounded first; the others then aim at what these
have left of the target, so the last residual is a short one.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyloom.llm.store import broadcast_if_small, materialize

ARITY = 512  # documents or residuals that meet in one block, on average
GRAIN = 20  # expected words are whole multiples of 2 ** -GRAIN, so that sums are exact
LONG = 8  # a document over this many times its source's mean is rounded first
ROWS = 4096  # repeated rows that are given out at a time

WORDS = r"[^\x20\x09-\x0D]+"


def source_targets(
    sources: DataFrame, weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: float = 2.0
) -> DataFrame:
    """``sources`` (source, source_size, ...) with ``target``, the words to take of each.

    Sources in the order of their code points, NULL last, take ``weights`` in turn and
    share ``share`` of all words. A target stops at ``most`` times the source's size, and what
    is over goes to the others by weight until none is above. One row per source is expected.
    """
    position = F.pmod("position", F.lit(len(weights))).cast("int") + 1
    table = materialize(
        _numbered(sources).withColumn(
            "weight", F.element_at(F.array(*[F.lit(float(w)) for w in weights]), position)
        ),
        "weights",
    )
    total = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, capped = 0.0, -1
    while True:
        above = F.col("weight") * F.lit(level) > F.col("source_size") * F.lit(most)
        n, full, rest = table.agg(
            F.count(F.when(above, 1)),
            F.coalesce(F.sum(F.when(above, F.col("source_size"))), F.lit(0)),
            F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0.0)),
        ).first()
        if n == capped or not rest:
            break
        capped, level = n, (total - full * most) / rest
    target = F.least(F.col("weight") * F.lit(level), F.col("source_size") * F.lit(most))
    return table.withColumn("target", target).drop("weight", "position")


def _numbered(sources: DataFrame) -> DataFrame:
    """``position`` from 0 by code point, NULL last; one range of sources a task."""
    order = F.col("source").asc_nulls_last()
    parts = materialize(
        sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "sources"
    )
    # One row for each partition of the shuffle.
    counts = parts.groupBy("part").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    counts = counts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    within = F.row_number().over(Window.partitionBy("part").orderBy(order)) - 1
    return (
        parts.join(F.broadcast(counts), "part")
        .withColumn("position", F.col("before") + within)
        .drop("part", "before")
    )


def mixing_plan(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    seed: int = 0,
) -> DataFrame:
    """One row per row of ``docs``: (id, source, size, source_size, target, copies, taken).

    ``size`` is the number of words, ``copies`` how often the mix takes the document, at
    most ``most`` rounded up, and ``taken`` the words that makes. The draw depends on ``seed`` and on id,
    source and size alone, so a rerun agrees however the rows are dealt out.

    A NULL or empty text has size 0 and is taken 0 times. A NULL source is a source, and
    a NULL id an id. Rows of one id, source and size are alike: some of them get one
    copy more than the others, and which is not told apart. An empty table gives no row.
    Other columns are left out, so their names cannot clash.
    """
    plan = _decide(docs, id_col, text_col, source_col, weights, share, most, seed)
    last = F.least(F.col("n"), (F.col("part") + 1) * ROWS)
    each = plan.withColumn("part", F.explode(F.expr(f"sequence(0L, (n - 1) div {ROWS})"))).withColumn(
        "k", F.explode(F.sequence(F.col("part") * ROWS + 1, last))
    )
    copies = F.col("base") + F.when(F.col("k") <= F.col("extra"), 1).otherwise(0)
    return each.withColumn("copies", copies).select(
        F.col("id").alias(id_col),
        F.col("source").alias(source_col) if source_col != id_col else "source",
        "size",
        "source_size",
        "target",
        "copies",
        (F.col("size") * F.col("copies")).alias("taken"),
    )


def mix_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    copies_col: str = "copies",
    **options: object,
) -> DataFrame:
    """The rows of ``docs`` that the mix takes, all columns, with ``copies_col`` beside them.

    The plan is that of :func:`mixing_plan`. A column that is called ``copies_col`` already
    is refused. Where rows have one id, source and size, the copy more goes to the first by the
    hash of their text. Texts are shuffled once, to their decisions.
    """
    if copies_col.lower() in map(str.lower, docs.columns):
        raise ValueError(f"there is a column {copies_col} already")
    settings = {"weights": (3, 1, 2), "share": 1.5, "most": 2.0, "seed": 0, **options}
    plan = _decide(docs, id_col, text_col, source_col, **settings)
    plan = plan.where("base > 0 or extra > 0").select(
        F.struct("id", "source", "size").alias("key"), "n", "base", "extra"
    )
    rows = docs.select(
        F.struct("*").alias("row"),
        F.struct(
            F.col(_quoted(id_col)).alias("id"),
            F.col(_quoted(source_col)).alias("source"),
            _words(text_col).alias("size"),
        ).alias("key"),
        F.xxhash64(_quoted(text_col)).alias("h"),
    ).join(plan, "key")
    rank = F.row_number().over(Window.partitionBy("key").orderBy("h"))
    alone = rows.where("n = 1").withColumn("k", F.lit(1))
    alike = rows.where("n > 1").withColumn("k", rank)
    copies = F.col("base") + F.when(F.col("k") <= F.col("extra"), 1).otherwise(0)
    taken = alone.unionByName(alike).withColumn("n", copies).where("n > 0")
    columns = [F.col(f"row.{_quoted(c)}") for c in docs.columns]
    return taken.select(*columns, F.col("n").alias(copies_col))


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _words(text_col: str) -> Column:
    return F.coalesce(F.regexp_count(_quoted(text_col), F.lit(WORDS)), F.lit(0)).cast("long")


def _decide(docs, id_col, text_col, source_col, weights, share, most, seed) -> DataFrame:
    """One row per (id, source, size): n rows, each ``base`` times, ``extra`` of them once more."""
    found = docs.select(
        F.col(_quoted(id_col)).alias("id"),
        F.col(_quoted(source_col)).alias("source"),
        _words(text_col).alias("size"),
    )
    units = materialize(found.groupBy("id", "source", "size").agg(F.count("*").alias("n")), "units")
    sums = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("n")).alias("source_size"),
        F.sum("n").alias("rows"),
        F.count("*").alias("units"),
    )
    p = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    sources = source_targets(sums, weights, share, most).withColumn("p", p)
    sources = sources.withColumn("base", F.floor("p")).withColumn("f", F.col("p") - F.col("base"))
    sources = sources.withColumn("blocks", F.expr(f"(units + {ARITY - 1}) div {ARITY}"))
    sources = materialize(sources.drop("units", "p"), "targets")
    blocks = sources.agg(F.max("blocks")).first()[0] or 0

    is_long = F.col("size") * F.col("rows") > F.col("source_size") * LONG
    rows = _with_source(units, sources).withColumn("long", is_long)
    first = _round(rows.where("long and size > 0"), blocks, seed)

    placed = first.groupBy("source").agg(F.sum(F.col("extra") * F.col("size")).alias("placed"))
    short = rows.where("not long and size > 0").groupBy("source")
    short = short.agg(F.sum(F.col("size") * F.col("n")).alias("short"))
    again = sources.join(placed.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(sources["source"]), "left").drop("s")
    again = again.join(short.withColumnRenamed("source", "s"), F.col("s").eqNullSafe(sources["source"])).drop("s")
    left = F.col("f") * F.col("source_size") - F.coalesce("placed", F.lit(0))
    fraction = F.least(F.lit(1.0), F.greatest(F.lit(0.0), left / F.col("short")))
    again = materialize(again.withColumn("f", fraction).drop("placed", "short"), "rest")
    rest = _with_source(units.where("size > 0"), again).withColumn("long", is_long)
    second = _round(rest.where("not long"), blocks, seed)

    empty = units.where("size = 0").withColumn("extra", F.lit(0).cast("long"))
    columns = ["id", "source", "size", "n", "extra"]
    decided = reduce(DataFrame.unionByName, [d.select(columns) for d in (first, second, empty)])
    out = _with_source(decided, sources).drop("f", "blocks", "rows")
    return out.withColumn("base", F.when(F.col("size") > 0, F.col("base")).otherwise(0))


def _with_source(rows: DataFrame, sources: DataFrame) -> DataFrame:
    # A hot source is a key of this join; beyond a broadcast Spark splits its partition.
    given = broadcast_if_small(sources.withColumnRenamed("source", "s"))
    return rows.join(given, F.col("source").eqNullSafe(F.col("s"))).drop("s")


_UNIT = ["id", "size", "n", "whole", "mass", "h"]


def _round(rows: DataFrame, blocks: int, seed: int) -> DataFrame:
    """(id, source, size, n, extra): ``n * f`` copies of each unit rounded up or down.

    The words placed per source differ from their expectation by less than one unit.
    """
    due = F.col("n") * F.col("f")
    cap = F.shiftleft("size", GRAIN)
    mass = F.round((due - F.floor(due)) * F.col("size") * F.lit(float(1 << GRAIN))).cast("long")
    h = F.xxhash64(F.lit(seed), "id", "source", "size")
    units = rows.withColumns(
        {"whole": F.floor(due), "mass": F.least(mass, cap), "h": h}
    ).select("source", "blocks", *_UNIT)
    units = materialize(units, "due")
    settled = units.where((F.col("mass") == 0) | (F.col("mass") == cap))
    level = units.where((F.col("mass") > 0) & (F.col("mass") < cap)).select(
        "source",
        F.pmod("h", "blocks").alias("block"),
        F.struct(*_UNIT).alias("unit"),
    )
    done, depth = [settled.select("source", F.struct(*_UNIT).alias("unit"))], 0
    while blocks >= 1:
        tree = materialize(_meet(level, seed, depth), f"level{depth}")
        done.append(tree.select("source", F.explode("state.done").alias("unit")).where("unit.n > 0"))
        level = tree.select("source", F.expr(f"block div {ARITY}").alias("block"), F.col("state.carry").alias("unit"))
        if blocks == 1:
            break
        blocks, depth = -(-blocks // ARITY), depth + 1
    # One residual a source is left, which is drawn.
    drawn = _chance(F.col("unit.h"), seed, -1) * F.shiftleft("unit.size", GRAIN) < F.col("unit.mass")
    full = F.when(drawn, F.shiftleft("unit.size", GRAIN)).otherwise(0)
    done.append(level.select("source", F.col("unit").withField("mass", full).alias("unit")))
    every = reduce(DataFrame.unionByName, done)
    taken = F.when(F.col("unit.mass") > 0, 1).otherwise(0)
    return every.select(
        "unit.id", "source", "unit.size", "unit.n", (F.col("unit.whole") + taken).alias("extra")
    )


def _chance(h: Column, seed: int, depth: int) -> Column:
    """A number from 0 to 1, exclusive, that only the unit and the level decide."""
    return F.shiftrightunsigned(F.xxhash64(h, F.lit(seed), F.lit(depth)), 11) / F.lit(float(1 << 53))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _meet(level: DataFrame, seed: int, depth: int) -> DataFrame:
    """Round the units of each block; ``state`` has the decided ones and the residual.

    Large units come first, so that the residual tends to be a small one.
    """
    kind = level.schema["unit"].dataType.simpleString()
    order = F.struct((-F.col("unit.size")).alias("o"), F.col("unit.h").alias("h"), "unit")
    units = F.sort_array(F.collect_list(order))
    nobody = F.struct(
        *[
            F.lit(1 if f.name == "size" else 0 if f.name in ("n", "whole", "mass", "h") else None)
            .cast(f.dataType)
            .alias(f.name)
            for f in level.schema["unit"].dataType
        ]
    )
    start = F.struct(
        nobody.cast(kind).alias("carry"), F.array().cast(f"array<{kind}>").alias("done")
    )

    def step(state: Column, item: Column) -> Column:
        carry, unit = state["carry"], item["unit"]
        cap, unit_cap = F.shiftleft(carry["size"], GRAIN), F.shiftleft(unit["size"], GRAIN)
        up = F.least(cap - carry["mass"], unit["mass"])
        down = F.least(carry["mass"], unit_cap - unit["mass"])
        ways = F.struct(up.alias("up"), down.alias("down"))

        def moved(way: Column) -> Column:
            gains = _chance(unit["h"], seed, depth) * (way["up"] + way["down"]) < way["down"]
            return F.when(gains, way["up"]).otherwise(-way["down"])

        def settle(words: Column) -> Column:
            mass = carry["mass"] + words
            pair = F.struct(
                carry.withField("mass", mass).alias("carry"),
                unit.withField("mass", unit["mass"] - words).alias("unit"),
                ((mass == 0) | (mass == cap)).alias("over"),
            )
            return _let(
                pair,
                lambda p: F.struct(
                    F.when(p["over"], p["unit"]).otherwise(p["carry"]).cast(kind).alias("carry"),
                    F.concat(
                        state["done"],
                        F.array(F.when(p["over"], p["carry"]).otherwise(p["unit"]).cast(kind)),
                    ).alias("done"),
                ),
            )

        return _let(ways, lambda w: _let(moved(w), settle))

    return level.groupBy("source", "block").agg(F.aggregate(units, start, step).alias("state"))
