"""Secret scan: fixed patterns, and a battery of randomness tests on long tokens.

Everything here is DataFrame functions; no Python runs on the executors.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.store import materialize

#: Kinds in the order that breaks ties of start; the first three are the base.
KINDS = ("assign", "access", "hex", "random")
MIN_ASSIGN = 12

FALSE_DISCOVERY = 0.01  # share of ordinary tokens among those reported, per stratum
FALSE_REJECTION = 0.01  # share of random tokens among those the battery rejects, per stratum
BANDS = (20, 28, 36, 48, 64, 96, 160)  # least lengths of the length strata
BINS_PER_DECADE, MAX_BIN = 4, 400  # of the p-values that are counted

_LOWER, _UPPER, _DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
#: Encodings with the pattern and the alphabet that tell them, first match first.
ENCODINGS = (
    ("digits", "^[0-9]+$", _DIGITS),
    ("hex", "^[0-9a-f]+$", _DIGITS + "abcdef"),
    ("HEX", "^[0-9A-F]+$", _DIGITS + "ABCDEF"),
    ("letters", "^[a-z]+$", _LOWER),
    ("LETTERS", "^[A-Z]+$", _UPPER),
    ("base32", "^[A-Z2-7]+$", _UPPER + "234567"),
    ("alnum", "^[a-z0-9]+$", _LOWER + _DIGITS),
    ("base62", "^[A-Za-z0-9]+$", _UPPER + _LOWER + _DIGITS),
    ("base64", "^[A-Za-z0-9+/]+$", _UPPER + _LOWER + _DIGITS + "+/"),
    ("base64url", "^[A-Za-z0-9_-]+$", _UPPER + _LOWER + _DIGITS + "-_"),
    ("mixed", "", _UPPER + _LOWER + _DIGITS + "+/-_"),
)
_TOKEN = "[A-Za-z0-9+/_-]{20,}"
#: Letters of ordinary words, per mille.
_FREQUENCY = dict(
    zip(
        _LOWER,
        (82, 15, 28, 43, 127, 22, 20, 61, 70, 2, 8, 40, 24, 67, 75, 19, 1, 60, 63, 91, 28, 10, 24,
         2, 20, 1),
        strict=True,
    )
)


def _either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


_KEYS = "|".join(map(_either_case, ("password", "passwd", "secret", "token"))) + "|{}_?{}".format(
    _either_case("api"), _either_case("key")
)
ASSIGN = rf"""({_KEYS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
# A run of these characters matches from its first AKIA to its end, so the length
# can stand in the pattern; the same goes for runs of hexadecimal digits.
ACCESS = "AKIA[A-Z0-9]{14,}"
HEX = "[0-9a-f]{16,}"


def _ordinary_weights() -> list[dict[str, float]]:
    """The natural logarithm of each character's share in words, words in capitals, and numbers."""
    share = {c: 0.86 * f / 1003 for c, f in _FREQUENCY.items()}
    share |= {c.upper(): 0.06 * f / 1003 for c, f in _FREQUENCY.items()}
    share |= dict.fromkeys(_DIGITS, 0.05 / 10) | dict.fromkeys("+/-_", 0.03 / 4)
    numbers = dict.fromkeys(share, 0.1 / 56) | dict.fromkeys(_DIGITS, 0.9 / 10)
    capitals = {c.swapcase(): p for c, p in share.items()}
    return [{c: math.log(p) for c, p in s.items()} for s in (share, capitals, numbers)]


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once per row, also inside of lambdas."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _running_totals(steps: Column) -> Column:
    """Inclusive prefix sums of an array, by blocks of 256 so that long arrays stay cheap."""

    def with_blocks(steps: Column) -> Column:
        n = F.size(steps)
        sums = F.transform(
            F.sequence(F.lit(0), F.ceil(n / 256).cast("int")),
            lambda b: _sum(F.slice(steps, b * 256 + 1, F.lit(256))),
        )
        return _let(sums, lambda s: with_offsets(steps, s))

    def with_offsets(steps: Column, sums: Column) -> Column:
        offsets = F.transform(sums, lambda _, b: _sum(F.slice(sums, F.lit(1), b)))

        def total(_: Column, i: Column, offsets: Column) -> Column:
            block = F.floor(i / 256).cast("int")
            return F.get(offsets, block) + _sum(F.slice(steps, block * 256 + 1, i % 256 + 1))

        return _let(offsets, lambda o: F.transform(steps, lambda x, i: total(x, i, o)))

    return _let(steps, with_blocks)


def _sum(values: Column) -> Column:
    return F.aggregate(values, F.lit(0).cast("long"), lambda a, x: a + x)


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    """Structs (start, end, value) of all matches, leftmost and not overlapping.

    The pieces between the matches give their places. Offsets count code points.
    """

    def places(found: Column) -> Column:
        lengths = F.transform(found["whole"], lambda m: F.length(m).cast("long"))

        def with_lengths(lengths: Column) -> Column:
            steps = F.transform(
                lengths,
                lambda _, i: F.length(F.get(found["between"], i))
                + F.when(i > 0, F.get(lengths, i - 1)).otherwise(F.lit(0)),
            )
            return F.zip_with(
                F.zip_with(_running_totals(steps), lengths, lambda s, n: F.struct(s.alias("s"), n.alias("n"))),
                found["value"],
                lambda p, v: F.struct(
                    p["s"].alias("start"), (p["s"] + p["n"]).alias("end"), v.alias("value")
                ),
            )

        return _let(lengths, with_lengths)

    found = F.struct(
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("whole"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
        F.split(text, pattern, -1).alias("between"),
    )
    nothing = F.array().cast("array<struct<start:bigint,end:bigint,value:string>>")
    return F.when(text.rlike(pattern), _let(found, places)).otherwise(nothing)


def _spans(matches: Column, kind: str) -> Column:
    return F.transform(
        matches,
        lambda m: F.struct(
            m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")
        ),
    )


def _two_sided(z: Column) -> Column:
    """An upper bound of the normal probability beyond ``z`` on both sides, at most 1."""
    z = F.abs(z)
    density = F.exp(-z * z / 2) / math.sqrt(2 * math.pi)
    return F.least(F.lit(1.0), 8 * density / (3 * z + F.sqrt(z * z + 8)))


def _battery(token: Column, size: Column, alphabet: Column) -> Column:
    """The least p-value of the three tests that a token is random, times three.

    - chi-squared of its characters against equal shares, by Wilson and Hilferty,
    - runs of characters in the lower and upper half of the alphabet,
    - correlation of each character's place in the alphabet with the next one's.
    """
    chars = F.split(token, "")
    places = F.transform(
        F.filter(chars, lambda c: c != ""), lambda c: F.instr(alphabet, c).cast("double")
    )

    def tests(p: Column) -> Column:
        n = F.size(p).cast("double")
        squares = F.aggregate(
            F.array_distinct(p),
            F.lit(0.0),
            lambda a, c: a + F.pow(F.size(F.filter(p, lambda x: x == c)).cast("double"), 2),
        )
        free = size - 1
        chi = F.greatest(squares * size / n - n, F.lit(0.0))
        z_chi = (F.pow(chi / free, 1 / 3) - (1 - 2 / (9 * free))) / F.sqrt(2 / (9 * free))

        high = F.aggregate(p, F.lit(0.0), lambda a, x: a + F.when(x > size / 2, 1.0).otherwise(0.0))
        expected = 2 * high * (n - high) / n
        runs = F.aggregate(
            p,
            F.struct(F.lit(0.0).alias("runs"), F.lit(-1.0).alias("last")),
            lambda a, x: F.struct(
                (
                    a["runs"]
                    + F.when((a["last"] > size / 2) == (x > size / 2), 0.0).otherwise(1.0)
                    + F.when((a["last"] < 0) & (x <= size / 2), 1.0).otherwise(0.0)
                ).alias("runs"),
                x.alias("last"),
            ),
            lambda a: a["runs"],
        )
        variance = expected * (expected - 1) / (n - 1)
        # All in one half: as unlikely as a coin that falls alike each time.
        p_runs = F.when(variance > 0, _two_sided((runs - 1 - expected) / F.sqrt(variance))).otherwise(
            F.pow(F.lit(0.5), n - 1)
        )

        sums = F.aggregate(
            p,
            F.struct(*[F.lit(0.0).alias(k) for k in ("x", "xx", "xy", "last")]),
            lambda a, x: F.struct(
                (a["x"] + x).alias("x"),
                (a["xx"] + x * x).alias("xx"),
                (a["xy"] + x * a["last"]).alias("xy"),
                x.alias("last"),
            ),
        )

        def serial(s: Column) -> Column:
            # The last character is followed by the first.
            around = s["xy"] + s["last"] * F.get(p, 0)
            spread = n * s["xx"] - s["x"] * s["x"]
            r = (n * around - s["x"] * s["x"]) / spread
            z = (r + 1 / (n - 1)) * F.sqrt(n)
            return F.when(spread > 0, _two_sided(z)).otherwise(F.lit(0.0))

        p_chi = F.when(z_chi > 0, _two_sided(z_chi) / 2).otherwise(F.lit(1.0))
        return F.least(F.lit(1.0), 3 * F.least(p_chi, p_runs, _let(sums, serial)))

    return _let(places, tests)


def _candidates(matches: Column) -> Column:
    """Structs (start, end, stratum, bin, battery) of the tokens.

    ``bin`` is that of the token's p-value as an ordinary word or number: by Markov's
    inequality, one over the ratio of its likelihood as random characters of its
    encoding to its likelihood as ordinary ones bounds it. Of the ordinary kinds (words,
    words in capitals, numbers) the likeliest counts, so the bound holds for each.
    ``battery`` is the bin of its p-value as random characters.
    """
    kinds = [
        F.create_map(*[F.lit(x) for pair in weights.items() for x in pair])
        for weights in _ordinary_weights()
    ]
    encoding = lambda t: F.coalesce(
        *[F.when(t.rlike(pattern), F.lit(i)) for i, (_, pattern, _) in enumerate(ENCODINGS)]
    )
    alphabets = F.array(*[F.lit(a) for _, _, a in ENCODINGS])

    def likelihood(token: Column, weights: Column) -> Column:
        chars = F.filter(F.split(token, ""), lambda c: c != "")
        return F.aggregate(chars, F.lit(0.0), lambda a, c: a + F.element_at(weights, c))

    def bin_of(evidence: Column) -> Column:
        evidence = F.greatest(evidence, F.lit(0.0)) * BINS_PER_DECADE
        return F.floor(F.least(evidence, F.lit(float(MAX_BIN)))).cast("int")

    def judged(m: Column) -> Column:
        token, n = m["value"], F.length(m["value"])
        ordinary = F.greatest(*[likelihood(token, weights) for weights in kinds])

        def of(e: Column) -> Column:
            alphabet = F.get(alphabets, e)
            size = F.length(alphabet).cast("double")
            evidence = (-n * F.log(size) - ordinary) / math.log(10)
            tests = F.greatest(_battery(token, size, alphabet), F.lit(1e-300))
            band = sum((F.when(n >= b, 1).otherwise(0) for b in BANDS), F.lit(0)) - 1
            return F.struct(
                m["start"].alias("start"),
                m["end"].alias("end"),
                (e * len(BANDS) + band).cast("int").alias("stratum"),
                bin_of(evidence).alias("bin"),
                bin_of(-F.log10(tests)).alias("battery"),
            )

        return _let(encoding(token), of)

    return F.transform(matches, judged)


def _thresholds(tokens: DataFrame, share: float) -> dict[int, int]:
    """For each stratum the least bin that Benjamini and Hochberg's procedure rejects.

    Strata are encodings by lengths, so short tokens, whose p-values cannot be small,
    are weighed against short ones only. The counts are of all tokens of the corpus;
    at most strata x bins rows are compared and one row a stratum reaches the driver.
    """
    counted = tokens.groupBy("stratum", "bin").count()
    totals = counted.groupBy("stratum").agg(F.sum("count").alias("m"))
    up = counted.alias("a").join(counted.alias("b"), (F.col("a.stratum") == F.col("b.stratum")) & (F.col("b.bin") >= F.col("a.bin")))
    above = up.groupBy(F.col("a.stratum").alias("stratum"), F.col("a.bin").alias("bin")).agg(F.sum("b.count").alias("k"))
    passing = above.join(totals, "stratum").where(
        F.pow(F.lit(10.0), -F.col("bin") / BINS_PER_DECADE) <= share * F.col("k") / F.col("m")
    )
    return {r["stratum"]: r["bin"] for r in passing.groupBy("stratum").agg(F.min("bin").alias("bin")).collect()}


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document with the spans of its secrets.

    Base kinds are patterns: assignments to a telling name, access keys, and long
    hexadecimal numbers. Kind ``random`` is any token of 20 or more characters that
    looks random, by two procedures of Benjamini and Hochberg in each stratum of encoding
    and length: it is among those that are no ordinary word or number
    (:data:`FALSE_DISCOVERY`), and not among those that the battery says are not random
    (:data:`FALSE_REJECTION`): chi-squared, runs and serial correlation, each over the
    alphabet of the token's encoding.

    The scan reads the texts once, without a shuffle, and writes only spans; counts of
    p-values give the limits; a second pass over the spans applies them. Work is
    linear in the text.

    A NULL or empty text has no spans and the hash of the empty string. Repeated rows
    give repeated results and count as repeated tokens, an empty table gives none,
    other columns are not read.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    assigned = F.filter(_matches(text, ASSIGN, 2), lambda m: F.length(m["value"]) >= MIN_ASSIGN)
    base = F.concat(
        _spans(assigned, "assign"),
        _spans(_matches(text, ACCESS), "access"),
        _spans(_matches(text, HEX), "hex"),
    )
    scanned = materialize(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            F.array_sort(base).alias("base"),
            _candidates(_matches(text, _TOKEN)).alias("tokens"),
        ),
        "secrets",
    )
    tokens = scanned.select(F.explode("tokens").alias("t"))

    def limit(name: str, share: float) -> Column:
        limits = _thresholds(tokens.select("t.stratum", F.col(f"t.{name}").alias("bin")), share)
        strata = range(len(ENCODINGS) * len(BANDS))
        return F.array(*[F.lit(limits.get(s, MAX_BIN + 1)) for s in strata])

    ordinary, not_random = limit("bin", FALSE_DISCOVERY), limit("battery", FALSE_REJECTION)
    chosen = F.filter(
        "tokens",
        lambda t: (t["bin"] >= F.get(ordinary, t["stratum"]))
        & (t["battery"] < F.get(not_random, t["stratum"])),
    )
    names = F.array(*[F.lit(k) for k in KINDS])
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"], s["end"])), ","
    )
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("long")
    both = F.array_sort(F.concat(F.col("base"), _spans(chosen, "random")))
    return scanned.select(
        "doc_id",
        *[count(k).alias(f"n_{KINDS[k]}") for k in range(3)],
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(both).alias("spans"),
        F.size(chosen).cast("long").alias("n_random"),
    )
