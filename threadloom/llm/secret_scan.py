r"""Secrets in texts: known patterns, and strings too random to be words.

The known patterns are assignments to a telling name, access keys and hexadecimal
digits.  Beyond them, every run of twenty or more characters of the usual
encodings is a candidate if it has letters and digits, or letters alone.  Its encoding is inferred
from its characters, and three tests ask whether it is a random string of that
alphabet: chi-squared for even use of the alphabet, the number of runs above and
below its middle, and the correlation of successive characters.  The smallest of
the three p-values, times three, is its randomness.

Most runs of letters alone are words, and show how random words of some length
look.  A candidate's p-value is the share of words, not longer than it, that look at
least as random; short candidates are held against short words, which the tests tell
apart less well.  As a corpus may have few long words, or none, ``PRIOR_WORDS`` words
are added that follow a calculation: the number of pairs of equal characters in a run
of that length and alphabet, if its characters are drawn as letters are in a text, has
a known mean and variance, and a random string has fewer pairs.  Candidates of letters
alone are not held against each other, but against that calculation only.  What the
three tests find too regular for a random string is not reported.  The
Benjamini-Hochberg rule over the candidates of the corpus, those of letters alone for
themselves, bounds the share of false ones among those reported, as far as the
calculation holds.  Each distinct run counts once.  Lengths, randomness and the
calculated share are counted in a fixed grid, so no task sees all candidates.

Everything is a built-in expression; a text is searched once.  Places are code
points, ends exclusive.

Defined results: a null or empty text has no spans; equal texts have equal spans;
rows with equal ids are looked at one by one; a candidate that overlaps a known
pattern adds nothing; an empty table gives no rows; other columns are passed through if asked for.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.functions.once import computed_once
from threadloom.llm.common import whole_text
from threadloom.session import materialize

ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"  # 20 characters or more
HEX = r"[0-9a-f]{24,}"
CANDIDATE = r"[A-Za-z0-9+/_=-]{20,}"
KINDS = ("assign", "access", "hex", "random")
LEAST_ASSIGNED = 6
FALSE_SHARE = 0.05
CHUNK = 128
LENGTHS = 32  # lengths in the grid, by four characters, the last open
LEVELS = 48  # halvings of the randomness in the grid, the last open
REGULAR = 10  # halvings from which on a run is no random string
PAIR_LEVELS = 128  # halvings of the calculated share in the grid, by half, the last open
PRIOR_WORDS = 400
DIGITS, LOWER, UPPER = "0123456789", "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
# The alphabets of the usual encodings, in the order they are tried.
ALPHABETS = (
    (r"^[0-9a-f]+$", DIGITS + "abcdef"),
    (r"^[0-9A-F]+$", DIGITS + "ABCDEF"),
    (r"^[A-Z2-7]+$", UPPER + "234567"),
    (r"^[A-Za-z0-9]+$", UPPER + LOWER + DIGITS),
    (r"^[A-Za-z0-9+/]+$", UPPER + LOWER + DIGITS + "+/"),
    (r"^[A-Za-z0-9_-]+$", UPPER + LOWER + DIGITS + "-_"),
)
# Sums of the squares and cubes of the characters' shares: letters in English, which
# are more even than in other languages; in hexadecimal, such letters and digits in equal parts.
# Names of letters alone may have capitals inside, every seventh letter here.
TEXT_SHARES, HEX_SHARES, NAME_SHARES = (0.0655, 0.0053), (0.09, 0.0119), (0.0488, 0.0033)
OTHER_ALPHABET = UPPER + LOWER + DIGITS + "+/-_="


def located(df: DataFrame, text: str, pattern: str, name: str) -> DataFrame:
    """Adds the leftmost matches that do not overlap: array of (start, end, match).

    The text between the matches gives their places.  Lengths are summed up chunk
    by chunk, so many matches in a text do not cost their square."""
    found, gaps, sizes, sums, placed = (f"_{name}_{x}" for x in ("found", "gaps", "sizes", "sums", "ends"))
    some = F.size(found) > 0
    plus = lambda a, b: a + b
    # Each step is computed once: written into the next one's lambda, it would be
    # computed for every match.
    df = computed_once(df, **{found: F.regexp_extract_all(F.col(text), F.lit(pattern), F.lit(0))})
    df = computed_once(df, **{gaps: F.when(some, F.split(F.col(text), pattern, -1))})
    df = computed_once(df, **{sizes: F.when(some, F.zip_with(found, gaps, lambda m, g: F.char_length(g) + F.coalesce(F.char_length(m), F.lit(0))))})
    n_chunks = F.expr(f"(size({found}) - 1) div {CHUNK}")
    chunk = lambda c: F.slice(sizes, (c * CHUNK + 1).cast("int"), F.lit(CHUNK))
    total = lambda c: F.aggregate(chunk(c), F.lit(0), plus)
    # Ends of the chunks before each chunk, then of the matches inside it.
    df = computed_once(df, **{sums: F.when(some, F.transform(F.sequence(F.lit(0), n_chunks), total))})
    before = F.aggregate(
        sums,
        F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda acc, s: F.struct((acc["at"] + s).alias("at"), F.concat(acc["all"], F.array(acc["at"])).alias("all")),
        lambda acc: acc["all"],
    )
    df = computed_once(df, **{f"{placed}0": F.when(some, before)})
    inside = F.transform(
        f"{placed}0", lambda at, k: F.transform(chunk(k), lambda _, i: at + F.aggregate(F.slice(chunk(k), 1, i + 1), F.lit(0), plus))
    )
    df = computed_once(df, **{placed: F.when(some, F.slice(F.flatten(inside), F.lit(1), F.size(found)))})
    spans = F.zip_with(
        found, placed, lambda m, e: F.struct((e - F.char_length(m)).alias("start"), e.alias("end"), m.alias("match"))
    )
    empty = F.array().cast("array<struct<start:int,end:int,match:string>>")
    df = computed_once(df, **{name: F.when(some, spans).otherwise(empty)})
    return df.drop(found, gaps, sizes, sums, placed, f"{placed}0")


def normal_tail(z: Column) -> Column:
    """The normal distribution's mass above z, by a logistic approximation."""
    return 1 / (1 + F.exp(F.least(F.lit(700.0), 1.5976 * z + 0.07056 * z * z * z)))


def randomness(match: Column) -> Column:
    """Three times the least of the three p-values, 1 at most.

    Built of nested one-element transforms, which name an intermediate value."""

    def let(value: Column, body) -> Column:
        return F.get(F.transform(F.array(value), body), F.lit(0))

    alphabet = reduce(lambda rest, a: F.when(_body(match).rlike(a[0]), F.lit(a[1])).otherwise(rest), reversed(ALPHABETS), F.lit(OTHER_ALPHABET))

    def tests(x: Column) -> Column:
        n, a = x["n"].cast("double"), x["a"].cast("double")
        # Wilson and Hilferty: the cube root of chi-squared over its freedom is near normal.
        freedom = a - 1
        chi = a / n * x["squares"] - n
        spread = 2 / (9 * freedom)
        uneven = (F.pow(F.greatest(chi, F.lit(0.0)) / freedom, F.lit(1 / 3)) - (1 - spread)) / F.sqrt(spread)
        low = n - x["high"]
        mean = 2 * x["high"] * low / n + 1
        variance = (mean - 1) * (mean - 2) / (n - 1)
        runs = F.when(variance > 0, F.abs(x["runs"] - mean) / F.sqrt(variance)).otherwise(F.lit(8.0))
        around = x["sum2"] - x["sum"] * x["sum"] / n
        m = x["sum"] / n
        ahead = x["lagged"] - m * (2 * x["sum"] - x["first"] - x["last"]) + (n - 1) * m * m
        serial = F.when(around > 0, F.abs(ahead / around) * F.sqrt(n)).otherwise(F.lit(8.0))
        least = F.least(normal_tail(uneven), 2 * normal_tail(runs), 2 * normal_tail(serial))
        return F.least(F.lit(1.0), 3 * least)

    def measured(v: Column) -> Column:
        half, values = F.size(v["letters"]) / 2, v["values"]
        add = lambda s, y: s + y
        pairs = lambda f: F.aggregate(F.sequence(F.lit(0), F.size(values) - 2), F.lit(0.0), lambda s, i: s + f(F.get(values, i), F.get(values, i + 1)))
        return F.struct(
            F.size(values).alias("n"),
            F.size(v["letters"]).alias("a"),
            F.aggregate(
                F.transform(F.array_distinct(values), lambda c: F.size(F.filter(values, lambda y: y == c))), F.lit(0.0), lambda s, k: s + k * k
            ).alias("squares"),
            F.aggregate(values, F.lit(0.0), lambda s, y: s + F.when(y >= half, 1.0).otherwise(0.0)).alias("high"),
            (1 + pairs(lambda y, z: F.when((y >= half) != (z >= half), 1.0).otherwise(0.0))).alias("runs"),
            F.aggregate(values, F.lit(0.0), add).alias("sum"),
            F.aggregate(values, F.lit(0.0), lambda s, y: s + y * y).alias("sum2"),
            pairs(lambda y, z: (y * z).cast("double")).alias("lagged"),
            F.get(values, F.lit(0)).alias("first"),
            F.get(values, F.size(values) - 1).alias("last"),
        )

    def spelled(letters: Column) -> Column:
        places = F.transform(F.split(_body(match), ""), lambda c: (F.instr(letters, c) - 1).cast("double"))
        return F.struct(F.split(letters, "").alias("letters"), places.alias("values"))

    return let(alphabet, lambda letters: let(spelled(letters), lambda v: let(measured(v), tests)))


def text_share(match: Column) -> Column:
    """The share of texts of the run's length that have as few pairs of equal characters."""
    hexadecimal = _body(match).rlike(ALPHABETS[0][0]) | _body(match).rlike(ALPHABETS[1][0])
    characters = F.split(_body(match), "")
    times = F.transform(F.array_distinct(characters), lambda c: F.size(F.filter(characters, lambda y: y == c)).cast("double"))
    n = F.char_length(_body(match)).cast("double")
    found = F.aggregate(times, F.lit(0.0), lambda s, k: s + k * (k - 1) / 2)

    def below(shares: tuple[float, float]) -> Column:
        two, three = shares
        variance = n * (n - 1) / 2 * (two - two * two) + n * (n - 1) * (n - 2) * (three - two * two)
        return normal_tail((n * (n - 1) / 2 * two - found) / F.sqrt(variance))

    name = match.rlike("^[A-Za-z]+$") & match.rlike("[a-z]") & match.rlike("^.+[A-Z]")
    return F.when(hexadecimal, below(HEX_SHARES)).when(name, below(NAME_SHARES)).otherwise(below(TEXT_SHARES))


def _body(match: Column) -> Column:
    return F.when(F.rtrim(match, F.lit("=")) == "", match).otherwise(F.rtrim(match, F.lit("=")))


def _meets(spans: Column, s: Column) -> Column:
    """Whether s overlaps one of ``spans``, which are in order and do not overlap:
    the last one that begins before the end of s, found by bisection."""
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(25))])
    number = F.aggregate(
        steps, F.lit(0), lambda low, step: low + F.when(F.get(spans, low + step - 1)["start"] < s["end"], step).otherwise(0)
    )
    return F.coalesce(F.get(spans, number - 1)["end"] > s["start"], F.lit(False))


def searched(docs: DataFrame, text_col: str, *columns: Column | str) -> DataFrame:
    """``columns`` with _base and _runs: the known patterns, and the long runs with
    their place in the grid; ``word`` tells those of letters alone."""
    df = docs.select(*columns, whole_text(text_col).alias("_text"))
    for pattern, name in ((ASSIGN, "_assign"), (ACCESS, "_access"), (HEX, "_hex"), (CANDIDATE, "_long")):
        df = located(df, "_text", pattern, name)
    named = lambda spans, k: F.transform(spans, lambda s: F.struct(s["start"].alias("start"), F.lit(k).alias("kind"), s["end"].alias("end")))
    assigned = F.filter("_assign", lambda s: F.char_length(F.regexp_extract(s["match"], ASSIGN, 2)) >= LEAST_ASSIGNED)
    df = computed_once(df, _assigned=assigned)
    base = F.sort_array(F.concat(named("_assigned", 0), named("_access", 1), named("_hex", 2)))
    df = computed_once(df, _base=base)
    telling = F.filter(
        "_long",
        lambda s: s["match"].rlike("[A-Za-z]")
        & (s["match"].rlike("[0-9]") | s["match"].rlike("^[A-Za-z]+$"))
        & ~reduce(lambda x, y: x | y, [_meets(F.col(k), s) for k in ("_assigned", "_access", "_hex")]),
    )
    df = computed_once(df, _telling=telling)

    def gridded(s: Column) -> Column:
        level = F.least(F.floor(-F.log2(F.greatest(randomness(s["match"]), F.lit(1e-300)))), F.lit(LEVELS - 1))
        length = F.least(F.expr("0") + F.floor((F.char_length(s["match"]) - 20) / 4), F.lit(LENGTHS - 1))
        pairs = F.least(F.floor(-2 * F.log2(F.greatest(text_share(s["match"]), F.lit(1e-300)))), F.lit(PAIR_LEVELS - 1))
        return F.struct(
            s["start"].alias("start"),
            s["end"].alias("end"),
            F.xxhash64(s["match"]).alias("run"),
            pairs.cast("int").alias("pairs"),
            (~s["match"].rlike("[0-9]")).alias("word"),
            (length * LEVELS + level).cast("int").alias("cell"),
        )

    return df.withColumn("_runs", F.transform("_telling", gridded)).drop("_assign", "_assigned", "_access", "_hex", "_long", "_telling")


def accepted_cells(found: DataFrame, share: float = FALSE_SHARE) -> list[tuple[bool, int, int]]:
    """(word, cell, pairs): the cells of the grid whose candidates are reported, from
    that level of pairs on.

    A cell's p-value comes from the words that are not longer and at least as random
    and from the calculated share, for letters alone from this only; over the cells in order of p-value runs the
    Benjamini-Hochberg rule."""
    runs = found.select(F.explode("_runs").alias("r")).select("r.run", "r.cell", "r.word", "r.pairs").distinct()
    counted = runs.groupBy("cell", "word", "pairs").agg(F.count(F.lit(1)).alias("n"))
    counted = materialize(counted, "secret-cells")
    grid = found.sparkSession.range(0, LENGTHS * LEVELS, 1, 1).select(F.col("id").cast("int").alias("cell"))
    filled = grid.join(counted.where("word").groupBy("cell").agg(F.sum("n").alias("words")), "cell", "left").select(
        "cell",
        F.expr(f"cell div {LEVELS}").alias("length"),
        (F.col("cell") % LEVELS).alias("level"),
        F.coalesce("words", F.lit(0)).alias("words"),
    )
    # From here on there are LENGTHS x LEVELS rows, whatever the corpus.
    up = Window.unboundedPreceding
    as_random = filled.withColumn("below", F.sum("words").over(Window.partitionBy("length").orderBy("level").rowsBetween(up, 0)))
    shorter = Window.partitionBy("level").orderBy("length").rowsBetween(up, 0)
    last = Window.partitionBy("length")
    totals = as_random.withColumn("own", F.sum("words").over(last)).withColumn("all", F.sum("own").over(shorter))
    totals = totals.select("cell", "level", F.sum("below").over(shorter).alias("below"), "all")
    calculated = F.pow(F.lit(2.0), -F.col("pairs") / 2)
    held = F.when(F.col("word"), calculated).otherwise((PRIOR_WORDS * calculated + F.col("below")) / (PRIOR_WORDS + F.col("all")))
    p = F.when(F.col("level") >= REGULAR, F.lit(1.0)).otherwise(held)
    valued = counted.join(totals, "cell").select("word", "cell", "pairs", "n", p.alias("p"))
    family = Window.partitionBy("word")
    ranked = valued.withColumn("upto", F.sum("n").over(family.orderBy("p").rangeBetween(up, 0))).withColumn("total", F.sum("n").over(family))
    passed = F.max(F.when(F.col("p") <= share * F.col("upto") / F.col("total"), F.col("p"))).over(family)
    accepted = ranked.withColumn("most", passed).where("p <= most").groupBy("word", "cell").agg(F.min("pairs").alias("pairs"))
    return [(r["word"], r["cell"], r["pairs"]) for r in accepted.collect()]


def scan(docs: DataFrame, text_col: str, *columns: Column | str) -> DataFrame:
    """``columns`` with base and spans: arrays of (start, kind, end) in order, where
    kind counts in ``KINDS``.  What the search found is written once, without texts
    unless the columns have them."""
    found = materialize(searched(docs, text_col, *columns).drop("_text"), "secret-spans")
    # A number for each cell, so the list has a fixed size.
    least = [PAIR_LEVELS] * (2 * LENGTHS * LEVELS)
    for word, cell, pairs in accepted_cells(found):
        least[2 * cell + word] = pairs
    some = min(least) < PAIR_LEVELS
    reported = F.filter("_runs", lambda r: r["pairs"] >= F.get(F.lit(least), 2 * r["cell"] + r["word"].cast("int")) if some else F.lit(False))
    added = F.transform(reported, lambda r: F.struct(r["start"].alias("start"), F.lit(3).alias("kind"), r["end"].alias("end")))
    return found.withColumn("spans", F.sort_array(F.concat("_base", added))).withColumnRenamed("_base", "base").drop("_runs")


def listed(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    name = lambda k: reduce(lambda rest, i: F.when(k == i, KINDS[i]).otherwise(rest), range(len(KINDS)), F.lit(""))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", name(s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def number_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: str, mask: str = "[secret]") -> Column:
    """The text with its spans, overlapping ones together, replaced by a mask."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    written = F.aggregate(
        F.col(spans),
        start,
        lambda acc, s: F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            F.when(s["start"] < acc["at"], acc["out"])
            .otherwise(F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(mask)))
            .alias("out"),
        ),
        lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.char_length(text))),
    )
    return F.when(F.size(spans) > 0, written).otherwise(text)
