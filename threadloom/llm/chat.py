"""Conversations as windows of a token budget, with a loss mask.

A window holds whole turns: the conversation's system turn, a limited history of
turns that an earlier window already held, and fresh turns up to the budget.  The
loss covers the text of fresh assistant turns only, so every target counts once.

Prefix sums of the turns' tokens, made block by block, cut a conversation into
segments of equal targets; inside a segment, which is bounded, fresh turns are
packed one after the other.  So a conversation of any length is spread over many
tasks.  A segment also gets the turns before it that its history may need.

The system turn has a share of the budget, what history and a quarter for fresh
turns leave.  One that is longer is whole in the first window, as a turn like
others, and later windows repeat as many of its first code points as surely fit.
Fresh turns get what system turn and history leave; a turn for which that is too
little stands alone, with as much of the history as there is room for.  So a window
is over the budget only where its system turn and a single fresh turn are.

A turn is written ``<turn LENGTH>role`` + newline + text + ``</turn>`` + newline,
LENGTH being the code points of the role as written.  In roles and texts a
backslash is doubled and the control strings get a backslash after ``<``.

Defined results: null roles and texts count as empty; turns are ordered by turn
(nulls first), then role, then text, so repeated rows stay; the first turn is the
system turn if its role is ``system`` and others follow; null conversation ids are
one conversation;
an empty table gives no windows; other columns are not looked at.  Everything is
a built-in expression.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import whole_text

BUDGET = 1024
HISTORY = 256
SEGMENT = 8192
TURNS_PER_BLOCK = 256
TARGET_ROLE = "assistant"
BYTES_PER_TOKEN = 4
TURN_TOKENS = 4  # for a turn's markers
TURN_END = "</turn>\n"


def escaped(c: Column) -> Column:
    doubled = F.replace(c, F.lit("\\"), F.lit("\\\\"))
    opened = F.replace(doubled, F.lit("<turn"), F.lit("<\\turn"))
    return F.replace(opened, F.lit("</turn"), F.lit("<\\/turn"))


def unescaped(c: Column) -> Column:
    return F.regexp_replace(c, r"(?s)\\(.)", "$1")


def turn_tokens(text: Column) -> Column:
    """An upper estimate of a turn's tokens: four bytes each, and its markers."""
    return (F.ceil(F.octet_length(text) / BYTES_PER_TOKEN) + TURN_TOKENS).cast("long")


def system_share(budget: int, history: int) -> int:
    """The most tokens that a repeated system turn has."""
    return max(budget - history - budget // 4, TURN_TOKENS)


def with_positions(turns: DataFrame) -> DataFrame:
    """Adds rank, tokens before a turn, and the number of turns per conversation.

    Blocks of turns are summed first; a conversation's own window runs over its
    blocks, and the turns' windows over one block each."""
    blocks = turns.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n"), F.sum("tokens").alias("t"))
    along = Window.partitionBy("conv_id").orderBy("block")
    above = along.rowsBetween(Window.unboundedPreceding, -1)
    starts = blocks.select(
        F.col("conv_id").alias("c"),
        F.col("block").alias("b"),
        F.coalesce(F.sum("n").over(above), F.lit(0)).alias("n0"),
        F.coalesce(F.sum("t").over(above), F.lit(0)).alias("t0"),
        F.sum("n").over(Window.partitionBy("conv_id")).alias("n_turns"),
    )
    joined = turns.join(starts, F.col("conv_id").eqNullSafe(F.col("c")) & F.col("block").eqNullSafe(F.col("b")))
    inside = Window.partitionBy("conv_id", "block").orderBy("turn", "role", "text")
    before = F.coalesce(F.sum("tokens").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return joined.select(
        "conv_id",
        "role",
        "text",
        "tokens",
        "n_turns",
        (F.col("n0") + F.row_number().over(inside) - 1).alias("rank"),
        (F.col("t0") + before).alias("before"),
    )


def format_windows(conversations: DataFrame, budget: int = BUDGET, history: int = HISTORY, segment: int = SEGMENT) -> DataFrame:
    """(conv_id, first_rank, repeated, tokens, formatted, loss) per window.

    ``first_rank`` orders a conversation's windows, ``repeated`` is the number of
    leading turns that an earlier window had as well, ``loss`` lists the masked
    in spans of ``formatted`` in code points, ends exclusive."""
    if not 0 <= history < segment or history >= budget:
        raise ValueError("history must be below the budget and the segment")
    turns = conversations.select(
        "conv_id",
        "turn",
        whole_text("role").alias("role"),
        whole_text("text").alias("text"),
        turn_tokens(whole_text("text")).alias("tokens"),
        F.floor(F.col("turn") / TURNS_PER_BLOCK).alias("block"),
    )
    placed = with_positions(turns)
    leads = (F.col("rank") == 0) & (F.col("role") == "system") & (F.col("n_turns") > 1)
    share = system_share(budget, history)
    long = F.col("tokens") > share
    # A code point has four bytes at most, so it costs a token at most.
    head = F.when(long, F.left("text", F.lit(share - TURN_TOKENS))).otherwise(F.col("text"))
    system = placed.where(leads).select(
        F.col("conv_id").alias("c"),
        long.alias("cut"),
        F.struct("rank", "before", F.lit(True).alias("own"), turn_tokens(head).alias("tokens"), "role", head.alias("text")).alias("system"),
    )
    own_segment = F.expr(f"before div {segment}")
    lent = F.col("before") >= (own_segment + 1) * segment - history
    body = (
        placed.where(~leads | long)
        .select("*", own_segment.alias("own_segment"), F.explode(F.when(lent, F.array(own_segment, own_segment + 1)).otherwise(F.array(own_segment))).alias("segment"))
        .groupBy("conv_id", "segment")
        .agg(
            F.sort_array(
                F.collect_list(
                    F.struct("rank", "before", (F.col("own_segment") == F.col("segment")).alias("own"), "tokens", "role", "text")
                )
            ).alias("near")
        )
        .withColumn("own", F.filter("near", lambda x: x["own"]))
        .where(F.size("own") > 0)
        .join(system, F.col("conv_id").eqNullSafe(F.col("c")), "left")
    )
    room = F.lit(budget - history) - F.coalesce(F.col("system.tokens"), F.lit(0))
    packed = F.aggregate(
        "own",
        F.struct(F.array().cast("array<int>").alias("starts"), F.lit(0).cast("long").alias("used"), F.lit(0).alias("i")),
        lambda acc, x: F.when(
            (acc["i"] == 0) | (acc["used"] + x["tokens"] > F.col("room")),
            F.struct(F.concat(acc["starts"], F.array(acc["i"])).alias("starts"), x["tokens"].alias("used"), (acc["i"] + 1).alias("i")),
        ).otherwise(F.struct(acc["starts"].alias("starts"), (acc["used"] + x["tokens"]).alias("used"), (acc["i"] + 1).alias("i"))),
        lambda acc: acc["starts"],
    )
    cut = body.withColumn("room", room).withColumn("starts", packed)
    fresh = F.transform(
        "starts",
        lambda lo, k: F.struct(
            F.get("own", lo)["rank"].alias("rank"),
            F.get("own", lo)["before"].alias("before"),
            F.slice("own", lo + 1, F.coalesce(F.get("starts", k + 1), F.size("own")) - lo).alias("fresh"),
        ),
    )
    opened = cut.select("conv_id", "system", "cut", "near", F.explode(fresh).alias("w")).select("*", "w.*")
    led = F.col("system").isNotNull() & (F.col("rank") > 0)
    fresh_tokens = F.aggregate("fresh", F.lit(0).cast("long"), lambda n, t: n + t["tokens"])
    left = F.lit(budget) - fresh_tokens - F.when(led, F.col("system.tokens")).otherwise(0)
    # Before a turn lie the system turn and the history; the former is not repeated as history.
    again = F.filter(
        "near",
        lambda x: (x["rank"] < F.col("rank"))
        & (F.col("before") - x["before"] <= F.least(F.lit(history), F.col("left")))
        & ~(F.coalesce("cut", F.lit(False)) & (x["rank"] == 0)),
    )
    opened = opened.withColumn("left", left).select(
        "conv_id", F.col("rank").alias("first_rank"), "cut", again.alias("again"), "fresh", F.when(led, F.array("system")).otherwise(F.array()).alias("lead")
    )
    # An uncut system turn is new in the window of the turn behind it.
    known = (F.size("lead") > 0) & (F.col("cut") | (F.col("first_rank") > 1))
    skipped = known.cast("int") + F.size("again")
    counted = opened.withColumn("turns", F.concat("lead", "again", "fresh")).withColumn("n_old", F.size("lead") + F.size("again"))
    head = lambda t: F.concat(F.lit("<turn "), F.char_length(escaped(t["role"])).cast("string"), F.lit(">"), escaped(t["role"]), F.lit("\n"))
    pieces = F.transform(
        "turns",
        lambda t, i: F.struct(
            head(t).alias("head"),
            escaped(t["text"]).alias("body"),
            ((i >= F.col("n_old")) & (t["role"] == TARGET_ROLE)).alias("target"),
        ),
    )
    no_spans = F.array().cast("array<struct<start:int,end:int>>")
    masked = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), no_spans.alias("spans")),
        lambda acc, p: F.struct(
            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"]) + len(TURN_END)).alias("at"),
            F.when(
                p["target"],
                F.concat(
                    acc["spans"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.char_length(p["head"])).alias("start"),
                            (acc["at"] + F.char_length(p["head"]) + F.char_length(p["body"])).alias("end"),
                        )
                    ),
                ),
            ).otherwise(acc["spans"]).alias("spans"),
        ),
        lambda acc: acc["spans"],
    )
    written = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit(TURN_END))), "")
    return counted.withColumn("pieces", pieces).select(
        "conv_id",
        "first_rank",
        skipped.alias("repeated"),
        F.aggregate("turns", F.lit(0).cast("long"), lambda n, t: n + t["tokens"]).alias("tokens"),
        written.alias("formatted"),
        masked.alias("loss"),
    )


def read_windows(windows: DataFrame) -> DataFrame:
    """(conv_id, first_rank, turns, loss_text, formatted_chars): the fresh turns and
    the text under the mask, read back from what was written."""
    written = F.split("formatted", TURN_END)
    fresh = F.slice(written, F.col("repeated") + 1, F.size(written) - 1 - F.col("repeated"))

    def turn(entry: Column) -> Column:
        size = F.regexp_extract(entry, r"^<turn (\d+)>", 1)
        at = F.char_length(size) + len("<turn >") + 1
        after = at + size.cast("int")
        return F.struct(
            unescaped(F.substring(entry, at, size.cast("int"))).alias("role"),
            unescaped(F.substring(entry, after + 1, F.char_length(entry))).alias("text"),
        )

    under = F.transform("loss", lambda s: unescaped(F.substring("formatted", s["start"] + 1, s["end"] - s["start"])))
    return windows.select(
        "conv_id",
        "first_rank",
        F.transform(fresh, turn).alias("turns"),
        F.array_join(under, "").alias("loss_text"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


def digests(windows: DataFrame) -> DataFrame:
    """One row per conversation with digests of what its windows say.

    A digest runs over a whole conversation, which is therefore put together
    again here, though not by ``format_windows``."""
    read = read_windows(windows).select(
        "conv_id",
        "first_rank",
        F.size("turns").cast("long").alias("n"),
        F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "").alias("said"),
        "loss_text",
        "formatted_chars",
    )
    whole = read.groupBy("conv_id").agg(
        F.sum("n").alias("n_turns"),
        F.sum("formatted_chars").alias("formatted_chars"),
        F.sort_array(F.collect_list(F.struct("first_rank", "said", "loss_text"))).alias("parts"),
    )
    return whole.select("conv_id", "n_turns", F.array_join("parts.said", "").alias("said"), F.array_join("parts.loss_text", "").alias("lost"), "formatted_chars").select(
        "conv_id",
        "n_turns",
        F.sha2(F.col("said").cast("binary"), 256).alias("turns_sha256"),
        F.char_length("lost").cast("long").alias("loss_chars"),
        F.sha2(F.col("lost").cast("binary"), 256).alias("loss_sha256"),
        "formatted_chars",
    )
