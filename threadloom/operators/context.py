"""Texts of hits and the context made from them."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.functions import ids, text
from threadloom.operators.captures import THREAD_KEYS, latest_versions

def _one_text(found: DataFrame) -> DataFrame:
    """One text per key, should a table hold several: a hit stays one row."""
    return found.groupBy(*[c for c in found.columns if c != "_text"]).agg(F.min("_text").alias("_text"))


def with_pinned_text(
    hits: DataFrame, store: DataFrame, max_chars: int = 0, text_column: str = "text"
) -> DataFrame:
    """The text that was embedded, found in the content-addressed table
    (t, sub, id, h, text) by the id's parts and the hash; '' if not there.

    The store is scanned once with the keys as a filter.  Write the hits out
    first: their size is then known, and adaptive execution sends few keys to
    the scan instead of shuffling the store.
    """
    part = ids.parse_document_id("id")
    keyed = hits.withColumn("_t", part["t"]).withColumn("_sub", part["sub"]).withColumn("_doc", part["doc"])
    keyed = keyed.withColumn("_h", text.none_if_empty(F.col("metadata.h")))
    wanted = keyed.where(F.col("_doc").isNotNull() & F.col("_h").isNotNull()).select(
        F.col("_t").alias("t"), F.col("_sub").alias("sub"), F.col("_doc").alias("id"), F.col("_h").alias("h")
    )
    found = store.select("t", "sub", "id", "h", "text").join(wanted.distinct(), ["t", "sub", "id", "h"], "left_semi")
    found = _one_text(
        found.select(
            F.col("t").alias("_t"), F.col("sub").alias("_sub"), F.col("id").alias("_doc"), F.col("h").alias("_h"),
            F.col("text").alias("_text"),
        )
    )
    joined = keyed.join(found, ["_t", "_sub", "_doc", "_h"], "left")
    shown = text.truncate_text(text.strip_text("_text"), max_chars)
    return joined.select(*hits.columns, shown.alias(text_column))


def with_latest_text(
    hits: DataFrame,
    staged: DataFrame,
    max_chars: int = 0,
    text_column: str = "excerpt",
    thread: Sequence[str] = THREAD_KEYS,
) -> DataFrame:
    """The text of the thread's last staged version; '' if not there.

    Cut ``staged`` to the lookback before.  It is scanned with the hits'
    threads as a filter, so versions are compared for those threads only.
    """
    t = F.col("metadata.t")
    keyed = hits.select(
        "*",
        text.none_if_empty(F.col("metadata.sub")).alias("_sub"),
        ids.kind_of_letter(t).alias("_kind"),
        text.none_if_empty(F.col("metadata.sid")).alias("_sid"),
        ids.comment_id_of("id", t).alias("_comment"),
    )
    wanted = keyed.where(F.col("_kind").isNotNull()).select(
        F.col("_sub").alias("sub"), F.col("_kind").alias("kind"), F.col("_sid").alias("sid")
    )
    candidates = staged.join(wanted.distinct(), list(thread), "left_semi")
    is_post = F.col("kind") == "submissions"
    title = F.when(is_post, F.col("title"))
    texts = latest_versions(candidates).where(is_post | (text.text_or_empty("comment_id") != "")).select(
        F.col("sub").alias("_sub"),
        F.col("kind").alias("_kind"),
        F.col("sid").alias("_sid"),
        F.when(is_post, F.lit("")).otherwise(F.col("comment_id")).alias("_comment"),
        text.compose_document(title, F.col("body")).alias("_text"),
    )
    texts = _one_text(texts)
    joined = keyed.join(texts, ["_sub", "_kind", "_sid", "_comment"], "left")
    shown = text.truncate_text(text.text_or_empty("_text"), max_chars)
    return joined.select(*hits.columns, shown.alias(text_column))


def context_blocks(
    hits: DataFrame, text_column: str = "text", style: str = "source", per: Sequence[str] = ("query_id",)
) -> DataFrame:
    """One block per hit that has a text, numbered by rank.

    source: SOURCE and the source line above the text; numbered: [n] and the
    source line above the text.
    """
    md = F.col("metadata")
    line = text.source_line(F.col("id"), md["sub"], md["t"], md["sid"], F.col("score"))
    order = Window.partitionBy(*per).orderBy(F.desc("score"), "id")
    usable = hits.where(F.col(text_column) != "").withColumn("rank", F.row_number().over(order))
    if style == "source":
        head = F.concat(F.lit("SOURCE "), line)
    elif style == "numbered":
        head = F.concat(F.lit("["), F.col("rank").cast("string"), F.lit("] "), line)
    else:
        raise ValueError(f"no style {style!r}")
    return usable.withColumn("source", line).withColumn("block", F.concat(head, F.lit("\n"), F.col(text_column)))


def within_budget(
    blocks: DataFrame, max_chars: int, per: Sequence[str] = ("query_id",), order: str = "rank", block: str = "block"
) -> DataFrame:
    """Blocks in rank order up to the first that would exceed the budget;
    nothing after it is taken.  0 means no budget."""
    if max_chars <= 0:
        return blocks
    so_far = Window.partitionBy(*per).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    used = blocks.withColumn("_used", F.sum(F.length(block)).over(so_far))
    # Blocks are never empty, so once the sum is over it stays over.
    return used.where(F.col("_used") <= max_chars).drop("_used")


@dataclass(frozen=True)
class PromptTemplate:
    """The caller's wording around the context blocks and the question."""

    header: str = ""
    separator: str = "\n\n"
    footer: str = "\n\n"
    empty_header: str | None = None
    end: str = "\n"


def build_prompts(
    questions: DataFrame, blocks: DataFrame, template: PromptTemplate = PromptTemplate(), question: str = "question"
) -> DataFrame:
    """One prompt per question: header, blocks in rank order with the
    separator between them, footer, question.  A question without blocks gets
    the empty header and no separator."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "block")))  # at most max_docs blocks
    joined = blocks.groupBy("query_id").agg(
        F.array_join(F.transform(ordered, lambda b: b["block"]), template.separator).alias("_context"),
        F.count(F.lit(1)).alias("n_blocks"),
    )
    bare = template.header if template.empty_header is None else template.empty_header
    context = F.when(F.col("_context").isNotNull(), F.concat(F.lit(template.header), F.col("_context"))).otherwise(
        F.lit(bare)
    )
    return questions.join(joined, "query_id", "left").select(
        *questions.columns,
        F.coalesce("n_blocks", F.lit(0)).alias("n_blocks"),
        F.concat(context, F.lit(template.footer), F.col(question), F.lit(template.end)).alias("prompt"),
    )


def source_fields() -> list[Column]:
    """The columns of a source that an answer cites."""
    md = F.col("metadata")
    return [
        F.col("id"),
        F.col("score"),
        text.text_or_empty(md["sub"]).alias("sub"),
        text.text_or_empty(md["t"]).alias("t"),
        text.text_or_empty(md["sid"]).alias("sid"),
        text.text_or_empty(md["pid"]).alias("pid"),
    ]
