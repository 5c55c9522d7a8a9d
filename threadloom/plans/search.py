"""Search with texts (J5) and question answering contexts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from threadloom.functions.text import strip_text
from threadloom.functions.times import in_lookback
from threadloom.operators import context, search as ops
from threadloom.operators.model import apply_model, call_with_retry
from threadloom.plans.parameters import QuestionParameters, SearchParameters
from threadloom.session import materialize

Model = Callable[[list[str]], Sequence]


def search(
    index: DataFrame,
    vector: Sequence[float],
    params: SearchParameters = SearchParameters(),
    *,
    filter: Mapping | str | None = None,
    store: DataFrame | None = None,
    staged: DataFrame | None = None,
    as_of: dt.date | str | None = None,
    metric: str = "cosine",
) -> DataFrame:
    """J5 for one vector: ranked hits, with the pinned text out of ``store`` or
    the latest text out of ``staged`` when ``with_text`` is set."""
    columns = ["metadata", *(["values"] if params.values else [])]
    hits = ops.topk(index, vector, params.topk, filter=filter, metric=metric, columns=columns)
    hits = ops.rank_hits(hits.withColumn("query_id", F.lit(0)))
    if params.with_text and store is None and staged is None:
        raise ValueError("with_text needs a store or a staged table")
    if params.with_text:
        # The hits are used twice to find their texts; the index is read once.
        hits = materialize(hits, "hits")
        if store is not None:
            hits = context.with_pinned_text(hits, store, params.max_chars)
        else:
            window = staged.where(in_lookback(params.lookback_days, as_of))
            hits = context.with_latest_text(hits, window, params.max_chars)
    return ops.project_hits(hits, params.metadata, params.values).drop("query_id")


def search_question(
    index: DataFrame,
    question: str,
    embed: Model,
    params: SearchParameters = SearchParameters(),
    retries: int = 6,
    backoff_ms: int = 1500,
    **options,
) -> DataFrame:
    """J5 for one question in words; ``options`` go to search."""
    asked = question.strip()
    if not asked:
        raise ValueError("blank question")
    vectors, error = call_with_retry(embed, [asked], retries, backoff_ms)
    if vectors is None:
        raise RuntimeError(f"question not embedded: {error}")
    return search(index, vectors[0], params, **options)


def context_for(
    hits: DataFrame,
    params: QuestionParameters,
    *,
    store: DataFrame | None = None,
    staged: DataFrame | None = None,
) -> DataFrame:
    """The context blocks of every question, from its hits: one per thread, at
    most ``max_docs``, with text, within the budget."""
    picked = ops.dedup_hits(hits, params.drop_missing_sid) if params.dedup_threads else hits
    picked = materialize(ops.best_per_query(picked, params.max_docs), "hits")
    if store is not None:
        texts = context.with_pinned_text(picked, store, params.doc_max_chars)
    elif staged is not None:
        texts = context.with_latest_text(picked, staged, params.doc_max_chars, text_column="text")
    else:
        raise ValueError("a context needs a store or a staged table")
    return context.within_budget(context.context_blocks(texts, "text", params.style), params.budget)


def rag_context(
    index: DataFrame,
    questions: DataFrame,
    params: QuestionParameters = QuestionParameters(),
    *,
    store: DataFrame | None = None,
    staged: DataFrame | None = None,
    filter: Mapping | str | None = None,
    template: context.PromptTemplate = context.PromptTemplate(),
    metric: str = "cosine",
) -> tuple[DataFrame, DataFrame]:
    """(prompts, sources) of a table of (query_id, question, vector)."""
    hits = ops.topk_batch(index, questions, params.topk, filter=filter, metric=metric)
    blocks = materialize(context_for(hits, params, store=store, staged=staged), "blocks")
    prompts = context.build_prompts(questions.drop("vector"), blocks, template)
    return prompts, blocks.select("query_id", "rank", *context.source_fields(), "source")


def embed_questions(questions: DataFrame, embed: Model, **retry) -> DataFrame:
    """(query_id, question, vector) of a table of (query_id, question); blank
    questions are an error."""
    asked = questions.withColumn("question", strip_text("question"))
    checked = asked.where(
        F.when(F.col("question") != "", F.lit(True)).otherwise(F.raise_error(F.lit("blank question")))
    )
    done = materialize(
        apply_model(checked, embed, "array<float>", text="question", result="vector", **retry), "questions"
    )
    failed = F.raise_error(F.concat(F.lit("question not embedded: "), "error"))
    return done.where(F.when(F.col("error").isNull(), F.lit(True)).otherwise(failed)).drop("error")


def answer(
    index: DataFrame,
    questions: DataFrame,
    embed: Model,
    generate: Model,
    params: QuestionParameters = QuestionParameters(),
    retry: Mapping | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """Question answering from end to end: (answers, sources).  ``options`` go
    to rag_context."""
    retry = dict(retry or {})
    prompts, sources = rag_context(index, embed_questions(questions, embed, **retry), params, **options)
    written = apply_model(prompts, generate, "string", text="prompt", result="answer", **{**retry, "batch_size": 1})
    answers = materialize(written.withColumn("answer", strip_text("answer")), "answers")
    return answers, sources
