"""Batched calls of a caller's model function."""

from __future__ import annotations

import random
import time
from collections.abc import Callable, Iterator, Sequence
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame, types as T
from pyspark.sql.pandas.types import to_arrow_type

# How a rate-limit error reads.
RATE_LIMIT_MARKS = ("429", "RESOURCE_EXHAUSTED")


def is_rate_limit_text(error: str | None) -> bool:
    return error is not None and any(mark in error for mark in RATE_LIMIT_MARKS)


def is_rate_limit(error: BaseException) -> bool:
    return is_rate_limit_text(str(error))


def call_with_retry(
    fn: Callable[[list[str]], Sequence[Any]],
    texts: list[str],
    retries: int,
    backoff_ms: int,
    sleep: Callable[[float], None] = time.sleep,
) -> tuple[Sequence[Any] | None, str | None]:
    """The results, or the error: of a rate limit once it has used up the
    retries, of any other kind at once."""
    for attempt in range(retries + 1):
        try:
            found = fn(texts)
        except Exception as error:
            if not is_rate_limit(error) or attempt == retries:
                return None, str(error) or type(error).__name__
            sleep(backoff_ms / 1000 * 2**attempt)
        else:
            if len(found) != len(texts):
                return None, f"model gave {len(found)} results for {len(texts)} texts"
            return found, None
    return None, "no attempt made"


def apply_model(
    df: DataFrame,
    fn: Callable[[list[str]], Sequence[Any]],
    result_type: str | T.DataType,
    *,
    text: str = "text",
    result: str = "values",
    batch_size: int = 20,
    retries: int = 4,
    backoff_ms: int = 1024,
    pause_ms: int = 0,
    jitter_ms: int = 0,
    calls_in_parallel: int | None = None,
    max_failures: int = 0,
) -> DataFrame:
    """``fn`` on lists of up to ``batch_size`` texts, its results in column
    ``result`` and errors in ``error``.

    A task whose retries run out makes no more calls: its remaining rows come
    back with the error, and the rows done so far are kept.  Where a list fails
    for another reason its texts are tried one by one, so that only those the
    model refuses have an error; more than ``max_failures`` of them in a task, if
    that is not 0, end the job.  ``fn`` is sent to the executors, so it must
    pickle.  Tasks can run twice; write the result before using it more than
    once.  ``calls_in_parallel`` bounds how many tasks call the model at a time,
    and between calls a task pauses for ``pause_ms`` and up to ``jitter_ms`` more.
    """
    kind = T._parse_datatype_string(result_type) if isinstance(result_type, str) else result_type
    schema = T.StructType(
        [*df.schema.fields, T.StructField(result, kind), T.StructField("error", T.StringType())],
    )
    arrow_kind = to_arrow_type(kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stopped: str | None = None
        refused = 0

        def call(part: list[str]) -> tuple[Sequence[Any] | None, str | None]:
            answer = call_with_retry(fn, part, retries, backoff_ms)
            if pause_ms > 0 or jitter_ms > 0:
                time.sleep((pause_ms + random.uniform(0, jitter_ms)) / 1000)
            return answer

        for batch in batches:
            texts = batch.column(text).to_pylist()
            results: list[Any] = []
            errors: list[str | None] = []
            for start in range(0, len(texts), batch_size):
                part = texts[start : start + batch_size]
                values: Sequence[Any] | None = None
                error = stopped
                if stopped is None:
                    values, error = call(part)
                if values is not None or len(part) == 1 or is_rate_limit_text(error):
                    tried = [(None if values is None else values[i], error) for i in range(len(part))]
                else:
                    tried = []
                    for one in part:
                        value, error = (None, stopped) if stopped else call([one])
                        if is_rate_limit_text(error):
                            stopped = error
                        tried.append((None if value is None else value[0], error))
                if is_rate_limit_text(error):
                    stopped = error
                refused += sum(e is not None and not is_rate_limit_text(e) for _, e in tried)
                if max_failures and refused > max_failures:
                    raise RuntimeError(f"model refused {refused} texts, the last one with: {error}")
                results.extend(value for value, _ in tried)
                errors.extend(e for _, e in tried)
            yield batch.append_column(result, pa.array(results, arrow_kind)).append_column(
                "error", pa.array(errors, pa.string())
            )

    spread = df.repartition(calls_in_parallel) if calls_in_parallel else df
    return spread.mapInArrow(run, schema)
