"""Exact top-k vector search and its results.

An index table has the columns id, values (array of float) and metadata (a
struct of strings).  A hit has id, score and metadata; with many questions
also query_id.
"""

from __future__ import annotations

import json
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from threadloom.functions import text
from threadloom.session import materialize

METRICS = ("cosine", "dot")

# Scores are rounded to this many decimals before they are compared, so that
# the order does not depend on the order in which products were added.
SCORE_DIGITS = 9

# About this many questions are sent to every task as one matrix; of more,
# every such number scans the index by itself.
QUESTIONS_PER_BLOCK = 4096
# The tasks' hits of one question are merged by this many tasks first.
MERGE_SALTS = 32

# A task scores this many questions at a time against one batch of rows.
QUERIES_AT_ONCE = 256

INDEXED_FIELDS = ("src", "sub", "t")


# -- filter --------------------------------------------------------------------


def metadata_filter(index: DataFrame, wanted: Mapping | str | None) -> DataFrame:
    """Equality on metadata fields, applied before scoring so that it
    reaches the scan.  Text is read as JSON; anything but an object is an
    error."""
    if wanted is None or wanted == "":
        return index
    if isinstance(wanted, str):
        try:
            wanted = json.loads(wanted)
        except ValueError as error:
            raise ValueError(f"filter is not JSON: {error}") from None
    if not isinstance(wanted, Mapping):
        raise ValueError("filter must be a JSON object")
    fields = {f.name for f in index.schema["metadata"].dataType.fields}
    for name, value in wanted.items():
        if isinstance(value, Mapping):
            if set(value) != {"$eq"}:
                raise ValueError(f"only equality is supported, got {value!r}")
            value = value["$eq"]
        if name not in fields:
            raise ValueError(f"no metadata field {name!r}")
        if isinstance(value, (list, dict)) or value is None:
            raise ValueError(f"filter value of {name!r} must be a scalar")
        index = index.where(F.col(f"metadata.{name}") == F.lit(str(value)))
    return index


# -- scoring -------------------------------------------------------------------


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of one Arrow column as rows of a float64 matrix; a number that
    is not finite has no place in an order of scores and is an error."""
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    if column.null_count or (lengths != dim).any():
        raise ValueError(f"vector length differs from {dim}")
    flat = column.flatten().to_numpy(zero_copy_only=False)
    matrix = flat.astype(np.float64).reshape(len(column), dim)
    if not np.isfinite(matrix).all():
        raise ValueError("vector with a number that is not finite")
    return matrix


def _unit(m: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(m, axis=1, keepdims=True)
    return np.divide(m, norms, out=np.zeros_like(m), where=norms > 0)


def _score(queries: np.ndarray, rows: np.ndarray, metric: str) -> np.ndarray:
    """One row of scores per question; a zero vector scores 0."""
    if metric == "cosine":
        queries, rows = _unit(queries), _unit(rows)
    return np.round(queries @ rows.T, SCORE_DIGITS) + 0.0


class _Best:
    """The k best rows per question so far: at most questions * k rows."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.floor = np.full(queries, -np.inf)
        self.query = np.empty(0, np.int64)
        self.score = np.empty(0, np.float64)
        self.rows: pa.Table | None = None

    def add(self, scores: np.ndarray, rows: pa.Table) -> None:
        q, r = self.candidates(scores, rows.column("id"))
        self.merge(q, scores[q, r], rows, r)

    def candidates(self, scores: np.ndarray, ids, part: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Question and row of every score that can be among the k best: those
        above the floor, which are fewer than k, and of those on it the k with
        the lowest ids, as a third of the rows may be copies.  ``part`` names the
        questions of the scores if they are not all."""
        n, part = scores.shape[1], slice(None) if part is None else part
        if n > self.k:
            kth = np.partition(scores, n - self.k, axis=1)[:, n - self.k]
            self.floor[part] = np.maximum(self.floor[part], kth)
        floor = self.floor[part][:, None]
        good = scores >= floor
        if np.count_nonzero(good) <= 4 * self.k * len(scores):
            return np.nonzero(good)
        by_id = pc.sort_indices(ids).to_numpy()
        tied = (scores == floor)[:, by_id]
        good = good[:, by_id] & ~(tied & (np.cumsum(tied, axis=1) > self.k))
        q, place = np.nonzero(good)
        return q, by_id[place]

    def merge(self, q: np.ndarray, scores: np.ndarray, rows: pa.Table, r: np.ndarray) -> None:
        """Take in the rows numbered ``r``, each with its question and score."""
        if not len(q):
            return
        used, at = np.unique(r, return_inverse=True)
        pool = rows.take(pa.array(used))
        held = 0 if self.rows is None else self.rows.num_rows
        pool = pool if self.rows is None else pa.concat_tables([self.rows, pool])
        query = np.concatenate([self.query, q])
        score = np.concatenate([self.score, scores])
        place = np.concatenate([np.arange(held), held + at])
        by_id = pc.rank(pool.column("id").combine_chunks(), tiebreaker="dense").to_numpy()
        order = np.lexsort((by_id[place], -score, query))
        ranked = query[order]
        rank = np.arange(len(order)) - np.searchsorted(ranked, ranked, side="left")
        kept = order[rank < self.k]
        last = order[rank == self.k - 1]
        self.floor[query[last]] = np.maximum(self.floor[query[last]], score[last])
        self.query, self.score = query[kept], score[kept]
        self.rows = pool.take(pa.array(place[kept])).combine_chunks()

    def merge_all(self, found: list, rows: pa.Table) -> None:
        """``merge`` of several (question, score, row)."""
        if found:
            q, scores, r = (np.concatenate(parts) for parts in zip(*found))
            self.merge(q, scores, rows, r)

    def batch(self, names: Sequence[str], query_ids: pa.Array | None) -> Iterator[pa.RecordBatch]:
        if self.rows is None:
            return
        out = self.rows.append_column("score", pa.array(self.score))
        if query_ids is not None:
            out = out.append_column("query_id", query_ids.take(pa.array(self.query)))
        yield from out.select(list(names)).combine_chunks().to_batches()


def _hit_schema(index: DataFrame, columns: Sequence[str], query_type: T.DataType | None) -> T.StructType:
    head = [] if query_type is None else [T.StructField("query_id", query_type)]
    return T.StructType(
        [*head, index.schema["id"], T.StructField("score", T.DoubleType())]
        + [index.schema[c] for c in columns if c != "id"]
    )


def _task_topk(
    index: DataFrame, matrix: np.ndarray, query_ids: pa.Array | None, query_type, k, metric, columns, at_once: int = QUERIES_AT_ONCE
):
    """The k best rows of every task, by a map over Arrow batches.

    Only ids, vectors and the wanted columns leave the scan; of them k rows
    per question and task go on.
    """
    dim = matrix.shape[1]
    shared = index.sparkSession.sparkContext.broadcast((matrix, query_ids))
    schema = _hit_schema(index, columns, query_type)
    names = schema.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        questions, ids = shared.value
        unit = _unit if metric == "cosine" else np.asarray
        questions = unit(questions)
        starts = range(0, len(questions), at_once)
        parts = [questions[s : s + at_once] for s in starts]
        best = [_Best(len(part), k) for part in parts]
        for batch in batches:
            if batch.num_rows:
                vectors = unit(_matrix(batch.column("values"), dim))
                rows = pa.Table.from_batches([batch]).drop_columns(dropped)
                for part, found in zip(parts, best):
                    found.add(_score(part, vectors, "dot"), rows)
        for start, found in zip(starts, best):
            yield from found.batch(names, None if ids is None else ids.slice(start, at_once))

    needed = ["id", "values", *[c for c in columns if c not in ("id", "values")]]
    dropped = [] if "values" in columns else ["values"]
    return index.select(*needed).mapInArrow(run, schema)


def _check(k: int, metric: str) -> None:
    if k < 1:
        raise ValueError("k must be at least 1")
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")


def topk(
    index: DataFrame,
    vector: Sequence[float],
    k: int,
    *,
    filter: Mapping | str | None = None,
    metric: str = "cosine",
    columns: Sequence[str] = ("metadata",),
) -> DataFrame:
    """The k best entries for one vector by (score desc, id)."""
    _check(k, metric)
    matrix = np.asarray([vector], dtype=np.float64)
    found = _task_topk(metadata_filter(index, filter), matrix, None, None, k, metric, columns)
    return found.orderBy(F.desc("score"), "id").limit(k)


def topk_batch(
    index: DataFrame,
    queries: DataFrame,
    k: int,
    *,
    filter: Mapping | str | None = None,
    metric: str = "cosine",
    columns: Sequence[str] = ("metadata",),
    block: int = QUESTIONS_PER_BLOCK,
) -> DataFrame:
    """F1 for many questions, a table of (query_id, vector): k hits for each.

    A task scores ``block`` questions at a time, QUERIES_AT_ONCE at most.  As many
    blocks as make up QUESTIONS_PER_BLOCK questions go to every task together, as
    a matrix of a bounded size: they scan the index once and shuffle only their
    hits, which are written before the next scan starts.
    """
    _check(k, metric)
    kept = metadata_filter(index, filter)
    asked = materialize(queries.select("query_id", "vector"), "questions")
    query_type = queries.schema["query_id"].dataType
    blocks = -(-asked.count() // max(block, QUESTIONS_PER_BLOCK))
    part = F.pmod(F.xxhash64("query_id"), F.lit(blocks))
    found = kept.sparkSession.createDataFrame([], _hit_schema(kept, columns, query_type))
    for number in range(blocks):
        own = asked.where(part == number).toArrow()
        if own.num_rows:
            vectors = own.column("vector").combine_chunks()
            ids = own.column("query_id").combine_chunks()
            hits = _task_topk(kept, _matrix(vectors, len(vectors[0])), ids, query_type, k, metric, columns, min(block, QUERIES_AT_ONCE))
            found = found.union(materialize(best_per_query(hits, k), "hits"))
    return found


def hit_order(per: Sequence[str] = ("query_id",)) -> Window:
    """F2 within each question: score desc, then id."""
    return Window.partitionBy(*per).orderBy(F.desc("score"), "id")


def best_per_query(hits: DataFrame, k: int) -> DataFrame:
    """The k best hits of every question, merged in two steps: as many tasks have
    brought hits of one question, they are first cut to k by salt."""
    salted = hits.withColumn("_salt", F.pmod(F.xxhash64("id"), F.lit(MERGE_SALTS)))
    for per in (("query_id", "_salt"), ("query_id",)):
        place = F.row_number().over(hit_order(per))
        salted = salted.withColumn("_place", place).where(F.col("_place") <= k).drop("_place")
    return salted.drop("_salt")


def query_vector(index: DataFrame, entry: Column | str) -> list[float]:
    """The vector of the one index entry that ``entry`` selects."""
    return [float(x) for x in index.where(entry).select("values").first()[0]]


# -- results -------------------------------------------------------------------


def project_hits(hits: DataFrame, metadata: str = "all", values: bool = False, indexed: Sequence[str] = INDEXED_FIELDS):
    """``metadata`` is none, indexed or all; vectors only when asked for."""
    if metadata not in ("none", "indexed", "all"):
        raise ValueError(f"metadata must be none, indexed or all, not {metadata!r}")
    out = hits if values else hits.drop("values")
    if metadata == "none":
        return out.drop("metadata")
    if metadata == "indexed":
        return out.withColumn("metadata", F.struct(*[F.col(f"metadata.{f}").alias(f) for f in indexed]))
    return out


def dedup_hits(hits: DataFrame, drop_missing_sid: bool = False, per: Sequence[str] = ("query_id",)) -> DataFrame:
    """The best hit of every thread, per question.  A hit without a thread
    stands for itself, or is dropped."""
    sid = text.none_if_empty(F.col("metadata.sid"))
    rows = hits.where(sid.isNotNull()) if drop_missing_sid else hits
    # An id cannot equal a thread's key: the two differ in their first part.
    thread = F.when(sid.isNotNull(), F.struct(F.lit("t").alias("k"), sid.alias("v"))).otherwise(
        F.struct(F.lit("i").alias("k"), F.col("id").alias("v"))
    )
    place = F.row_number().over(Window.partitionBy(*per, thread).orderBy(F.desc("score"), "id"))
    return rows.withColumn("_place", place).where(F.col("_place") == 1).drop("_place")


def rank_hits(hits: DataFrame, per: Sequence[str] = ("query_id",), name: str = "rank") -> DataFrame:
    """1-based rank per question by (score desc, id)."""
    return hits.withColumn(name, F.row_number().over(hit_order(per)))


def render_hits(ranked: DataFrame, style: str = "pretty", excerpt: str | None = None) -> DataFrame:
    """One text ``line`` per hit.

    jsonl: an object of id, score, metadata and the excerpt; pretty: numbered
    with metadata and excerpt; snippet: numbered with a short excerpt.
    """
    body = text.text_or_empty(excerpt) if excerpt else F.lit("")
    head = F.format_string("%d. score=%.6f id=%s\n", F.col("rank"), F.col("score"), F.col("id"))
    if style == "jsonl":
        extra = [F.col(excerpt).alias("excerpt")] if excerpt else []
        line = F.to_json(F.struct("id", "score", "metadata", *extra))
    elif style == "pretty":
        stripped = text.strip_text(body)
        shown = F.when(stripped != "", F.concat(stripped, F.lit("\n"))).otherwise(F.lit(""))
        line = F.concat(head, F.to_json("metadata"), F.lit("\n"), shown, F.lit("\n"))
    elif style == "snippet":
        line = F.concat(head, text.snippet(body), F.lit("\n\n"))
    else:
        raise ValueError(f"no style {style!r}")
    return ranked.withColumn("line", line)
