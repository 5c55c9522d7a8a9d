"""Exact top-k search that skips cells of the index (F1).

Entries are grouped around centres.  A cell knows its centre, the distance of its
farthest entry and its number of entries, so no entry of it can score more than a
bound.  A question first searches the cells with the highest bounds that hold k
entries; their k-th score is a floor, and only cells whose bound reaches the floor
are searched besides.  Entries that tie with the floor are never skipped, so the
result equals that of a whole scan.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from threadloom.operators import search as se
from threadloom.session import materialize

# Centres come from so many entries at most, and are fitted in so many rounds;
# which ones changes the work only, not the result.
FITTED_ON = 65536
ROUNDS = 8
MOST_CELLS = 4096
# A task keeps about so many candidates until they are merged.
CANDIDATES_HELD = 1 << 18
# Bounds are computed in floating point, scores rounded to SCORE_DIGITS.
SLACK = 1e-8


@dataclass(frozen=True)
class Cells:
    """``entries`` is the index with a column ``cell``, laid out by cell; the rest has
    one number or vector per cell."""

    entries: DataFrame
    metric: str
    centres: np.ndarray
    radius: np.ndarray
    size: np.ndarray

    def bounds(self, questions: np.ndarray) -> np.ndarray:
        """The most that an entry of each cell can score, per question."""
        if self.metric == "cosine":
            questions = se._unit(questions)
        reach = np.linalg.norm(questions, axis=1)[:, None] * self.radius
        return questions @ self.centres.T + reach + SLACK


def _nearest(vectors: np.ndarray, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centre of each vector and the distance to it."""
    found = np.argmax(vectors @ centres.T - (centres**2).sum(axis=1) / 2, axis=1)
    return found, np.linalg.norm(vectors - centres[found], axis=1)


def _fitted(sample: np.ndarray, n: int) -> np.ndarray:
    """At most n centres by Lloyd's rounds, begun with entries spread over the sample."""
    distinct = np.unique(sample, axis=0)
    centres = distinct[np.linspace(0, len(distinct) - 1, min(n, len(distinct))).astype(int)]
    for _ in range(ROUNDS):
        cell, _ = _nearest(sample, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, cell, sample)
        counts = np.bincount(cell, minlength=len(centres))[:, None]
        centres = np.where(counts > 0, sums / np.maximum(counts, 1), centres)
    return centres


def build_cells(index: DataFrame, n_cells: int = 0, metric: str = "cosine") -> Cells:
    """Cells of an index table; about the root of its entries unless ``n_cells`` says
    how many.  The entries are assigned in one pass and written laid out by cell."""
    if metric not in se.METRICS:
        raise ValueError(f"metric must be one of {se.METRICS}")
    n = index.count()
    wanted = min(MOST_CELLS, n_cells or int(np.ceil(np.sqrt(n))))
    near = index.where(F.xxhash64("id", F.lit("cells")) / F.lit(float(1 << 63)) < min(1.0, FITTED_ON / max(n, 1)) * 2 - 1)
    sample = near.select("values").limit(2 * FITTED_ON).toArrow().column("values").combine_chunks()
    if not len(sample):
        sample = index.select("values").limit(1).toArrow().column("values").combine_chunks()
    dim = len(sample[0]) if len(sample) else 0
    vectors = se._matrix(sample, dim)
    centres = _fitted(se._unit(vectors) if metric == "cosine" else vectors, max(1, wanted)) if dim else np.zeros((0, 0))
    shared = index.sparkSession.sparkContext.broadcast(centres)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = se._matrix(batch.column("values"), dim)
            cell, distance = _nearest(se._unit(rows) if metric == "cosine" else rows, shared.value)
            added = [pa.array(cell.astype(np.int32)), pa.array(distance)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "cell", "distance"])

    schema = index.withColumns({"cell": F.lit(0), "distance": F.lit(0.0)}).schema
    laid = index.mapInArrow(run, schema).repartitionByRange("cell", "id").sortWithinPartitions("cell", "id")
    entries = materialize(laid, "cells")
    known = entries.groupBy("cell").agg(F.max("distance").alias("radius"), F.count(F.lit(1)).alias("n")).collect()
    radius, size = np.zeros(len(centres)), np.zeros(len(centres), np.int64)
    for row in known:  # MOST_CELLS at most
        radius[row["cell"]], size[row["cell"]] = row["radius"], row["n"]
    return Cells(entries.drop("distance"), metric, centres, radius, size)


def _scored(
    cells: Cells, asked: pa.Table, wanted: np.ndarray, k: int, columns: Sequence[str], query_type, floors: np.ndarray | None = None
) -> DataFrame:
    """The k best of each task among the wanted (question, cell) pairs, and of at least
    the question's floor."""
    schema = se._hit_schema(cells.entries, columns, query_type)
    names, metric = schema.names, cells.metric
    ids = asked.column("query_id").combine_chunks()
    questions = se._matrix(asked.column("vector").combine_chunks(), cells.centres.shape[1])
    context = cells.entries.sparkSession.sparkContext
    floors = np.full(len(wanted), -np.inf) if floors is None else floors
    shared = context.broadcast((questions, ids, np.packbits(wanted, axis=0), floors))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vectors, query_ids, packed, floor = shared.value
        unit = se._unit if metric == "cosine" else np.asarray
        vectors, n = unit(vectors), len(floor)
        best = se._Best(n, k)
        best.floor = floor.copy()
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            matrix = unit(se._matrix(batch.column("values"), vectors.shape[1]))
            cell = batch.column("cell").to_numpy()
            rows = rows.drop_columns([c for c in ("cell", "values") if c not in names])
            ids, found, held = rows.column("id").combine_chunks(), [], 0
            for number in np.unique(cell):
                asking = np.flatnonzero(np.unpackbits(packed[:, number], count=n))
                own = np.flatnonzero(cell == number)
                for start in range(0, len(asking), se.QUERIES_AT_ONCE):
                    part = asking[start : start + se.QUERIES_AT_ONCE]
                    scores = se._score(vectors[part], matrix[own], "dot")
                    q, r = best.candidates(scores, ids.take(pa.array(own)), part)
                    found.append((part[q], scores[q, r], own[r]))
                    held += len(q)
                    if held > CANDIDATES_HELD:
                        best.merge_all(found, rows)
                        found, held = [], 0
            best.merge_all(found, rows)
        yield from best.batch(names, query_ids)

    needed = list(dict.fromkeys(["id", "values", "cell", *columns]))
    numbers = [int(c) for c in np.flatnonzero(wanted.any(axis=0))]
    return cells.entries.select(*needed).where(F.col("cell").isin(numbers)).mapInArrow(run, schema)


def topk_cells(
    cells: Cells,
    queries: DataFrame,
    k: int,
    columns: Sequence[str] = ("metadata",),
    block: int = se.QUESTIONS_PER_BLOCK,
    report: dict | None = None,
) -> DataFrame:
    """F1 for a table of (query_id, vector): the k best entries of every question,
    as ``search.topk_batch`` finds them.

    ``report`` takes the pairs of question and entry: all, and those scored."""
    se._check(k, cells.metric)
    asked = materialize(queries.select("query_id", "vector"), "questions")
    query_type = queries.schema["query_id"].dataType
    blocks = -(-asked.count() // block)
    found = asked.sparkSession.createDataFrame([], se._hit_schema(cells.entries, columns, query_type))
    counted = {"pairs": 0, "scored": 0}
    for number in range(blocks):
        own = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number).toArrow()
        if not own.num_rows or not len(cells.size):
            continue
        bounds = cells.bounds(se._matrix(own.column("vector").combine_chunks(), cells.centres.shape[1]))
        order = np.argsort(-bounds, axis=1, kind="stable")
        before = np.cumsum(cells.size[order], axis=1) - cells.size[order]
        first = np.zeros(bounds.shape, bool)
        np.put_along_axis(first, order, before < k, axis=1)
        first &= cells.size > 0
        hits = materialize(se.best_per_query(_scored(cells, own, first, k, columns, query_type), k), "hits")
        floors = _floors(hits, own.column("query_id"), k)
        rest = (bounds >= floors[:, None]) & ~first & (cells.size > 0)
        if rest.any():
            hits = hits.unionByName(_scored(cells, own, rest, k, columns, query_type, floors))
        found = found.unionByName(materialize(se.best_per_query(hits, k), "hits"))
        counted["pairs"] += own.num_rows * int(cells.size.sum())
        counted["scored"] += int(((first | rest) * cells.size).sum())
    if report is not None:
        report.update(counted)
    return found


def _floors(hits: DataFrame, query_ids: pa.ChunkedArray, k: int) -> np.ndarray:
    """The k-th score of each question of a block so far, -inf with fewer hits."""
    kth = hits.groupBy("query_id").agg(F.min("score").alias("floor"), F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    known: Mapping = {r["query_id"]: r["floor"] for r in kth.collect()}  # one row per question of the block
    return np.array([known.get(q, -np.inf) for q in query_ids.to_pylist()])
