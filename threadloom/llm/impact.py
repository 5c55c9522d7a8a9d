"""Exact top-k search over an impact-ordered index, a score at a time.

Every task cuts its vectors into shards.  A shard's index lists, for each
dimension, the rows by falling impact, which is the size of the component
quantised to at most 256 levels; the rows of one level are a posting segment.  A
group of questions takes the segments of all dimensions by falling impact, in
rounds down to a level each, and sums them in accumulators: a segment is read once
for the group.  What a row was not given yet is a rest whose length the index knows
for each round, so accumulator and length of the rest times that of the question
bound its score from above.  A round is a question's last one when the bound leaves
few rows, or when nothing is left to add; the rows left are scored again exactly.
The score that rules out the others is the k-th best of rows scored exactly, so
nothing is left to luck, and rows that tie with it are never ruled out.

Defined results: see ``vectors`` for nulls, numbers that are not finite, repeated
ids and unlike lengths.  A question's own id is no candidate.  An empty table
gives no rows, and with fewer candidates than k all of them come.  Other columns
are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame

from threadloom.llm import vectors as V
from threadloom.session import materialize

LEVELS = 256
# Rounds end where these shares of all postings have been read, at last at level 1.
SHARES = (0.55, 0.75)
# A question stops when no more than this share of a shard is possible.
FEW = 1 / 11
# Questions that share a reading of the segments: their accumulators stay in the cache.
GROUP = 32
# A segment of more than this share of the rows is kept as a column with zeros, others
# as lists.
FILLED = 1 / 4
# Lengths are computed in floating point.
SLACK = 1 + 1e-9


class Segments:
    """The posting segments of one shard, by dimension and level."""

    def __init__(self, ids, vectors):
        import numpy as np

        self.ids, self.vectors = ids, vectors
        self.exact = self.left = vectors.astype(np.float64)
        n, dims = vectors.shape
        sizes = np.abs(vectors)
        self.largest = int(sizes.max(initial=0))
        self.shift = max(0, self.largest.bit_length() - LEVELS.bit_length() + 1)
        levels = sizes >> self.shift
        signed = (np.sign(vectors) * (levels << self.shift)).astype(np.float64)
        read = np.cumsum(np.bincount(levels.ravel(), minlength=1)[::-1])[::-1]
        last = {max(1, int(np.argmax(np.append(read, 0) <= share * n * dims))) for share in SHARES} | {1}
        self.rounds, above = [], self.largest + 1
        for level in sorted(last, reverse=True):
            self.rounds.append(self._round(signed, (levels >= level) & (levels < above)))
            above = level

    def _round(self, signed, read) -> tuple:
        """What a round reads: the segments of most rows as a matrix of (row, dimension),
        the others as (dimension, rows, impacts), and the number of postings; and the
        length of what is left of each row then."""
        import numpy as np

        sizes = np.count_nonzero(read, axis=0)
        filled = np.flatnonzero(sizes > len(signed) * FILLED)
        matrix = np.where(read[:, filled], signed[:, filled], 0.0)
        lists = []
        for d in np.flatnonzero((sizes > 0) & (sizes <= len(signed) * FILLED)).tolist():
            rows = np.flatnonzero(read[:, d])
            lists.append((d, rows, signed[rows, d]))
        self.left = np.where(read, self.exact - signed, self.left)
        return filled, matrix, lists, int(sizes.sum()), np.sqrt((self.left**2).sum(axis=1))

    def scores(self, rows, question):
        """Exact scores of some rows."""
        import numpy as np

        if self.largest * int(np.abs(question).max(initial=0)) * max(len(question), 1) < 1 << 53:
            return np.rint(self.exact[rows] @ question.astype(np.float64)).astype(np.int64)
        return self.vectors[rows] @ question

    def possible(self, question, k: int, floor: int, own):
        """``possible_of`` for one question."""
        import numpy as np

        return self.possible_of(question[None, :], k, np.array([floor]), own[None, :])[0]

    def possible_of(self, questions, k: int, floors, own) -> list:
        """For each question the rows that can be among the k best of at least its floor,
        and the number of postings read for it; ``own`` marks its own rows."""
        import numpy as np

        n, dims = self.vectors.shape
        found = [(np.flatnonzero(~mine), 0) for mine in own]
        exact = self.largest * int(np.abs(questions).max(initial=0)) * max(dims, 1) < 1 << 53
        active = np.flatnonzero([exact and len(rows) > k and q.any() for (rows, _), q in zip(found, questions)])
        weights = np.ascontiguousarray(questions[active].T.astype(np.float64))
        lengths = np.sqrt((weights**2).sum(axis=0)) * SLACK
        sums = np.zeros((n, len(active)))
        read = 0
        for filled, matrix, lists, size, left in self.rounds:
            if not len(active):
                break
            if len(filled):
                sums += matrix @ weights[filled]
            for d, rows, impacts in lists:
                sums[rows] += np.multiply.outer(impacts, weights[d])  # a row comes once
            read += size
            bounds = np.multiply.outer(lengths, left)
            bounds += sums.T
            bounds[own[active]] = -np.inf
            best = np.argpartition(bounds, n - k, axis=1)[:, n - k :]
            more = []
            for i, q in enumerate(active.tolist()):
                floor = max(int(floors[q]), int(self.scores(best[i], questions[q]).min()))
                rows = np.flatnonzero(bounds[i] >= floor)
                found[q] = rows, read
                if len(rows) > max(2 * k, n * FEW):
                    more.append(i)
            if len(more) < len(active):
                active, lengths = active[more], lengths[more]
                weights, sums = np.ascontiguousarray(weights[:, more]), np.ascontiguousarray(sums[:, more])
        return found


def search(embeddings: DataFrame, is_question: Column, k: int, scale: int = 64, block: int = V.QUESTIONS_PER_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): the k highest integer inner products of
    every row that ``is_question`` names, a condition on vec_id.

    Vectors stay where they are; questions go to all tasks in blocks of a bounded
    size, and a task passes on k rows per question of a block at most."""
    if k < 1:
        raise ValueError("k must be at least 1")
    rows = V.taking_part(embeddings)
    hits = None
    for asked in V.question_blocks(rows.where(is_question), block):
        part = materialize(V.merged(_block_hits(rows, asked, k, scale), ["query_id"], k), "hits")
        hits = part if hits is None else hits.unionByName(part)
    if hits is None:
        hits = rows.sparkSession.createDataFrame([], "query_id long, vec_id long, score long, rank int")
    return hits.select("query_id", "rank", "vec_id", "score")


def _block_hits(rows: DataFrame, asked, k: int, scale: int) -> DataFrame:
    import numpy as np

    ids = asked.column("vec_id").to_numpy()
    shared = rows.sparkSession.sparkContext.broadcast((ids, V.integers(asked.column("vector"), scale).astype(np.int64)))

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        asked_ids, asked_vectors = shared.value
        best = V.Best(len(asked_ids), k)
        for shard in V.shards(batches):
            found = V.integers(shard.column("vector"), scale)
            questions, found = V.same_width(asked_vectors, found)
            index = Segments(shard.column("vec_id").to_numpy(), found)
            new = []
            for start in range(0, len(asked_ids), GROUP):
                group = slice(start, start + GROUP)
                own = asked_ids[group, None] == index.ids
                answers = index.possible_of(questions[group], k, best.floor[group], own)
                for q, (possible, _) in enumerate(answers, start):
                    scores = index.scores(possible, questions[q])
                    good = scores >= best.floor[q]
                    possible, scores = possible[good], scores[good]
                    if len(possible) > k:
                        order = np.lexsort((possible, -scores))[:k]  # rows of a shard are sorted by id
                        possible, scores = possible[order], scores[order]
                    new.append((np.full(len(possible), q), scores, index.ids[possible]))
            best.add(*(np.concatenate(parts) for parts in zip(*new)))
        if len(best.question):
            for start in range(0, len(best.question), 65536):
                part = slice(start, start + 65536)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(asked_ids[best.question[part]]), pa.array(best.id[part]), pa.array(best.score[part])],
                    names=["query_id", "vec_id", "score"],
                )

    return rows.select("vec_id", "vector").mapInArrow(run, "query_id long, vec_id long, score long")
