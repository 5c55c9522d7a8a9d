"""Integer vectors for exact scoring: who takes part, blocks of questions, merged bests.

Rows without an id, with a null vector, or with a null or non-finite component
take no part.  Of rows with one id the one whose vector comes first (then the
smallest label) counts, so repeated rows change nothing.  A shorter vector counts
as filled up with zeros.  A table whose scores could exceed 64 bits is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.session import materialize, scratch_path

# Questions that go to every task at once: of 64 components 16 MB.
QUESTIONS_PER_BLOCK = 32768
# Vectors that a task scores at once.
ROWS_PER_SHARD = 8192
MERGE_SALTS = 32


def taking_part(embeddings: DataFrame, *others: str) -> DataFrame:
    """(vec_id, vector, others), one row per id, written once and spread over the
    cores of the cluster."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").alias("vector"), *others)
    rows = rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & finite)
    for name in others:
        rows = rows.where(F.col(name).isNotNull())
    written = materialize(rows, "vectors")
    n, ids = written.agg(F.count(F.lit(1)), F.count_distinct("vec_id")).first()
    if ids < n:
        first = F.min(F.struct("vector", *others)).alias("first")
        written = written.groupBy("vec_id").agg(first).select("vec_id", "first.*")
    # As many parts as give every core work, none of them longer than 32 shards.
    cores = written.sparkSession.sparkContext.defaultParallelism
    parts = max(-(-ids // (32 * ROWS_PER_SHARD)), min(-(-ids // ROWS_PER_SHARD), 3 * cores), 1)
    return materialize(written.repartition(parts, "vec_id"), "vectors")


def question_blocks(rows: DataFrame, per_block: int) -> Iterator:
    """The rows as Arrow tables of about ``per_block`` rows, one after the other."""
    n = rows.count()
    if not n:
        return
    blocks = -(-n // per_block)
    path = scratch_path(rows.sparkSession, "questions")
    block = F.pmod(F.xxhash64("vec_id", F.lit("block")), F.lit(blocks)).cast("int")
    rows.withColumn("_block", block).repartition("_block").write.partitionBy("_block").parquet(path)
    written = rows.sparkSession.read.parquet(path)
    for number in range(blocks):
        found = written.where(F.col("_block") == number).drop("_block").toArrow()
        if found.num_rows:
            yield found.sort_by("vec_id").combine_chunks()


def integers(column, scale: int):
    """floor(scale * x) of an Arrow column of lists without nulls, as rows of an
    int64 matrix, shorter vectors filled up with zeros."""
    import numpy as np
    import pyarrow as pa

    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    flat = np.floor(scale * column.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
    width = int(lengths.max(initial=0))
    if np.abs(flat).max(initial=0) ** 2 * max(width, 1) >= 2.0**62:
        raise ValueError("components too large for scores of 64 bits")
    matrix = np.zeros((len(lengths), width), np.int64)
    matrix[np.arange(width) < lengths[:, None]] = flat.astype(np.int64)
    return matrix


def same_width(a, b):
    """Both matrices, the narrower one filled up with zeros."""
    import numpy as np

    width = max(a.shape[1], b.shape[1])
    return tuple(m if m.shape[1] == width else np.pad(m, ((0, 0), (0, width - m.shape[1]))) for m in (a, b))


def shards(batches, rows: int = ROWS_PER_SHARD):
    """A task's Arrow batches as tables of ``rows`` rows (the last may have fewer),
    each sorted by id."""
    import pyarrow as pa

    held, size = [], 0
    for batch in batches:
        start = 0
        while start < batch.num_rows:
            part = batch.slice(start, rows - size)
            held.append(part)
            size += part.num_rows
            start += part.num_rows
            if size == rows:
                yield pa.Table.from_batches(held).sort_by("vec_id")
                held, size = [], 0
    if size:
        yield pa.Table.from_batches(held).sort_by("vec_id")


class Best:
    """The k best (score, id) of each of n questions: the highest scores, of equal
    ones the lowest ids."""

    def __init__(self, n: int, k: int):
        import numpy as np

        self.n, self.k = n, k
        self.floor = np.full(n, np.iinfo(np.int64).min)  # the k-th best score so far
        self.question, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))

    def add(self, question, score, ids) -> None:
        import numpy as np

        if not len(question):
            return
        question, score, ids = (
            np.concatenate(pair) for pair in ((self.question, question), (self.score, score), (self.id, ids))
        )
        order = np.lexsort((ids, -score, question))
        question = question[order]
        place = np.arange(len(order)) - np.searchsorted(question, question)
        kept = place < self.k
        order = order[kept]
        self.question, self.score, self.id = question[kept], score[order], ids[order]
        full = place[kept] == self.k - 1
        self.floor[self.question[full]] = self.score[full]


def merged(hits: DataFrame, per: list[str], k: int, score: str = "score", vec_id: str = "vec_id") -> DataFrame:
    """The k best rows of each question with their ``rank`` from 1.  As many tasks
    bring rows of one question, they are first cut to k by salt."""
    order = (F.desc(score), F.col(vec_id))
    salt: Column = F.pmod(F.xxhash64(vec_id), F.lit(MERGE_SALTS))
    found = hits.withColumn("_salt", salt)
    for group in ([*per, "_salt"], per):
        place = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
        found = found.withColumn("rank", place).where(F.col("rank") <= k)
    return found.drop("_salt")
