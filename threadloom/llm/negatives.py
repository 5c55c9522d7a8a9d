"""Hard negatives by Four-Russians scoring.

An anchor's vector is cut into groups of eight dimensions.  For each group a table
holds the sums of all 256 subsets of its components.  A candidate's components are
written in two's complement, and the bits of equal weight of eight dimensions are
packed into a byte.  The byte of a group looks its plane's share of the score up in
the anchor's table; the planes' shares are added from the highest, which counts
negative, to the lowest, shifting the sum by one bit each time.  So a full score
costs as many look-ups as there are planes and groups, without a multiplication,
and is exact.  The tables of all anchors of a block lie side by side, so that one
look-up adds for all of them.

Two passes over the vectors: the first finds each anchor's positives, scoring an
anchor against rows of its label only; the second scores the others and keeps, for
each positive, the best within the stated share of its score.  Anchors go to all
tasks in blocks of a bounded size, and a task passes on no more rows than are
asked for per anchor and positive.

Defined results: rows with a null label take no part; see ``vectors`` for nulls,
numbers that are not finite, repeated ids and unlike lengths.  An anchor without
positives, or a positive without negatives in its range, gives no rows; so does an
empty table.  Other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from threadloom.llm import vectors as V
from threadloom.session import materialize

# Anchors per block, and anchors whose tables lie side by side: 8 groups of 256
# sums are 2,048 numbers an anchor.
ANCHORS_PER_BLOCK = 4096
ANCHORS_AT_ONCE = 512
# Candidates whose scores with those anchors are worked out at once.
ROWS_AT_ONCE = 2048


def subset_sums(anchors):
    """(groups, 256, anchors): for each group of eight dimensions and each byte the
    sum of the components whose bits are set."""
    import numpy as np

    n, dims = anchors.shape
    groups = -(-dims // 8)
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :dims] = anchors
    sums = np.zeros((groups, 256, n), np.int64)
    for bit in range(8):
        size = 1 << bit
        sums[:, size : 2 * size] = sums[:, :size] + padded[:, bit::8].T[:, None, :]
    return sums


def bit_planes(vectors):
    """(planes, groups, rows) of bytes: plane j of a row's group holds bit j of its
    eight components in two's complement, the last plane the sign."""
    import numpy as np

    n, dims = vectors.shape
    groups = -(-dims // 8)
    low, high = int(vectors.min(initial=0)), int(vectors.max(initial=0))
    planes = max((-low - 1).bit_length() if low < 0 else 0, high.bit_length()) + 1
    padded = np.zeros((n, groups * 8), np.int64)
    padded[:, :dims] = vectors
    packed = [np.packbits((padded >> j) & 1, axis=1, bitorder="little") for j in range(planes)]
    return np.ascontiguousarray(np.stack(packed).astype(np.uint8).reshape(planes, n, groups).transpose(0, 2, 1))


def scores(sums, planes):
    """(rows, anchors): exact inner products out of look-ups, shifts and additions."""
    import numpy as np

    rows, anchors = planes.shape[2], sums.shape[2]
    total = np.zeros((rows, anchors), sums.dtype)
    found = np.empty((rows, anchors), sums.dtype)
    for j in reversed(range(len(planes))):
        total <<= 1
        for group, table in enumerate(sums):
            np.take(table, planes[j, group], axis=0, out=found, mode="clip")
            if j == len(planes) - 1:
                total -= found
            else:
                total += found
    return total


def narrowest(sums, planes):
    """The tables as 32-bit numbers where no score can exceed them."""
    import numpy as np

    largest = int(np.abs(sums).max(initial=0)) * max(len(sums), 1) << (len(planes) + 1)
    return sums.astype(np.int32) if largest < 1 << 31 else sums


def _scored(anchors, vectors):
    """(first row, first anchor, scores) for blocks of rows and anchors."""
    planes = bit_planes(vectors)
    for a in range(0, len(anchors), ANCHORS_AT_ONCE):
        sums = narrowest(subset_sums(anchors[a : a + ANCHORS_AT_ONCE]), planes)
        for r in range(0, len(vectors), ROWS_AT_ONCE):
            yield r, a, scores(sums, planes[:, :, r : r + ROWS_AT_ONCE])


def _batches(columns: dict):
    import pyarrow as pa

    names, size = list(columns), len(next(iter(columns.values())))
    for start in range(0, size, 65536):
        yield pa.RecordBatch.from_arrays([pa.array(columns[c][start : start + 65536]) for c in names], names=names)


def _positives(rows: DataFrame, anchors, n: int, scale: int) -> DataFrame:
    """The n best rows of each anchor's label, as brought by the tasks."""
    shared = rows.sparkSession.sparkContext.broadcast(anchors)

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        ids, labels, vectors = shared.value
        best = V.Best(len(ids), n)
        for shard in V.shards(batches):
            asked, found = V.same_width(vectors, V.integers(shard.column("vector"), scale))
            own_ids, own_labels = shard.column("vec_id").to_numpy(), shard.column("label").to_numpy()
            for label in np.unique(own_labels):
                mine, theirs = np.flatnonzero(own_labels == label), np.flatnonzero(labels == label)
                for r, a, got in _scored(asked[theirs], found[mine]):
                    cut = got.T >= best.floor[theirs[a : a + got.shape[1]], None]
                    q, row = np.nonzero(cut)
                    question, vec_id, score = theirs[a + q], own_ids[mine[r + row]], got[row, q].astype(np.int64)
                    other = vec_id != ids[question]
                    best.add(question[other], score[other], vec_id[other])
        yield from _batches({"anchor_id": ids[best.question], "vec_id": best.id, "score": best.score})

    return rows.mapInArrow(run, "anchor_id long, vec_id long, score long")


def _negatives(rows: DataFrame, anchors, pairs, n: int, least: int, most: int, scale: int) -> DataFrame:
    """The n best rows of other labels within each positive's range, as brought by
    the tasks.  ``pairs`` are (anchor's number, positive's id, its score)."""
    shared = rows.sparkSession.sparkContext.broadcast((anchors, pairs))

    def run(batches: Iterator) -> Iterator:
        import numpy as np

        (ids, labels, vectors), (anchor, positive, level) = shared.value
        low, high = -((-least * level) // 100), (most * level) // 100
        best = V.Best(len(anchor), n)
        by_anchor = np.argsort(anchor, kind="stable")
        first = np.searchsorted(anchor[by_anchor], np.arange(len(ids) + 1))
        for shard in V.shards(batches):
            asked, found = V.same_width(vectors, V.integers(shard.column("vector"), scale))
            own_ids, own_labels = shard.column("vec_id").to_numpy(), shard.column("label").to_numpy()
            for r, a, got in _scored(asked, found):
                block_ids, block_labels = own_ids[r : r + len(got)], own_labels[r : r + len(got)]
                new = []
                for i in range(got.shape[1]):
                    own = by_anchor[first[a + i] : first[a + i + 1]]
                    if not len(own):
                        continue
                    # What cannot come among the n best of any positive stays out.
                    floors = np.maximum(low[own], best.floor[own])
                    fit = (got[:, i] >= floors.min()) & (got[:, i] <= high[own].max()) & (block_labels != labels[a + i])
                    at = np.flatnonzero(fit)
                    score = got[at, i].astype(np.int64)
                    order = np.argsort(-score, kind="stable")  # rows of a shard are sorted by id
                    at, score = at[order], score[order]
                    starts = np.searchsorted(-score, -high[own])
                    ends = np.minimum(np.searchsorted(-score, -low[own], "right"), starts + n)
                    for pair, start, end in zip(own, starts, ends):
                        if start < end:
                            new.append((np.full(end - start, pair), score[start:end], block_ids[at[start:end]]))
                if new:
                    best.add(*(np.concatenate(parts) for parts in zip(*new)))
        yield from _batches(
            {
                "anchor_id": ids[anchor[best.question]],
                "positive_id": positive[best.question],
                "negative_id": best.id,
                "positive_score": level[best.question],
                "negative_score": best.score,
            }
        )

    return rows.mapInArrow(run, SCHEMA)


SCHEMA = "anchor_id long, positive_id long, negative_id long, positive_score long, negative_score long"


def mine(
    embeddings: DataFrame,
    label: Column,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    least: int = 30,
    most: int = 90,
    scale: int = 256,
    block: int = ANCHORS_PER_BLOCK,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Negatives are rows of another label whose score lies between ``least`` and
    ``most`` hundredths of the positive's, the highest first, then by id."""
    import numpy as np

    own = embeddings.select("vec_id", "embedding", label.cast("long").alias("label"))
    rows = V.taking_part(own, "label")
    mined = None
    for asked in V.question_blocks(rows.where(is_anchor), block):
        ids = asked.column("vec_id").to_numpy()
        anchors = (ids, asked.column("label").to_numpy(), V.integers(asked.column("vector"), scale))
        hits = _positives(rows, anchors, positives, scale)
        # Bounded by the block: some positives for each of its anchors.
        pairs = V.merged(hits, ["anchor_id"], positives).toArrow()
        numbers = np.searchsorted(ids, pairs.column("anchor_id").to_numpy())
        pairs = (numbers, pairs.column("vec_id").to_numpy(), pairs.column("score").to_numpy())
        found = _negatives(rows, anchors, pairs, negatives, least, most, scale)
        found = V.merged(found, ["anchor_id", "positive_id"], negatives, "negative_score", "negative_id")
        part = materialize(found, "negatives")
        mined = part if mined is None else mined.unionByName(part)
    if mined is None:
        mined = rows.sparkSession.createDataFrame([], SCHEMA + ", rank int")
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def shifted_label(every: int = 7, classes: int = 10) -> Column:
    """The label, one further for ids divisible by ``every``."""
    moved = (F.col("label") + 1) % classes
    return F.when(F.col("vec_id") % every == 0, moved).otherwise(F.col("label"))
