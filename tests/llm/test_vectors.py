import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F
from threadloom.llm import impact, negatives, vectors

SCHEMA = "score long, label int, vec_id long, rank string, embedding array<float>"


def table(spark, rows):
    return spark.createDataFrame([(1, label, i, "x", v) for i, label, v in rows], SCHEMA)


def parts(rows, scale):
    """id to (whole numbers, label) of the rows that take part."""
    out = {}
    for i, label, v in sorted((r for r in rows if r[0] is not None and r[2] is not None and None not in r[2]), key=lambda r: (r[0], r[2], r[1] is None, r[1])):
        if all(math.isfinite(x) for x in v):
            out.setdefault(i, ([math.floor(scale * float(np.float32(x))) for x in v], label))
    return out


def inner(a, b):
    return sum(x * y for x, y in zip(a, b))


def brute_search(rows, every, k, scale=64):
    own = parts(rows, scale)
    out = []
    for q in own:
        if q % every == 0:
            ranked = sorted((-inner(own[q][0], own[c][0]), c) for c in own if c != q)[:k]
            out += [(q, r + 1, c, -s) for r, (s, c) in enumerate(ranked)]
    return sorted(out)


def brute_negatives(rows, every):
    own = parts([r for r in rows if r[1] is not None], 256)
    own = {i: (v, (label + 1) % 10 if i % 7 == 0 else label) for i, (v, label) in own.items()}
    out = []
    for a in own:
        if a % every:
            continue
        ranked = sorted((-inner(own[a][0], own[c][0]), c) for c in own if c != a)
        same = [(p, -s) for s, p in ranked if own[p][1] == own[a][1]][:5]
        for p, ps in same:
            fit = [(c, -s) for s, c in ranked if own[c][1] != own[a][1] and 30 * ps <= -100 * s <= 90 * ps][:10]
            out += [(a, p, r + 1, c, ps, s) for r, (c, s) in enumerate(fit)]
    return sorted(out)


def made(n, dims=16, seed=1, copies=0, spread=1.0):
    rng = random.Random(seed)
    rows = [(i, rng.randrange(4), [rng.gauss(0, 0.25) * spread for _ in range(dims)]) for i in range(n)]
    same = [0.25] * dims
    return rows + [(n + i, i % 3, same) for i in range(copies)]


ODD = [
    (None, 1, [1.0, 1.0]),
    (0, 1, [0.5, -0.25, 0.125]),
    (0, 1, [0.5, -0.25, 0.125]),
    (0, 2, [0.75, 0.5]),
    (1, None, [0.5, 0.5]),
    (2, 2, None),
    (3, 2, [0.5, None]),
    (4, 2, [float("nan"), 0.5]),
    (5, 2, [float("inf"), 0.5]),
    (6, 1, []),
    (7, 0, [0.5, 0.0, 0.25, 0.75]),
    (8, 1, [0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5, 0.5]),
    (20, 1, [-0.5, -0.5]),
    (100, 1, [0.25, 0.25]),
    (101, 3, [0.125, 0.25]),
    (-20, 4, [0.3, 0.1]),
    (-100, 4, [0.3, 0.1]),
]
CASES = {
    "plain": made(900),
    "copies": made(300, copies=300),
    "odd": ODD,
    "few": made(5),
    "wide": made(400, spread=4000.0),
    "flat": [(i, i % 3, [0.0] * 8) for i in range(200)],
    "narrow": [(i, i % 3, [(i % 5) / 64]) for i in range(300)],
}


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("rows_per_shard", [64, 8192])
def test_search_equals_brute_force(spark, monkeypatch, case, rows_per_shard):
    monkeypatch.setattr(vectors.shards, "__defaults__", (rows_per_shard,))
    rows = CASES[case]
    found = impact.search(table(spark, rows), F.col("vec_id") % 20 == 0, 20, block=17)
    assert sorted(tuple(r) for r in found.collect()) == brute_search(rows, 20, 20)


@pytest.mark.parametrize("case", CASES)
def test_negatives_equal_brute_force(spark, monkeypatch, case):
    monkeypatch.setattr(vectors.shards, "__defaults__", (100,))
    monkeypatch.setattr(negatives, "ANCHORS_AT_ONCE", 3)
    monkeypatch.setattr(negatives, "ROWS_AT_ONCE", 50)
    rows = CASES[case]
    found = negatives.mine(table(spark, rows), negatives.shifted_label(), F.col("vec_id") % 20 == 0, block=9)
    assert sorted(tuple(r) for r in found.collect()) == brute_negatives(rows, 20)


def test_empty_tables(spark):
    empty = table(spark, [])
    assert impact.search(empty, F.col("vec_id") % 20 == 0, 20).count() == 0
    assert negatives.mine(empty, negatives.shifted_label(), F.col("vec_id") % 20 == 0).count() == 0


def test_scores_beyond_64_bits_are_an_error(spark):
    with pytest.raises(Exception, match="too large"):
        impact.search(table(spark, [(0, 1, [1e30]), (1, 1, [1.0])]), F.col("vec_id") == 0, 3).collect()


def test_table_look_ups_are_inner_products():
    rng = np.random.default_rng(3)
    for dims, size in ((1, 2), (8, 1), (13, 200), (64, 1 << 20)):
        a = rng.integers(-size, size + 1, (7, dims))
        b = rng.integers(-size, size + 1, (31, dims))
        planes = negatives.bit_planes(b)
        sums = negatives.narrowest(negatives.subset_sums(a), planes)
        assert (negatives.scores(sums, planes) == b @ a.T).all()


def test_bounds_leave_out_no_member_and_most_others():
    rng = np.random.default_rng(5)
    rows = np.floor(64 * rng.normal(0, 0.125, (4000, 64))).astype(np.int64)
    index = impact.Segments(np.arange(4000), rows)
    none, left = np.zeros(4000, bool), 0
    for q in range(40):
        possible, read = index.possible(rows[q], 20, np.iinfo(np.int64).min, none)
        scores = rows @ rows[q]
        assert set(np.flatnonzero(scores >= np.sort(scores)[-20])) <= set(possible.tolist())
        assert read < 4000 * 64
        left += len(possible)
    assert left < 40 * 4000 / 10


def test_a_group_reads_a_segment_once_and_finds_what_each_question_does():
    rng = np.random.default_rng(8)
    rows = np.floor(64 * rng.normal(0, 0.125, (3000, 40))).astype(np.int64)
    rows[:, 20:] *= rng.random((3000, 20)) < 0.1  # lists, and columns with zeros
    rows[:7] = 0
    index, asked = impact.Segments(np.arange(3000), rows), rows[:90]
    floors = np.full(90, np.iinfo(np.int64).min)
    floors[50:] = 3000
    own = np.arange(90)[:, None] == np.arange(3000)
    assert {len(r[0]) for r in index.rounds} & set(range(1, 40)) and any(r[2] for r in index.rounds)
    found = index.possible_of(asked, 20, floors, own)
    for q, (possible, read) in enumerate(found):
        alone, read_alone = index.possible(asked[q], 20, floors[q], own[q])
        assert possible.tolist() == alone.tolist() and read == read_alone
        scores = np.where(own[q], np.iinfo(np.int64).min, rows @ asked[q])
        least = max(floors[q], np.sort(scores)[-20])
        assert set(np.flatnonzero(scores >= least)) <= set(possible.tolist()) and q not in possible


def test_segments_of_large_components_keep_every_member():
    rng = np.random.default_rng(6)
    rows = np.floor(rng.normal(0, 5000, (3000, 24))).astype(np.int64)
    index = impact.Segments(np.arange(3000), rows)
    assert index.shift > 0
    for q in range(30):
        scores = rows @ rows[q]
        possible, _ = index.possible(rows[q], 10, np.iinfo(np.int64).min, np.arange(3000) == q)
        scores[q] = np.iinfo(np.int64).min
        assert set(np.flatnonzero(scores >= np.sort(scores)[-10])) <= set(possible.tolist())
