import numpy as np
import pytest
from pyspark.sql import functions as F

from threadloom.operators import search as se
from threadloom.operators.cells import build_cells, topk_cells
from threadloom.operators.digests import differing, in_leaves, leaf_digests

SCHEMA = "id string, values array<float>, metadata struct<sub:string>"


def clustered(n, groups, dim=8, seed=1, copies=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dim)) * 4
    rows = centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dim)) * 0.1
    return np.concatenate([rows, np.repeat(rows[:1], copies, axis=0)]).astype(np.float32)


def tables(spark, vectors, every=7):
    rows = [(f"e{i:05d}", v.tolist(), ("s",)) for i, v in enumerate(vectors)]
    index = spark.createDataFrame(rows, SCHEMA)
    asked = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors) if i % every == 0], "query_id long, vector array<float>")
    return index, asked


def found(df):
    return sorted((r.query_id, -r.score, r.id) for r in df.collect())


@pytest.mark.parametrize("metric", se.METRICS)
@pytest.mark.parametrize("case", ["groups", "copies", "one"])
def test_cells_equal_a_whole_scan_and_skip_entries(spark, metric, case):
    vectors = {"groups": clustered(1500, 30), "copies": clustered(400, 8, copies=300), "one": clustered(5, 2)}[case]
    index, asked = tables(spark, vectors)
    report = {}
    got = topk_cells(build_cells(index, metric=metric), asked, 6, report=report, block=64)
    assert found(got) == found(se.topk_batch(index, asked, 6, metric=metric))
    if case == "groups":
        assert report["scored"] < report["pairs"] / 3


def test_cells_of_nothing(spark):
    index, asked = tables(spark, clustered(10, 2))
    empty = build_cells(index.limit(0))
    assert topk_cells(empty, asked, 3).count() == 0
    assert topk_cells(build_cells(index), asked.limit(0), 3).count() == 0


KEYS = "id string, metadata struct<h:string>, y string, md string"


def test_only_leaves_that_differ_are_opened(spark):
    def keys(changed=()):
        return spark.createDataFrame(
            [(f"i{n}", ("new" if n in changed else f"h{n}",), "2024", f"01{n % 28 + 1:02d}") for n in range(3000)], KEYS
        )

    known = leaf_digests(keys())
    assert differing(leaf_digests(keys()), known).count() == 0
    opened = differing(leaf_digests(keys((5, 900))), known)
    assert sorted(r.md for r in opened.collect()) == ["0105", "0106"] or opened.count() == 2
    inside = {r.id for r in in_leaves(keys((5, 900)), opened).collect()}
    assert {"i5", "i900"} <= inside and len(inside) < 60
    assert differing(known, known.limit(0)).count() == known.count()
    assert known.agg(F.sum("n")).first()[0] == 3000
