import json
import random

import numpy as np
import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from threadloom.operators import index as ix, search as se
from threadloom.sources import schemas

DIM = 8


def entries(n, seed=0, copies=0):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        v = [round(rng.uniform(-1, 1), 3) for _ in range(DIM)]
        if i < copies:
            v = [0.5] * DIM
        out.append((f"r:s:x:{rng.randrange(10**9):09d}", v, ("r", f"sub{i % 3}", "s" if i % 2 else "c", f"s{i % 7}", None, "h")))
    return out


def brute(data, q, k, metric="cosine"):
    q = np.asarray(q, float)

    def score(v):
        v = np.asarray(np.asarray(v, np.float32), float)
        if metric == "dot":
            return round(float(v @ q), 9)
        norm = np.linalg.norm(v) * np.linalg.norm(q)
        return round(float(v @ q / norm), 9) if norm else 0.0

    return sorted(((-score(v), id) for id, v, _ in data))[:k]


def pairs(df):
    return [(-r.score, r.id) for r in df.collect()]


@pytest.mark.parametrize("metric", ["cosine", "dot"])
@pytest.mark.parametrize("k", [1, 10, 700])
def test_topk_is_exact(rows, metric, k):
    data = entries(500, copies=170)  # a third of the rows are copies of one vector
    q = [0.3, -0.2, 0.9, 0.1, 0.0, 0.4, -0.7, 0.2]
    got = pairs(se.topk(rows(data, schemas.VECTOR).repartition(5), q, k, metric=metric))
    expected = brute(data, q, k, metric)
    assert [i for _, i in got] == [i for _, i in expected]
    assert np.allclose([s for s, _ in got], [s for s, _ in expected], atol=1e-9)


def test_topk_ties_go_by_id(rows):
    data = entries(300, copies=300)
    got = pairs(se.topk(rows(data, schemas.VECTOR).repartition(4), [1.0] * DIM, 20))
    assert [i for _, i in got] == sorted(i for i, _, _ in data)[:20]


def test_zero_vectors_and_wrong_lengths(rows):
    md = ("r", "a", "s", "x", None, "h")
    df = rows([("z", [0.0, 0.0], md), ("a", [1.0, 0.0], md), ("b", [-1.0, 0.0], md)], schemas.VECTOR)
    assert pairs(se.topk(df, [1.0, 0.0], 5)) == [(-1.0, "a"), (0.0, "z"), (1.0, "b")]
    assert pairs(se.topk(df, [0.0, 0.0], 5)) == [(0.0, "a"), (0.0, "b"), (0.0, "z")]
    with pytest.raises(Exception, match="vector length"):
        se.topk(df, [1.0, 0.0, 0.0], 5).collect()
    with pytest.raises(Exception, match="vector length 2, expected 3"):
        ix.check_dim(df, 3).collect()
    assert ix.check_dim(df, 2).count() == 3
    with pytest.raises(Exception, match="vector length -1"):
        ix.check_dim(rows([("z", None, md)], schemas.VECTOR), 2).collect()


@pytest.mark.parametrize("copies", [100, 400])
def test_copies_do_not_pile_up(copies):
    import pyarrow as pa

    data = entries(400, seed=5, copies=copies)
    ids = [i for i, _, _ in data]
    matrix = np.asarray([v for _, v, _ in data])
    asked = np.asarray([[1.0] * DIM, [-1.0] * DIM, [0.1, 0.9] * 4])
    best = se._Best(3, 6)
    for start in range(0, 400, 90):
        rows = pa.table({"id": ids[start : start + 90]})
        scores = se._score(asked, matrix[start : start + 90], "cosine")
        best.add(scores, rows)
        assert len(best.query) <= 18
    out = pa.Table.from_batches(best.batch(["query_id", "id", "score"], pa.array(["a", "b", "c"]))).to_pylist()
    for name, q in zip("abc", asked):
        scores = se._score(q[None, :], matrix, "cosine")[0]
        expected = sorted(zip(-scores, ids))[:6]
        assert [r["id"] for r in out if r["query_id"] == name] == [i for _, i in expected]


@pytest.mark.parametrize("metric", se.METRICS)
@pytest.mark.parametrize("odd", [float("nan"), float("inf"), -float("inf")])
def test_numbers_that_are_not_finite_are_errors(rows, metric, odd):
    data = entries(40)
    data[7] = (data[7][0], [odd, *data[7][1][1:]], data[7][2])
    with pytest.raises(Exception, match="not finite"):
        se.topk(rows(data, schemas.VECTOR), [1.0] * DIM, 3, metric=metric).collect()
    with pytest.raises(ValueError, match="not finite"):
        se.topk_batch(rows(entries(5), schemas.VECTOR), rows([("q", data[7][1])], "query_id string, vector array<float>"), 3, metric=metric)


@pytest.mark.parametrize("block", [5, 100])
def test_batch_in_blocks(rows, monkeypatch, block):
    monkeypatch.setattr(se, "QUERIES_AT_ONCE", 10)
    data = entries(400, seed=2, copies=130)
    asked = [(f"q{i}", v) for i, (_, v, _) in enumerate(entries(23, seed=9))]
    queries = rows(asked, "query_id string, vector array<float>")
    got = se.topk_batch(rows(data, schemas.VECTOR).repartition(3), queries, 7, block=block)
    assert got.columns == ["query_id", "id", "score", "metadata"]
    by_query = {}
    for r in got.collect():
        by_query.setdefault(r.query_id, []).append((-r.score, r.id))
    assert len(by_query) == 23
    for name, q in asked:
        expected = brute(data, np.asarray(q, np.float32), 7)
        assert [i for _, i in sorted(by_query[name])] == [i for _, i in expected]


def test_batch_without_questions(rows):
    empty = rows([], "query_id int, vector array<float>")
    got = se.topk_batch(rows(entries(5), schemas.VECTOR), empty, 3)
    assert got.count() == 0 and got.columns == ["query_id", "id", "score", "metadata"]


def test_filter(rows):
    df = rows(entries(60), schemas.VECTOR)
    got = se.topk(df, [1.0] * DIM, 100, filter='{"sub": "sub1", "t": {"$eq": "s"}}')
    assert got.count() == 10
    assert {(r.metadata["sub"], r.metadata["t"]) for r in got.collect()} == {("sub1", "s")}
    assert se.topk(df, [1.0] * DIM, 5, filter={"sub": "none"}).count() == 0
    for bad in ("{", "[1]", '{"sub": {"$gt": 1}}', '{"nope": 1}', '{"sub": null}', '{"sub": ["a"]}'):
        with pytest.raises(ValueError):
            se.topk(df, [1.0] * DIM, 5, filter=bad)


def test_bad_arguments(rows):
    df = rows(entries(3), schemas.VECTOR)
    with pytest.raises(ValueError):
        se.topk(df, [1.0] * DIM, 0)
    with pytest.raises(ValueError):
        se.topk(df, [1.0] * DIM, 3, metric="l2")


def test_filter_and_columns_reach_the_scan(spark, rows, tmp_path):
    wide = rows(entries(60), schemas.VECTOR).withColumn("other", F.lit("x" * 50))
    wide.write.parquet(str(tmp_path / "index"))
    plan = plan_of(se.topk(spark.read.parquet(str(tmp_path / "index")), [1.0] * DIM, 5, filter={"sub": "sub1"}))
    assert "EqualTo(metadata.sub,sub1)" in plan
    assert "other" not in plan.split("ReadSchema")[1]
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan
    diff = ix.changed(rows([], "id string, text string, metadata " + schemas.METADATA), spark.read.parquet(str(tmp_path / "index")))
    assert "values" not in plan_of(diff) and "CartesianProduct" not in plan_of(diff)


def test_projection(rows):
    hits = se.topk(rows(entries(9), schemas.VECTOR), [1.0] * DIM, 3, columns=["metadata", "values"])
    assert se.project_hits(hits, "none").columns == ["id", "score"]
    assert se.project_hits(hits, "all", values=True).columns == ["id", "score", "metadata", "values"]
    assert se.project_hits(hits, "indexed").schema["metadata"].dataType.names == ["src", "sub", "t"]
    with pytest.raises(ValueError):
        se.project_hits(hits, "some")


def hit(id, score, sid):
    return ("q", id, score, ("r", "a", "s", sid, None, "h"))


HITS = "query_id string, id string, score double, metadata " + schemas.METADATA


def test_dedup(rows):
    data = [hit("b", 0.9, "x"), hit("a", 0.9, "x"), hit("c", 0.5, "y"), hit("d", 0.8, ""), hit("e", 0.7, None), hit("x", 0.6, "")]
    df = rows(data, HITS)
    assert sorted(r.id for r in se.dedup_hits(df).collect()) == ["a", "c", "d", "e", "x"]
    assert sorted(r.id for r in se.dedup_hits(df, drop_missing_sid=True).collect()) == ["a", "c"]
    ranked = {r.id: r["rank"] for r in se.rank_hits(df).collect()}
    assert ranked == {"a": 1, "b": 2, "d": 3, "e": 4, "x": 5, "c": 6}


def test_render(rows):
    ranked = se.rank_hits(rows([hit("a", 0.5, "x"), hit("b", 0.25, "y")], HITS)).withColumn(
        "text", F.when(F.col("id") == "a", "  line\n two ").otherwise("")
    )
    lines = [r.line for r in se.render_hits(ranked, "pretty", "text").orderBy("rank").collect()]
    assert lines[0] == '1. score=0.500000 id=a\n{"src":"r","sub":"a","t":"s","sid":"x","h":"h"}\nline\n two\n\n'
    assert lines[1] == '2. score=0.250000 id=b\n{"src":"r","sub":"a","t":"s","sid":"y","h":"h"}\n\n'
    lines = [r.line for r in se.render_hits(ranked, "snippet", "text").orderBy("rank").collect()]
    assert lines == ["1. score=0.500000 id=a\n line two \n\n", "2. score=0.250000 id=b\n\n\n"]
    first = json.loads(se.render_hits(ranked, "jsonl", "text").orderBy("rank").first().line)
    assert (first["id"], first["score"], first["excerpt"]) == ("a", 0.5, "  line\n two ")


def test_diff(rows):
    docs = [(i, "t", ("r", "a", "s", i, None, f"h{i}")) for i in ("new", "same", "other", "empty", "null")]
    known = [("same", "hsame"), ("other", "x"), ("empty", ""), ("null", None), ("gone", "y")]
    index = rows([(i, [1.0], ("r", "a", "s", i, None, h)) for i, h in known], schemas.VECTOR)
    docs = rows(docs, "id string, text string, metadata " + schemas.METADATA)
    assert sorted(r.id for r in ix.changed(docs, index).collect()) == ["empty", "new", "null", "other"]
    assert [r.id for r in ix.plan_index(docs, index, 2).orderBy("id").collect()] == ["empty", "new"]
    assert [r.id for r in ix.stale_ids(index, docs).collect()] == ["gone"]
    batch = ix.changed(docs, index).select("id", F.array(F.lit(2.0).cast("float")).alias("values"), "metadata")
    after = ix.upsert(index, batch)
    assert ix.changed(docs, after).count() == 0
    assert after.count() == 6


def test_many_small_blocks_share_a_scan(rows, monkeypatch):
    scans = []
    whole = se._task_topk
    monkeypatch.setattr(se, "_task_topk", lambda *given: scans.append(len(given[1])) or whole(*given))
    data = entries(60, seed=3)
    queries = rows([(i, v) for i, (_, v, _) in enumerate(entries(23, seed=9))], "query_id int, vector array<float>")
    got = se.topk_batch(rows(data, schemas.VECTOR), queries, 3, block=2)
    assert got.count() == 69 and scans == [23]


def test_candidates_of_some_questions_are_merged_by_score_and_id():
    import pyarrow as pa

    rng = np.random.default_rng(4)
    scores, ids = rng.integers(0, 9, (6, 50)).astype(float), [f"i{n:03d}" for n in rng.permutation(50)]
    best, part = se._Best(9, 4), np.array([0, 2, 3, 5, 7, 8])
    for start in (0, 20, 40):
        table = pa.table({"id": ids[start : start + 20]})
        q, r = best.candidates(scores[:, start : start + 20], table.column("id"), part)
        best.merge(part[q], scores[q, start + r], table, r)
    out = pa.Table.from_batches(best.batch(["query_id", "id", "score"], pa.array(range(9)))).to_pylist()
    for q, row in zip(part, scores):
        want = [i for _, i in sorted(zip(-row, ids))[:4]]
        assert [r["id"] for r in out if r["query_id"] == q] == want
        assert best.floor[q] == np.sort(row)[-4]
