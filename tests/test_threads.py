import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from threadloom.operators import captures as cp, narrow as nw, ranking, stats, threads as th


def test_first_and_last(rows):
    df = rows([("a", 2, "x"), ("a", 1, "y"), ("b", 5, None), ("b", 6, "z")], "k string, n int, v string")
    assert sorted(map(tuple, ranking.first_by(df, ["k"], ["n"]).collect())) == [("a", 1, "y"), ("b", 5, None)]
    assert sorted(map(tuple, ranking.last_by(df, ["k"], ["n"]).collect())) == [("a", 2, "x"), ("b", 6, "z")]


def brute_positions(data):
    out, seen = [], {}
    for g, o in sorted(data):
        seen[g] = seen.get(g, 0) + 1
        out.append((g, o, seen[g]))
    return out


def test_positions_of_a_skewed_group(rows):
    rng = random.Random(3)
    data = [("hot" if rng.random() < 0.4 else f"g{rng.randrange(200)}", n) for n in rng.sample(range(10**6), 5000)]
    got = ranking.positions(rows(data, "g string, o int"), ["g"], ["o"], partitions=7)
    assert sorted(map(tuple, got.collect())) == brute_positions(data)


def test_positions_over_everything(rows):
    data = [(f"{i * 7919 % 3001:05d}",) for i in range(3001)]
    got = ranking.positions(rows(data, "o string"), [], ["o"], partitions=5).collect()
    assert sorted(map(tuple, got)) == [(f"{i:05d}", i + 1) for i in range(3001)]


def test_ranges_split_one_group(rows):
    df = rows([("hot", i) for i in range(4000)], "g string, o int")
    sizes = df.repartitionByRange(8, "g", "o").groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 8 and max(r["count"] for r in sizes) < 1500


@pytest.mark.parametrize("n", [1, 5, 999, 1000, 1001, 1777, 2999, 3000, 3001, 10**6])
def test_take_lowest(rows, n):
    ids = [f"r:s:x:{i:06d}" for i in range(3000)]
    random.Random(1).shuffle(ids)
    got = ranking.take_lowest(rows([(i,) for i in ids], "id string"), "id", n)
    assert sorted(r.id for r in got.collect()) == sorted(ids)[:n]


def test_take_lowest_zero_is_all(rows):
    assert ranking.take_lowest(rows([("a",), ("b",)], "id string"), "id", 0).count() == 2


def test_dedup_comments_keeps_the_first_in_file_order(rows):
    data = [("j", "p", "c1", "f2", 1, "late"), ("j", "p", "c1", "f1", 9, "first"), ("j", "q", "c1", "f3", 1, "other thread")]
    data += [("j", "p", None, "f1", 1, "no id"), ("j", "p", "", "f1", 2, "empty id")]
    df = rows(data, "sub string, post_id string, id string, f string, n int, body string")
    got = th.dedup_comments(df, ["f", "n"])
    assert sorted((r.post_id, r.body) for r in got.collect()) == [("p", "first"), ("q", "other thread")]


def test_comment_order(rows):
    data = [("c3", None, "5"), ("c1", "t3_p", "2.5"), ("c2", "t3_p", "2.25"), ("c0", "t3_p", "x"), ("c9", "t3_p", "2.5")]
    df = rows([("j", "p", *d) for d in data], "sub string, post_id string, id string, parent_id string, created_utc string")
    got = th.comment_order(df)
    assert [r.id for r in got.orderBy("pos").collect()] == ["c3", "c0", "c2", "c1", "c9"]


def test_capture_times(rows):
    data = [("p", "100"), ("p", "300.9"), ("p", "soon"), ("q", None), ("r", "-5"), ("lost", "7")]
    df = rows([("j", p, x) for p, x in data], "sub string, post_id string, x string")
    df = df.withColumn("retrieved", th.retrieved_epoch(F.col("x"), F.lit(None).cast("string")))
    posts = rows([("j", p, 50) for p in "pqr"], "sub string, post_id string, created bigint")
    got = {r.post_id: r.captured for r in th.thread_capture_times(df, posts, 999).collect()}
    assert got == {"p": 300, "q": 999, "r": 50}


def test_captures_a_b_a(rows):
    data = [("j", "s", "p", "1", "A"), ("j", "s", "p", "2", "B"), ("j", "s", "p", "3", "A"), ("j", "s", "q", "1", "A")]
    df = rows(data, "sub string, kind string, sid string, cap14 string, hash string")
    got = sorted((r.sid, r.hash, r.cap14, r.n_captures) for r in cp.distinct_captures(df).collect())
    assert got == [("p", "A", "1", 2), ("p", "B", "2", 1), ("q", "A", "1", 1)]
    seen = rows([("j", "s", "p", "0", "B")], "sub string, kind string, sid string, cap14 string, hash string")
    assert sorted((r.sid, r.hash) for r in cp.new_captures(df, seen).collect()) == [("p", "A"), ("q", "A")]
    assert cp.new_captures(df, df).count() == 0


@pytest.mark.parametrize("partitions", [1, 7])
def test_changed_captures(rows, partitions):
    states = "ABAABBBA" * 40
    data = [("j", "s", "p", f"{i:04d}", h) for i, h in enumerate(states)]
    data += [("j", "s", "q", "1", "A"), ("j", "s", "q", "1", "A"), ("j", "s", "q", "1", "B"), ("j", "s", "r", None, None), ("j", "s", "r", "1", None)]
    data += [("j", "s", None, "1", "A"), ("j", "s", None, "2", "A")]
    df = rows(data, "sub string, kind string, sid string, cap14 string, hash string").repartition(3)
    got = cp.changed_captures(df, partitions=partitions).collect()
    wanted = [f"{i:04d}" for i, h in enumerate(states) if not i or h != states[i - 1]]
    assert sorted(r.cap14 for r in got if r.sid == "p") == wanted
    assert sorted((r.sid or "", r.cap14 or "", r.hash) for r in got if r.sid != "p") == [("", "1", "A"), ("q", "1", "A"), ("q", "1", "B"), ("r", "", None)]
    assert cp.changed_captures(df.limit(0)).count() == 0


def test_latest_capture_in_one_second(rows):
    df = rows([("j", "p", "1", "A", 1), ("j", "p", "1", "B", 2)], "sub string, sid string, cap14 string, hash string, n int")
    assert [r.n for r in cp.latest_capture(df).collect()] == [2]


VERSIONS = "sub string, kind string, sid string, y string, md string, hms string, cap14 string, h16 string, n int"


def test_latest_versions(rows):
    old = ("j", "c", "p", "2024", "0101", "000000", "20240101000000", "ff")
    new = ("j", "c", "p", "2024", "0101", "000000", "20240102000000", "aa")
    moved = ("j", "c", "q", "2024", "0102", "000000", "20240101000000", "aa")
    before = ("j", "c", "q", "2024", "0101", "000000", "20240109000000", "aa")
    df = rows([(*old, 1), (*old, 2), (*new, 3), (*new, 4), (*moved, 5), (*before, 6)], VERSIONS)
    assert sorted(r.n for r in cp.latest_versions(df).collect()) == [3, 4, 5]


def test_valid_posts(rows):
    data = [("a", "5", "j"), ("", "5", "j"), (None, "5", "j"), ("b", "x", "j"), ("c", "0", "j"), ("d", "-1", "j")]
    data += [("e", None, "j"), ("f", "5", ""), ("g", "1.9", "j"), ("h", "0.9", "j")]
    df = rows(data, "id string, created_utc string, sub string")
    assert [r.id for r in nw.valid_posts(df).collect()] == ["a", "g"]
    with pytest.raises(Exception, match="lacks a required field"):
        nw.valid_posts(df, mode="fail").collect()
    with pytest.raises(ValueError):
        nw.valid_posts(df, mode="warn")


def test_harvested_posts(rows):
    good = rows([("a", "t3_a", "0")], "id string, name string, created_utc string")
    assert nw.harvested_posts(good).count() == 1
    bad = rows([("a", None, "5")], "id string, name string, created_utc string")
    with pytest.raises(Exception, match="without created_utc"):
        nw.harvested_posts(bad).collect()


def test_links(rows):
    df = rows([("t3_abc",), ("t1_abc",), (None,), ("t3_a_b",), ("t3",)], "link_id string")
    assert [r.post_id for r in nw.link_filter(df).collect()] == ["abc", "a_b"]


def test_since_is_pushed_down(spark):
    import datetime as dt

    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = plan_of(nw.since(df, dt.datetime(2024, 1, 31), 7, "ts"))
    assert "GreaterThanOrEqual(ts,2024-01-24T00:00" in plan
    epochs = spark.range(10).withColumnRenamed("id", "created")
    assert nw.since(epochs, dt.datetime(1970, 1, 2, 0, 0, 5, tzinfo=dt.UTC), 1).count() == 5


def test_run_stats(rows):
    data = [("a", "c", 3, 1, 2, 0), ("a", "c", 0, 0, 0, 1), ("b", "s", 1, 1, 0, 0)]
    df = rows(data, "sub string, kind string, files int, wrote int, skipped int, empty int")
    got = {(r["sub"], r.kind): (r.threads, r.files, r.wrote, r.skipped, r.empty) for r in stats.run_stats(df).collect()}
    assert got == {("a", "c"): (2, 3, 1, 2, 1), ("b", "s"): (1, 1, 1, 0, 0), (None, None): (3, 4, 2, 2, 1)}


def test_counted(rows):
    df, seen = stats.counted(rows([(1,), (2,), (3,)], "n int"), "c", large=F.col("n") > 1)
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 3, "large": 2}


def test_aggregates_combine_before_the_shuffle(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    rows_ = df.select(F.col("user_id").alias("sid"), F.lit("x").alias("sub"), F.sha2("props", 256).alias("row_hash"))
    plan = plan_of(th.thread_fingerprints(rows_, thread=["sub", "sid"]))
    assert "partial_sum" in plan and "SortAggregate" not in plan and "collect" not in plan
    plan = plan_of(ranking.first_by(df.select("user_id", "ts", "props"), ["user_id"], ["ts"]))
    assert "partial_min" in plan and "Window" not in plan and "min_by" not in plan


def test_winners_are_found_over_keys_alone(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/events.parquet").select("user_id", "ts", "event_id", "props")
    plan = plan_of(ranking.last_by(df, ["user_id"], ["ts", "event_id"]))
    assert "SemiJoin" in plan or "LeftSemi" in plan
    assert all("props" not in line for line in plan.splitlines() if "Aggregate" in line)
