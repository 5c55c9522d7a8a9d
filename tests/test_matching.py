import pytest

from threadloom.operators import ranking
from threadloom.operators.captures import latest_versions

KEYED = "a string, b string, text string"


@pytest.mark.parametrize("limit", [0, 3, 100])
def test_matching_keeps_what_a_semi_join_keeps(rows, monkeypatch, limit):
    monkeypatch.setattr(ranking, "SENT_ALONG_KEYS", limit)
    data = [(f"k{i % 9}", "x" if i % 2 else "y", f"t{i}") for i in range(40)] + [(None, "x", "n"), ("k1", None, "n"), ("k1", "x", "t1")]
    df = rows(data, KEYED)
    for keys in ([], ["k1"], ["k0", "k1", "k1", "k2"], [f"k{i}" for i in range(9)], ["k1", None]):
        wanted = rows([(k, b) for k in keys for b in ("x", None)], "a string, b string")
        want = sorted(t for a, b, t in data if a is not None and a in keys and b == "x")
        got = ranking.matching(df, wanted, ["a", "b"])
        assert sorted(r.text for r in got.collect()) == want and got.columns == df.columns


def test_texts_of_a_first_run_are_not_shuffled(spark, rows):
    """Where few versions are superseded, only keys go through a shuffle."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        data = [("a", "k", f"s{i}", "2024", "0101", "00", f"{c}", "h", f"text {i} {c}") for i in range(200) for c in range(1 + (i < 5))]
        df = rows(data, "sub string, kind string, sid string, y string, md string, hms string, cap14 string, h16 string, text string")
        got = latest_versions(df)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
        assert got.count() == 200 and got.where("cap14 = '0'").count() == 195
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("blocks", [0, 100])
def test_rows_of_files_are_matched_at_their_places(spark, rows, monkeypatch, tmp_path, blocks):
    """Between few keys and nearly all of them, no row of a scan is shuffled."""
    monkeypatch.setattr(ranking, "SENT_ALONG_KEYS", 0)
    monkeypatch.setattr(ranking, "SENT_ALONG_BLOCKS", blocks)
    data = [(f"k{i % 9}", "x" if i % 2 else None, f"t{i}") for i in range(700)]
    rows(data, KEYED).repartition(3).write.parquet(str(tmp_path / "t"))
    scan = spark.read.schema(KEYED).parquet(str(tmp_path / "t"))
    wanted = rows([(k, b) for k in ("k1", "k1", "k2", "k5", "none") for b in ("x", None)], "a string, b string")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got, in_place = ranking.matching_in_place(ranking.with_place(scan), wanted, ["a", "b"])
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert in_place == (blocks > 0) == ("SortMergeJoin" not in plan and "Exchange hashpartitioning" not in plan)
        want = sorted(t for a, b, t in data if a in ("k1", "k2", "k5") and b == "x")
        assert sorted(r.text for r in got.collect()) == want
        assert got.columns == ["a", "b", "text", *ranking.PLACE]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
