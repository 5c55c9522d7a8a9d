import json
import re
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import DataFrameWriter
from pyspark.sql import functions as F

from threadloom.operators import ranking
from threadloom.plans.import_dump import import_files, lie_by_day
from threadloom.plans.parameters import QuestionParameters, RefreshParameters, SearchParameters
from threadloom.plans.refresh import refresh
from threadloom.plans.search import answer, rag_context, search, search_question
from threadloom.operators.context import PromptTemplate
from threadloom.sources import schemas, sinks
from threadloom.sources.captures import lookback, read_table

cloudpickle.register_pickle_by_value(sys.modules[__name__])

NOW = 1735689600


def embed(texts):
    """Three numbers per text: how many of three letters it has."""
    return [[float(t.count(c)) + 0.01 for c in "abc"] for t in texts]


def write(path, items):
    path.write_text("".join((x if isinstance(x, str) else json.dumps(x, ensure_ascii=False)) + "\n" for x in items), "utf-8")
    return str(path)


def post(i, **more):
    return {"id": f"p{i}", "subreddit": "ja", "created_utc": 1706702400 + i, "title": f"T{i}", "selftext": "a" * i} | more


def said(i, p, **more):
    return {"id": f"c{i}", "link_id": f"t3_{p}", "parent_id": f"t3_{p}", "subreddit": "r/ja", "created_utc": 10 + i, "body": "b" * i} | more


@pytest.fixture
def dumps(tmp_path):
    posts = [post(1, retrieved_on=1706800000), post(2, retrieved_utc="soon"), post(2), "junk", "", [1], post(3, created_utc=0)]
    posts += [post(4, subreddit="", subreddit_name_prefixed="r/other"), post(5, subreddit=None), post(6, id="")]
    posts += [post(1, retrieved_on=1706800000), post(1, created_utc=1706702300)]
    one = [said(1, "p1"), said(3, "p1", parent_id="t1_c1"), said(2, "p1", retrieved_utc=1706900000), said(1, "p1", body="dup")]
    one += [said(9, "lost"), said(8, "p1", link_id=5), said(7, "p1", id=None), said(6, "p2", subreddit=" ")]
    two = [said(4, "p1", retrieved_utc=1706900001.5), said(5, "p2")]
    return [
        write(tmp_path / "x_posts.jsonl", posts),
        write(tmp_path / "x_comments.jsonl", one),
        write(tmp_path / "y_comments.jsonl", two),
    ]


def test_import(spark, dumps, tmp_path):
    path = str(tmp_path / "captures")
    done = import_files(spark, dumps, path, NOW)
    table = read_table(spark, path, schemas.CAPTURE)
    posts = table.where("kind = 'submissions'").orderBy("sid", "cap14").collect()
    assert [(r["sub"], r.sid, r.cap14, r.created) for r in posts] == [
        ("ja", "p1", "20240201150640", 1706702401),
        ("ja", "p2", "20240131120002", 1706702402),
        ("other", "p4", "20250101000000", 1706702404),
    ]
    assert (posts[0].y, posts[0].md, posts[0].hms) == ("2024", "0131", "120001")
    rows = table.where("kind = 'comments'").orderBy("sid", "line_no").collect()
    # p1: one thread over two files, its earliest creation, its newest retrieval.
    assert [(r.sid, r.line_no, json.loads(r.raw)["id"], r.cap14) for r in rows] == [
        ("p1", 1, "c3", "20240202185321"),
        ("p1", 2, "c1", "20240202185321"),
        ("p1", 3, "c2", "20240202185321"),
        ("p1", 4, "c4", "20240202185321"),
        ("p2", 1, "c5", "20250101000000"),
    ]
    assert json.loads(rows[1].raw)["body"] == "b"
    assert rows[0].created == 1706702300 and len({r.hash for r in rows}) == 2
    assert [tuple(r) for r in done.orphans.collect()] == [("ja", "lost")]
    before = table.count()
    import_files(spark, dumps, path, NOW + 100)
    after = read_table(spark, path, schemas.CAPTURE)
    # A post without a retrieval time is the same capture at any time.
    assert after.count() == before


def test_import_of_a_grown_thread(spark, dumps, tmp_path):
    path = str(tmp_path / "captures")
    import_files(spark, dumps, path, NOW)
    more = write(tmp_path / "z_comments.jsonl", [said(10, "p2", retrieved_utc=NOW + 5)])
    import_files(spark, [*dumps, more], path, NOW)
    rows = read_table(spark, path, schemas.CAPTURE).where("kind = 'comments' and sid = 'p2'")
    assert sorted((r.cap14, r.line_no) for r in rows.collect()) == [
        ("20250101000000", 1), ("20250101000005", 1), ("20250101000005", 2),
    ]


PARAMS = RefreshParameters(lookback_days=0, dim=3, zstd_level=3)


def paths(tmp_path):
    return {n: str(tmp_path / n) for n in ("captures", "narrow", "index", "store")}


def index_of(spark, p):
    return {r.id: r.metadata["h"] for r in sinks.read_current(spark, p["index"]).collect()}


def test_import_stats(spark, dumps, tmp_path):
    path = str(tmp_path / "captures")

    def run(now):
        done = import_files(spark, dumps, path, now)
        return {(r["sub"], r.kind): (r.threads, r.files, r.wrote, r.skipped, r.empty) for r in done.stats.collect()}

    first = run(NOW)
    rows = {(r["sub"], r.kind, r.sid, r.hash) for r in read_table(spark, path, schemas.CAPTURE).collect()}
    threads = {r[:3] for r in rows}
    idle = {(s, "comments", t) for s, k, t in threads if k == "submissions" and (s, "comments", t) not in threads}
    expected = {}
    for group in {r[:2] for r in threads | idle} | {(None, None)}:
        inside = lambda r: group == (None, None) or r[:2] == group
        n, empty = sum(map(inside, rows)), sum(map(inside, idle))
        expected[group] = (sum(map(inside, threads)) + empty, n, n, 0, empty)
    assert first == expected and first[None, None][4] > 0
    assert run(NOW + 100) == {g: (t, n, 0, n, e) for g, (t, n, _, _, e) in expected.items()}


def test_refresh(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    first = refresh(spark, embed=embed, params=PARAMS, **p)
    opened = first.pop("opened")
    assert opened > 0
    assert first == {"converted": 5, "documents": 8, "vectors": 8, "failed": 0, "deferred": 0}
    index = index_of(spark, p)
    assert set(index) == {"r:s:ja:p1", "r:s:ja:p2", "r:s:other:p4", *[f"r:c:ja:c{i}" for i in range(1, 6)]}
    nothing = {"converted": 0, "documents": 8, "vectors": 0, "failed": 0, "deferred": 0, "opened": 0}
    assert refresh(spark, embed=embed, params=PARAMS, **p) == nothing

    changed = write(tmp_path / "n_posts.jsonl", [post(2, title="new title", retrieved_utc=NOW + 9)])
    import_files(spark, [changed], p["captures"], NOW)
    assert refresh(spark, embed=embed, params=PARAMS, **p)["vectors"] == 1
    after = index_of(spark, p)
    assert {k for k in after if after[k] != index[k]} == {"r:s:ja:p2"}

    store = read_table(spark, p["store"], schemas.STORE)
    assert store.count() == 9 and store.select("key").distinct().count() == 9
    keys = {r.key for r in store.collect()}
    assert {f"reddit/v1/r/s/ja/p2/{h['r:s:ja:p2']}.txt" for h in (index, after)} <= keys


def test_refresh_without_news_reads_no_text(spark, dumps, tmp_path, monkeypatch):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    refresh(spark, embed=embed, params=PARAMS, **p)
    plans, write = [], DataFrameWriter.parquet

    def watched(writer, path, *args, **kwargs):
        plans.append(writer._df._jdf.queryExecution().executedPlan().toString())
        return write(writer, path, *args, **kwargs)

    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    assert refresh(spark, embed=embed, params=PARAMS, **p)["opened"] == 0
    assert plans
    for plan in plans:
        for column in ("body", "title", "raw", "text", "values"):
            assert f"{column}:" not in "".join(re.findall(r"ReadSchema: \S+", plan)), plan


def test_texts_stay_where_they_are_read(spark, dumps, tmp_path, monkeypatch):
    """With more keys than are sent along, and several versions of a post, only the
    store's rows are dealt anew."""
    more = [post(2, retrieved_utc=1706800000 + i, title=f"v{i}") for i in range(5)]
    files = [*dumps, write(tmp_path / "z_posts.jsonl", more)]
    plans, write_ = [], DataFrameWriter.parquet

    def watched(writer, path, *args, **kwargs):
        plans.append((path, writer._df._jdf.queryExecution().executedPlan().toString()))
        return write_(writer, path, *args, **kwargs)

    want = paths(tmp_path / "want")
    import_files(spark, files, want["captures"], NOW)
    refresh(spark, embed=embed, params=PARAMS, **want)
    monkeypatch.setattr(DataFrameWriter, "parquet", watched)
    monkeypatch.setattr(ranking, "SENT_ALONG_KEYS", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    p = paths(tmp_path)
    try:
        import_files(spark, files, p["captures"], NOW)
        refresh(spark, embed=embed, params=PARAMS, **p)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    posts = next(plan for path, plan in plans if path == p["captures"])
    narrow = next(plan for path, plan in plans if path == p["narrow"])
    embedded = next(plan for path, plan in plans if "/embedded-" in path)
    stored = next(plan for path, plan in plans if path == p["store"])
    for plan in (posts, narrow, embedded, stored):
        assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan
    assert not re.search(r"(?<!Broadcast)Exchange", posts + narrow)
    for name, schema in (("captures", schemas.CAPTURE), ("narrow", schemas.NARROW), ("store", schemas.STORE)):
        rows = [sorted(map(repr, read_table(spark, q[name], schema).collect())) for q in (want, p)]
        assert rows[0] == rows[1] and rows[0]
    assert index_of(spark, p) == index_of(spark, want)


def test_many_small_days_lie_by_year(spark, tmp_path, monkeypatch):
    """The folders and files of a refresh do not grow with its days, and its tables and
    counts are those of a layout by day."""
    days = 24
    posts = [post(i, created_utc=1702598400 + 86400 * i, retrieved_on=1735000000) for i in range(days)]
    comments = [said(i, f"p{i}", retrieved_on=1735000000) for i in range(5, days, 5)]
    files = [write(tmp_path / "a_posts.jsonl", posts), write(tmp_path / "a_comments.jsonl", comments)]
    later = [post(i, created_utc=1702598400 + 86400 * i, retrieved_on=1735000001, title="new") for i in range(0, days, 10)]
    later = write(tmp_path / "b_posts.jsonl", later)
    window = RefreshParameters(lookback_days=10, dim=3, zstd_level=3)
    seen = []
    for few, name in ((days - 1, "year"), (days, "day")):
        monkeypatch.setattr(sinks, "FEW_DAYS", few)
        p = paths(tmp_path / name)
        import_files(spark, files, p["captures"], NOW)
        runs = [refresh(spark, embed=embed, params=window, as_of="2024-01-05", **p)]
        n_files = sum(1 for n in ("captures", "narrow") for _ in (tmp_path / name / n).rglob("*.parquet"))
        assert n_files <= 12 if name == "year" else n_files >= days + 11
        import_files(spark, [later], p["captures"], NOW)
        runs.append(refresh(spark, embed=embed, params=PARAMS, **p))
        assert sinks.lies_by(spark, p["narrow"]) == (schemas.YEARLY if name == "year" else schemas.PARTITIONS)
        schema = (("captures", schemas.CAPTURE), ("narrow", schemas.NARROW), ("store", schemas.STORE))
        rows = {n: sorted(map(repr, read_table(spark, p[n], s).collect())) for n, s in schema}
        seen.append(([(r["converted"], r["documents"], r["vectors"]) for r in runs], rows, index_of(spark, p)))
    assert seen[0] == seen[1]
    assert seen[0][0] == [(13, 13, 13), (18, 28, 16)]
    table = read_table(spark, str(tmp_path / "year" / "narrow"), schemas.NARROW)
    plan = lookback(table, 10, "2024-01-05")._jdf.queryExecution().executedPlan().toString()
    assert "y#" in re.search(r"PartitionFilters: \[(.*?)\], PushedFilters", plan).group(1)
    assert "md" in re.search(r"PushedFilters: (.*)", plan).group(1)


def test_a_day_that_is_not_known_is_the_same_in_both_layouts(spark, tmp_path):
    rows = [("ja", "p1", "", None, "20240101000000", "a", 1, "{}", "submissions", y, md) for y, md in (("", ""), ("2024", "0101"))]
    got = []
    for by in (schemas.PARTITIONS, schemas.YEARLY):
        sinks.write_captures(spark.createDataFrame(rows, schemas.CAPTURE), str(tmp_path / by[-1]), by=by)
        got.append(sorted(map(repr, read_table(spark, str(tmp_path / by[-1]), schemas.CAPTURE).collect())))
        assert sinks.lies_by(spark, str(tmp_path / by[-1])) == by
    assert got[0] == got[1] and len(got[0]) == 2


def test_large_days_keep_their_folders():
    assert sinks.partitions_for(sinks.FEW_DAYS, 1) == schemas.PARTITIONS
    assert sinks.partitions_for(5000, 5000 * sinks.DAY_ROWS) == schemas.PARTITIONS
    assert sinks.partitions_for(5000, 5000) == schemas.YEARLY


def test_posts_out_of_order_are_dealt_by_day(spark, tmp_path):
    """Files that would each write a file for every day are not written as they lie."""
    rows = [(f, i, 86400 * day) for f in range(4) for i, day in enumerate(range(10))]
    placed = spark.createDataFrame(rows, "_file long, _row long, created long")
    assert not lie_by_day(placed) and lie_by_day(placed.where("created div 86400 div 3 = _file"))


def test_refresh_compares_again_after_another_writer(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    refresh(spark, embed=embed, params=PARAMS, **p)
    before = index_of(spark, p)
    row = sinks.read_current(spark, p["index"]).where("id = 'r:s:ja:p1'")
    other = row.withColumn("metadata", F.col("metadata").withField("h", F.lit("other"))).withColumn("version", F.lit("9"))
    sinks.upsert_table(spark, p["index"], other)
    assert index_of(spark, p)["r:s:ja:p1"] == "other"
    got = refresh(spark, embed=embed, params=PARAMS, **p)
    # The other writer's version is higher, so its record stays; the leaf is opened.
    assert (got["vectors"], got["opened"] > 0) == (1, True)
    assert {k: v for k, v in index_of(spark, p).items() if k != "r:s:ja:p1"} == {k: v for k, v in before.items() if k != "r:s:ja:p1"}


def test_refresh_hashes_rows_that_were_written_without(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    refresh(spark, embed=embed, params=PARAMS, **p)
    old = read_table(spark, p["narrow"], schemas.NARROW).withColumn("h", F.lit(None).cast("string"))
    again = p | {"narrow": str(tmp_path / "old")}
    sinks.write_narrow(old, again["narrow"])
    got = refresh(spark, embed=embed, params=PARAMS, **again)
    assert (got["converted"], got["documents"], got["vectors"]) == (0, 8, 0)


def test_a_batch_that_is_run_again_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "index")

    def batch(value, version):
        row = ("a", [value], ("r", "j", "s", "x", None, "h"), "2024", "0101", version)
        return spark.createDataFrame([row], schemas.INDEX + ", version string")

    def now():
        return [r["values"][0] for r in sinks.read_current(spark, root).collect()]

    first = sinks.number_of_epoch(spark, root, "marks", 0)
    sinks.upsert_table(spark, root, batch(1.0, None), number=first)
    assert now() == [1.0]
    sinks.upsert_table(spark, root, batch(2.0, None))
    assert sinks.number_of_epoch(spark, root, "marks", 0) == first
    sinks.upsert_table(spark, root, batch(1.0, None), number=first)
    assert now() == [2.0]
    sinks.upsert_table(spark, root, batch(3.0, "20240101-b"))
    sinks.upsert_table(spark, root, batch(4.0, "20240101-a"))
    assert now() == [3.0]
    number = sinks.number_of_epoch(spark, root, "marks", 1)
    for _ in range(2):
        sinks.upsert_table(spark, root, batch(5.0, "20240102-a"), number=number)
    assert now() == [5.0]


def test_refresh_with_a_budget_goes_on(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    small = RefreshParameters(lookback_days=0, dim=3, max_vectors=3, zstd_level=3)
    runs = [refresh(spark, embed=embed, params=small, **p) for _ in range(4)]
    assert [(r["vectors"], r["deferred"]) for r in runs] == [(3, 5), (3, 2), (2, 0), (0, 0)]
    assert len(index_of(spark, p)) == 8


def test_refresh_window_and_subs(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    window = RefreshParameters(lookback_days=2, dim=3, zstd_level=3)
    assert refresh(spark, embed=embed, params=window, as_of="2024-02-03", **p)["documents"] == 0
    got = refresh(spark, embed=embed, params=window, as_of="2024-02-02", subs=["other"], **p)
    assert got["documents"] == 1
    assert set(index_of(spark, p)) == {"r:s:other:p4"}


def test_refresh_stops_on_a_wrong_dimension(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    with pytest.raises(Exception, match="vector length 3, expected 4"):
        refresh(spark, embed=embed, params=RefreshParameters(lookback_days=0, dim=4, zstd_level=3), **p)
    assert sinks.read_current(spark, p["index"]).count() == 0


def test_refresh_keeps_what_the_model_did(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)

    def limited(texts):
        if any("bbbb" in t for t in texts):
            raise RuntimeError("429")
        return embed(texts)

    params = RefreshParameters(lookback_days=0, dim=3, zstd_level=3, embed_batch=1, retries=0)
    got = refresh(spark, embed=limited, params=params, **p)
    assert got["vectors"] + got["failed"] == 8 and got["failed"] >= 2
    assert refresh(spark, embed=embed, params=PARAMS, **p)["vectors"] == got["failed"]


@pytest.fixture
def corpus(spark, dumps, tmp_path):
    p = paths(tmp_path)
    import_files(spark, dumps, p["captures"], NOW)
    refresh(spark, embed=embed, params=PARAMS, **p)
    index = sinks.read_current(spark, p["index"])
    staged = read_table(spark, p["narrow"], schemas.NARROW)
    return index, read_table(spark, p["store"], schemas.STORE), staged


def test_search(corpus):
    index, store, staged = corpus
    got = search(index, [0.0, 1.0, 0.0], SearchParameters(topk=3, with_text=True), store=store).orderBy("rank").collect()
    assert [r.id for r in got] == ["r:c:ja:c5", "r:c:ja:c4", "r:c:ja:c3"]
    assert [r.text for r in got] == ["bbbbb", "bbbb", "bbb"]
    params = SearchParameters(topk=2, with_text=True, max_chars=2, metadata="none", lookback_days=7)
    got = search(index, [1.0, 0.0, 0.0], params, staged=staged, as_of="2024-02-02").orderBy("rank").collect()
    assert [(r.id, r.excerpt) for r in got] == [("r:s:other:p4", "T4"), ("r:s:ja:p2", "T2")]
    assert got[0].asDict().keys() == {"id", "score", "rank", "excerpt"}
    got = search(index, [1.0, 0.0, 0.0], params, staged=staged, as_of="2025-02-02").collect()
    assert [r.excerpt for r in got] == ["", ""]
    with pytest.raises(ValueError):
        search(index, [1.0, 0.0, 0.0], params)
    params = SearchParameters(topk=1)
    assert [r.id for r in search_question(index, " bbbbb ", embed, params, filter={"t": "c"}).collect()] == ["r:c:ja:c5"]
    with pytest.raises(ValueError, match="blank question"):
        search_question(index, " ", embed)

    def limited(texts):
        raise RuntimeError("429")

    with pytest.raises(RuntimeError, match="not embedded: 429"):
        search_question(index, "q", limited, retries=1, backoff_ms=1)


def test_questions(spark, corpus):
    index, store, staged = corpus
    asked = spark.createDataFrame([(1, " aaa "), (2, "bbb")], "query_id int, question string")

    def generate(prompts):
        return [f" {p.count('SOURCE')} sources for {p.splitlines()[-1]} " for p in prompts]

    params = QuestionParameters(topk=8, max_docs=2, drop_missing_sid=True, budget=4096, style="source")
    answers, sources = answer(index, asked, embed, generate, params, store=store)
    assert {r.query_id: r.answer for r in answers.collect()} == {1: "2 sources for aaa", 2: "2 sources for bbb"}
    got = sorted((r.query_id, r["rank"], r.sid) for r in sources.collect())
    assert got == [(1, 1, "p4"), (1, 2, "p2"), (2, 1, "p1"), (2, 2, "p2")]
    blank = spark.createDataFrame([(1, "  ")], "query_id int, question string")
    with pytest.raises(Exception, match="blank question"):
        answer(index, blank, embed, generate, store=store)


def test_context_from_staged_rows(spark, corpus):
    index, _, staged = corpus
    asked = spark.createDataFrame([(1, "q", [0.0, 1.0, 0.0])], "query_id int, question string, vector array<float>")
    params = QuestionParameters(topk=20, max_docs=2, doc_max_chars=3)
    prompts, sources = rag_context(index, asked, params, staged=staged, template=PromptTemplate(separator="\n-----\n"))
    (row,) = prompts.collect()
    lines = row.prompt.split("\n")
    assert row.n_blocks == 2 and lines[0].startswith("[1] id=r:c:ja:c5 ") and lines[1:3] == ["bbb", "-----"]
    assert lines[3].startswith("[2] id=r:c:ja:c4 ") and lines[-2] == "q"
    assert sources.where(F.col("pid") == "t3_p2").count() == 1
