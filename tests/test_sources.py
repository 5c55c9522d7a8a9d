import json
import random

import pytest
from conftest import plan_of
from pyspark.sql import functions as F

from threadloom.operators import narrow as nw
from threadloom.sources import captures as sc, dumps, schemas, sinks

H = "a" * 64


def put(root, rel, lines):
    path = root / rel
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("".join(x + "\n" for x in lines), encoding="utf-8")


@pytest.fixture
def tree(tmp_path):
    post = json.dumps({"id": "p1", "author": "ann", "title": "T", "selftext": "B", "extra": {"x": 1}})
    put(tmp_path, f"r_ja/submissions/2024/0131/120000_p1/20240201000000_{H}.jsonl", [post, '{"id": "second"}'])
    said = [json.dumps({"id": f"c{i}", "parent_id": "t3_p1", "body": f"b{i}"}) for i in range(5)]
    put(tmp_path, f"r_ja/comments/2024/0131/120000_p1/20240201000000_{'b' * 64}.jsonl", [*said, '{"body": "no id"}'])
    (tmp_path / "r_ja/comments/2024/0131/120000_p1/EMPTY.txt").write_text("no_comments")
    return tmp_path


def test_read_captures(spark, tree):
    got = sc.read_captures(spark, f"{tree}/r_ja/submissions", "submissions")
    keyed = sc.with_path_keys(got)
    narrow = nw.narrow_submissions(keyed, nw.CAPTURE_KEYS, sc.FILE_ORDER).collect()
    assert len(narrow) == 1
    row = narrow[0].asDict()
    assert (row["sub"], row["y"], row["md"], row["hms"], row["sid"]) == ("ja", "2024", "0131", "120000", "p1")
    assert (row["author"], row["title"], row["body"], row["hash"]) == ("ann", "T", "B", H)


def test_read_captures_strict(spark, tmp_path):
    put(tmp_path, "x.jsonl", ['{"id": "a"}', "{broken"])
    with pytest.raises(Exception, match="Malformed|MALFORMED"):
        sc.read_captures(spark, str(tmp_path), "comments").collect()
    assert [r.id for r in sc.read_captures(spark, str(tmp_path), "comments", strict=False).collect()] == ["a"]


def test_captures_from_tree(spark, tree):
    rows = sc.captures_from_tree(spark, str(tree)).orderBy("kind", "line_no").collect()
    assert [(r.kind, r.line_no) for r in rows] == [("comments", i) for i in range(1, 7)] + [("submissions", 1), ("submissions", 2)]
    assert rows[0].created == 1706702400
    assert [json.loads(r.raw).get("id") for r in rows[:6]] == ["c0", "c1", "c2", "c3", "c4", None]


def test_a_large_capture_file(spark, tree, monkeypatch):
    put(tree, f"r_ja/comments/2024/0131/120000_p9/20240201000000_{H}.jsonl", [f'{{"id": "d{i}"}}' for i in range(500)])
    monkeypatch.setattr(sc.positions, "__defaults__", ("pos", 4))
    rows = sc.captures_from_tree(spark, str(tree)).where("sid = 'p9'").orderBy("line_no").collect()
    assert [(r.line_no, json.loads(r.raw)["id"]) for r in rows] == [(i + 1, f"d{i}") for i in range(500)]


def test_trees_within_a_lookback(spark, tree):
    put(tree, f"r_ja/comments/2024/0115/120000_p0/20240201000000_{H}.jsonl", ['{"id": "old"}'])
    assert sc.captures_from_tree(spark, str(tree)).count() == 9
    assert sc.captures_from_tree(spark, str(tree), 5, "2024-02-02").count() == 8
    assert sc.captures_from_tree(spark, str(tree), 5, "2024-03-02").count() == 0
    assert sc.staged_from_tree(spark, str(tree), 5, "2024-03-02").count() == 0


@pytest.mark.parametrize("name", ["2024020100000_x.jsonl", "20240201000000.jsonl", "2024020100000a_ff.jsonl"])
def test_names_out_of_layout(spark, tree, name):
    put(tree, f"r_ja/comments/2024/0131/120000_p1/{name}", ['{"id": "z"}'])
    lines = sc.read_captures(spark, str(tree), "comments")
    assert sc.with_path_keys(lines, mode="skip").where("id = 'z'").count() == 0
    with pytest.raises(Exception, match="out of layout"):
        sc.with_path_keys(lines, mode="fail").collect()


def test_staged_tree(spark, tmp_path):
    folder = tmp_path / "r_ja/submissions/2024/0131"
    folder.mkdir(parents=True)
    import pyarrow as pa
    import pyarrow.parquet as pq

    pq.write_table(pa.table({"author": ["a"], "body": ["b"], "title": ["t"]}), folder / "120000_p1_20240201000000_abcd.parquet")
    pq.write_table(pa.table({"author": ["a"], "body": ["b"], "title": ["t"]}), folder / "12000_p1_2024_abcd.parquet")
    folder = tmp_path / "r_ja/comments/2024/0131"
    folder.mkdir(parents=True)
    comments = pa.table({"author": ["a"], "body": ["b"], "comment_id": ["c"], "parent_id": ["p"]})
    pq.write_table(comments, folder / "120000_p1_20240201000000_ABCD.parquet")
    rows = sc.staged_from_tree(spark, str(tmp_path)).orderBy("kind").collect()
    assert [(r.kind, r.sid, r.h16, r.title, r.comment_id) for r in rows] == [
        ("comments", "p1", "ABCD", None, "c"),
        ("submissions", "p1", "abcd", "t", None),
    ]


def test_tolerant_lines(spark, tmp_path):
    lines = ['{"a":1}', "", "   ", "{bad", "[1]", '"text"', "7", "null", '{"a":1}}', '{"a":1} {"a":2}', '{"a":1},{"a":2}']
    lines += ['{"a":1,"a":2}', ' {"a":"é"} ', '{"a":1}], "b":[2', '{"a":{"a":3}}']
    put(tmp_path, "d.jsonl", lines)
    rows = dumps.read_dump(spark, str(tmp_path / "d.jsonl"))
    got = [r[0] for r in rows.orderBy(*sc.FILE_ORDER).select(F.to_json("obj")).collect()]
    good = []
    for line in lines:
        try:
            obj = json.loads(line)
        except ValueError:
            continue
        if isinstance(obj, dict):
            good.append(json.dumps(obj, separators=(",", ":"), ensure_ascii=False))
    assert got == good


def damaged_lines(n, seed):
    """JSON of all kinds, with characters put in or left out."""
    rng = random.Random(seed)
    texts = ["", "a", "é", "　", '"q"', "\\", "日本", "😀", "]}", '],"threadloom_end":0}']
    marks = ["{", "}", "[", "]", ",", ":", '"', "0", "e", "\\", " ", "\t", "\x01", "-", ".", "t", "null", "//", "'", "　", "\ufeff"]

    def value(depth):
        kind = rng.randrange(6)
        if kind == 0 or depth > 3:
            return rng.choice([0, 1, -5, 1.5, 10**25, -0.0, 1e-7, True, False, None])
        if kind == 1:
            return rng.choice(texts)
        if kind == 2:
            return [value(depth + 1) for _ in range(rng.randrange(4))]
        return {rng.choice(texts): value(depth + 1) for _ in range(rng.randrange(4))}

    for _ in range(n):
        line = json.dumps(value(0), ensure_ascii=rng.random() < 0.5)
        for _ in range(rng.randrange(4)):
            at = rng.randrange(len(line) + 1)
            line = line[:at] + (rng.choice(marks) + line[at:] if rng.random() < 0.6 else line[at + 1 :])
        yield line


def test_damaged_lines(rows):
    lines = list(damaged_lines(5000, 4))
    df = rows(list(enumerate(lines)), "i int, raw string").repartition(4)
    got = {r.i for r in dumps.parse_lines(df).select("i").collect()}
    good = set()
    for i, line in enumerate(lines):
        try:
            if isinstance(json.loads(line.strip()), dict):
                good.add(i)
        except ValueError:
            pass
    assert got == good and 500 < len(good) < 4500


def test_bytes_that_are_not_utf8(spark, tmp_path):
    (tmp_path / "d.jsonl").write_bytes(b'{"a":"x\xff\xfey"}\n\xe3\x80\x80{"a":"\xe6\x97\xa5"}\n{"a":"\xef\xbf\xbd"}\n')
    rows = dumps.read_dump(spark, str(tmp_path / "d.jsonl")).orderBy(*sc.FILE_ORDER)
    got = [r[0] for r in rows.select(F.try_variant_get("obj", "$.a", "string")).collect()]
    assert got == ["xy", "日", "\ufffd"]


def test_file_order_over_splits(spark, tmp_path):
    put(tmp_path, "d.jsonl", [json.dumps({"n": i, "pad": "x" * 200}) for i in range(2000)])
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        rows = dumps.read_dump(spark, str(tmp_path / "d.jsonl"))
        assert rows.rdd.getNumPartitions() > 4
        got = rows.orderBy(*sc.FILE_ORDER).select(F.try_variant_get("obj", "$.n", "int")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert [r[0] for r in got] == list(range(2000))


def test_split_paths():
    posts, comments = dumps.split_paths(["/d/x_comments.jsonl", "/d/x_posts.jsonl", "/d/readme"])
    assert (posts, comments) == (["/d/x_posts.jsonl"], ["/d/x_comments.jsonl"])
    with pytest.raises(ValueError, match="no \\*_posts"):
        dumps.split_paths(["/d/x_comments.jsonl"])


def narrow_rows(rows):
    days = [("0130", "a"), ("0131", "a"), ("0201", "b")]
    data = [("ja", "submissions", "2024", md, "000000", s + md, "20240201000000", "ff", "x", "t", "b") for md, s in days]
    return rows(
        data,
        "sub string, kind string, y string, md string, hms string, sid string, cap14 string, h16 string, "
        "author string, title string, body string",
    )


def test_lookback_prunes_partitions(spark, rows, tmp_path):
    path = str(tmp_path / "narrow")
    sinks.write_narrow(narrow_rows(rows), path)
    table = sc.read_table(spark, path, schemas.NARROW)
    kept = sc.lookback(table, 1, "2024-02-01")
    assert sorted(r.md for r in kept.collect()) == ["0131", "0201"]
    assert "PartitionFilters: [((y" in plan_of(kept) or "md#" in plan_of(kept).split("PartitionFilters")[1].split("]")[0]
    assert kept._jdf.queryExecution().executedPlan().toString().count("FileScan") == 1
    assert sc.lookback(table, 0).count() == 3
    import glob

    assert glob.glob(path + "/kind=submissions/y=2024/md=0131/*.zstd.parquet")


def test_write_captures_once(spark, rows, tmp_path):
    data = [("ja", "p1", "000000", 1, "20240101000000", h, 1, "{}", "submissions", "2024", "0101") for h in ("a", "b")]
    path = str(tmp_path / "captures")
    sinks.write_captures(rows(data, schemas.CAPTURE), path)
    sinks.write_captures(rows([*data, (*data[0][:5], "c", *data[0][6:])], schemas.CAPTURE), path)
    assert sorted(r.hash for r in sc.read_table(spark, path, schemas.CAPTURE).collect()) == ["a", "b", "c"]


def records(rows, *data):
    return rows([(i, [v], ("r", "j", "s", "x", None, h), "2024", md) for i, v, h, md in data], schemas.INDEX)


def test_vector_table(spark, rows, tmp_path):
    root = str(tmp_path / "index")

    def now():
        got = sinks.read_current(spark, root).collect()
        return {(r.id, r.metadata.h, r.md) for r in got}

    assert now() == set()
    first = records(rows, ("a", 1.0, "h1", "0101"), ("b", 1.0, "h1", "0102"), ("c", 1.0, "h1", "0103"))
    one = sinks.upsert_table(spark, root, first)
    opened = sinks.read_current(spark, root)
    files = {p for p in (tmp_path / "index").rglob("*.parquet")}
    assert sinks.upsert_table(spark, root, records(rows, ("b", 2.0, "h2", "0102"), ("d", 2.0, "h2", "0104"))) > one
    assert now() == {("a", "h1", "0101"), ("b", "h2", "0102"), ("c", "h1", "0103"), ("d", "h2", "0104")}
    assert opened.count() == 3  # a reader keeps what it opened
    # What was written stays; an entry may move to another day.
    assert files < {p for p in (tmp_path / "index").rglob("*.parquet")}
    sinks.upsert_table(spark, root, records(rows, ("c", 3.0, "h3", "0101")))
    assert now() == {("a", "h1", "0101"), ("b", "h2", "0102"), ("c", "h3", "0101"), ("d", "h2", "0104")}
    sinks.upsert_table(spark, root, records(rows))
    # A batch that is written twice, as after a lost job, changes nothing.
    for _ in range(2):
        sinks.upsert_table(spark, root, records(rows, ("a", 4.0, "h4", "0101")))
    assert ("a", "h4", "0101") in now() and len(now()) == 4
    assert sinks.read_current(spark, root).count() == 4
    sinks.compact_table(spark, root, str(tmp_path / "compact"))
    packed = sinks.read_if_there(spark, str(tmp_path / "compact"), schemas.INDEX)
    assert {(r.id, r.metadata.h, r.md) for r in packed.collect()} == now() and packed.count() == 4
    with pytest.raises(ValueError, match="there already"):
        sinks.compact_table(spark, root, str(tmp_path / "compact"))


def test_the_last_record_of_a_batch_counts(spark, rows, tmp_path):
    root = str(tmp_path / "index")
    batch = records(rows, ("a", 1.0, "h1", "0101"), ("a", 2.0, "h2", "0101")).withColumn("seq", F.col("values")[0])
    sinks.upsert_table(spark, root, batch, seq="seq")
    assert [r.metadata.h for r in sinks.read_current(spark, root).collect()] == ["h2"]


def test_vector_records_as_json(spark, rows, tmp_path):
    df = rows([("a", [1.0, 0.5], ("r", "j", "s", "x", None, "h1"))], schemas.VECTOR)
    sinks.write_vectors(df.withColumn("other", F.lit(1)), str(tmp_path / "v"))
    (line,) = [r.value for r in spark.read.text(str(tmp_path / "v")).collect()]
    assert json.loads(line) == {
        "id": "a", "values": [1.0, 0.5], "metadata": {"src": "r", "sub": "j", "t": "s", "sid": "x", "h": "h1"},
    }
