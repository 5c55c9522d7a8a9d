import json

import pytest
from pyspark.sql import functions as F

from threadloom.sources import schemas, sinks
from threadloom.sources.captures import read_table
from threadloom.streaming.incremental import append_available, capture_stream, narrow_stream, upsert_available


def put(root, day, sid, cap, hash, lines, kind="comments"):
    folder = root / "r_ja" / kind / "2024" / day / f"120000_{sid}"
    folder.mkdir(parents=True, exist_ok=True)
    (folder / f"{cap}_{hash}.jsonl").write_text("".join(json.dumps(x) + "\n" for x in lines))


def run(spark, root, out, marks):
    rows = narrow_stream(capture_stream(spark, str(root), "comments"), "comments")
    append_available(rows, out, marks).awaitTermination()
    return read_table(spark, out, schemas.NARROW)


def test_only_new_captures_are_read(spark, tmp_path):
    root, out, marks = tmp_path / "raw", str(tmp_path / "narrow"), str(tmp_path / "marks")
    put(root, "0131", "p1", "20240201000000", "a" * 64, [{"id": "c1", "body": "x"}, {"body": "no id"}])
    put(root, "0131", "p1", "2024", "a" * 64, [{"id": "bad name"}])
    put(root, "0131", "p1", "20240201000000", "a" * 64, [{"id": "p1", "title": "t"}], "submissions")
    assert run(spark, root, out, marks).count() == 1
    assert run(spark, root, out, marks).count() == 1
    put(root, "0102", "p0", "20240301000000", "b" * 64, [{"id": "c2"}, {"id": "c3", "parent_id": "t1_c2"}])
    rows = {r.comment_id: r for r in run(spark, root, out, marks).collect()}
    assert set(rows) == {"c1", "c2", "c3"}
    assert (rows["c3"].md, rows["c3"].sid, rows["c3"].h16, rows["c3"].parent_id) == ("0102", "p0", "b" * 16, "t1_c2")


def test_stream_of_upserts(spark, tmp_path):
    root, source = str(tmp_path / "index"), tmp_path / "vectors"
    schema = schemas.INDEX + ", seq int"

    def batch(data):
        rows = [(i, [v], ("r", "j", "s", "x", None, "h"), "2024", "0101", n) for n, (i, v) in enumerate(data)]
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").json(str(source))
        stream = spark.readStream.schema(schema).json(str(source))
        upsert_available(stream, root, str(tmp_path / "marks"), seq="seq").awaitTermination()
        got = sinks.read_current(spark, root).select("id", F.col("values")[0].alias("v"))
        return {r.id: r.v for r in got.collect()}

    assert batch([("a", 1.0), ("b", 1.0), ("a", 2.0)]) == {"a": 2.0, "b": 1.0}
    assert batch([("b", 3.0)]) == {"a": 2.0, "b": 3.0}
    assert batch([]) == {"a": 2.0, "b": 3.0}


def test_a_line_that_is_not_json_stops_the_stream(spark, tmp_path):
    root = tmp_path / "raw"
    put(root, "0131", "p1", "20240201000000", "a" * 64, [{"id": "c1"}])
    (root / "r_ja/comments/2024/0131/120000_p1" / f"20240202000000_{'b' * 64}.jsonl").write_text("{broken\n")
    with pytest.raises(Exception, match="FAILED_READ_FILE"):
        run(spark, root, str(tmp_path / "out"), str(tmp_path / "marks"))
    rows = narrow_stream(capture_stream(spark, str(root), "comments", strict=False), "comments")
    append_available(rows, str(tmp_path / "out2"), str(tmp_path / "marks2")).awaitTermination()
    assert read_table(spark, str(tmp_path / "out2"), schemas.NARROW).count() == 1
