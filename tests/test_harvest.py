import datetime as dt
import json

import pytest

from threadloom.plans.harvest import comment_captures, submission_captures
from threadloom.sources import schemas, sinks
from threadloom.sources.captures import read_table

NOW = dt.datetime(2024, 2, 1, 12, 0, 0, tzinfo=dt.UTC)
T0 = int(NOW.timestamp())


def item(i, age=0, **more):
    return ("ja", json.dumps({"id": f"p{i}", "name": f"t3_p{i}", "created_utc": T0 - age, "title": f"T{i}"} | more))


def test_feed(spark, rows, tmp_path):
    path = str(tmp_path / "captures")
    feed = rows([item(1), item(1, score=9), item(2, 7 * 86400), item(3, 7 * 86400 + 1), item(4, 1.5)], "sub string, raw string")
    first = submission_captures(feed, NOW)
    got = {r.sid: (r.created, r.cap14, r.md, r.hms) for r in first.collect()}
    assert got == {
        "p1": (T0, "20240201120000", "0201", "120000"),
        "p2": (T0 - 7 * 86400, "20240201120000", "0125", "120000"),
        "p4": (T0 - 2, "20240201120000", "0201", "115958"),
    }
    assert first.count() == 3
    sinks.write_captures(first, path)
    table = read_table(spark, path, schemas.CAPTURE)
    again = rows([item(1, score=10), item(2, title="new")], "sub string, raw string")
    later = submission_captures(again, NOW + dt.timedelta(seconds=1), 8, table).collect()
    assert [(r.sid, r.cap14) for r in later] == [("p2", "20240201120001")]


@pytest.mark.parametrize("more", [{"id": ""}, {"name": None}, {"created_utc": "5"}, {"created_utc": None}, {"id": 5}, {"created_utc": True}])
def test_feed_with_a_bad_post(rows, more):
    with pytest.raises(Exception, match="without created_utc"):
        submission_captures(rows([item(1, **more)], "sub string, raw string"), NOW).collect()


def tree(*comments):
    nodes = [{"kind": "t1", "data": {"id": i, "parent_id": "t3_p", "created_utc": c, "body": b, "replies": ""}} for i, c, b in comments]
    return json.dumps([{}, {"kind": "Listing", "data": {"children": nodes}}])


def test_trees(spark, rows, tmp_path):
    path = str(tmp_path / "captures")
    schema = "sub string, sid string, created bigint, tree string"

    def harvest(*trees, existing=None):
        return comment_captures(rows([("ja", s, T0, t) for s, t in trees], schema), NOW, existing)

    got = harvest(("p1", tree(("b", 2, "x"), ("a", 2, "y"), ("c", 1, "z"))), ("p2", tree()), ("p3", "{"))
    found = got.rows.orderBy("line_no").collect()
    assert [(r.sid, r.line_no, json.loads(r.raw)["id"]) for r in found] == [("p1", 1, "c"), ("p1", 2, "a"), ("p1", 3, "b")]
    assert [r.sid for r in got.empty.collect()] == ["p2"]
    assert [r.sid for r in got.failed.collect()] == ["p3"]
    sinks.write_captures(got.rows, path)
    table = read_table(spark, path, schemas.CAPTURE)
    assert table.count() == 3
    same = tree(("c", 1, "z"), ("b", 2, "x"), ("a", 2, "y"))
    more = tree(("c", 1, "z"), ("b", 2, "x"), ("a", 2, "y!"))
    assert harvest(("p1", same), existing=table).rows.count() == 0
    assert harvest(("p1", more), existing=table).rows.count() == 3
    assert harvest(("p4", same), existing=table).rows.count() == 3
