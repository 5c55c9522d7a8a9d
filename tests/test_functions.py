import datetime as dt
import hashlib
import json

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from threadloom.functions import fingerprints, ids, text, times

BLANKS = [chr(i) for i in range(0x110000) if chr(i).isspace()]


def values(df):
    return [r[0] for r in df.collect()]


@pytest.mark.parametrize("blank", BLANKS)
def test_strip_knows_every_blank(blank):
    assert blank in text.BLANKS


def test_strip(spark, rows):
    given_ = [None, "", "   ", "　日本　", "\xa0a b\x85", "\x1cx\x1f", "a \t b", "​z", "﻿q"]
    df = rows([(x,) for x in given_], "x string")
    assert values(df.select(text.strip_text("x"))) == [(x or "").strip() for x in given_]


@settings(max_examples=20, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.text(), st.text()), min_size=1, max_size=30), st.integers(1, 12))
def test_document_text_like_python(spark, pairs, n):
    pairs = [(a.replace("\x00", ""), b.replace("\x00", "")) for a, b in pairs]
    pairs = [tuple(x.encode("utf-8", "ignore").decode() for x in p) for p in pairs]

    def whole(title, body):
        t, b = title.strip(), body.strip()
        return f"{t}\n\n{b}" if t and b else t or b

    df = spark.createDataFrame(pairs, "a string, b string").withColumn("d", text.compose_document("a", "b"))
    got = df.select("d", text.truncate_text("d", n).alias("c"), text.content_hash("d").alias("h")).collect()
    for (a, b), row in zip(pairs, got):
        expected = whole(a, b)
        assert row.d == expected
        assert row.c == expected[:n]
        assert row.h == hashlib.sha256(expected.encode()).hexdigest()[:16]


def test_compose_with_nulls(rows):
    df = rows([("t", None), (None, "b"), (None, None), (" ", "\n"), (" t ", " b ")], "a string, b string")
    assert values(df.select(text.compose_document("a", "b"))) == ["t", "b", "", "", "t\n\nb"]


def test_truncate_counts_code_points(rows):
    df = rows([("ab😀cd",), ("日本語",), ("abc",)], "x string")
    assert values(df.select(text.truncate_text("x", 3))) == ["ab😀", "日本語", "abc"]
    assert values(df.select(text.truncate_text("x", 0))) == ["ab😀cd", "日本語", "abc"]


def test_snippet_and_message(rows):
    df = rows([("a \n　 b" + "x" * 200,), (None,), ("  ",)], "x string")
    assert values(df.select(text.snippet("x"))) == [("a b" + "x" * 200)[:120], "", " "]
    assert values(df.select(text.bounded_message("x", 5))) == ["a \n　 ", "（空）", "（空）"]


def test_norm_sub(rows):
    df = rows([(" r/ja",), ("R_ja",), ("r/r_x",), ("",), (None,), ("r_r/x",), ("r/ y ",), ("rx",)], "x string")
    assert values(df.select(ids.norm_sub("x"))) == ["ja", "ja", "x", "", "", "r/x", "y", "rx"]


def test_parse_ids(rows):
    df = rows([("r:s:ja:abc",), ("r:x:ja:a",), ("a:b",), ("r:c:ja:x:y",), ("",), (None,), ("q:s:ja:a",)], "x string")
    got = values(df.select(ids.parse_document_id("x")))
    assert got[0].asDict() == {"src": "r", "t": "s", "sub": "ja", "doc": "abc"}
    assert got[1:] == [None] * 6
    last = values(df.select(ids.comment_id_of("x", F.lit("c"))))
    assert last[:4] == ["abc", "a", "b", "y"] and last[4] == ""
    assert values(df.limit(1).select(ids.comment_id_of("x", F.lit("s")))) == [""]


def test_object_keys(rows):
    df = rows([("s", "ja", "abc", "ff")], "t string, sub string, i string, h string")
    args = [F.col(c) for c in ("t", "sub", "i", "h")]
    assert values(df.select(ids.object_key(*args, prefix=" /a/b/ "))) == ["a/b/r/s/ja/abc/ff.txt"]
    assert values(df.select(ids.object_key(*args, prefix=""))) == ["r/s/ja/abc/ff.txt"]
    assert values(df.select(ids.object_key_of_hit(F.lit("r:s:ja:abc"), F.lit("")))) == [""]
    assert values(df.select(ids.object_key_of_hit(F.lit("r:z:ja:abc"), F.col("h")))) == [""]


def python_epoch(x):
    try:
        return int(float(x))
    except (TypeError, ValueError, OverflowError):
        return None


def test_lenient_epoch_like_python(rows):
    texts = ["1700000000.9", "1700000000", "0", "-1", "-1.9", "x", "", " 12 ", "1e3", ".5", "5.", "1.0d", "1f", "0x10"]
    texts += ["nan", "inf", "1,5", None, "+7", "　8　"]
    df = rows([(t,) for t in texts], "x string")
    assert values(df.select(times.lenient_epoch("x"))) == [python_epoch(t) for t in texts]


def test_stamps(rows):
    df = rows([(1704067200,), (0,), (-5,), (None,), (1709251199,)], "e bigint")
    assert values(df.select(times.stamp14("e"))) == ["20240101000000", "", "", "", "20240229235959"]
    parts = times.utc_parts("e")
    assert [tuple(r) for r in df.select(*parts.values()).collect()][4] == ("2024", "0229", "235959")


def test_variant_numbers(rows):
    lines = ['{"v": 5.5}', '{"v": "6"}', '{"v": true}', '{"v": "true"}', '{"v": null}', "{}"]
    df = rows([(x,) for x in lines], "j string").select(F.parse_json("j").alias("v"))
    assert values(df.select(times.lenient_epoch(times.variant_number_text(F.col("v"), "$.v")))) == [5, 6, 1, None, None, None]


def test_day_window():
    assert times.day_window(2, "2024-03-01") == [("2024", "0301"), ("2024", "0229"), ("2024", "0228")]
    assert len(times.day_window(16, dt.date(2024, 1, 5))) == 17


def test_canonical_hash_ignores_layout(rows):
    a, b, c = '{"b":1,"a":[1,{"y":"é","x":null}]}', '{ "a" : [1, {"x":null,"y":"\\u00e9"}], "b":1 }', '{"b":2,"a":[]}'
    df = rows([(a,), (b,), (c,)], "j string").select(fingerprints.canonical_json_hash(F.parse_json("j")))
    one, two, three = values(df)
    expected = json.dumps(json.loads(a), sort_keys=True, separators=(",", ":"), ensure_ascii=False)
    assert one == two == hashlib.sha256(expected.encode()).hexdigest() != three


def fingerprint(rows, **changes):
    base = {"id": "a", "name": "t3_a", "title": "x", "selftext": "y", "edited": False, "is_self": True}
    df = rows([(json.dumps(base | changes),)], "j string")
    return values(df.select(fingerprints.submission_fingerprint(F.parse_json("j"))))[0]


def test_submission_fingerprint(rows):
    base = fingerprint(rows)
    assert fingerprint(rows, score=5, num_comments=1) == base  # fields outside the list
    assert fingerprint(rows, stickied="true") == base  # wrong type counts as false
    assert fingerprint(rows, url=7) == base  # wrong type counts as ''
    assert fingerprint(rows, edited=1700000001.5) != base
    assert fingerprint(rows, edited="false") != base
    assert fingerprint(rows, stickied=True) != base
    assert fingerprint(rows, title="xy", selftext="") != base
    assert fingerprint(rows, title="", selftext="xy") != fingerprint(rows, title="xy", selftext="")


def thread_hash(rows, data):
    df = rows([(f"{x}",) for x in data], "x string").select(F.sha2("x", 256).alias("h"))
    sums = df.agg(F.count(F.lit(1)).alias("n"), *fingerprints.set_hash_sums("h"))
    return values(sums.select(fingerprints.set_hash("n")))[0]


def test_set_hash(rows):
    assert thread_hash(rows, "abc") == thread_hash(rows, "cab")
    assert len({thread_hash(rows, x) for x in ("abc", "ab", "abcc", "abbc", "abd", "a")}) == 6
