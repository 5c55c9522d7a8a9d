import pytest
from pyspark.sql import functions as F

from threadloom.operators.model import apply_model, call_with_retry


class Flaky:
    def __init__(self, failures, error="429 slow down"):
        self.failures, self.error, self.calls = failures, error, 0

    def __call__(self, texts):
        self.calls += 1
        if self.calls <= self.failures:
            raise RuntimeError(self.error)
        return [len(t) for t in texts]


def test_retry_waits_longer_each_time():
    waits = []
    assert call_with_retry(Flaky(3), ["a"], 4, 1000, waits.append) == ([1], None)
    assert waits == [1.0, 2.0, 4.0]


def test_retries_run_out():
    waits, model = [], Flaky(99, "RESOURCE_EXHAUSTED")
    assert call_with_retry(model, ["a"], 2, 10, waits.append) == (None, "RESOURCE_EXHAUSTED")
    assert model.calls == 3 and len(waits) == 2


def test_other_errors_are_not_tried_again():
    model = Flaky(1, "boom")
    assert call_with_retry(model, ["a"], 4, 1) == (None, "boom") and model.calls == 1


def test_only_refused_texts_fail(rows):
    def refuses_z(texts):
        if any("z" in t for t in texts):
            raise ValueError("no z")
        return [[float(len(t))] for t in texts]

    df = rows([(i, "z" if i in (3, 17) else "x" * i) for i in range(30)], "n int, text string").coalesce(1)
    got = apply_model(df, refuses_z, "array<float>", batch_size=10, jitter_ms=1).orderBy("n").collect()
    assert [r.n for r in got if r.error] == [3, 17] and {r.error for r in got} == {None, "no z"}
    assert all(r["values"] == [float(r.n)] for r in got if not r.error)
    with pytest.raises(Exception, match="model refused 2 texts"):
        apply_model(df, refuses_z, "array<float>", batch_size=10, max_failures=1).collect()


def test_batches(rows):
    df = rows([(i, "x" * i) for i in range(45)], "n int, text string").coalesce(1)

    def sizes(texts):
        return [[float(len(t)), float(len(texts))] for t in texts]

    got = apply_model(df, sizes, "array<float>", batch_size=20).orderBy("n").collect()
    assert [r["values"][0] for r in got] == [float(i) for i in range(45)]
    assert [r["values"][1] for r in got] == [20.0] * 40 + [5.0] * 5
    assert all(r.error is None for r in got)


def test_stops_and_keeps_what_is_done(rows):
    df = rows([(i, "x" * i) for i in range(50)], "n int, text string").coalesce(1)

    def limited(texts):
        if "x" * 20 in texts:
            raise RuntimeError("429")
        return [[1.0]] * len(texts)

    got = apply_model(df, limited, "array<float>", batch_size=10, retries=1, backoff_ms=1).orderBy("n").collect()
    assert [r.error for r in got] == [None] * 20 + ["429"] * 30
    assert all(r["values"] is None for r in got[20:])


def test_wrong_number_of_results(rows):
    df = rows([(1, "x"), (2, "y")], "n int, text string").coalesce(1)
    got = apply_model(df, lambda texts: [[1.0]] * 3, "array<float>").collect()
    assert {r.error for r in got} == {"model gave 3 results for 1 texts"}


def test_text_results(rows):
    df = rows([(1, "x")], "n int, text string").withColumn("m", F.struct("n", "text"))
    got = apply_model(df, lambda texts: [t.upper() for t in texts], "string", result="answer").collect()
    assert (got[0].answer, got[0].m["text"]) == ("X", "x")
