import zlib

import numpy as np
import pyarrow as pa
import pytest
from conftest import SF
from pyspark.sql import functions as F
from threadloom.llm import language, quality
from threadloom.llm.common import byte_view, table
from threadloom.llm.queries import LLM_QUERIES
from threadloom.llm.words import distinct_by_text, grouped, letters_only, mixed, shingle_hashes, word_hashes

MEDIUM = "/root/testdata/sf0.01"


# Words


def test_words_are_told_apart_as_by_a_pattern():
    import re

    texts = ["", " ", "The  the\tTHE\n", "a", "é É x\x0bx", "longer words here, here", "b" * 3000, "a b a b"]
    column = pa.array(["skipped", *texts])[1:]
    found = []
    for low, high, data, starts, ends in grouped(column):
        hashes, owner, begin, end = word_hashes(data, starts, ends)
        for h, o, b, e in zip(hashes, owner, begin, end):
            found.append((low + int(o), bytes(data[b:e]), int(h)))
    want = [(i, m[0].encode()) for i, t in enumerate(texts) for m in re.finditer(r"[^\x20\x09-\x0D]+", t)]
    assert [f[:2] for f in found] == want
    upper = bytes(range(65, 91))
    by_word = {}
    for _, word, h in found:
        assert by_word.setdefault(word.translate(bytes.maketrans(upper, upper.lower())), h) == h
    assert len(set(by_word.values())) == len(by_word)


def test_words_do_not_run_across_texts():
    column = pa.array(["ab", "cd", "", "ef gh"])
    _, _, data, starts, ends = next(grouped(column))
    hashes, owner, begin, end = word_hashes(data, starts, ends)
    assert owner.tolist() == [0, 1, 3, 3]
    assert [bytes(data[b:e]) for b, e in zip(begin, end)] == [b"ab", b"cd", b"ef", b"gh"]


def test_shingles_of_short_texts():
    hashes = np.array([1, 2, 3, 9, 7, 7, 7], np.uint64)
    owner = np.array([0, 0, 0, 2, 3, 3, 3])
    values, own = shingle_hashes(hashes, owner, 5, 2)
    assert own.tolist() == [0, 0, 2, 3, 3]
    values, own = distinct_by_text(values, own)
    assert own.tolist() == [0, 0, 2, 3]


def test_letters_only():
    assert bytes(letters_only(np.frombuffer("AÉ-b,\n×1".encode(), np.uint8))) == "Aé b  ×1".encode()


# Language


def test_network_answers_as_its_tables(spark):
    rng = np.random.default_rng(1)
    net = language.ByteNet(["a", "b", "c"])
    windows = rng.integers(97, 123, (40, language.WINDOW)).astype(np.uint8)
    plain = net.softmax(net.answers(windows)[0])
    assert np.allclose(plain, net.predict(windows, net.tables()), atol=1e-5)


def test_gradient_is_that_of_the_loss():
    rng = np.random.default_rng(2)
    windows = rng.integers(97, 101, (32, language.WINDOW)).astype(np.uint8)
    labels = (windows[:, 0] > 98).astype(int)
    windows[labels == 1, 10:13] = 120
    net = language.ByteNet(["a", "b"]).fit(windows, labels, epochs=60)
    assert (net.predict(windows, net.tables()).argmax(axis=1) == labels).all()


def test_windows_cover_every_byte():
    texts = ["", "a", "b" * 256, "c" * 257, "é" * 300]
    data, starts, ends = byte_view(pa.array(texts))
    plain = language.plain_bytes(data)
    windows, owner, letters = language.windows_of(plain, starts, ends)
    for i, t in enumerate(texts):
        own = windows[owner == i]
        n = len(t.encode())
        assert len(own) == max(1, -(-n // 256))
        if n >= 256:
            assert bytes(own[-1]) == bytes(plain[ends[i] - 256 : ends[i]])
            assert bytes(own[0]) == bytes(plain[starts[i] : starts[i] + 256])
        else:
            assert bytes(own[0]) == bytes(plain[starts[i] : ends[i]]) + b" " * (256 - n)


def test_language_accuracy_on_held_out_texts(spark):
    docs = table(spark, MEDIUM, "documents")
    got = LLM_QUERIES["op5_byte_network"](spark, MEDIUM).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert sum(r["lang"] == r["lang_pred"] for r in held) / len(held) >= 0.97
    assert all(0 <= r["score"] <= 1 for r in got)


@pytest.fixture(scope="module")
def net(spark):
    return language.train(table(spark, SF, "documents"))


def test_language_of_edge_rows(rows, net):
    long = "the thing and the other " * 8000
    df = rows(
        [(1, None, "x", 1.0), (2, "", "x", 1.0), (3, "12 $$ \n", "x", 1.0), (4, "中文", "x", 1.0), (5, long, "x", 1.0), (5, long, "x", 1.0), (None, "the", "x", 1.0)],
        "doc_id long, text string, lang_pred string, score double",
    )
    got = language.predicted(df, net, "text", F.struct(*df.columns).alias("row")).collect()
    named = [(r["row"]["doc_id"], r["lang_pred"]) for r in got]
    assert named[:3] == [(1, "und"), (2, "und"), (3, "und")] and named[3][1] in net.languages
    assert got[4]["lang_pred"] == "en" and got[4]["score"] == got[5]["score"]
    assert language.predicted(df.limit(0), net, "text", "doc_id").collect() == []
    assert language.train(df.select("doc_id", "text", F.lit(None).cast("string").alias("lang"))) is None
    assert {r["lang_pred"] for r in language.predicted(df, None, "text", "doc_id").collect()} == {"und"}


# Quality


def test_quality_on_held_out_texts(spark):
    got = LLM_QUERIES["op8_quality"](spark, MEDIUM)
    assert got.count() == table(spark, MEDIUM, "documents").count()
    held = got.where("held_out").join(table(spark, MEDIUM, "labels"), "doc_id").collect()
    assert all(r["predicted"] == int(r["score"] >= 0.3) and 0 <= r["score"] <= 1 for r in held)
    clean = [r["predicted"] for r in held if r["quality"] == 1]
    junk = [r["predicted"] for r in held if r["quality"] == 0]
    assert sum(clean) / len(clean) >= 0.95 and sum(junk) / max(1, len(junk)) <= 0.2


def test_descent_reaches_the_dual_optimum():
    rng = np.random.default_rng(4)
    rows = [np.sort(rng.choice(50, 12, replace=False)) for _ in range(80)]
    labels = np.array([int((r < 20).sum() > 4) for r in rows])
    scale = np.ones(quality.PLACES)
    weights, offset = quality.descend(rows, labels, scale, 1e-9, passes=400)
    signs = 2 * labels - 1
    share = np.bincount(labels)
    most = len(labels) / (2 * share[labels])

    def loss(w, b):
        margins = np.array([w[r].sum() / 12**0.5 + b for r in rows])
        return 0.5 * (w @ w + b * b) + (most * np.maximum(0, 1 - signs * margins)).sum()

    best = loss(weights, offset)
    for _ in range(200):
        step = np.zeros(quality.PLACES)
        step[:50] = rng.normal(0, 0.02, 50)
        assert loss(weights + step, offset + rng.normal(0, 0.02)) >= best - 1e-3


def test_places_of_texts_one_by_one():
    texts = ["", "ab", "abcabc", "x y x y y", "é" * 500, "word word word " * 100]
    got = list(quality.places_of(pa.array(texts)))
    for text, places in zip(texts, got):
        data = text.encode()
        grams = {(data[i] << 16 | data[i + 1] << 8 | data[i + 2]) for i in range(len(data) - 2)}
        want = {(g * 2654435761 & 0xFFFFFFFF) >> 16 for g in grams}
        words = text.split()
        for k in (1, 2):
            n = sum(a == b for a, b in zip(words, words[k:]))
            first = quality.GRAMS + (k - 1) * quality.LEVELS
            want |= set(range(first, first + n.bit_length()))
        assert sorted(places.tolist()) == sorted(want)


def test_quality_of_edge_rows(spark, rows):
    docs = rows([(1, None, 0.5), (2, "", 0.5), (3, "a b " * 30_000, 0.5), (4, "same", 0.5), (4, "same", 0.5), (None, "x", 0.5)], "doc_id long, text string, score double")
    labels = rows([(3, 1, 0), (4, 0, 0), (4, None, 0), (9, 1, 0), (None, 0, 0)], "doc_id long, quality int, toxic int")
    scorer = quality.train(docs, labels)
    got = quality.scored(docs, scorer, "text", F.col("doc_id").alias("id"), F.col("score").alias("old")).collect()
    assert got[0]["score"] == got[1]["score"] and got[3]["score"] == got[4]["score"] and len(got) == 6
    assert quality.scored(docs, quality.train(docs, labels.limit(0)), "text", "doc_id").first()["score"] == 0.5
    assert quality.scored(docs, quality.train(docs, labels.where("quality = 1")), "text", "doc_id").first()["score"] == 1.0
    assert quality.scored(docs.limit(0), scorer, "text", "doc_id").collect() == []


def test_mixed_is_a_bijection():
    values = np.arange(100_000, dtype=np.uint64)
    assert len(np.unique(mixed(values))) == len(values)
