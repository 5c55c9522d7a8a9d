"""Rows of one id with different texts, texts of many matches, gates of passages."""

import random
import time

import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F
from threadloom.llm import decontam, near, secret_scan

WORDS = [f"w{i}" for i in range(400)]


def text(seed, n=60):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) for _ in range(n))


A, B, C, D = (text(i) for i in range(4))
SCHEMA = "doc_id long, text string, lang string, _text_hash int"


def test_rows_of_one_id_are_told_apart_by_their_texts(spark, rows):
    near_a = A + " more"
    docs = rows([(1, A, "x", 0), (1, B, "x", 0), (2, A, "x", 0), (3, C, "x", 0), (3, D, "x", 0), (4, near_a, "x", 0)], SCHEMA)
    found = {(r.doc_id, r.text_hash): r for r in near.near_rows(docs).collect()}
    assert len(found) == 6
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == sorted([(1, A), (1, B), (3, C), (3, D)])


def test_copies_under_one_id_and_rows_without_words(spark, rows):
    alike = A + " more"
    docs = rows([(5, A, "x", 0), (5, A, "y", 0), (5, alike, "x", 0), (6, "", "x", 0), (6, "", "x", 0), (None, A, "x", 0), (None, None, "x", 0)], SCHEMA)
    kept = sorted((r.doc_id or 0, r.text or "") for r in corpus_pipeline.one_of_each_group(spark, docs, "").collect())
    assert len(kept) == 5 and kept[:2] == [(0, ""), (0, A)] and kept[3:] == [(6, ""), (6, "")]
    assert kept[2][0] == 5 and kept[2][1] in (A, alike)


def test_columns_called_as_the_stages_call_theirs(spark, rows):
    schema = "doc_id long, text string, _id int, _Hash int, _n int, _text_hash int, _gone int, _gone_ int"
    docs = rows([(i, t, 1, 2, 3, 4, 5, 6) for i, t in ((1, A), (2, A), (3, B), (3, B), (4, C))], schema)
    kept = corpus_pipeline.one_of_each_group(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(tuple(r) for r in kept.collect()) == [(i, t, 1, 2, 3, 4, 5, 6) for i, t in ((1, A), (3, B), (4, C))]
    left = corpus_pipeline.without(docs, rows([(3,), (9,)], "doc_id long"))
    assert left.columns == docs.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 4]


def test_a_text_of_100_000_matches(spark):
    n = 100_000
    whole = " ".join("%040x" % (i * 2654435761 + (1 << 158)) for i in range(n))
    df = spark.createDataFrame([(1, whole), (2, "secret=abcdefgh"), (3, None)], "doc_id long, text string")
    began = time.time()
    found = {r.doc_id: r.base for r in secret_scan.scan(df, "text", "doc_id").collect()}
    assert time.time() - began < 180
    assert [(s.start, s.end) for s in found[1]] == [(41 * i, 41 * i + 40) for i in range(n)]
    assert len(found[2]) == 1 and found[3] == []


def test_overlaps_equal_brute_force(spark):
    rng = random.Random(4)
    texts = []
    for i in range(60):
        parts = [rng.choice(["secret=", "token: ", "x ", "AKIA", "%032x" % rng.getrandbits(128), "Q" * rng.randrange(30), " "]) for _ in range(12)]
        texts.append((i, "".join(parts)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    located = secret_scan.searched(df, "text", "doc_id", "text")
    for r in located.collect():
        for run in r["_runs"]:
            assert not any(b.start < run.end and run.start < b.end for b in r["_base"])


def test_gates_bound_what_a_candidate_has():
    rng = np.random.default_rng(2)
    hashes = rng.integers(0, 1 << 63, 300, dtype=np.int64)
    words = [hashes[rng.integers(0, 300, rng.integers(8, 40))].tolist() for _ in range(30)]
    weights = 1 + rng.random(decontam.TERMS)
    row, term, value, norm = decontam.weighted(words, weights)
    terms = np.unique(term)
    matrix = np.zeros((len(words), len(terms)))
    matrix[row, np.searchsorted(terms, term)] = value
    directions = np.linalg.svd(matrix, full_matrices=False)[2].T
    at = matrix @ directions
    aims = at / (np.linalg.norm(at, axis=1) ** 2 * norm)[:, None]
    least = decontam.gates(words, terms, directions, aims, weights)
    assert (least > decontam.NEAR).any()
    for p, own in enumerate(words):
        for _ in range(50):
            n = int(np.ceil(decontam.COMMON_WITH_ANSWER * len(own)))
            chosen = np.array(own)[rng.permutation(len(own))[:n]]
            held = np.unique(decontam.terms_of(chosen.view(np.uint64)))
            window = np.zeros(len(terms))
            window[np.searchsorted(terms, held)] = weights[held]
            assert window @ directions @ aims[p] >= least[p] - 1e-9 or least[p] == decontam.NEAR


@pytest.mark.parametrize("ends", [True, False])
def test_only_the_end_of_an_item_is_its_answer(ends):
    passage = list(range(40))
    found = list(range(100, 120)) + passage[18:]
    assert decontam.agree(passage, found, ends)[1:] == (ends, ends)
    assert decontam.can_agree(passage, found, ends) == ends
    assert decontam.agree(passage, passage, ends)[2] and decontam.can_agree(passage, passage, ends)
    assert not decontam.can_agree(passage, list(range(200, 240)), ends)
