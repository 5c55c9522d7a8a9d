import random
import re
from itertools import combinations

import numpy as np
from conftest import SF
from threadloom.llm import decontam, near
from threadloom.llm.common import table
from threadloom.llm.components import components
from threadloom.llm.queries import LLM_QUERIES


def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_groups(docs, size, num=80, den=100):
    sets = [(i, shingles(t, size)) for i, t in docs]
    parent = {i: i for i, _ in sets if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for (i, a), (j, b) in combinations([s for s in sets if s[0] is not None and s[1]], 2):
        common = len(a & b)
        if den * common >= num * (len(a) + len(b) - common):
            low, high = sorted((find(i), find(j)))
            parent[high] = low
    return sorted((i, len(s), find(i), find(i) == i) for i, s in sets if i is not None)


def test_query_equals_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    assert sorted(tuple(r) for r in LLM_QUERIES["op9_near_groups"](spark, SF).collect()) == brute_groups(docs, 2)


def edited(rng, words, share):
    out = list(words)
    for i in range(len(out)):
        if rng.random() < share:
            out[i] = f"z{rng.randrange(10**6)}"
    return " ".join(out)


def test_large_groups_of_near_copies(spark):
    rng = random.Random(3)
    docs = []
    for base in range(3):
        words = [f"w{rng.randrange(5000)}" for _ in range(120)]
        docs += [edited(rng, words, rng.choice([0.0, 0.02, 0.04, 0.06, 0.09])) for _ in range(130)]
        docs += [docs[-1]] * 40
    docs += [" ".join(f"w{rng.randrange(5000)}" for _ in range(rng.randrange(1, 9))) for _ in range(60)]
    rng.shuffle(docs)
    given = [(i * 3 + 1, t) for i, t in enumerate(docs)]
    df = spark.createDataFrame(given, "doc_id long, text string").repartition(5)
    for size in (2, 5):
        got = near.near_groups(df, size=size)
        assert sorted(tuple(r) for r in got.collect()) == brute_groups(given, size)


def test_chunks_of_a_bucket(spark, monkeypatch):
    monkeypatch.setattr(near, "MEMBERS_PER_TASK_GROUP", 4)
    rng = random.Random(8)
    words = [f"w{i}" for i in range(60)]
    given = [(i, edited(rng, words, 0.08)) for i in range(70)]
    got = near.near_groups(spark.createDataFrame(given, "doc_id long, text string"), size=2)
    assert sorted(tuple(r) for r in got.collect()) == brute_groups(given, 2)


def test_edge_rows(rows):
    long = " ".join(f"w{i}" for i in range(30_000))
    given = [(5, None), (6, ""), (7, " \n"), (8, "one"), (9, "ONE"), (9, "ONE"), (4, long), (3, long + " x"), (2, "a b c"), (1, "a b c d e f"), (11, "A b c d e f g")]
    df = rows([(i, t, "x", 1) for i, t in given] + [(None, "one", "x", 1), (None, None, "x", 1)], "doc_id long, text string, kept string, n_shingles int")
    got = [tuple(r) for r in near.near_groups(df).collect()]
    named = [g for g in got if g[0] is not None]
    assert sorted(set(named)) == sorted(set(brute_groups(given, 5))) and len(named) == len(given)
    assert sorted((g for g in got if g[0] is None), key=str) == [(None, 0, None, False), (None, 1, 8, False)]
    assert near.near_groups(df.limit(0)).collect() == []
    assert near.near_groups(df.where("doc_id = 2")).collect()[0]["kept"]


def plain_signature(values, places):
    """Shingle by shingle and step by step, without stopping early."""
    best = np.full(places, np.inf)
    for value in values:
        order = list(range(places))
        for step in range(places):
            seed = near.mixed(np.uint64([(int(value) + (step + 1) * near.BASE) & ((1 << 64) - 1)]))
            draw = (int(seed[0]) >> 11) * 2.0**-53
            chosen = step + (int(near.mixed(seed)[0]) >> 33) % (places - step)
            order[step], order[chosen] = order[chosen], order[step]
            best[order[step]] = min(best[order[step]], step + draw)
    return best


def test_signatures_are_those_of_the_definition():
    rng = np.random.default_rng(0)
    sizes = [1, 3, 17, 0, 60, 400]
    values = [np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64)) for n in sizes]
    owner = np.repeat(np.arange(len(sizes)), sizes)
    got = near.signatures(np.concatenate(values), owner, len(sizes), 24)
    for v, row in zip(values, got):
        assert np.array_equal(row, plain_signature(v, 24))


def test_signatures_estimate_likeness():
    rng = np.random.default_rng(1)
    common, a, b = (rng.integers(0, 1 << 63, n).astype(np.uint64) for n in (160, 20, 20))
    first, second = np.sort(np.r_[common, a]), np.sort(np.r_[common, b])
    values, owner = np.r_[first, second], np.repeat([0, 1], [180, 180])
    sig = near.signatures(values, owner, 2, 240)
    assert abs((sig[0] == sig[1]).mean() - 0.8) < 0.1


def test_components_equal_union_find(spark):
    rng = random.Random(2)
    for n, links in ((1, []), (40, [(i, i + 1) for i in range(39)]), (200, [(rng.randrange(200), rng.randrange(200)) for _ in range(150)])):
        parent = list(range(n))

        def find(x):
            while parent[x] != x:
                x = parent[x]
            return x

        for a, b in links:
            low, high = sorted((find(a), find(b)))
            parent[high] = low
        touched = {x for a, b in links if a != b for x in (a, b)}
        df = spark.createDataFrame([*links, (None, 3), (5, 5)] if n > 5 else links, "a long, b long")
        assert sorted(tuple(r) for r in components(df).collect()) == sorted((x, find(x)) for x in touched)


# Benchmark passages


def test_all_exact_passages_are_found(spark):
    sf = "/root/testdata/sf0.01"
    items = [(r["item_id"], r["text"]) for r in table(spark, sf, "benchmark").collect()]
    docs = [(r["doc_id"], r["text"]) for r in table(spark, sf, "documents").collect()]
    got = {(r["doc_id"], r["item_id"]): r for r in LLM_QUERIES["op6_latent_leaks"](spark, sf).collect()}
    exact = {(d, i) for i, t in items for d, x in docs if t in x}
    assert exact and exact <= got.keys()

    def words(t):
        return re.findall(r"[^\W_]+", t.lower())

    for (d, i), r in got.items():  # what else is found has most of the words in order
        passage, text = words(dict(items)[i]), words(dict(docs)[d])
        best = max(subsequence(passage, text[k : k + 160]) for k in range(0, len(text), 40))
        assert best >= 0.5 * len(passage)
        assert r["common"] <= 1 and 0 < r["cosine"] <= 1


def subsequence(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_words():
    rng = random.Random(1)
    for _ in range(200):
        a, b = ([rng.randrange(6) for _ in range(rng.randrange(1, 30))] for _ in range(2))
        assert decontam.common_words(a, b) == subsequence(a, b)


def test_paraphrases_and_edge_rows(rows, monkeypatch):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abdefgiklmnoprstu") for _ in range(rng.randrange(3, 8)))
    items = [(k, " ".join(word() for _ in range(n))) for k, n in enumerate((12, 30, 45, 64, 150, 8))]
    noise = lambda n: " ".join(word() for _ in range(n))
    docs = [(100 + d, noise(rng.randrange(30, 200))) for d in range(60)]
    want = set()
    for k, text in items:
        w = text.split()
        docs.append((k, f"{noise(rng.randrange(0, 90))} {text.upper()}! {noise(70)}"))
        want.add((k, k))
        changed = [x if rng.random() > 0.15 else word() for x in w]
        changed[-6:] = w[-6:]
        docs.append((10 + k, f"{noise(37)}, {', '.join(changed)}. {noise(20)}"))
        want.add((10 + k, k))
    docs += [(50, None), (51, ""), (52, items[1][1]), (52, items[1][1]), (None, items[2][1]), (53, noise(20_000) + " " + items[2][1])]
    want |= {(52, 1), (None, 2), (53, 2)}
    df = rows([(d, t, 1, True) for d, t in docs], "doc_id long, text string, item_id int, answer boolean")
    bench = rows([*items, (6, None), (7, ""), (8, "...")], "item_id long, text string")
    for block in (decontam.BLOCK_ITEMS, 3):
        monkeypatch.setattr(decontam, "BLOCK_ITEMS", block)
        got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(df.repartition(3), bench).collect()}
        assert got == want
    assert decontam.leaks(df.limit(0), bench).collect() == [] and decontam.leaks(df, bench.limit(0)).collect() == []


def test_latent_space_is_that_of_the_singular_vectors(spark, rows):
    rng = random.Random(4)
    found = decontam.passages(rows([(i, " ".join(f"t{rng.randrange(40)}" for _ in range(25))) for i in range(30)], "item_id long, text string"), "item_id", "text")
    weights = np.linspace(1, 3, decontam.TERMS)
    terms, directions = decontam.latent_space(found.repartition(3), weights, rank=8, rounds=6)
    rows_ = [r["words"] for r in found.collect()]
    row, term, value, _ = decontam.weighted(rows_, weights)
    dense = np.zeros((len(rows_), len(terms)))
    dense[row, np.searchsorted(terms, term)] = value
    left, sizes, right = np.linalg.svd(dense, full_matrices=False)
    kept = np.linalg.norm(dense @ directions) ** 2
    assert kept >= 0.99 * (sizes[:8] ** 2).sum()

def test_recall_of_replaced_words(spark):
    rng = random.Random(3)
    given = [r["text"] for r in table(spark, "/root/testdata/sf0.01", "documents").select("text").collect()]
    bench = table(spark, "/root/testdata/sf0.1", "benchmark").select("item_id", "text")
    plain = lambda t: [w for w in (re.sub(r"\W", "", x.lower()) for x in t.split()) if w]
    vocabulary = [w for t in given for w in t.split()]
    docs, want = [(-1 - i, t) for i, t in enumerate(given)], set()
    for share in (0.15, 0.3, 0.45):
        for item in bench.collect():
            words = plain(item["text"])
            for j in rng.sample(range(max(0, len(words) - 6)), min(max(0, len(words) - 6), int(share * len(words)))):
                words[j] = rng.choice(vocabulary)
            around = rng.choice(given).split()
            at = rng.randrange(len(around) + 1)
            docs.append((len(docs), " ".join(around[:at] + words + around[at:])))
            if decontam.agree(plain(item["text"]), plain(docs[-1][1]))[2]:
                want.add((docs[-1][0], item["item_id"]))
    got = decontam.leaks(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), bench).collect()
    assert len(want) > 500 and want <= {(r["doc_id"], r["item_id"]) for r in got}
