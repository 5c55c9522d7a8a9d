import hashlib
import re
import zlib
from collections import defaultdict

import pytest
from threadloom.llm import trie
from threadloom.llm.queries import LLM_QUERIES

SCHEMA = "turn long, extra string, conv_id long, role string, text string, depth int, member long"


def brute(rows):
    """Every node by its definition, from (conv_id, turn, role, text)."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append(((turn is not None, turn or 0), role or "", hashlib.sha256((text or "").encode()).hexdigest(), text or ""))
    own = {c: [(r, t) for _, r, _, t in sorted(v)] for c, v in own.items()}
    rebuilt = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - (abs(c) % 20 if c >= 0 else -(abs(c) % 20))
        rebuilt[c] = tuple(own.get(base, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, turns in rebuilt.items():
        for d in range(len(turns) + 1):
            members[turns[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [n for n in members if n[: len(node)] == node]
        childless = [n for n in below if not any(m[:-1] == n for m in members if m)]
        saved = sum((len(members[n]) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", n[-1][1])) for n in below if n)
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(node))
        children = sum(1 for m in members if m and m[:-1] == node)
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(convs), len(node), parent, len(convs), children, len(childless), saved, digest))
    return sorted(out, key=repr)


def found(df):
    return sorted([tuple(r) for r in df.collect()], key=repr)


def table(spark, rows):
    return spark.createDataFrame([(t, "x", c, r, x, 7, 9) for c, t, r, x in rows], SCHEMA)


def talk(conv, *texts):
    return [(conv, i, "user" if i % 2 == 0 else "assistant", t) for i, t in enumerate(texts)]


CASES = {
    "shared": [r for c in range(45) for r in talk(c, "hello there", "yes  you", f"t{c % 3}", f"u{c % 7}", "bye")],
    "odd": [
        (None, 0, "user", "no one"),
        (0, None, None, None),
        (0, None, None, None),
        (0, 3, "user", "a b c"),
        (1, 1, "user", "x"),
        (1, 1, "user", "a"),
        (1, 1, "assistant", "x"),
        (-3, 0, "user", "neg"),
        (-20, 0, "user", "base"),
        (7, 0, "user", ""),
        (27, 5, "u", "long " * 3000),
        (27, 5, "u", "long " * 3000),
        (27, None, "ser", ""),
        (27, None, "", "ser"),
    ],
    "heads_only": [r for c in range(60) for r in talk(c, *["same"] * (c % 5 + 1))],
}


@pytest.mark.parametrize("case", CASES)
def test_nodes_equal_brute_force(spark, case):
    assert found(trie.prefix_trie(table(spark, CASES[case]))) == brute(CASES[case])


def test_runs_longer_than_a_block(spark, monkeypatch):
    monkeypatch.setattr(trie, "BLOCK_BITS", 2)
    rows = talk(4, *[f"w{i % 3} x" for i in range(41)]) + talk(24, *[f"w{i % 3} x" for i in range(37)])
    rows += talk(5, *["w0 x"] * 30) + talk(0, "w0 x", "w1 x", "w2 x", "w0 x")
    assert found(trie.prefix_trie(table(spark, rows))) == brute(rows)


def test_clashing_fingerprints_are_made_anew(spark, monkeypatch):
    proper, asked = trie.fields, []

    def fields(attempt):
        asked.append(attempt)
        return [(7, 3)] * 3 if attempt == 0 else proper(attempt)

    monkeypatch.setattr(trie, "fields", fields)
    rows = [r for c in range(60) for r in talk(c, *[f"{c} {i}" for i in range(5)])]
    assert found(trie.prefix_trie(table(spark, rows))) == brute(rows)
    assert asked == [0, 1]


def test_many_ends_of_one_node(spark):
    rows = [r for c in range(3000) for r in talk(c, "a", "b", "c")]
    nodes = trie.prefix_trie(table(spark, rows)).collect()
    ends = next(r for r in nodes if r["depth"] == 3)
    assert ends["ends_sha256"] == hashlib.sha256(",".join(map(str, range(3000))).encode()).hexdigest()
    assert [(r["conv_id"], r["depth"], r["n_convs"]) for r in sorted(nodes, key=lambda r: r["depth"])] == [(0, d, 3000) for d in range(4)]


def test_empty_table(spark):
    assert trie.prefix_trie(table(spark, [])).count() == 0
    assert trie.prefix_trie(table(spark, [(None, 0, "user", "x")])).count() == 0


def test_query_equals_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert found(LLM_QUERIES["op11_prefix_trie"](spark, sf)) == brute(rows)
