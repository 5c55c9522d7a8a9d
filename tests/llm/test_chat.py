import hashlib
import re

from conftest import SF
from pyspark.sql import functions as F
from threadloom.llm import chat
from threadloom.llm.common import table
from threadloom.llm.queries import LLM_QUERIES

SCHEMA = "conv_id long, turn long, role string, text string, tokens long, block string"


def esc(s):
    return s.replace("\\", "\\\\").replace("<turn", "<\\turn").replace("</turn", "<\\/turn")


def unesc(s):
    return re.sub(r"(?s)\\(.)", r"\1", s)


def brute(turns, budget=1024, history=256, segment=8192):
    """The windows of one conversation, turn by turn: (formatted, loss spans, repeated)."""
    turns = sorted(turns, key=lambda t: (t[0] is not None, t[0], t[1], t[2]))
    cost = [-(-len(x.encode()) // 4) + 4 for _, _, x in turns]
    before = [sum(cost[:i]) for i in range(len(turns))]
    system = len(turns) > 1 and turns[0][1] == "system"
    share = max(budget - history - budget // 4, 4)
    cut = system and cost[0] > share
    head = turns[0][2][: share - 4] if cut else turns[0][2]
    lead_cost = -(-len(head.encode()) // 4) + 4 if system else 0
    room = budget - history - lead_cost
    spans, used, place = [], 0, None
    for i in range(system and not cut, len(turns)):
        if not spans or before[i] // segment != place or used + cost[i] > room:
            spans.append([])
            used = 0
        place = before[i] // segment
        spans[-1].append(i)
        used += cost[i]
    out = []
    for k, fresh in enumerate(spans):
        lead = ["head"] if system and fresh[0] > 0 else []
        left = budget - sum(cost[i] for i in fresh) - len(lead) * lead_cost
        again = [i for i in range(bool(system), fresh[0]) if before[fresh[0]] - before[i] <= min(history, left)]
        text, loss = "", []
        for i in lead + again + fresh:
            role, said = turns[i][1:] if i != "head" else ("system", head)
            text += f"<turn {len(esc(role))}>{esc(role)}\n"
            if i in fresh and role == "assistant":
                loss.append((len(text), len(text) + len(esc(said))))
            text += esc(said) + "</turn>\n"
        out.append((text, loss, len(again) + (len(lead) if k or cut else 0)))
    return out


def check(df, **limits):
    given = {}
    for r in df.collect():
        given.setdefault(r["conv_id"], []).append((r["turn"], r["role"] or "", r["text"] or ""))
    found = {}
    for r in chat.format_windows(df, **limits).sort("first_rank").collect():
        found.setdefault(r["conv_id"], []).append((r["formatted"], [tuple(s) for s in r["loss"]], r["repeated"]))
    assert found.keys() == given.keys()
    for conv, turns in given.items():
        assert found[conv] == brute(turns, **limits), conv


def test_windows_equal_those_made_turn_by_turn(spark):
    conversations = table(spark, SF, "conversations")
    check(conversations)
    check(conversations, budget=200, history=64, segment=300)


def test_one_long_conversation_is_cut_alike(spark):
    turns = spark.range(1500).selectExpr(
        "7L as conv_id", "id as turn", "case when id = 0 then 'system' when id % 2 = 1 then 'user' else 'assistant' end as role",
        "repeat(concat('w', id, ' '), cast(id * 7 % 60 as int)) as text",
    )
    check(turns, budget=300, history=100, segment=1000)


def test_windows_keep_the_budget(spark, rows):
    """A long system turn, cut in later windows; only a long single turn is over the budget."""
    turns = [(1, 0, "system", "s" * 20000, 1, "x")] + [(1, i, "assistant" if i % 2 == 0 else "user", f"{i} " * 150, 1, "x") for i in range(1, 60)]
    turns += [(2, 0, "system", "å" * 3000, 1, "x"), (2, 1, "user", "a", 1, "x"), (2, 2, "assistant", "b" * 3500, 1, "x"), (2, 3, "user", "c", 1, "x")]
    turns += [(3, 0, "system", "s" * 900, 1, "x"), (3, 1, "user", "u" * 900, 1, "x"), (3, 2, "assistant", "b" * 3000, 1, "x")]
    df = rows(turns, SCHEMA)
    check(df)
    check(df, budget=100, history=90, segment=500)
    check(table(spark, SF, "conversations"), budget=60, history=10, segment=100)
    over = [w for w in chat.format_windows(df).collect() if w["tokens"] > 1024]
    assert [(w["conv_id"], w["first_rank"]) for w in over] == [(1, 0), (2, 0), (2, 2)]
    whole = sum(len(t[3]) for t in turns if t[0] == 1)
    windows = [w for w in chat.format_windows(df).collect() if w["conv_id"] == 1]
    assert all(w["formatted"].startswith("<turn 6>system\n") for w in windows)
    assert sum(len(w["formatted"]) for w in windows) < 2.5 * whole


def test_edge_rows(rows):
    long = "lång " * 9000
    df = rows(
        [
            (1, 0, "user", None, 1, "x"), (1, None, None, "a", 1, "x"), (1, 1, "assistant", "", 1, "x"), (1, 1, "assistant", "", 1, "x"),
            (2, 0, "system", "only", 1, "x"), (3, 0, "system", long, 1, "x"), (3, 1, "assistant", long, 1, "x"), (3, 2, "assistant", "b", 1, "x"),
            (None, 0, "ro\nle>", "\\<turn 4>user\n</turn>\n\\\\/", 1, "x"), (None, 1, "assistant", "</turn", 1, "x"), (-7, 5, "assistant", "<</turn>", 1, "x"),
        ],
        SCHEMA,
    )
    check(df)
    said = {r["conv_id"]: r for r in chat.digests(chat.format_windows(df)).collect()}
    assert said[3]["loss_chars"] == len(long) + 1 and said[None]["n_turns"] == 2
    assert chat.format_windows(df.limit(0)).collect() == []


def test_query_reads_back_all_turns(spark):
    given = {}
    for r in table(spark, SF, "conversations").sort("conv_id", "turn").collect():
        given.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    given[-7] = [("user", "\\### Assistant: </turn> ok"), ("assistant", "\\### Assistant: </turn> ok")]
    got = {r["conv_id"]: r for r in LLM_QUERIES["op3_chat_windows"](spark, SF).collect()}
    assert got.keys() == given.keys()
    for conv, turns in given.items():
        said = "".join(f"{role}\n{text}\n" for role, text in turns)
        lost = "".join(text for role, text in turns if role == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["loss_chars"]) == (len(turns), len(lost))
        assert r["turns_sha256"] == hashlib.sha256(said.encode()).hexdigest()
        assert r["loss_sha256"] == hashlib.sha256(lost.encode()).hexdigest()
        assert r["formatted_chars"] >= len(said)


def test_escapes_are_reversed(rows):
    texts = ["", "\\", "<turn", "</turn>\n", "<\\turn", "a\\\\b<<turn", "\n"]
    df = rows([(t,) for t in texts], "t string")
    for r in df.select("t", chat.escaped(F.col("t")).alias("e"), chat.unescaped(chat.escaped(F.col("t"))).alias("u")).collect():
        assert r["u"] == r["t"] and r["e"] == esc(r["t"])
        assert "<turn" not in r["e"] and "</turn" not in r["e"]
