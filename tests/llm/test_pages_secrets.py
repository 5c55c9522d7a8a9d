import hashlib
import html
import math
import re

import pytest
from conftest import SF
from pyspark.sql import functions as F
from threadloom.llm import pages, secret_scan
from threadloom.llm.common import table
from threadloom.llm.queries import LLM_QUERIES


def text_of(source):
    return "\n".join(t for _, t in pages.Page(source).candidates())


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>a<p>b <b>bold<br>c</b>\n d</p>e", "a\nb bold c d\ne"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul>", "a\nb\nc"),
        ("<table><tr><td>a<td>b<tr><th>c</table>", "a\nb\nc"),
        ("<script>var t='</p><p>x';</script><style>p{}</style><!-- <p>no</p> --><p>yes</p>", "yes"),
        ("<nav><p>no</nav><header>no</header><p>yes</p><footer>no", "yes"),
        ("<article><header><h1>Title</h1></header><p>in</p><div class='comments'><p>no</div></article><p>out</p>", "Title\nin"),
        ("<div class='side-bar x sidebar'>no</div><div class=content>yes</div>", "yes"),
        ("<body class='has-sidebar'><p>yes</p><form>no</form></body>", "yes"),
        ("<p title='a > b'>x &lt;b&gt; &#233;&nbsp;y</p>", "x <b> é y"),
        ("<div id=comment-12>no</div><div role=\"banner\">no</div><p>1 < 2 <3", "1 < 2 <3"),
        ("<p>open <div>block</div> rest", "open\nblock\nrest"),
        ("<main>a<aside>no</aside>b</main>c", "a\nb"),
        ("</p></div>x<p", "x"),
        ("<title>no</title><h2>head</h2><pre>a\n  b</pre>", "head\na b"),
    ],
)
def test_blocks(source, want):
    assert text_of(source) == want


@pytest.mark.parametrize(
    ("source", "want"),
    [
        ("<div class='has-sidebar'><article><p>yes</article></div><p>no", "yes"),
        ("<article class='post no-sidebar with-comments'><p>yes</article>", "yes"),
        ("<main id=sidebar><p>yes</main>", "yes"),
        ("<div class='with-comments'><p>yes</div>", "yes"),
        ("<div class='page--sidebar'><div class='content-sidebar-wrap'><p>yes</div></div>", "yes"),
        ("<div class=promo><div class=widget><main><p>yes<div class=comments>no</div></main><p>no</div></div>", "yes"),
        ("<article><div class='post-header'><h1>yes</h1></div><div class='header'>too</div><p>text</article>", "yes\ntoo\ntext"),
        ("<div class='entry-header'><h1>yes</h1></div><div class=header>no</div><p>text", "yes\ntext"),
        ("<div class='post category-social tag-advertising'><p>yes</div>", "yes"),
        ("<article><p>yes</article><div class='comment-list'><article class=comment><p>no</article></div>", "yes"),
        ("<p>yes</p><div class='comments-area'>no</div><div class='post-comments'>no</div><div id=ad_300x250>no</div>", "yes"),
    ],
)
def test_names_do_not_take_the_article(source, want):
    assert text_of(source) == want


def plain(source):
    inside = source[source.index("<article>") + 9 :].split("</article>")[0]
    blocks = (" ".join(html.unescape(re.sub("<[^>]*>", " ", b)).split()) for b in re.split("</?(?:p|h1)>", inside))
    return "\n".join(b for b in blocks if b)


def test_articles_of_the_table(spark):
    given = {r["page_id"]: r for r in table(spark, SF, "pages").collect()}
    got = LLM_QUERIES["op4_main_texts"](spark, SF).collect()
    assert len(got) == len(given)
    for r in got:
        assert r["text"] == plain(given[r["page_id"]]["html"]) and r["n_chars"] == len(r["text"])
        assert r["url"] == given[r["page_id"]]["url"]


def test_repeated_branches_go_without_names(spark):
    lines = ["Read more of our stories", "Call us today", "All rights kept"]
    site = "<div><p>{0}</p></div><section><h1>Title {1}</h1><p>Story {1} goes on</p></section><div class=x><p>{2}</p></div>"
    rows = [(i, "http://A.example/%d" % i, site.format(lines[i % 3], i, lines[(i + 1) % 3])) for i in range(240)]
    rows += [(1000 + i, f"https://small{i}.example/", site.format(lines[0], 1000 + i, lines[1])) for i in range(5)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    for joined in (pages.SENT_ALONG_NODES, -1):
        pages.SENT_ALONG_NODES, before = joined, pages.SENT_ALONG_NODES
        try:
            got = pages.main_texts(df, "page_id").collect()
        finally:
            pages.SENT_ALONG_NODES = before
        assert len(got) == 245
        for r in got:
            assert r["text"] == f"Title {r['page_id']}\nStory {r['page_id']} goes on"


def test_copies_and_recurring_blocks_of_an_article_stay(spark):
    article = "<article><h1>Story {0}</h1><p>Of {0}</p><h2>Conclusion</h2><ul><li>Yes<li>No</ul></article>"
    rows = [(i, f"http://h{i % 2}.example/{i}", article.format(i % 50)) for i in range(600)]
    same = "<div><h1>Title</h1><p>A page that 300 addresses have</p></div>"
    rows += [(1000 + i, "http://same.example/%d" % i, same) for i in range(300)]
    rows += [(2000 + i, f"http://mirror{i}.example/", "<section><p>A page on 300 hosts</p></section>") for i in range(300)]
    got = pages.main_texts(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4), "page_id").collect()
    assert len(got) == 1200
    for r in got:
        i = r["page_id"]
        want = "Story {0}\nOf {0}\nConclusion\nYes\nNo".format(i % 50) if i < 1000 else "Title\nA page that 300 addresses have"
        assert r["text"] == ("A page on 300 hosts" if i >= 2000 else want)


def test_the_tree_judges_marked_pages(spark):
    teaser = "<article class=card><h2>Our guide</h2><p>It is free</p></article>"
    site = "<nav><p>{0}</p></nav>{1}<article class=story><h1>Story {2}</h1><p>Of {2}</p><h2>Conclusion</h2></article>{1}"
    rows = [(i, f"http://a.example/{i}", site.format(("Home", "News")[i % 2], teaser, i)) for i in range(240)]
    rows += [(1000 + i, f"http://b.example/{i}", f"<main>{teaser}<p>So{i // 2}</p></main>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    low = {r["n"] for r in pages.unimportant(df).select(F.explode("nodes").alias("n")).collect()}
    assert {pages.node_key(p) for p in ("/nav/p", "/article.card/h2", "/article.card/p", "/article.story/h2")} <= low
    for r in pages.main_texts(df, "page_id").collect():
        i = r["page_id"]
        # Few pages say nothing against a marked article.
        assert r["text"] == (f"Story {i}\nOf {i}\nConclusion" if i < 1000 else "Our guide\nIt is free\nSo0")


def test_the_tree_has_nodes_of_the_table(spark):
    df = table(spark, SF, "pages")
    hosts = df.select(F.xxhash64(pages.host_of(F.col("url"))).alias("host")).distinct().count()
    judged = pages.style_nodes(df, "url", "html").select("host", "node").distinct()
    assert judged.where(F.col("node") == pages.node_key("/html/body/nav/ul/li")).count() == hosts


def test_values_do_not_jump(spark):
    n = spark.range(1, 1000).select(pages.drawn(F.lit(0.2), F.col("id"), F.lit(1.0)).alias("v")).collect()
    assert n[0]["v"] == 1.0 and all(0 < a["v"] - b["v"] < 0.01 for a, b in zip(n, n[1:]))


def test_importance(spark):
    n = 256
    counts = spark.createDataFrame(
        [(1, 2, 0, n), (1, 0, 5, n // 2), (1, 0, 6, n // 2), *[(1, 1, v, 16) for v in range(4)], (2, 2, 0, 1), (2, 1, 0, 1)],
        "node long, kind int, value int, n long",
    )
    got = {r["node"]: r["importance"] for r in pages.importance(counts, "node").collect()}
    assert math.isclose(got[1], 0.1 * math.log(2, n) + 0.9 * (1 - math.log(16, n))) and got[2] == 1.0


def test_pages_of_edge_rows(rows):
    long = "<p>" + "wörd " * 100_000
    df = rows([(1, None, None, "t"), (2, "", "", "t"), (None, "x", "<p>a", "t"), (3, "http://h/", long, "t"), (3, "http://h/", long, "t")], "page_id long, url string, html string, text string")
    got = pages.main_texts(df, "page_id", "url").collect()
    assert [len(r["text"]) for r in got] == [0, 0, 1, 499_999, 499_999]
    assert pages.main_texts(df.limit(0), "page_id").collect() == []
    assert {r["h"] for r in rows([("HTTPS://A.b:1/x?y",), (None,), ("no",)], "u string").select(pages.host_of(F.col("u")).alias("h")).collect()} == {"a.b:1", ""}


# Secrets


BASE = (
    (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A), lambda m: len(m[2]) >= 6),
    (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
)


def base_spans(text):
    return sorted((m.start(), k, m.end()) for k, (p, ok) in enumerate(BASE) for m in p.finditer(text or "") if ok(m))


def as_list(spans):
    return ",".join(f"{secret_scan.KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_known_patterns_of_the_table(spark):
    sf = "/root/testdata/sf0.01"
    texts = {r["doc_id"]: r["text"] for r in table(spark, sf, "documents").collect()}
    got = LLM_QUERIES["op7_secret_spans"](spark, sf).collect()
    assert len(got) == len(texts) and sum(r["n_assign"] for r in got) > 0
    for r in got:
        want = base_spans(texts[r["doc_id"]])
        assert r["base_sha256"] == hashlib.sha256(as_list(want).encode()).hexdigest()
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == i for _, k, _ in want) for i in range(3)]
        assert set(as_list(want).split(",")) <= set(r["spans"].split(","))


HOSTILE = [
    None, "", "token=abcdef", "token=abcde", "\U0001f600é token: 'a.b=c-d' x", "token=token=token=abcdefgh", "api_key=token: abcdef123",
    "PASSWORD = \"x1y2z3\" passwd:::abcdefg secret' : 'abcdefgh", "AKIA" + "A1" * 8, "xAKIA" + "B" * 15, "AKIAAKIA" + "7" * 30,
    "0123456789abcdef01234567", "z" + "ab" * 12 + "Z" + "0" * 23, "tOken=Kabcdefg apiKey=abcdefg", "secret\t=abcdefg secret  =  abcdefg",
    "password=" + "a" * 50_000, ("token=abcdef" + " x" * 7 + "ß") * 700, "apikey=abcdef,api_key=ghijkl api__key=mnopqr",
]


def test_known_patterns_in_hostile_texts(rows):
    df = rows([(i, t, "x") for i, t in enumerate(HOSTILE)] + [(None, HOSTILE[2], "x"), (3, HOSTILE[2], "x")], "doc_id long, text string, spans string")
    got = secret_scan.scan(df, "text", "doc_id", F.col("text").alias("said")).collect()
    assert len(got) == len(HOSTILE) + 2
    for r in got:
        assert [tuple(s) for s in r["base"]] == base_spans(r["said"])
    assert secret_scan.scan(df.limit(0), "text", "doc_id").collect() == []


def tail(z):
    return 1 / (1 + math.exp(min(700.0, 1.5976 * z + 0.07056 * z**3)))


def randomness(match):
    body = match.rstrip("=") or match
    letters = next((a for p, a in secret_scan.ALPHABETS if re.match(p, body)), secret_scan.OTHER_ALPHABET)
    v = [letters.index(c) for c in body]
    n, a = len(v), len(letters)
    chi = a / n * sum(v.count(c) ** 2 for c in set(v)) - n
    spread = 2 / (9 * (a - 1))
    uneven = ((max(chi, 0) / (a - 1)) ** (1 / 3) - (1 - spread)) / spread**0.5
    high = [x >= a / 2 for x in v]
    n1, n0 = sum(high), n - sum(high)
    mean = 2 * n1 * n0 / n + 1
    variance = (mean - 1) * (mean - 2) / (n - 1)
    runs = 1 + sum(x != y for x, y in zip(high, high[1:]))
    z = abs(runs - mean) / variance**0.5 if variance > 0 else 8.0
    m = sum(v) / n
    around = sum((x - m) ** 2 for x in v)
    serial = abs(sum((x - m) * (y - m) for x, y in zip(v, v[1:])) / around) * n**0.5 if around > 1e-9 else 8.0
    return min(1.0, 3 * min(tail(uneven), 2 * tail(z), 2 * tail(serial)))


def test_randomness_equals_the_three_tests(rows):
    import random

    rng = random.Random(1)
    texts = ["a" * 20, "ab" * 15, "0123456789abcdef" * 3, "internationalizationofthings", "A" * 30 + "==", "=" * 20]
    for _, letters in secret_scan.ALPHABETS:
        texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(20, 70))) for _ in range(6)]
    got = rows([(t,) for t in texts], "t string").select("t", secret_scan.randomness(F.col("t")).alias("p")).collect()
    for r in got:
        assert math.isclose(r["p"], randomness(r["t"]), rel_tol=1e-6, abs_tol=1e-12), r["t"]


def test_random_strings_are_added_and_words_are_not(rows):
    import random

    rng = random.Random(2)
    letters = secret_scan.UPPER + secret_scan.LOWER + secret_scan.DIGITS
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(40)]
    words = ["".join(rng.choice(["ing", "tion", "er", "the", "and"]) for _ in range(rng.randrange(6, 12))) for _ in range(400)]
    names = [f"{w[:20]}-{w[:12]}-2024" for w in words[:40]]
    docs = [(i, f"see {w} here") for i, w in enumerate(words)]
    docs += [(1000 + i, f"é key {k}. And") for i, k in enumerate(keys)] + [(2000 + i, f"file {n} is") for i, n in enumerate(names)]
    got = secret_scan.scan(rows(docs, "doc_id long, text string").repartition(3), "text", "doc_id").collect()
    marked = {r["doc_id"] for r in got if r["spans"]}
    assert not [d for d in marked if d < 1000]
    assert len([d for d in marked if 1000 <= d < 2000]) >= 36 and len([d for d in marked if d >= 2000]) <= 4
    assert all([tuple(s) for s in r["spans"]] == [(6, 3, 46)] for r in got if 1000 <= r["doc_id"] < 2000 and r["spans"])


@pytest.mark.parametrize("words", [0, 30])
def test_random_strings_without_words_and_with_a_hot_run(rows, words):
    import random

    rng = random.Random(5)
    letters = secret_scan.UPPER + secret_scan.LOWER
    keys = ["".join(rng.choice(letters + secret_scan.DIGITS) for _ in range(40)) for _ in range(20)]
    alone = ["".join(rng.choice(letters) for _ in range(48)) for _ in range(10)]
    names = [f"report-of-the-section-{i}-in-2024" for i in range(10)] + [letters[26:] + secret_scan.DIGITS]
    usual = ["counterrevolutionaries", "internationalization", "Donaudampfschifffahrtsgesellschaft", "antidisestablishmentarianism"]
    docs = [(i, f"key {k} is") for i, k in enumerate(keys)] + [(200 + i, f"file {n} is") for i, n in enumerate(names)]
    if words:
        docs += [(300 + i, f"see {usual[i % 4]}{'es' * (i // 4)} here") for i in range(words)]
        docs += [(100 + i, f"key {k} is") for i, k in enumerate(alone)] + [(1000 + i, f"key {alone[0]} is") for i in range(200)]
    got = secret_scan.scan(rows(docs, "doc_id long, text string").repartition(3), "text", "doc_id").collect()
    marked = {r["doc_id"] for r in got if r["spans"]}
    assert len([d for d in marked if d < 100]) >= 19 and not [d for d in marked if 200 <= d < 1000]
    if words:
        assert len([d for d in marked if 100 <= d < 200]) >= 8 and len([d for d in marked if d >= 1000]) == 200


def test_masks(rows):
    text = "a token=abcdef, b secret='0123456789abcdef01234567' é c"
    df = secret_scan.scan(rows([(1, text), (2, "clean"), (3, None)], "doc_id long, text string"), "text", "doc_id", F.col("text").alias("said"))
    got = df.select(secret_scan.masked(F.col("said"), "spans").alias("m")).collect()
    assert [r["m"] for r in got] == ["a [secret], b [secret]' é c", "clean", None]
