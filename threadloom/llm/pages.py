"""The main text of web pages, by a style tree for each site.

Every page is read into blocks of text under a path of block elements, each given
by its tag, class, id and role.  Merging the pages of a host gives its style tree:
for each path, on how many pages it occurs, with which sequences of children, and
which texts it holds.  The importance of a node is the entropy of its children's
sequences, and one less the mean entropy of its texts over the pages, weighted
1 : 9, logarithms to the base of the pages that have the node.  Text that comes
again on many pages makes a node unimportant, and blocks below ``IMPORTANT`` are
removed.  Equal pages count once, in a host and over all hosts.  The value of a host
is drawn to that of the tree of all hosts together, and this one to 1, the less the
fewer pages have the node: a weight of (pages - 1) / (pages - 1 + ``PRIOR_PAGES``).

Comments of readers or side columns can be as varied as articles, so elements
that say by tag, class, id or role that they are none of the article are left out
too; names that are also usual on articles, as ``has-sidebar`` or ``post-header``, say
nothing, and no name leaves out a page's main part or what is around it.  The tree
counts these blocks like all others, and its judgement comes first: names and marks
are looked at in what it has judged.  Where a page marks its article or main part,
only that is read; of several marked articles those without any important block, as
teasers that come again on other pages, are removed, unless none has one.  Inside an
article that stays nothing is removed for coming again.

Only hashes of paths and texts are shuffled, and counted before; the nodes to
remove are sent along if they are few, else joined to the pages by host.

Defined results: null and empty pages, and pages without text, have the empty
text; a null url is a host of its own; equal rows have a text each; tags that are
not closed end where HTML says so; an empty table gives no rows; columns other
than those named are not looked at.
"""

from __future__ import annotations

import html
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from threadloom.llm.common import bounded_batches, ids_for_join, whole_text
from threadloom.session import materialize

IMPORTANT = 0.7
LAYOUT_SHARE = 0.1
PRIOR_PAGES = 100
SENT_ALONG_NODES = 500_000

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    r"|<(script|style|noscript|template|svg|iframe|textarea|title)\b[^>]*>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)(?:>|\Z)"
    r"|<[!?][^>]*>?"
    r"|[^<]+|<",
    re.DOTALL | re.IGNORECASE,
)
ATTRIBUTE = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.IGNORECASE)
# Elements that stand in a line of text; all others are blocks.
INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img input ins kbd label map mark q ruby rb rp rt s "
    "samp small span strike strong sub sup time tt u var wbr".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
# What a start tag closes: the nearest of these, unless one of the second comes before.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table", "tbody", "thead", "tfoot"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
# Block elements that a paragraph may hold, so they do not end it.
IN_PARAGRAPH = frozenset("br button object select option picture video audio canvas area source track".split())
OUTSIDE_TAGS = frozenset("head nav footer aside form button select dialog menu object embed canvas".split())
# Names that say so as a whole or as the last part of a name, and as a whole only.
OUTSIDE_NAMES = frozenset(
    "ad ads adv advert advertisement advertising adverts banner breadcrumb breadcrumbs comment comments consent "
    "contentinfo cookie cookies disqus foot footer masthead menubar modal nav navbar navigation newsletter pagination "
    "popup promo related replies sharing sidebar sidenav signup sponsor sponsored subscribe subscription toolbar widget".split()
)
WHOLE_NAMES = frozenset("header login menu reply search share social".split())
# Last parts that do not count if a single part is left, and parts that make a name one of a state, topic or layout.
CONTAINERS = frozenset("area bar block body box buttons container inner item items links list section wrap wrapper".split())
STATES = frozenset("category content format has hidden hide is lang layout no show tag template topic type with without".split())
MAIN_TAGS = frozenset(("article", "main"))
PARTS = re.compile(r"(?<![a-z0-9])([a-z]+)\d*(?![a-z0-9])")


def says_outside(name: str, in_main: bool) -> bool:
    """Whether a class, id or role is one that articles do not have."""
    parts = PARTS.findall(name.split("--")[0])
    if not parts or not STATES.isdisjoint(parts):
        return False
    if len(parts) == 1:
        return parts[0] in OUTSIDE_NAMES or (parts[0] in WHOLE_NAMES and not (in_main and parts[0] == "header"))
    return parts[-1] in OUTSIDE_NAMES or (len(parts) == 2 and parts[1] in CONTAINERS and parts[0] in OUTSIDE_NAMES)


def outside(tag: str, in_main: bool) -> bool:
    """Whether an element says by its tag that it is none of the article."""
    return tag in OUTSIDE_TAGS or (tag == "header" and not in_main)


def named_outside(tag: str, names: str, in_main: bool) -> bool:
    """Whether an element says so by its class, id or role."""
    return bool(names) and tag not in ("html", "body") and any(says_outside(name, in_main) for name in names.split())


class Page:
    """A page's blocks and elements, from one pass over its tags.

    ``blocks`` are (path, text, outside, in main part, article) in page order, the last
    the number of the outermost article that holds the block, 0 for none; ``layouts``
    are (path, children) for each element.

    Names of a main element and around it do not count.  Articles can be cards or
    comments as well, so for them this holds if no main part is found otherwise."""

    def __init__(self, source: str):
        self.found: list[tuple[str, str, bool, int, bool, int]] = []
        self.layouts: list[tuple[str, str]] = []
        self.has_main = False
        # The elements outside by name that are around main elements, and around articles.
        self.around_main: set[int] = set()
        self.around_articles: set[int] = set()
        self.named = 0
        self.articles = 0
        # Of each open element: tag, path, outside by tag, the innermost element outside by name, in main part, article, children.
        self.open: list[tuple[str, str, bool, int, bool, int, list]] = [("", "", False, 0, False, 0, [])]
        self.text: list[str] = []
        for match in TOKEN.finditer(source):
            tag = match[3]
            if tag is None:
                token = match[0]
                if token[0] != "<" or token == "<":
                    self.text.append(token)
                elif match[1]:
                    self.text.append(" ")
                continue
            tag = tag.lower()
            if tag == "br":
                self.text.append(" ")
            elif tag in INLINE:
                pass
            elif match[2]:
                self.end(tag)
            else:
                self.start(tag, match[4])
        while len(self.open) > 1:
            self.close()
        self.flush()
        inside = self.around_main
        if not (self.has_main or inside):
            inside = self.around_articles
        self.has_main = self.has_main or bool(inside)
        self.blocks = [
            (path, text, out or (named > 0 and named not in inside), main, article)
            for path, text, out, named, main, article in self.found
        ]

    def flush(self) -> None:
        if self.text:
            text = " ".join(html.unescape("".join(self.text)).split())
            self.text = []
            if text:
                _, path, out, named, main, article, _ = self.open[-1]
                self.found.append((path, text, out, named, main, article))

    def start(self, tag: str, attributes: str) -> None:
        self.flush()
        if tag not in IN_PARAGRAPH:
            self.close_to({"p"}, {"table", "td", "th", "button", "object"})
        if tag in CLOSES:
            self.close_to(*CLOSES[tag])
        names = ""
        if attributes and not attributes.isspace():
            names = " ".join((m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes))
        if tag in VOID:
            return
        _, path, out, named, main, article, children = self.open[-1]
        starts = tag in MAIN_TAGS or names == "main"
        main = main or starts
        if tag == "article" and not article:
            self.articles += 1
            article = self.articles
        out = out or outside(tag, main)
        if named_outside(tag, names, main):
            self.named += 1
            named = self.named
        if starts and not out and named:
            around = self.around_articles if tag == "article" else self.around_main
            around.add(named)
            around.update(o[3] for o in self.open if o[3])
        self.has_main = self.has_main or (main and not out and not named)
        shape = f"{tag}.{names}" if names else tag
        if not children or children[-1] != shape:
            children.append(shape)
        self.open.append((tag, f"{path}/{shape}", out, named, main, article, []))

    def end(self, tag: str) -> None:
        self.flush()
        if any(o[0] == tag for o in self.open):
            self.close_to({tag}, set())

    def close_to(self, tags: set, bounds: set) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] in tags:
                while len(self.open) > depth:
                    self.close()
                return
            if self.open[depth][0] in bounds:
                return

    def close(self) -> None:
        self.flush()
        _, path, _, _, _, _, children = self.open.pop()
        self.layouts.append((path, " ".join(children)))

    def candidates(self) -> list[tuple[str, str]]:
        """(path, text) of the blocks that may belong to the article."""
        return [(path, text) for path, text, out, main, _ in self.blocks if not out and (main or not self.has_main)]

    def main_text(self, low) -> str:
        """The page's main text, given which nodes the style tree finds unimportant."""
        if not low:
            return "\n".join(text for _, text in self.candidates())
        judged = [(*block, node_key(block[0]) not in low) for block in self.blocks]
        if not self.has_main:
            return "\n".join(text for _, text, out, _, _, important in judged if important and not out)
        marked = [(text, article, important) for _, text, out, main, article, important in judged if main and not out]
        varied = {article for _, article, important in marked if article and important}
        return "\n".join(text for text, article, _ in marked if not article or not varied or article in varied)


def host_of(url: Column) -> Column:
    """The host in lower case, '' for none."""
    return F.coalesce(F.regexp_extract(F.lower(url), r"^[a-z][a-z0-9+.\-]*://([^/?#]*)", 1), F.lit(""))


def node_key(path: str) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(path) - (1 << 63)


def style_nodes(pages: DataFrame, url_col: str, html_col: str) -> DataFrame:
    """(host, node, kind, value, own, all): what each page has under each node, once.

    Kind 0 is a sequence of children, 1 a text, 2 the node itself.  A page that its
    host has m times counts as 1/m in ``own``, by its copies on all hosts in ``all``.
    Every block is counted, whatever its names and marks say."""
    given = pages.select(F.xxhash64(host_of(F.col(url_col))).alias("host"), whole_text(html_col).alias("html")).withColumn("page", F.xxhash64("html"))
    copies = given.groupBy("page", "host").agg(F.count(F.lit(1)).alias("n"))
    here = materialize(copies.where("n > 1").select(F.col("page").alias("_p"), F.col("host").alias("_h"), F.col("n").alias("_here")), "page-copies")
    anywhere = materialize(
        copies.groupBy("page").agg(F.sum("n").alias("_anywhere")).where("_anywhere > 1").withColumnRenamed("page", "_q"), "page-mirrors"
    )
    given = given.join(ids_for_join(here), (F.col("page") == F.col("_p")) & (F.col("host") == F.col("_h")), "left")
    given = given.join(ids_for_join(anywhere), F.col("page") == F.col("_q"), "left")
    given = given.select("host", "html", *[(1 / F.coalesce(n, F.lit(1))).alias(c) for c, n in (("own", "_here"), ("all", "_anywhere"))])

    bounded_batches(pages.sparkSession)
    def run(batches):
        import pyarrow as pa
        import xxhash

        for batch in batches:
            hosts, nodes, kinds, values, owns, alls = [], [], [], [], [], []
            for host, source, own, everywhere in zip(*(c.to_pylist() for c in batch.columns)):
                page = Page(source)
                found = {(path, 1, xxhash.xxh32_intdigest(text) - (1 << 31)) for path, text, *_ in page.blocks}
                held = {path for path, _, _ in found}
                found |= {(path, 2, 0) for path in held}
                found |= {(path, 0, xxhash.xxh32_intdigest(shape) - (1 << 31)) for path, shape in page.layouts if path in held}
                for path, kind, value in found:
                    hosts.append(host)
                    nodes.append(node_key(path))
                    kinds.append(kind)
                    values.append(value)
                    owns.append(own)
                    alls.append(everywhere)
            yield pa.RecordBatch.from_arrays(
                [
                    *(pa.array(hosts, pa.int64()), pa.array(nodes, pa.int64()), pa.array(kinds, pa.int8()), pa.array(values, pa.int32())),
                    *(pa.array(owns, pa.float64()), pa.array(alls, pa.float64())),
                ],
                names=["host", "node", "kind", "value", "own", "all"],
            )

    return given.mapInArrow(run, "host long, node long, kind byte, value int, own double, all double")


def drawn(value: Column, pages: Column, to: Column) -> Column:
    """The value seen on so many pages, drawn to another one the less the more they are."""
    return to + (value - to) * (pages - 1) / (pages - 1 + PRIOR_PAGES)


def importance(counts: DataFrame, *by: str) -> DataFrame:
    """(by, pages, importance) of nodes, from pages per (by, kind, value)."""
    n = F.col("n")
    sums = counts.groupBy(*by).agg(
        F.sum(F.when(F.col("kind") == 2, n)).alias("pages"),
        F.sum(F.when(F.col("kind") == 0, n)).alias("layouts"),
        F.sum(F.when(F.col("kind") == 0, n * F.ln(n))).alias("layout_logs"),
        F.count_if(F.col("kind") == 1).alias("texts"),
        F.sum(F.when(F.col("kind") == 1, F.ln(n))).alias("text_logs"),
    )
    base = F.ln("pages")
    layout = F.when(F.col("layouts") > 0, (F.ln("layouts") - F.col("layout_logs") / F.col("layouts")) / base).otherwise(0.0)
    texts = 1 - F.col("text_logs") / F.col("texts") / base
    value = F.when(F.col("pages") < 2, F.lit(1.0)).otherwise(LAYOUT_SHARE * layout + (1 - LAYOUT_SHARE) * texts)
    return sums.select(*by, "pages", value.alias("importance"))


def unimportant(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(host, nodes): the nodes of each host whose blocks are to be removed."""
    # Parts of a page add up to 1 but for rounding.
    counts = materialize(
        style_nodes(pages, url_col, html_col)
        .groupBy("host", "node", "kind", "value")
        .agg(F.round(F.sum("own")).cast("long").alias("n"), F.sum("all").alias("all")),
        "style-tree",
    )
    own = importance(counts, "host", "node")
    # A node whose pages are all mirrors of a page counts as one page.
    shared = counts.groupBy("node", "kind", "value").agg(F.greatest(F.lit(1), F.round(F.sum("all"))).cast("long").alias("n"))
    merged = importance(shared, "node").select(F.col("node").alias("m"), drawn(F.col("importance"), F.col("pages"), F.lit(1.0)).alias("usual"))
    known = own.join(merged, F.col("node") == F.col("m"))
    low = drawn(F.col("importance"), F.col("pages"), F.col("usual")) < IMPORTANT
    return materialize(known.where(low).groupBy("host").agg(F.collect_list("node").alias("nodes")), "style-noise")


def main_texts(pages: DataFrame, *columns: str, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``columns`` of every page with its main text: blocks joined by newlines."""
    noise = unimportant(pages, url_col, html_col)
    found = noise.agg(F.sum(F.size("nodes") + 1).alias("n")).first()["n"] or 0
    given = pages.select(*columns, F.xxhash64(host_of(F.col(url_col))).alias("_host"), whole_text(html_col).alias("_html"))
    noise = noise.withColumnRenamed("host", "_h")
    joined = given.join(F.broadcast(noise) if found <= SENT_ALONG_NODES else noise, F.col("_host") == F.col("_h"), "left").select(
        *columns, F.coalesce("nodes", F.array().cast("array<bigint>")).alias("_nodes"), "_html"
    )
    kept = joined.schema.fields[: len(columns)]
    schema = T.StructType([*kept, T.StructField("text", T.StringType())])

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = []
            for nodes, source in zip(batch.column(batch.num_columns - 2).to_pylist(), batch.column(batch.num_columns - 1).to_pylist()):
                texts.append(Page(source).main_text(set(nodes)))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-2], pa.array(texts, pa.string())], names=[*columns, "text"])

    return joined.mapInArrow(run, schema)
