"""Connected components of a graph that is a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.session import materialize


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable, for every id with a link.

    Union by stars: links are turned, in rounds, until each points from an id to
    the smallest of its component.  The links stay a table, written each round,
    and the number of rounds grows with the logarithm of the longest path.  Links
    of an id with itself and links with a null do not count.
    """
    edges = materialize(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where(F.col("a").isNotNull() & F.col("b").isNotNull() & (F.col("a") != F.col("b")))
        .distinct(),
        "links",
    )
    state = _state(edges)
    while True:
        edges = materialize(_small_star(_large_star(edges)), "links")
        now = _state(edges)
        if now == state:
            break
        state = now
    stars = edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    roots = edges.select(F.col("b").alias("id"), F.col("b").alias("component")).distinct()
    return stars.union(roots)


def _state(edges: DataFrame):
    found = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(found)


def _large_star(edges: DataFrame) -> DataFrame:
    """Every neighbour above an id is linked with the smallest id around."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy(F.col("a").alias("u")).agg(F.least(F.min("b"), F.col("u")).alias("least"))
    # From the link (a, b) with a > b: a is above b, so it goes to b's smallest.
    return edges.join(least, edges["b"] == least["u"]).select("a", F.col("least").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """An id and its smaller neighbours are linked with the smallest of them."""
    least = edges.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("least"))
    turned = edges.join(least, edges["a"] == least["u"]).select(F.col("b").alias("a"), F.col("least").alias("b"))
    own = least.select(F.col("u").alias("a"), F.col("least").alias("b"))
    return turned.union(own).where(F.col("a") != F.col("b")).distinct()
