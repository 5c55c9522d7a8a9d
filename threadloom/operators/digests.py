"""A digest tree over documents (C3, J8): days, and buckets of ids inside a day.

A leaf holds the number of its documents and four sums over hashes of (id, content
hash).  Sums of leaves are the sums of their day.  Two sets of documents are
compared from the top: days first, leaves of the days that differ next, and only
the ids of leaves that differ are looked at at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.operators.ranking import same

# The vector table is partitioned by the same buckets, so a leaf that differs
# opens one of them.
BUCKETS = 32
LEAF = ("y", "md", "bucket")
SUMS = ("s0", "s1", "s2", "s3")
LEAVES = "y string, md string, bucket int, n bigint, s0 bigint, s1 bigint, s2 bigint, s3 bigint"


def id_bucket(id: Column | str = "id") -> Column:
    return F.pmod(F.xxhash64(id), F.lit(BUCKETS)).cast("int")


def leaf_digests(keys: DataFrame) -> DataFrame:
    """One row of LEAVES per day and bucket of (id, metadata, y, md)."""
    # 32 bits of each hash, so that two thousand million rows of a leaf fit a sum.
    parts = [
        F.sum(F.shiftrightunsigned(F.xxhash64("id", "metadata.h", F.lit(i)), 32)).alias(s) for i, s in enumerate(SUMS)
    ]
    leaves = keys.groupBy("y", "md", id_bucket().alias("bucket")).agg(F.count(F.lit(1)).alias("n"), *parts)
    return leaves.select(*LEAF, "n", *SUMS)


def day_digests(leaves: DataFrame) -> DataFrame:
    return leaves.groupBy("y", "md").agg(*[F.sum(c).alias(c) for c in ("n", *SUMS)])


def differing(leaves: DataFrame, known: DataFrame) -> DataFrame:
    """The leaves that ``known`` lacks or holds with another digest."""

    def lacking(left: DataFrame, right: DataFrame) -> DataFrame:
        other = right.select(*[F.col(c).alias(f"_{c}") for c in left.columns])
        return left.join(other, same(left.columns, other.columns), "left_anti")

    days = lacking(day_digests(leaves), day_digests(known)).select(F.col("y").alias("_y"), F.col("md").alias("_md"))
    inside = leaves.join(days, same(("y", "md"), days.columns), "left_semi")
    return lacking(inside, known.select(*leaves.columns))


def in_leaves(keys: DataFrame, leaves: DataFrame) -> DataFrame:
    """The rows of (id, y, md) that lie in the given leaves."""
    names = [f"_{c}" for c in LEAF]
    marked = keys.withColumn("_leaf", id_bucket())
    given = leaves.select(*[F.col(c).alias(n) for c, n in zip(LEAF, names)])
    return marked.join(given, same(("y", "md", "_leaf"), names), "left_semi").drop("_leaf")
