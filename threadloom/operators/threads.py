"""Posts, comments and threads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.fingerprints import set_hash, set_hash_sums
from threadloom.functions.text import text_or_empty
from threadloom.functions.times import lenient_double, lenient_epoch
from threadloom.operators.ranking import first_by, positions

THREAD = ("sub", "post_id")


def post_index(posts: DataFrame, sub: str = "sub", id: str = "id", created: str = "created") -> DataFrame:
    """The earliest ``created`` of every post."""
    return posts.groupBy(F.col(sub).alias("sub"), F.col(id).alias("post_id")).agg(F.min(created).alias("created"))


def retrieved_epoch(utc: Column | str = "retrieved_utc", on: Column | str = "retrieved_on") -> Column:
    """The first of the two fields that is not null, if it is a number."""
    first = F.coalesce(*[F.col(c) if isinstance(c, str) else c for c in (utc, on)])
    return lenient_epoch(first)


def capture_epoch(retrieved: Column, created: Column, now: int) -> Column:
    """The retrieval time, ``now`` where unknown, ``created`` where not
    after the epoch."""
    known = F.coalesce(retrieved, F.lit(int(now)).cast("bigint"))
    return F.when(known > 0, known).otherwise(created)


def thread_join(comments: DataFrame, posts: DataFrame) -> DataFrame:
    """Comments of known posts, with the post's ``created``.

    ``posts`` has one row per post, so only the comment side can be skewed;
    adaptive execution splits its hot partitions.
    """
    return comments.join(posts, list(THREAD), "inner")


def orphan_threads(threads: DataFrame, posts: DataFrame) -> DataFrame:
    """Comment threads with no known post."""
    return threads.join(posts, list(THREAD), "left_anti")


def empty_posts(posts: DataFrame, comments: DataFrame) -> DataFrame:
    """Posts that have no comments."""
    return posts.join(comments, list(THREAD), "left_anti")


def order_columns(parent: Column | str = "parent_id", created: Column | str = "created_utc", id: Column | str = "id"):
    """parent, time, id; missing counts as '' or 0."""
    time = F.col(created) if isinstance(created, str) else created
    return (
        text_or_empty(parent).alias("o_parent"),
        F.coalesce(lenient_double(time.cast("string")), F.lit(0.0)).alias("o_created"),
        text_or_empty(id).alias("o_id"),
    )


def comment_order(
    comments: DataFrame,
    group: Sequence[str] = THREAD,
    parent: str = "parent_id",
    created: str = "created_utc",
    id: str = "id",
    tie: Sequence[str] = (),
) -> DataFrame:
    """Comments with their 1-based place ``pos`` in their thread.

    ``tie`` names columns that keep equal rows in file order.
    """
    keyed = comments.select("*", *order_columns(parent, created, id))
    placed = positions(keyed, group, ["o_parent", "o_created", "o_id", *tie])
    return placed.drop("o_parent", "o_created", "o_id")


def dedup_comments(
    comments: DataFrame, file_order: Sequence[str], thread: Sequence[str] = THREAD, id: str = "id"
) -> DataFrame:
    """One row per comment id in a thread, the first in file order; rows
    without an id are dropped."""
    return first_by(comments.where(text_or_empty(id) != ""), [*thread, id], file_order)


def thread_fingerprints(comments: DataFrame, row_hash: str = "row_hash", thread: Sequence[str] = THREAD) -> DataFrame:
    """Comment count and fingerprint of every thread."""
    sums = comments.groupBy(*thread).agg(F.count(F.lit(1)).alias("n_comments"), *set_hash_sums(row_hash))
    return sums.select(*thread, "n_comments", set_hash("n_comments").alias("fingerprint"))


def thread_capture_times(
    comments: DataFrame, posts: DataFrame, now: int, retrieved: str = "retrieved", thread: Sequence[str] = THREAD
) -> DataFrame:
    """The newest retrieval time of every thread that has a post."""
    newest = comments.groupBy(*thread).agg(F.max(retrieved).alias("_newest"))
    joined = newest.join(posts, list(thread), "inner")
    return joined.select(*thread, "created", capture_epoch(F.col("_newest"), F.col("created"), now).alias("captured"))
