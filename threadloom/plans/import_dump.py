"""Bulk import of dumps into captures."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions.fingerprints import comment_hash, submission_fingerprint
from threadloom.functions.times import lenient_epoch, stamp14, utc_parts
from threadloom.operators import threads
from threadloom.operators.narrow import link_filter, valid_posts
from threadloom.operators.ranking import PLACE, at_places_in_place, with_place
from threadloom.operators.stats import capture_stats
from threadloom.session import materialize
from threadloom.sources import schemas
from threadloom.sources.captures import FILE_ORDER
from threadloom.sources.dumps import comment_fields, post_fields, read_dump, split_paths
from threadloom.sources.sinks import append_captures, partitions_for, read_if_there


@dataclass(frozen=True)
class Imported:
    """posts and comments: capture rows; orphans: threads without a post; stats: what
    the run found, wrote and skipped (D9), out of the keys it has written down.
    posts_by_day: the posts can be written as they lie, see lie_by_day.  partitions: how
    a new table of the captures is to lie."""

    posts: DataFrame
    comments: DataFrame
    threads: DataFrame
    orphans: DataFrame
    stats: DataFrame
    posts_by_day: bool = False
    partitions: tuple[str, ...] = schemas.PARTITIONS


def valid_post_rows(parsed: DataFrame, now: int) -> DataFrame:
    """Valid posts with ``created``, ``captured``, ``cap14`` and ``hash``."""
    rows = valid_posts(post_fields(parsed), "id", "created_utc", "sub")
    created = lenient_epoch("created_utc")
    return rows.select(
        "sub",
        "id",
        created.alias("created"),
        stamp14(threads.capture_epoch(_post_retrieved(now), created, now)).alias("cap14"),
        submission_fingerprint("obj").alias("hash"),
        "raw",
        *FILE_ORDER,
    )


def _post_retrieved(now: int):
    # A retrieval time that is no number leaves a post with its creation time.
    given = F.coalesce("retrieved_utc", "retrieved_on")
    return F.when(given.isNull(), F.lit(now).cast("bigint")).otherwise(
        F.coalesce(threads.retrieved_epoch(), F.lit(0).cast("bigint"))
    )


def linked_comments(parsed: DataFrame) -> DataFrame:
    """Comments of a named corpus that hang on a post."""
    rows = link_filter(comment_fields(parsed)).where(F.col("sub") != "")
    return rows.select(
        "sub",
        "post_id",
        "id",
        "parent_id",
        "created_utc",
        threads.retrieved_epoch().alias("retrieved"),
        comment_hash("obj").alias("row_hash"),
        "raw",
        *FILE_ORDER,
    )


def thread_captures(comments: DataFrame, unique: DataFrame, posts: DataFrame, now: int) -> DataFrame:
    """One row per comment thread of a known post: created, cap14, hash.

    Two aggregates that combine before the shuffle, joined on the thread; no
    task ever holds all comments of a thread.
    """
    times = threads.thread_capture_times(comments, posts, now)
    prints = threads.thread_fingerprints(unique)
    return times.join(prints, list(threads.THREAD), "inner").select(
        *threads.THREAD, "created", stamp14("captured").alias("cap14"), F.col("fingerprint").alias("hash"), "n_comments"
    )


def import_dump(
    parsed_posts: DataFrame, parsed_comments: DataFrame, existing: DataFrame | None = None, now: int | None = None
) -> Imported:
    """Captures out of parsed dump lines.

    A post has the same fingerprint (H5) whichever way it came in, so one that
    was harvested is not captured again.
    The posts of all files are known before any comment is looked at, and a
    thread whose comments lie in several files is one thread.  ``existing`` is
    the capture table, whose (thread, hash) pairs are not captured again.
    """
    now = int(dt.datetime.now(dt.UTC).timestamp()) if now is None else now
    posts = with_place(materialize(valid_post_rows(parsed_posts, now), "posts", "zstd"))
    comments = materialize(linked_comments(parsed_comments), "comments")
    index = threads.post_index(posts)

    offered = materialize(_marked(first_post_rows(posts), _of_kind(existing, "submissions")), "post-offers")
    # The first row is found over keys; lines are read at its place, without a shuffle.
    won = offered.where("wrote AND cap14 IS NOT NULL")
    post_rows, in_place = at_places_in_place(posts, won)
    post_rows = post_rows.drop(*PLACE).withColumnRenamed("id", "sid")

    unique = threads.dedup_comments(comments, FILE_ORDER)
    keys = thread_captures(comments, unique, index, now).withColumnRenamed("post_id", "sid")
    found = materialize(_marked(keys, _of_kind(existing, "comments")), "thread-offers")
    fresh = found.where("wrote").drop("wrote", "n_comments")
    kept = unique.withColumnRenamed("post_id", "sid").join(fresh, ["sub", "sid"], "inner")
    placed = threads.comment_order(materialize(kept, "threads"), ["sub", "sid"])
    all_threads = comments.select(*threads.THREAD).distinct()
    partitions = _partitions(won)
    return Imported(
        posts=_capture_rows(post_rows.withColumn("line_no", F.lit(1).cast("bigint")), "submissions"),
        comments=_capture_rows(placed.withColumnRenamed("pos", "line_no"), "comments"),
        threads=found.drop("wrote").withColumnRenamed("sid", "post_id"),
        orphans=threads.orphan_threads(all_threads, index),
        stats=_import_stats(offered, found, index),
        posts_by_day=in_place and lie_by_day(won, partitions[1:]),
        partitions=partitions,
    )


def first_post_rows(posts: DataFrame) -> DataFrame:
    """Of every hash a post has had the earliest capture, and of its rows the place
    of the first in file order, by one aggregate."""
    order = F.struct(F.col("cap14").isNull().alias("unknown"), "cap14", *FILE_ORDER, *PLACE, "created")
    first = posts.groupBy("sub", F.col("id").alias("sid"), "hash").agg(F.min(order).alias("_first"))
    return first.select("sub", "sid", "hash", *[f"_first.{c}" for c in ("cap14", "created", *PLACE)])


def _days(rows: DataFrame, *more: str, by: Sequence[str] = ("y", "md")) -> DataFrame:
    return rows.select(*more, *[c.alias(n) for n, c in utc_parts("created").items() if n in by])


def lie_by_day(rows: DataFrame, by: Sequence[str] = ("y", "md")) -> bool:
    """Whether written by the tasks that read them, rows make few files: about one for
    every day (or year) and file that they come from, as where dumps are in order of time."""
    days = _days(rows, "_file", by=by).distinct()
    pairs, days, files = days.agg(F.count(F.lit(1)), F.count_distinct(*by), F.count_distinct("_file")).first()
    return pairs <= 2 * days + files


def _partitions(rows: DataFrame) -> tuple[str, ...]:
    days = _days(rows).groupBy("y", "md").agg(F.count(F.lit(1)).alias("n"))
    n_days, n_rows = days.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    return partitions_for(n_days, n_rows)


def _marked(keys: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Keys of captures with ``wrote``, which tells that the thread has not had the
    hash before."""
    if seen is None:
        return keys.withColumn("wrote", F.lit(True))
    known = seen.withColumn("_known", F.lit(True))
    return keys.join(known, ["sub", "sid", "hash"], "left").select(*keys.columns, F.col("_known").isNull().alias("wrote"))


def _import_stats(posts: DataFrame, found: DataFrame, index: DataFrame) -> DataFrame:
    """A post without a thread of comments counts as an empty thread."""
    keys = ("sub", "kind", "sid")
    post, comment = F.lit("submissions").alias("kind"), F.lit("comments").alias("kind")
    offers = posts.select("sub", post, "sid", "wrote").unionByName(found.select("sub", comment, "sid", "wrote"))
    named = index.select("sub", comment, F.col("post_id").alias("sid"))
    idle = named.join(found.select("sub", comment, "sid"), list(keys), "left_anti")
    return capture_stats(offers.withColumn("skipped", ~F.col("wrote")), idle)


def _of_kind(existing: DataFrame | None, kind: str) -> DataFrame | None:
    if existing is None:
        return None
    return existing.where(F.col("kind") == kind).select("sub", "sid", "hash").distinct()


def _capture_rows(rows: DataFrame, kind: str) -> DataFrame:
    return rows.select(
        "sid", "created", "cap14", "hash", "line_no", "raw", "sub", F.lit(kind).alias("kind")
    ).withColumns(utc_parts("created"))


def import_files(spark: SparkSession, paths: list[str], captures: str, now: int | None = None) -> Imported:
    """J7 over dump files, appended to the capture table at ``captures``."""
    post_files, comment_files = split_paths(paths)
    posts = read_dump(spark, post_files)
    comments = read_dump(spark, comment_files) if comment_files else posts.limit(0)
    done = import_dump(posts, comments, read_if_there(spark, captures, schemas.CAPTURE), now)
    append_captures(done.posts, captures, done.posts_by_day, done.partitions)
    append_captures(done.comments, captures, by=done.partitions)
    return done
