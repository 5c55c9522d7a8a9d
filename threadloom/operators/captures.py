"""Captures and versions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from threadloom.operators.ranking import last_by, matching, one_per_key, same
from threadloom.session import materialize

THREAD_KEYS = ("sub", "kind", "sid")
VERSION_KEYS = ("y", "md", "hms", "cap14", "h16")


def unseen(rows: DataFrame, seen: DataFrame, keys: Sequence[str]) -> DataFrame:
    """C4: rows whose keys are not in ``seen``; of ``seen`` only the keys are
    read."""
    return rows.join(seen.select(*keys), list(keys), "left_anti")


def distinct_captures(
    captures: DataFrame, thread: Sequence[str] = THREAD_KEYS, hash: str = "hash", cap: str = "cap14"
) -> DataFrame:
    """Every hash a thread has ever had, with its earliest capture."""
    return captures.groupBy(*thread, hash).agg(F.min(cap).alias(cap), F.count(F.lit(1)).alias("n_captures"))


def new_captures(
    captures: DataFrame, existing: DataFrame | None, thread: Sequence[str] = THREAD_KEYS, hash: str = "hash"
) -> DataFrame:
    """C4 and D7 for one batch of (thread, hash, cap14) rows: the earliest
    capture of every hash the thread has not had before."""
    first = distinct_captures(captures, thread, hash).drop("n_captures")
    return first if existing is None else unseen(first, existing, [*thread, hash])


def changed_captures(
    captures: DataFrame,
    thread: Sequence[str] = THREAD_KEYS,
    hash: str = "hash",
    cap: str = "cap14",
    partitions: int | None = None,
) -> DataFrame:
    """Q4: captures whose hash differs from that of the thread's previous capture by
    (cap, hash), so that a thread which goes back to an old state is captured again.

    Rows are laid out in ranges of (thread, cap, hash), so a thread of any length is
    shared by many tasks.  Inside a range the previous row is at hand; the first row
    of a range is compared with the last one of the thread's range before."""
    keys = [*thread, cap, hash]
    ranged = captures.repartitionByRange(partitions, *keys) if partitions else captures.repartitionByRange(*keys)
    laid = materialize(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    own = Window.partitionBy(*thread, "_range").orderBy(cap, hash)
    # A thread has one row per range here, so this window stays small.
    runs = laid.groupBy(*thread, "_range").agg(F.max(F.struct(cap, hash)).alias("_last"))
    carried = F.lag(F.struct(F.col(f"_last.{hash}").alias("h"))).over(Window.partitionBy(*thread).orderBy("_range"))
    names = [f"_k{i}" for i in range(len(thread) + 1)]
    runs = runs.select(*[F.col(c).alias(n) for c, n in zip([*thread, "_range"], names)], carried.alias("_carried"))
    # Structs tell a null hash from a row that is not there.
    placed = laid.withColumns(
        {"_before": F.lag(F.struct(F.col(hash).alias("h"))).over(own), "_place": F.row_number().over(own)}
    ).join(runs, same([*thread, "_range"], names))
    before = F.when(F.col("_place") == 1, F.col("_carried")).otherwise(F.col("_before"))
    changed = before.isNull() | ~before["h"].eqNullSafe(F.col(hash))
    return placed.where(changed).select(*captures.columns)


def latest_capture(
    captures: DataFrame, post: Sequence[str] = ("sub", "sid"), cap: str = "cap14", hash: str = "hash"
) -> DataFrame:
    """The capture of every post that comes last by (cap14, hash); one of them
    if it is there several times."""
    last = last_by(captures, post, [cap, hash])
    return one_per_key(last, last.select(*post), post)


def latest_versions(
    rows: DataFrame, thread: Sequence[str] = THREAD_KEYS, version: Sequence[str] = VERSION_KEYS
) -> DataFrame:
    """All rows of every thread's last version.

    The last version is found over the key columns alone with an aggregate
    that combines before the shuffle; the rows are then matched on the whole
    key, so a thread's rows need not meet in one task, and are not shuffled where
    few versions are superseded.
    """
    newest = rows.groupBy(*thread).agg(F.max(F.struct(*version)).alias("_newest")).select(*thread, "_newest.*")
    return matching(rows, newest, [*thread, *version])


def convert_new(
    captures: DataFrame, done: DataFrame, keys: Sequence[str] = ("sub", "kind", "sid", "cap14", "h16")
) -> DataFrame:
    """Captures whose output is missing."""
    return unseen(captures, done, keys)
