"""Captures out of freshly collected posts and comment trees."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from threadloom.functions.fingerprints import comment_hash, submission_fingerprint, variant_field
from threadloom.functions.once import computed_once
from threadloom.functions.times import lenient_epoch, stamp14, utc_parts
from threadloom.operators import threads
from threadloom.operators.captures import latest_capture, new_captures
from threadloom.operators.flatten import flatten_replies
from threadloom.operators.narrow import harvested_posts, since
from threadloom.operators.ranking import first_by
from threadloom.session import materialize

POST = ("sub", "sid")
# How the types of JSON numbers begin.
NUMBERS = r"^(BIGINT|DECIMAL|DOUBLE|FLOAT)"


def _number_field(name: str) -> Column:
    path = f"$.{name}"
    is_number = F.schema_of_variant(F.try_variant_get("obj", path, "variant")).rlike(NUMBERS)
    return F.when(is_number, F.try_variant_get("obj", path, "string"))


def submission_captures(
    items: DataFrame, now: dt.datetime, days: int = 7, existing: DataFrame | None = None
) -> DataFrame:
    """Capture rows of the posts of a feed, a table of (sub, raw).

    A post without its time, id or name stops the job.  Posts older than
    ``days`` are left out (B5), and so are those whose fingerprint (H5) the
    thread has had before (D7).
    """
    opened = computed_once(items.select("sub", "raw"), obj=F.parse_json("raw"))
    fields = computed_once(
        opened,
        sid=variant_field(F.col("obj"), "id", "string"),
        name=variant_field(F.col("obj"), "name", "string"),
        created_utc=_number_field("created_utc"),
    )
    checked = harvested_posts(fields, "sid", "name").withColumn("created", lenient_epoch("created_utc"))
    recent = since(checked, now, days).select(
        *POST,
        "created",
        stamp14(F.lit(_epoch(now))).alias("cap14"),
        submission_fingerprint("obj").alias("hash"),
        F.lit(1).cast("bigint").alias("line_no"),
        "raw",
        F.lit("submissions").alias("kind"),
    )
    # Numbered as it is written: a feed can show the same post twice.
    rows = materialize(recent.withColumn("seq", F.monotonically_increasing_id()), "feed")
    fresh = new_captures(rows.select(*POST, "hash", "cap14"), _seen(existing, "submissions"), POST)
    kept = rows.join(fresh, [*POST, "hash", "cap14"], "left_semi")
    return first_by(kept, [*POST, "hash"], ["created", "seq"]).drop("seq").withColumns(utc_parts("created"))


@dataclass(frozen=True)
class Harvested:
    """rows: capture rows; empty: posts without comments (M15); failed: posts
    whose payload could not be read."""

    rows: DataFrame
    empty: DataFrame
    failed: DataFrame


def comment_captures(trees: DataFrame, now: dt.datetime, existing: DataFrame | None = None) -> Harvested:
    """Capture rows of the reply trees of posts, a table of (sub, sid, created,
    tree): flattened (I1), in order (F6), with the thread's fingerprint (D8),
    unless the thread has had it before (C4)."""
    flat = materialize(flatten_replies(trees, "tree", [*POST, "created"]), "comments")
    comments = flat.where(F.col("parse_error").isNull()).withColumn("row_hash", comment_hash(F.parse_json("raw")))
    prints = comment_hashes(comments)
    seen = _seen(existing, "comments")
    fresh = prints if seen is None else prints.join(seen, [*POST, "hash"], "left_anti")
    # Read from the written comments again, for the few new threads of a run.
    kept = comments.join(materialize(fresh.select(*POST, "hash"), "fresh"), list(POST), "inner")
    placed = threads.comment_order(kept, POST, id="comment_id", tie=["seq"])
    rows = placed.select(
        *POST,
        "created",
        stamp14(F.lit(_epoch(now))).alias("cap14"),
        "hash",
        F.col("pos").alias("line_no"),
        "raw",
        F.lit("comments").alias("kind"),
    ).withColumns(utc_parts("created"))
    failed = flat.where(F.col("parse_error").isNotNull()).select(*POST, "parse_error")
    empty = trees.select(*POST).join(flat.select(*POST).distinct(), list(POST), "left_anti")
    return Harvested(rows, empty, failed)


def comment_hashes(comments: DataFrame) -> DataFrame:
    """(sub, sid, n_comments, hash): the fingerprint (D8) of every thread."""
    return threads.thread_fingerprints(comments, thread=POST).withColumnRenamed("fingerprint", "hash")


def harvest_targets(captures: DataFrame, now: dt.datetime, days: int = 7) -> DataFrame:
    """The posts whose comments are to be harvested: of every post created since
    the cutoff (B5) its latest capture (D4)."""
    posts = captures.where(F.col("kind") == "submissions")
    recent = since(posts, now, days).where(F.col("created").isNotNull())
    return latest_capture(recent)


def _epoch(now: dt.datetime) -> int:
    return int((now if now.tzinfo else now.replace(tzinfo=dt.UTC)).timestamp())


def _seen(existing: DataFrame | None, kind: str) -> DataFrame | None:
    if existing is None:
        return None
    return existing.where(F.col("kind") == kind).select(*POST, "hash").distinct()
