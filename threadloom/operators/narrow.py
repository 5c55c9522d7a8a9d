"""Validation, filters and narrow projections."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from threadloom.functions.text import text_or_empty
from threadloom.functions.times import lenient_epoch
from threadloom.operators.ranking import first_by

CAPTURE_KEYS = ("sub", "kind", "y", "md", "hms", "sid", "cap14", "hash")


def narrow_submissions(
    raw: DataFrame, keys: Sequence[str] = CAPTURE_KEYS, line_order: Sequence[str] | None = None
) -> DataFrame:
    """B1: author, title and body (the ``selftext``), nulls as ''.

    With ``line_order`` only the first row of every capture is kept; leave it
    out where captures hold one row each, which saves the shuffle.
    """
    order = list(line_order or [])
    slim = raw.select(
        *keys,
        *order,
        text_or_empty("author").alias("author"),
        text_or_empty("selftext").alias("body"),
        text_or_empty("title").alias("title"),
    )
    return first_by(slim, keys, order).drop(*order) if order else slim


def narrow_comments(raw: DataFrame, keys: Sequence[str] = CAPTURE_KEYS) -> DataFrame:
    """B2: author, body, comment_id and parent_id of rows that have an id."""
    return raw.where(F.col("id").isNotNull()).select(
        *keys,
        text_or_empty("author").alias("author"),
        text_or_empty("body").alias("body"),
        F.col("id").alias("comment_id"),
        text_or_empty("parent_id").alias("parent_id"),
    )


def union_kinds(submissions: DataFrame, comments: DataFrame) -> DataFrame:
    """G1: both kinds in one table; columns a kind lacks are null."""
    return submissions.unionByName(comments, allowMissingColumns=True)


def nonblank(df: DataFrame, text: str = "text") -> DataFrame:
    """B4, on text that is already stripped."""
    return df.where(F.col(text) != "")


def since(df: DataFrame, now: dt.datetime, days: int, created: str = "created") -> DataFrame:
    """Rows not older than ``days`` times 86400 seconds; the literal bound
    reaches the scan."""
    cutoff = now - dt.timedelta(days=days)
    if isinstance(df.schema[created].dataType, T.TimestampNTZType):
        bound = F.lit(cutoff.replace(tzinfo=None)).cast("timestamp_ntz")
    elif isinstance(df.schema[created].dataType, T.TimestampType):
        bound = F.lit(cutoff)
    else:
        whole = cutoff if cutoff.tzinfo else cutoff.replace(tzinfo=dt.UTC)
        bound = F.lit(int(whole.timestamp()))
    return df.where(F.col(created) >= bound)


def only_subs(df: DataFrame, subs: Sequence[str] | DataFrame) -> DataFrame:
    """Rows of the allowed corpora, given as a list or as a table."""
    if isinstance(subs, DataFrame):
        return df.join(subs.select("sub"), "sub", "left_semi")
    return df.where(F.col("sub").isin(list(subs)))


def unknown_subs(df: DataFrame, subs: Sequence[str] | DataFrame) -> DataFrame:
    """Allowed corpora that have no rows, for a warning."""
    if not isinstance(subs, DataFrame):
        subs = df.sparkSession.createDataFrame([(s,) for s in subs], "sub string")
    return subs.join(df.select("sub").distinct(), "sub", "left_anti")


def post_is_valid(id: Column | str, created: Column | str, sub: Column | str) -> Column:
    """The id is there, the time is a number above 0, the corpus is named."""
    return (
        (text_or_empty(id) != "")
        & (text_or_empty(sub) != "")
        & (F.coalesce(lenient_epoch(created), F.lit(0)) > 0)
    )


def valid_posts(
    df: DataFrame, id: str = "id", created: str = "created_utc", sub: str = "sub", mode: str = "skip"
) -> DataFrame:
    """``skip`` drops posts that lack a required field, ``fail`` stops the
    job at the first one."""
    good = post_is_valid(id, created, sub)
    if mode == "skip":
        return df.where(good)
    if mode != "fail":
        raise ValueError(f"mode must be skip or fail, not {mode!r}")
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("post lacks a required field"))))


def harvested_posts(df: DataFrame, id: str = "id", name: str = "name", created: str = "created_utc") -> DataFrame:
    """B9 for freshly collected posts: a missing id, name or time is fatal."""
    good = (text_or_empty(id) != "") & (text_or_empty(name) != "") & lenient_epoch(created).isNotNull()
    return df.where(F.when(good, F.lit(True)).otherwise(F.raise_error(F.lit("post without created_utc, id or name"))))


def link_filter(df: DataFrame, link: str = "link_id", post: str = "post_id") -> DataFrame:
    """Comments that hang on a post; the post id follows the first _."""
    return df.where(F.col(link).startswith("t3_")).withColumn(post, F.substr(F.col(link), F.lit(4)))
