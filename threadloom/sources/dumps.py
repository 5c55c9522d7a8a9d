"""Bulk dumps of posts and comments (A2)."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions.ids import norm_sub
from threadloom.functions.once import computed_once
from threadloom.functions.text import none_if_empty, strip_text
from threadloom.functions.times import variant_number_text
from threadloom.session import configure
from threadloom.sources.captures import line_position


def parse_lines(lines: DataFrame, raw: str = "raw") -> DataFrame:
    """A2: keeps the lines that are one JSON object each, parsed once into
    VARIANT column ``obj``; blank, malformed and other lines are left out.

    The parser stops after the first whole value, so that a line with something
    left over would pass.  Inside a frame what is left over either breaks the
    frame or adds to it; its keys are new for every call, so no line can close
    the frame and open it again."""
    configure(lines.sparkSession)
    key = uuid.uuid4().hex
    framed = F.try_parse_json(F.concat(F.lit(f'{{"l{key}":['), strip_text(raw), F.lit(f'],"e{key}":0}}')))
    whole = computed_once(lines, _framed=framed).where(
        (F.size(F.try_variant_get("_framed", "$", "map<string,variant>")) == 2)
        & F.try_variant_get("_framed", f"$.e{key}", "int").isNotNull()
        & F.try_variant_get("_framed", f"$.l{key}[1]", "variant").isNull()
    )
    first = F.try_variant_get("_framed", f"$.l{key}[0]", "variant")
    return computed_once(whole, obj=first).drop("_framed").where(F.schema_of_variant("obj").startswith("OBJECT"))


def read_dump(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """A2 over dump files: raw, obj and the columns of FILE_ORDER."""
    configure(spark)
    paths = [paths] if isinstance(paths, str) else list(paths)
    return parse_lines(spark.read.text(paths).select(valid_utf8("value").alias("raw"), *line_position()))


def valid_utf8(c: str) -> Column:
    """Text without the bytes that are not UTF-8."""
    mended = F.replace(F.make_valid_utf8(c), F.lit("\ufffd"), F.lit(""))
    return F.when(F.is_valid_utf8(c), F.col(c)).otherwise(mended)


def split_paths(paths: Sequence[str]) -> tuple[list[str], list[str]]:
    """Dump files of posts and of comments, told apart by their names; no post
    file is an error."""
    names = [(p, p.rstrip("/").rsplit("/", 1)[-1]) for p in paths]
    posts = [p for p, n in names if "_posts" in n]
    comments = [p for p, n in names if "_comments" in n and "_posts" not in n]
    if not posts:
        raise ValueError("no *_posts files given")
    return posts, comments


def _text(path: str):
    return F.try_variant_get("obj", path, "string")


def _number(path: str) -> Column:
    return variant_number_text(F.col("obj"), path)


def post_fields(parsed: DataFrame) -> DataFrame:
    """The fields the import needs of a post; the corpus name is taken from the
    first of two fields that is not empty."""
    sub = F.coalesce(none_if_empty(_text("$.subreddit")), _text("$.subreddit_name_prefixed"))
    return computed_once(
        parsed,
        sub=norm_sub(sub),
        id=_text("$.id"),
        created_utc=_number("$.created_utc"),
        retrieved_utc=_number("$.retrieved_utc"),
        retrieved_on=_number("$.retrieved_on"),
    )


def comment_fields(parsed: DataFrame) -> DataFrame:
    """The fields the import needs of a comment; a link id that is not text
    counts as missing."""
    link = F.try_variant_get("obj", "$.link_id", "variant")
    return computed_once(
        parsed,
        sub=norm_sub(_text("$.subreddit")),
        id=_text("$.id"),
        link_id=F.when(F.schema_of_variant(link) == "STRING", _text("$.link_id")),
        parent_id=_text("$.parent_id"),
        created_utc=_number("$.created_utc"),
        retrieved_utc=_number("$.retrieved_utc"),
        retrieved_on=_number("$.retrieved_on"),
    )
