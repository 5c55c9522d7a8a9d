"""Nested reply trees to flat comments."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, types as T

FLAT_FIELDS = [
    T.StructField("comment_id", T.StringType()),
    T.StructField("parent_id", T.StringType()),
    T.StructField("created_utc", T.DoubleType()),
    T.StructField("seq", T.LongType()),
    T.StructField("raw", T.StringType()),
    T.StructField("parse_error", T.StringType()),
]


def _object(node) -> dict:
    return node if isinstance(node, dict) else {}


def _children(listing) -> list:
    found = _object(_object(listing).get("data")).get("children")
    return found if isinstance(found, list) else []


def comments_of(payload) -> Iterator[dict]:
    """The data of every comment node below a listing, parents first.

    Nodes that are neither a comment nor a listing are left out.  Pending
    nodes are kept on a stack, so depth is bounded by the parser alone.
    """
    pending = _children(payload)[::-1]
    while pending:
        node = _object(pending.pop())
        data = node.get("data")
        if not isinstance(data, dict):
            continue
        if node.get("kind") == "t1":
            yield data
            pending.extend(_children(data.get("replies"))[::-1])
        elif node.get("kind") == "Listing":
            pending.extend(_children(node)[::-1])


def _utf8(text: str) -> str:
    """Without lone surrogates, which JSON escapes can produce."""
    return text.encode("utf-8", "ignore").decode("utf-8")


def _text(value) -> str:
    return _utf8(value) if isinstance(value, str) else ""


def _number(value) -> float:
    return float(value) if isinstance(value, (int, float)) and not isinstance(value, bool) else 0.0


def _read(payload: str | None):
    try:
        tree = json.loads(payload or "")
    except (ValueError, RecursionError) as error:
        return None, f"{type(error).__name__}: {error}"
    if isinstance(tree, list):
        return (tree[1], None) if len(tree) > 1 else (None, "payload has no comment listing")
    return tree, None


def flatten_replies(df: DataFrame, tree: str, keys: Sequence[str]) -> DataFrame:
    """One row per comment of the payload in column ``tree``: a post
    listing followed by a comment listing, or a comment listing alone.

    Each payload is parsed once, in the task that reads it; nothing is
    shuffled.  ``raw`` is the comment without its replies, ``seq`` its place
    in the walk.  A payload that cannot be read gives one row with
    ``parse_error`` instead of vanishing.
    """
    keys = list(keys)
    schema = T.StructType([*[df.schema[k] for k in keys], *FLAT_FIELDS])
    names = [f.name for f in schema.fields]

    def flat(key: tuple, payload: str | None) -> Iterator[tuple]:
        listing, error = _read(payload)
        if error is not None:
            yield (*key, None, None, None, None, None, error)
            return
        for seq, data in enumerate(comments_of(listing)):
            bare = {k: v for k, v in data.items() if k != "replies"}
            yield (
                *key,
                _text(data.get("id")),
                _text(data.get("parent_id")),
                _number(data.get("created_utc")),
                seq,
                _utf8(json.dumps(bare, ensure_ascii=False)),
                None,
            )

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = []
            for *key, payload in frame[[*keys, tree]].itertuples(index=False, name=None):
                for row in flat(tuple(key), payload):
                    rows.append(row)
                    if len(rows) >= 10_000:
                        yield pd.DataFrame(rows, columns=names, dtype=object)
                        rows = []
            if rows:
                yield pd.DataFrame(rows, columns=names, dtype=object)

    return df.select(*keys, tree).mapInPandas(run, schema)
