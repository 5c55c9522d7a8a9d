"""From captures to narrow rows, documents, vectors and texts."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.functions.once import computed_once
from threadloom.functions.text import truncate_text
from threadloom.operators import digests as dg, index as ix
from threadloom.operators.captures import VERSION_KEYS, convert_new, unseen
from threadloom.operators.documents import build_documents, document_keys, hashed
from threadloom.operators.model import apply_model
from threadloom.operators.narrow import narrow_comments, narrow_submissions, only_subs, union_kinds
from threadloom.operators.ranking import at_places, matching_in_place, one_per_key
from threadloom.plans.parameters import RefreshParameters
from threadloom.session import configure, materialize
from threadloom.sources import ledger, schemas
from threadloom.sources.captures import h16, lookback
from threadloom.sources.sinks import (
    append_texts,
    batch_number,
    lies_by,
    read_current,
    read_if_there,
    read_placed,
    text_key,
    text_objects,
    upsert_table,
    write_narrow,
)

NARROW_KEYS = ("kind", "sub", "sid", "cap14", "h16")
# So many days are written into the filter of a scan.
DAYS_NAMED = 1000


def narrow_rows(captures: DataFrame) -> DataFrame:
    """Capture rows of both kinds to narrow rows, one pass over the lines."""
    keys = ("sub", "kind", "y", "md", "hms", "sid", "cap14", "h16")
    posts = captures.where(F.col("kind") == "submissions").where(F.col("line_no") == 1)
    comments = captures.where(F.col("kind") == "comments")

    def opened(rows: DataFrame, schema: str) -> DataFrame:
        return computed_once(rows.select(*keys, "raw"), f=F.from_json("raw", schema)).select(*keys, "f.*")

    return union_kinds(
        narrow_submissions(opened(posts, schemas.SUBMISSION), keys),
        narrow_comments(opened(comments, schemas.COMMENT), keys),
    )


def refresh(
    spark: SparkSession,
    captures: str,
    narrow: str,
    index: str,
    store: str,
    embed: Callable[[list[str]], Sequence[Sequence[float]]],
    params: RefreshParameters = RefreshParameters(),
    subs: Sequence[str] | None = None,
    as_of: dt.date | str | None = None,
) -> dict[str, int]:
    """Convert new captures, stage the last version of every thread, embed
    and upsert what changed, export the missing texts.

    Arguments are the paths of the four tables.  Running it again without new
    captures changes nothing and reads no text: documents are known by the hashes
    stored with narrow rows, whose digests are compared with those recorded for the
    index and the store, and only leaves that differ are opened.  The counts
    returned say how many leaves of the index were opened, what a budget has
    deferred and how many texts the model has refused; both come again in the next
    run.
    """
    configure(spark)

    def windowed(df: DataFrame) -> DataFrame:
        kept = lookback(df, params.lookback_days, as_of)
        return kept if subs is None else only_subs(kept, subs)

    raw = windowed(read_placed(spark, captures, schemas.CAPTURE)).withColumn("h16", h16())
    done = windowed(read_placed(spark, narrow, schemas.NARROW))
    # Keys are compared alone, and their result is small in a regular run: the
    # lines are then read for new captures only, without a shuffle.
    todo = materialize(convert_new(raw.select(*NARROW_KEYS).distinct(), done, NARROW_KEYS), "todo")
    converted = todo.count()
    if converted:
        # A new narrow table lies as the captures do, by day or by year.
        fresh, dealt = matching_in_place(raw, todo, NARROW_KEYS)
        write_narrow(narrow_rows(fresh), narrow, params.zstd_level, dealt, lies_by(spark, captures))
        done = windowed(read_placed(spark, narrow, schemas.NARROW))

    keys = materialize(document_keys(done), "document-keys")
    if not keys.where("metadata.h IS NULL").isEmpty():
        keys = materialize(document_keys(hashed(done)), "document-keys")
    leaves = materialize(dg.leaf_digests(keys), "leaves")
    counts = {"converted": converted, "documents": leaves.agg(F.sum("n")).first()[0] or 0}
    counts |= _refresh_index(spark, done, keys, leaves, index, embed, params)
    _refresh_store(spark, done, keys, leaves, store, params)
    return counts


def _opened(spark: SparkSession, keys: DataFrame, leaves: DataFrame, path: str):
    """The table's files, and the leaves of which it is not known that it holds all
    their documents; None if there are no such leaves."""
    files = ledger.data_files(spark, path)
    opened = materialize(dg.differing(leaves, ledger.recorded(spark, path, files)), "opened")
    return files, None if opened.isEmpty() else opened


def _record(spark: SparkSession, path: str, leaves: DataFrame, pending: DataFrame | None, before) -> None:
    """Record the leaves without pending rows, if nobody else has written."""
    files = ledger.data_files(spark, path)
    if files and ledger.one_write(before, files):
        if pending is not None:
            rest = pending.select("y", "md", dg.id_bucket().alias("bucket")).distinct()
            leaves = leaves.join(rest, list(dg.LEAF), "left_anti")
        ledger.record(spark, path, batch_number(), leaves, files)


def documents_of(done: DataFrame, wanted: DataFrame) -> DataFrame:
    """The documents with texts of some rows of document_keys that were written.

    They are read at the rows' places, so no text is shuffled.  Few days are named to
    the scan, so that other days' texts are not read."""
    days = [tuple(r) for r in wanted.select("y", "md").dropna().distinct().limit(DAYS_NAMED + 1).collect()]
    rows = done
    if len(days) <= DAYS_NAMED:
        # Each column alone, so that folders and pages are left out.
        years, dates = ([*{d[i] for d in days}] for i in (0, 1))
        rows = done.where(F.col("y").isin(years) & F.col("md").isin(dates) & F.concat("y", "md").isin([y + md for y, md in days]))
    named = wanted.dropna(subset=["id", "kind", "sub", "sid", *VERSION_KEYS])
    return build_documents(at_places(rows, named), latest=False)


def _refresh_index(spark, done, keys, leaves, index, embed, params) -> dict[str, int]:
    counts = {"vectors": 0, "failed": 0, "deferred": 0, "opened": 0}
    before, opened = _opened(spark, keys, leaves, index)
    if opened is None:
        return counts
    buckets = [r[0] for r in opened.select("bucket").distinct().collect()]  # 32 at most
    counts["opened"] = opened.count()
    current = read_current(spark, index, buckets=buckets)
    fresh = materialize(ix.changed(dg.in_leaves(keys, opened), current), "changed")
    fresh_ids = materialize(fresh.select("id").distinct(), "changed-ids")
    n_fresh = fresh_ids.count()
    pending = None
    if n_fresh:
        todo_ids = ix.take_lowest(fresh_ids, "id", params.max_vectors)
        wanted = materialize(fresh.join(todo_ids, "id", "left_semi"), "wanted")
        plan = one_per_key(documents_of(done, wanted), wanted.select("id"), ["id"])
        handed = plan.withColumn("_handed", truncate_text("text", params.embed_chars)).drop("text")
        # Model calls must not run again for every use of their results.
        embedded = materialize(
            apply_model(
                handed, embed, "array<float>", text="_handed", batch_size=params.embed_batch, retries=params.retries,
                backoff_ms=params.backoff_ms, pause_ms=params.pause_ms, jitter_ms=params.jitter_ms,
                calls_in_parallel=params.calls_in_parallel or None, max_failures=params.max_failures,
            ).drop("_handed"),
            "embedded",
        )
        n, failed = embedded.agg(F.count(F.lit(1)), F.count("error")).first()
        counts |= {"vectors": n - failed, "failed": failed, "deferred": n_fresh - n}
        good = embedded.where(F.col("error").isNull())
        if n > failed:
            version = F.max(F.concat_ws("-", "cap14", "h16")).alias("version")
            versions = wanted.groupBy("id").agg(version)
            upsert_table(spark, index, ix.check_dim(good.join(versions, "id"), params.dim))
        if n_fresh > n - failed:
            pending = fresh.join(good.select("id"), "id", "left_anti")
    _record(spark, index, leaves, pending, before)
    return counts


def _refresh_store(spark, done, keys, leaves, store, params) -> None:
    before, opened = _opened(spark, keys, leaves, store)
    if opened is None:
        return
    named = dg.in_leaves(keys, opened).withColumn("key", text_key(params.prefix)).where("key IS NOT NULL")
    manifest = read_if_there(spark, store, schemas.STORE)
    fresh = materialize(unseen(named, manifest, ["key"]), "fresh")
    pending = None
    if not fresh.isEmpty():
        kept = ix.take_lowest(fresh, "key", params.max_objects)
        if params.max_objects:
            kept = materialize(kept, "exported")
            pending = fresh.join(kept.select("key"), "key", "left_anti")
        append_texts(text_objects(documents_of(done, kept), params.prefix), store)
    _record(spark, store, leaves, pending, before)
