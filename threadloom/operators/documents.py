"""From staged rows to text documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.functions import ids, text
from threadloom.operators.captures import latest_versions
from threadloom.operators.narrow import nonblank
from threadloom.operators.ranking import PLACE


def _is_post():
    return F.col("kind") == "submissions"


def composed():
    """A narrow row's whole text.  On a comment the title is null, so composing it
    gives the stripped body."""
    return text.compose_document(F.when(_is_post(), F.col("title")), F.col("body"))


def document_hash():
    """The content hash that is stored with a narrow row; '' if its text is blank."""
    return F.when(composed() != "", text.content_hash(composed())).otherwise(F.lit(""))


def _identified(rows: DataFrame) -> DataFrame:
    """Rows that a document can be made of, with ``t``, ``local_id`` and ``pid``."""
    usable = rows.where(_is_post() | F.col("comment_id").isNotNull())
    return usable.withColumns(
        {
            "t": ids.kind_letter("kind"),
            "local_id": F.when(_is_post(), F.col("sid")).otherwise(F.col("comment_id")),
            "pid": F.when(~_is_post(), text.text_or_empty("parent_id")),
        }
    )


def _metadata(h):
    return F.struct(F.lit(ids.SRC).alias("src"), "sub", "t", "sid", "pid", h.alias("h")).alias("metadata")


def hashed(staged: DataFrame) -> DataFrame:
    """Narrow rows with the hashes that older writers left out."""
    return staged.withColumn("h", F.coalesce("h", document_hash()))


def document_keys(staged: DataFrame) -> DataFrame:
    """(id, metadata) of the documents that the rows make, with the rows' own keys and
    places, if they have them, from stored hashes: no text is read.  Rows that were written without a hash keep a
    null; ``hashed`` fills them in."""
    rows = _identified(latest_versions(staged)).where("h IS NULL OR h <> ''")
    return rows.select(
        ids.document_id(F.col("t"), F.col("sub"), F.col("local_id")).alias("id"),
        _metadata(F.col("h")),
        "y",
        "md",
        "kind",
        "sub",
        "sid",
        "hms",
        "cap14",
        "h16",
        *[c for c in PLACE if c in staged.columns],
    )


def build_documents(staged: DataFrame, max_chars: int = 0, latest: bool = True) -> DataFrame:
    """(id, text, metadata) of the last version of every thread, with the
    day (y, md) the thread was created on.

    ``staged`` holds both kinds.  Text is stripped, composed and hashed, whole
    unless ``max_chars`` cuts it before; blank texts are dropped.  Pass ``latest=False``
    when the rows are already one version per thread.
    """
    rows = latest_versions(staged) if latest else staged
    whole = _identified(rows).select("sub", "sid", "y", "md", "t", "local_id", "pid", composed().alias("whole"))
    kept = nonblank(whole, "whole").withColumn("text", text.truncate_text("whole", max_chars))
    return kept.select(
        ids.document_id(F.col("t"), F.col("sub"), F.col("local_id")).alias("id"),
        "text",
        _metadata(text.content_hash("text")),
        "y",
        "md",
    )
