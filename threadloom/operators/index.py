"""Incremental upkeep of the vector table."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from threadloom.operators.ranking import last_by, take_lowest
from threadloom.session import materialize

def changed(documents: DataFrame, index: DataFrame) -> DataFrame:
    """Documents whose id the index lacks or holds with another hash.

    Reads ids and hashes of the index, never its vectors.  An empty or null
    hash in the index matches nothing, so such documents come back.
    """
    known = index.select("id", F.col("metadata.h").alias("_h")).where(F.col("_h") != "")
    return documents.withColumn("_h", F.col("metadata.h")).join(known, ["id", "_h"], "left_anti").drop("_h")


def plan_index(documents: DataFrame, index: DataFrame, budget: int = 0) -> DataFrame:
    """What to embed in this run: changed documents, lowest ids first, at
    most ``budget`` of them (0 means all).  The cut comes after the diff.

    The diff and the cut see ids and hashes only.  Their result is written
    out, so its size is known: few ids are broadcast to the scan of the texts,
    and the texts are shuffled only where most of them are new.
    """
    fresh = materialize(changed(documents.select("id", "metadata"), index).select("id"), "changed")
    return documents.join(take_lowest(fresh, "id", budget), "id", "left_semi")


def upsert(target: DataFrame, batch: DataFrame, key: str = "id", seq: str | None = None) -> DataFrame:
    """The target after the batch; per key the batch wins, and within the
    batch the highest ``seq``."""
    batch = materialize(batch, "batch")
    newest = batch if seq is None else last_by(batch, [key], [seq]).drop(seq)
    kept = target.join(newest.select(key), key, "left_anti")
    return kept.unionByName(newest.select(*target.columns))


def stale_ids(index: DataFrame, documents: DataFrame) -> DataFrame:
    """Index entries whose document is gone; upserts never remove them."""
    return index.select("id").join(documents.select("id"), "id", "left_anti")


def check_dim(df: DataFrame, dim: int, values: str = "values") -> DataFrame:
    """Stops the job at a vector that has another length, or a number in it
    that is null or not finite."""
    size = F.coalesce(F.size(values), F.lit(-1))
    message = F.format_string(f"vector length %d, expected {dim}", size)
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    fits = F.when(odd, F.raise_error(F.lit("vector with a number that is not finite"))).otherwise(F.lit(True))
    return df.where(F.when(size == dim, fits).otherwise(F.raise_error(message)))


def vector_records(df: DataFrame) -> DataFrame:
    """The columns of an exported vector record."""
    return df.select("id", "values", "metadata")
