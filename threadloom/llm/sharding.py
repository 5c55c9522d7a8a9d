"""Contiguous shards of nearly equal size in bytes.

The ids are dealt into ordered ranges; the byte totals of the ranges are summed
up, which gives every document the number of bytes before it, and the documents
are cut where that number passes equal targets.  Texts are read once, for their
length and checksum; only ids, sizes and checksums are shuffled.

Defined results: a null text has no bytes (its row still weighs the fixed
overhead) and checksum 0; rows with equal ids are ordered by size and checksum,
equal rows take neighbouring places; an empty table gives no rows; columns other
than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import running_totals, shuffle_partitions, whole_text
from threadloom.session import materialize

ROW_OVERHEAD = 8
RANGES_PER_PARTITION = 4


def shard_by_bytes(
    docs: DataFrame, n_shards: int, id_col: str = "doc_id", text_col: str = "text", overhead: int = ROW_OVERHEAD
) -> DataFrame:
    """(doc_id, size, text_crc32, shard, slot): shards of nearly equal bytes.

    A document belongs to the shard whose target its first byte falls into, so a
    shard differs from the target by less than its largest document on either
    side.  ``slot`` counts from 0 within the shard, in the order of ids.
    """
    spark = docs.sparkSession
    keys = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(whole_text(text_col)).cast("long") + F.lit(overhead)).alias("size"),
        F.crc32(whole_text(text_col).cast("binary")).alias("text_crc32"),
        F.monotonically_increasing_id().alias("tie"),
    )
    order = ["doc_id", "size", "text_crc32", "tie"]
    ranges = keys.repartitionByRange(RANGES_PER_PARTITION * shuffle_partitions(spark), *order)
    # Written, so that the number of a range stays what it is if a task is repeated.
    parts = materialize(ranges.withColumn("part", F.spark_partition_id()), "shard-ranges")
    placed = running_totals(parts, "part", [F.col(c) for c in order], ["size"])
    cut = materialize(
        placed.select(
            "doc_id",
            "size",
            "text_crc32",
            "rank",
            F.expr(f"cast((before_size * {int(n_shards)}) div total_size as int)").alias("shard"),
        ),
        "shard-cuts",
    )
    firsts = cut.groupBy(F.col("shard").alias("s")).agg(F.min("rank").alias("first"))  # n_shards rows
    return cut.join(F.broadcast(firsts), cut["shard"] == firsts["s"]).select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first")).alias("slot")
    )


def write_shards(docs: DataFrame, assignment: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write the texts into one folder per shard, sorted by slot within each file.

    Ids must be unique here, as a text finds its place by its id.
    """
    places = assignment.select(F.col("doc_id").alias("_id"), "shard", "slot")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    placed = texts.join(places, F.col("doc_id").eqNullSafe(F.col("_id"))).drop("_id")
    placed.repartition("shard", F.expr("slot div 100000")).sortWithinPartitions("shard", "slot").write.partitionBy(
        "shard"
    ).parquet(path)
