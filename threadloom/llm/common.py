"""What the operators of this folder share: reading tables, global order, digests."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(name: str = "text") -> Column:
    """The text; a null counts as empty."""
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


TEXTS_PER_BATCH = 1000


def bounded_batches(spark: SparkSession) -> None:
    """Hand Python fewer rows at a time than Spark does by default, as a row is a
    whole text here and both sides hold a batch in memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXTS_PER_BATCH:
        spark.conf.set(name, str(TEXTS_PER_BATCH))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions", "200")))


def id_bucket(doc_id: Column, n: int) -> Column:
    """crc32 of the id's decimal text, modulo ``n``."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(n))


def running_totals(parts: DataFrame, part: str, order: list[Column], sums: list[str]) -> DataFrame:
    """Exclusive prefix sums over a table dealt into ordered parts.

    ``part`` numbers the parts in the order of the whole.  Every part is summed
    by itself, and only the totals, one row per part, are summed in one task.
    Adds ``rank`` (gapless from 0), ``before_x`` and ``total_x`` for each x of
    ``sums``.  An empty table stays empty.
    """
    totals = parts.groupBy(F.col(part).alias("_p")).agg(
        F.count(F.lit(1)).alias("_n"), *[F.sum(c).cast("long").alias(f"_t_{c}") for c in sums]
    )
    earlier = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    starts = totals.select(
        "_p",
        F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_rank"),
        *[F.coalesce(F.sum(f"_t_{c}").over(earlier), F.lit(0)).alias(f"_b_{c}") for c in sums],
        *[F.sum(f"_t_{c}").over(everything).alias(f"total_{c}") for c in sums],
    )
    within = Window.partitionBy(part).orderBy(*order)
    above = within.rowsBetween(Window.unboundedPreceding, -1)
    placed = parts.select(
        "*",
        (F.row_number().over(within) - 1).alias("_row"),
        *[F.coalesce(F.sum(c).over(above), F.lit(0)).alias(f"_w_{c}") for c in sums],
    )
    # starts has one row per part of the range partitioning, so it can be sent along.
    joined = placed.join(F.broadcast(starts), placed[part] == starts["_p"])
    return joined.select(
        *[placed[c] for c in parts.columns],
        (F.col("_rank") + F.col("_row")).alias("rank"),
        *[(F.col(f"_b_{c}") + F.col(f"_w_{c}")).cast("long").alias(f"before_{c}") for c in sums],
        *[F.col(f"total_{c}") for c in sums],
    )


def range_bounds(ids: DataFrame, id_col: str, n_parts: int) -> list[int]:
    """At most ``n_parts - 1`` ascending ids that cut the table into ranges of
    about as many rows; where exactly they lie changes no result."""
    if n_parts < 2:
        return []
    cuts = [i / n_parts for i in range(1, n_parts)]
    found = ids.agg(F.percentile_approx(id_col, cuts, 20 * n_parts).alias("q")).first()["q"]
    return sorted(set(found or []))


def range_part(id_col: Column, bounds: list[int]) -> Column:
    """The number of bounds up to the id, found by bisection; 0 for a null id."""
    if not bounds:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(bounds).bit_length()))]
    cut = F.lit(bounds) if len(bounds) > 1 else F.array(F.lit(bounds[0]))
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda low, step: low + F.when(F.get(cut, low + step - 1) <= id_col, step).otherwise(0),
    )


def kept_by_worker(key: str, make):
    """What ``make`` returns, kept by a Python worker from task to task.

    Functions travel by value, so their module's globals last for one task."""
    kept = sys.modules.setdefault("threadloom_worker_state", types.ModuleType("threadloom_worker_state")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def bounded_sample(rows: DataFrame, by: str, key: str, per_value: int) -> DataFrame:
    """At most ``per_value`` rows for each value of ``by``, lowest hashes of ``key`` first.

    Counts per value give the hash below which twice as many rows are to be
    expected, so no value brings more than these into its task."""
    # One bounded row per value: labels and languages, not keys of the corpus.
    counts = rows.groupBy(F.col(by).alias("_v")).agg(F.count(F.lit(1)).alias("_n"))
    placed = rows.withColumn("_h", F.xxhash64(F.col(key), F.lit("sample")))
    share = (F.col("_h") / F.lit(float(1 << 64))) + 0.5
    near = placed.join(F.broadcast(counts), placed[by] == counts["_v"]).where(
        share * F.col("_n") < 2.0 * per_value + 8.0 * per_value**0.5
    )
    order = Window.partitionBy(by).orderBy("_h", key)
    return near.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= per_value).drop("_v", "_n", "_h", "_r")


def byte_view(texts):
    """The UTF-8 bytes of an Arrow string column without nulls: bytes, starts, ends."""
    import numpy as np
    import pyarrow as pa

    width = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, offsets, data = texts.buffers()
    if data is None or len(texts) == 0:
        nothing = np.zeros(len(texts), np.int64)
        return np.zeros(0, np.uint8), nothing, nothing
    cuts = np.frombuffer(offsets, width)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    return np.frombuffer(data, np.uint8)[cuts[0] : cuts[-1]], cuts[:-1] - cuts[0], cuts[1:] - cuts[0]


SENT_ALONG_IDS = 1_000_000


def ids_for_join(ids: DataFrame) -> DataFrame:
    """Ids that were written out, marked to be sent to every task if their counted
    number is small enough; otherwise the join shuffles both sides."""
    return F.broadcast(ids) if ids.count() <= SENT_ALONG_IDS else ids
