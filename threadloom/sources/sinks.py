"""Writers (A5, A7-A10)."""

from __future__ import annotations

import hashlib
import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from threadloom.functions.ids import DEFAULT_PREFIX, object_key
from threadloom.operators.captures import unseen
from threadloom.operators.digests import id_bucket
from threadloom.operators.documents import document_hash
from threadloom.operators.index import vector_records
from threadloom.operators.ranking import PLACE, last_by, matching, matching_in_place, take_lowest, with_place
from threadloom.session import materialize
from threadloom.sources import schemas
from threadloom.sources.captures import read_table
from threadloom.sources.files import partitions_of, path_exists

# Level 22, the highest, took over 30 times as long as this one and saved 8 %.
ZSTD_LEVEL = 9
# A new table has a folder for every day if there are so few of them, or if they hold
# so many rows on average.
FEW_DAYS = 366
DAY_ROWS = 20_000


def read_if_there(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table, empty where nothing has been written yet."""
    return read_table(spark, path, schema) if path_exists(spark, path) else spark.createDataFrame([], schema)


def read_placed(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """read_if_there, with the PLACE of each row."""
    if path_exists(spark, path):
        return with_place(read_table(spark, path, schema))
    return spark.createDataFrame([], schema + "".join(f", {c} bigint" for c in PLACE))


def _write_partitioned(
    df: DataFrame, path: str, by: Sequence[str], sort: Sequence[str] = (), level: int | None = None, dealt: bool = False
) -> None:
    """Append few large files per partition: adaptive execution merges small
    partitions and splits large ones, so one busy day is not one task.  Rows that
    are ``dealt`` so already, as those of a table with such partitions, are written
    by the tasks that read them."""
    laid = (df if dealt else df.hint("rebalance", *by)).sortWithinPartitions(*by, *sort)
    writer = laid.write.mode("append").partitionBy(*by).option("compression", "zstd")
    if level is not None:
        writer = writer.option("parquet.compression.codec.zstd.level", str(level))
    writer.parquet(path)


def _laid(df: DataFrame, path: str, by: Sequence[str] | None, dealt: bool):
    """The rows, the columns they are written by, those they are sorted by, and whether
    they are dealt so already.  A table that is there stays as it lies; of a new one
    ``by`` tells it, a folder for every day unless it is given."""
    lies = lies_by(df.sparkSession, path) or by or schemas.PARTITIONS
    if lies != schemas.YEARLY:
        return df, lies, schemas.CLUSTERED, dealt and by != schemas.YEARLY
    # A folder's name cannot tell an empty day from none.
    day = F.nullif("md", F.lit(""))
    return df.withColumn("md", day), lies, ("md", *schemas.CLUSTERED), dealt


def lies_by(spark: SparkSession, path: str) -> tuple[str, ...] | None:
    """YEARLY or PARTITIONS, None if the table at ``path`` lies in another way or is not there."""
    there = partitions_of(spark, path)
    return there if there in (schemas.PARTITIONS, schemas.YEARLY) else None


def partitions_for(days: int, rows: int) -> tuple[str, ...]:
    """How a new table of so many days and rows is to lie.  A folder and its files cost
    every reader and writer the same however small they are."""
    return schemas.YEARLY if days > FEW_DAYS and rows < days * DAY_ROWS else schemas.PARTITIONS


def _fit(df: DataFrame, schema: str) -> DataFrame:
    empty = df.sparkSession.createDataFrame([], schema)
    missing = {f.name: F.lit(None).cast(f.dataType) for f in empty.schema if f.name not in df.columns}
    return df.withColumns(missing).select(*empty.columns) if missing else df.select(*empty.columns)


def write_narrow(
    df: DataFrame, path: str, level: int = ZSTD_LEVEL, dealt: bool = False, by: Sequence[str] | None = None
) -> None:
    """A5: narrow rows of either kind as zstd Parquet, partitioned by PARTITIONS, or as
    the table lies or ``by`` says, with the content hash of what each row says."""
    if "h" not in df.columns:
        missing = [c for c in ("title", "body") if c not in df.columns]
        df = df.withColumns({c: F.lit(None).cast("string") for c in missing}).withColumn("h", document_hash())
    rows, by, sort, dealt = _laid(_fit(df, schemas.NARROW), path, by, dealt)
    _write_partitioned(rows, path, by, sort, level, dealt)


def append_captures(df: DataFrame, path: str, dealt: bool = False, by: Sequence[str] | None = None) -> None:
    """Append raw capture rows that are known to be new."""
    rows, by, sort, dealt = _laid(_fit(df, schemas.CAPTURE), path, by, dealt)
    _write_partitioned(rows, path, by, sort, dealt=dealt)


def write_captures(df: DataFrame, path: str, dealt: bool = False, by: Sequence[str] | None = None) -> None:
    """Append raw capture rows whose (thread, hash) is not there yet.

    The check sees keys only; the lines themselves are then matched with the
    new keys.
    """
    spark, keys = df.sparkSession, ["kind", "sub", "sid", "hash"]
    if path_exists(spark, path):
        existing = read_table(spark, path, schemas.CAPTURE)
        fresh = materialize(unseen(df.select(*keys).distinct(), existing, keys), "fresh")
        df, in_place = matching_in_place(df, fresh, keys)
        dealt = dealt and in_place
    append_captures(df, path, dealt, by)


def write_vectors(df: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Newline-delimited JSON records {id, values, metadata}."""
    vector_records(df).write.mode(mode).json(path)


def text_key(prefix: str | None = DEFAULT_PREFIX):
    """The store's key of a row of (id, metadata)."""
    md = F.col("metadata")
    local_id = F.when(md["t"] == "s", md["sid"]).otherwise(F.substring_index("id", ":", -1))
    return object_key(md["t"], md["sub"], local_id, md["h"], prefix)


def text_objects(documents: DataFrame, prefix: str | None = DEFAULT_PREFIX) -> DataFrame:
    """The rows of the content-addressed table: key, t, sub, id, h, text."""
    md = F.col("metadata")
    local_id = F.when(md["t"] == "s", md["sid"]).otherwise(F.substring_index("id", ":", -1))
    return documents.select(
        text_key(prefix).alias("key"),
        md["t"].alias("t"),
        md["sub"].alias("sub"),
        local_id.alias("id"),
        md["h"].alias("h"),
        "text",
    )


def new_texts(
    documents: DataFrame,
    manifest: DataFrame,
    max_objects: int = 0,
    prefix: str | None = DEFAULT_PREFIX,
    keys: DataFrame | None = None,
):
    """A10: text objects whose key is not in the manifest, lowest keys first,
    at most ``max_objects`` (0 means all).

    As in plan_index, only keys are compared and cut; ``keys`` are (id, metadata)
    of the documents if these were written already.
    """
    objects = text_objects(documents, prefix)
    if keys is not None:
        named = text_objects(keys.withColumn("text", F.lit("")), prefix)
        fresh = materialize(unseen(named.select("key"), manifest, ["key"]), "fresh")
        if fresh.isEmpty():
            return objects.limit(0)
        return matching(objects, take_lowest(fresh, "key", max_objects), ["key"])
    fresh = materialize(unseen(objects.select("key"), manifest, ["key"]), "fresh")
    if fresh.isEmpty():
        return objects.limit(0)
    return matching(objects, take_lowest(fresh, "key", max_objects), ["key"])


def export_texts(
    documents: DataFrame,
    path: str,
    max_objects: int = 0,
    prefix: str | None = DEFAULT_PREFIX,
    keys: DataFrame | None = None,
) -> None:
    """A10: append the missing text objects to the table at ``path``, which is
    its own manifest."""
    manifest = read_if_there(documents.sparkSession, path, schemas.STORE)
    fresh = new_texts(documents, manifest, max_objects, prefix, keys)
    append_texts(fresh, path)


def append_texts(objects: DataFrame, path: str) -> None:
    """Append text objects that are known to be missing."""
    _write_partitioned(_fit(objects, schemas.STORE), path, ("t", "sub"))


# -- vector table ----------------------------------------------------------------

# Records are only ever appended, each batch with a number of its own.  Of an id
# the record of the highest source version counts, of equal versions that of the
# highest number; records without a version come before all others.  So neither
# the order in which writers come nor a batch written twice matters, and what is
# written grows with the batch alone.  compact_table writes a table that holds
# each id once.

LOG = "version string, seq string, bucket int"


def batch_number() -> str:
    """Later batches have higher numbers, no two have the same."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def number_of_epoch(spark: SparkSession, root: str, stream: str, epoch: int) -> str:
    """The number of a stream's batch: given once, and found again when the batch
    is run again.  It is written before the batch is."""
    name = hashlib.sha256(stream.encode()).hexdigest()[:16]
    path = f"{root}/_batches/{name}/{epoch:020d}"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        spark.range(1).select(F.lit(batch_number()).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    return spark.read.text(path).first()["value"]


def read_current(
    spark: SparkSession, root: str, schema: str = schemas.INDEX, buckets: Sequence[int] | None = None
) -> DataFrame:
    """The table as of now, or some of its buckets; empty where nothing has been
    written.

    Only ids, versions and numbers are compared.  The records that no longer count
    are written out, so that few of them are sent to the scan of the vectors, which
    are not shuffled then."""
    rows = read_if_there(spark, root, f"{schema}, {LOG}")
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(list(buckets)))
    at = F.struct(F.coalesce("version", F.lit("")).alias("version"), "seq")
    marks = rows.select(F.col("id").alias("_id"), at.alias("_at"))
    several = marks.groupBy(F.col("_id").alias("_i")).agg(F.max("_at").alias("_newest"), F.count(F.lit(1)).alias("_n")).where("_n > 1")
    seen = marks.join(several, F.col("_id").eqNullSafe(F.col("_i"))).groupBy("_id", "_at", "_newest").agg(F.count(F.lit(1)).alias("_n"))
    odd = materialize(seen.where("_at < _newest OR _n > 1").select("*", (F.col("_at") < F.col("_newest")).alias("_old")), "superseded")
    old, twice = odd.where("_old"), odd.where("NOT _old").select("_id")
    kept = rows.join(old, F.col("id").eqNullSafe(F.col("_id")) & (at == F.col("_at")), "left_anti")
    if not twice.isEmpty():
        repeated = F.col("id").eqNullSafe(F.col("_id"))
        place = F.row_number().over(Window.partitionBy("id").orderBy("id"))
        firsts = kept.join(twice, repeated, "left_semi").withColumn("_place", place).where("_place = 1").drop("_place")
        kept = kept.join(twice, repeated, "left_anti").unionByName(firsts)
    return kept.drop("version", "seq", "bucket")


def upsert_table(
    spark: SparkSession,
    root: str,
    batch: DataFrame,
    schema: str = schemas.INDEX,
    seq: str | None = None,
    number: str | None = None,
) -> str:
    """Append the batch, and give its number.  Within the batch an id may come
    twice only if ``seq`` names the column that tells which one is the last.  A
    column ``version`` is the source version, which decides before the number."""
    if seq is not None:
        batch = last_by(materialize(batch, "batch"), ["id"], [seq])
    number = number or batch_number()
    version = F.col("version") if "version" in batch.columns else F.lit(None)
    rows = _fit(batch.withColumn("version", version.cast("string")), f"{schema}, version string").withColumn("seq", F.lit(number))
    bucketed = rows.withColumn("bucket", id_bucket())
    _write_partitioned(bucketed, root, ("bucket",), ("id",))
    return number


def compact_table(spark: SparkSession, root: str, target: str, schema: str = schemas.INDEX) -> None:
    """Write what counts of the table at ``root`` to ``target``, a new folder."""
    if path_exists(spark, target):
        raise ValueError(f"{target} is there already")
    upsert_table(spark, target, read_current(spark, root, schema), schema)
