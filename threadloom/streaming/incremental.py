"""Captures and vector batches as streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from threadloom.functions.ids import path_key_columns, path_keys, valid_stamp
from threadloom.functions.once import computed_once
from threadloom.operators.documents import document_hash
from threadloom.operators.narrow import narrow_comments, narrow_submissions
from threadloom.sources import schemas
from threadloom.sources.captures import h16
from threadloom.sources.sinks import number_of_epoch, upsert_table

KEYS = ("sub", "kind", "y", "md", "hms", "sid", "cap14", "h16")


def capture_stream(
    spark: SparkSession, root: str, kind: str, files_per_trigger: int = 10_000, strict: bool = True
) -> DataFrame:
    """The capture files of one kind that have not been read yet, as rows with
    the keys of their paths; files out of layout are skipped.  ``strict`` stops
    the stream at a line that is not JSON."""
    schema = {"submissions": schemas.SUBMISSION, "comments": schemas.COMMENT}[kind]
    lines = (
        spark.readStream.schema(schema)
        .option("mode", "FAILFAST" if strict else "DROPMALFORMED")
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.jsonl")
        .option("maxFilesPerTrigger", str(files_per_trigger))
        .json(root)
    )
    matched = computed_once(lines, _keys=path_keys(F.col("_metadata.file_path")))
    keyed = matched.withColumns(path_key_columns("_keys")).drop("_keys")
    return keyed.where(valid_stamp("cap14") & (F.col("kind") == kind)).withColumn("h16", h16())


def narrow_stream(rows: DataFrame, kind: str) -> DataFrame:
    """B1, B2 on a stream; a post's capture holds one line."""
    narrow = narrow_submissions(rows, KEYS) if kind == "submissions" else narrow_comments(rows, KEYS)
    title = narrow if "title" in narrow.columns else narrow.withColumn("title", F.lit(None).cast("string"))
    return title.withColumn("h", document_hash())


def append_available(rows: DataFrame, path: str, checkpoint: str, partitions=schemas.PARTITIONS) -> StreamingQuery:
    """Append everything that is available now, then stop.  The checkpoint
    remembers the files read, so a second run adds nothing."""
    return (
        rows.writeStream.format("parquet")
        .partitionBy(*partitions)
        .option("compression", "zstd")
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start(path)
    )


def upsert_available(batches: DataFrame, root: str, checkpoint: str, seq: str | None = None) -> StreamingQuery:
    """A9 for a stream of vector records: one number per epoch.

    Where an id can come twice in a batch, name the column ``seq`` that tells
    which record is the last.  A batch that is run again keeps the number of its
    first run, so it changes nothing, whatever has been written since.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        number = number_of_epoch(batch.sparkSession, root, checkpoint, epoch)
        upsert_table(batch.sparkSession, root, batch, seq=seq, number=number)

    return (
        batches.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
