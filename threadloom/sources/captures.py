"""Capture files, the trees they lie in, and the tables made of them
(A1, A3, A4)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from threadloom.functions.ids import path_key_columns, path_keys, valid_stamp
from threadloom.functions.once import computed_once
from threadloom.functions.times import in_lookback
from threadloom.operators.ranking import positions
from threadloom.sources import schemas
from threadloom.sources.files import day_folders


def line_position() -> list[Column]:
    """Columns that order lines as they lie in their files: the file, the
    split's offset, and an id that grows within one split."""
    return [
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_block_start").alias("file_offset"),
        F.monotonically_increasing_id().alias("line_seq"),
    ]


FILE_ORDER = ("file_path", "file_offset", "line_seq")


def read_captures(
    spark: SparkSession,
    path: str | list[str],
    kind: str,
    strict: bool = True,
    keep_raw: bool = False,
    glob: str = "*.jsonl",
) -> DataFrame:
    """A1: newline-delimited JSON captures of one kind, with FILE_ORDER.

    ``strict`` stops the job at a line that is not JSON.  ``keep_raw`` reads
    the lines as text instead, in column ``raw``, with the ``file_size``.
    """
    schema = {"submissions": schemas.SUBMISSION, "comments": schemas.COMMENT}[kind]
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob)
    if keep_raw:
        size = F.col("_metadata.file_size").alias("file_size")
        return reader.text(path).select(F.col("value").alias("raw"), *line_position(), size)
    reader = reader.schema(schema).option("mode", "FAILFAST" if strict else "DROPMALFORMED")
    return reader.json(path).select("*", *line_position())


def with_path_keys(df: DataFrame, path: str = "file_path", staged: bool = False, mode: str = "skip") -> DataFrame:
    """A3: sub, kind, y, md, hms, sid, cap14 and hash out of the file's path.

    ``skip`` drops files whose name does not follow the layout; ``fail`` stops
    the job at one.
    """
    if mode not in ("skip", "fail"):
        raise ValueError(f"mode must be skip or fail, not {mode!r}")
    matched = computed_once(df, _keys=path_keys(path, staged))
    keyed = matched.withColumns(path_key_columns("_keys")).drop("_keys")
    good = valid_stamp("cap14") & (F.col("sid") != "")
    if mode == "skip":
        return keyed.where(good)
    bad = F.raise_error(F.concat(F.lit("file name out of layout: "), F.coalesce(F.col(path), F.lit("null"))))
    return keyed.where(F.when(good, F.lit(True)).otherwise(bad))


def h16(hash: Column | str = "hash") -> Column:
    """The short hash a narrow file is named by."""
    return F.left(F.col(hash) if isinstance(hash, str) else hash, F.lit(16))


def captures_from_tree(
    spark: SparkSession, root: str, days: int = 0, as_of: dt.date | str | None = None, mode: str = "fail"
) -> DataFrame:
    """The capture rows of a tree of capture files, one row per line, with the
    line's number in its file; ``days`` limits it to a lookback."""
    folders = day_folders(spark, root, days, as_of)
    if not folders:
        return spark.createDataFrame([], schemas.CAPTURE)
    lines = read_captures(spark, folders, "comments", keep_raw=True)
    numbered = positions(lines, ["file_path"], ["file_offset", "line_seq"], "line_no")
    keyed = with_path_keys(numbered, mode=mode).withColumn("created", created_epoch())
    return keyed.drop(*FILE_ORDER, "file_size")


def staged_from_tree(
    spark: SparkSession, root: str, days: int = 0, as_of: dt.date | str | None = None
) -> DataFrame:
    """The rows of a tree of staged files of both kinds; files out of layout
    are ignored.  Fields that a file lacks are null."""
    folders = day_folders(spark, root, days, as_of)
    if not folders:
        return spark.createDataFrame([], schemas.NARROW)
    files = (
        spark.read.schema(schemas.NARROW_FILE)
        .option("recursiveFileLookup", "true")
        .option("pathGlobFilter", "*.parquet")
        .parquet(*folders)
        .select("*", F.col("_metadata.file_path").alias("file_path"))
    )
    return with_path_keys(files, staged=True).withColumnRenamed("hash", "h16").drop("file_path")


def created_epoch() -> Column:
    """The creation second out of the path's day and time."""
    return F.unix_timestamp(F.concat("y", "md", "hms"), "yyyyMMddHHmmss")


def lookback(df: DataFrame, days: int, as_of: dt.date | str | None = None) -> DataFrame:
    """A4: threads created on as_of (today) or one of the ``days`` days before;
    all of them for 0.  Tests partition columns only, so other days' folders
    are not listed or read."""
    return df.where(in_lookback(days, as_of))


def read_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A partitioned Parquet table with a given schema, so that partition
    values such as 0131 stay text; columns are in the schema's order, whichever of
    them the table lies by."""
    table = spark.read.schema(schema).parquet(path)
    names = T._parse_datatype_string(schema).names
    return table if table.columns == names else table.select(*names)
