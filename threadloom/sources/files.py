"""The file system that Spark reads from, whatever it is."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import SparkSession

from threadloom.functions.times import day_window


def hadoop(spark: SparkSession, path: str):
    """The file system of ``path``, and the class of its paths."""
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), jvm.org.apache.hadoop.fs.Path


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = hadoop(spark, path)
    return fs.exists(hadoop_path(path))


def partitions_of(spark: SparkSession, path: str) -> tuple[str, ...]:
    """The columns that a table lies by, as the first of its folders tell."""
    fs, hadoop_path = hadoop(spark, path)
    where, found = hadoop_path(path), []
    while where is not None and fs.exists(where):
        inside = (s.getPath() for s in fs.listStatus(where) if s.isDirectory())
        where = next((p for p in inside if "=" in p.getName() and not p.getName().startswith(("_", "."))), None)
        if where is not None:
            found.append(where.getName().split("=")[0])
    return tuple(found)


def day_folders(spark: SparkSession, root: str, days: int, as_of: dt.date | str | None = None) -> list[str]:
    """A4 on a tree of files: the folders of the lookback's days, or the whole
    tree for 0.  Other days' folders are not listed."""
    if days <= 0:
        return [root]
    fs, hadoop_path = hadoop(spark, root)
    found = []
    for y, md in day_window(days, as_of):
        for status in fs.globStatus(hadoop_path(f"{root}/r_*/*/{y}/{md}")) or []:
            found.append(status.getPath().toString())
    return found
