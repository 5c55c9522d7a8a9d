"""What a table is known to hold: digests recorded beside its files.

A record says: with exactly these data files, the table holds the documents of
these leaves.  If files have come or gone since, by whatever writer, the record
counts for nothing, and everything is compared again.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Collection

from pyspark.sql import DataFrame, SparkSession, functions as F

from threadloom.operators.digests import LEAVES
from threadloom.sources.files import hadoop, path_exists

# Readers of a table pass over folders with such a name.
FOLDER = "_digests"
# Spark names the files of one write by one id.
WRITE_ID = re.compile(r"part-\d+-([0-9a-f-]{36})")


def data_files(spark: SparkSession, path: str) -> frozenset[str]:
    """The table's data files, as a plan over it would list them."""
    return frozenset(spark.read.schema("id string").parquet(path).inputFiles()) if path_exists(spark, path) else frozenset()


def one_write(before: Collection[str], after: Collection[str]) -> bool:
    """Files were added by one write at most, and none is gone."""
    added = set(after) - set(before)
    ids = {m.group(1) if (m := WRITE_ID.search(f)) else f for f in added}
    return set(before) <= set(after) and len(ids) <= 1


def _signature(files: Collection[str]) -> str:
    return hashlib.sha256("\n".join(sorted(files)).encode()).hexdigest()


def recorded(spark: SparkSession, path: str, files: Collection[str]) -> DataFrame:
    """The leaves of the last record, none unless it was made for these files."""
    nothing = spark.createDataFrame([], LEAVES)
    root = f"{path}/{FOLDER}"
    if not path_exists(spark, root):
        return nothing
    fs, hadoop_path = hadoop(spark, root)
    runs = sorted(s.getPath().getName() for s in fs.listStatus(hadoop_path(root)))
    whole = [r for r in runs if path_exists(spark, f"{root}/{r}/_SUCCESS")]
    if not whole:
        return nothing
    found = spark.read.schema(f"{LEAVES}, files string").parquet(f"{root}/{whole[-1]}")
    return found.where(F.col("files") == _signature(files)).drop("files")


def record(spark: SparkSession, path: str, run: str, leaves: DataFrame, files: Collection[str]) -> None:
    """Later runs have higher names."""
    rows = leaves.withColumn("files", F.lit(_signature(files)))
    rows.coalesce(1).write.parquet(f"{path}/{FOLDER}/{run}")
