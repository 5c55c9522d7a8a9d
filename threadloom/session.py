"""Session settings and the shared scratch folder."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
from urllib.parse import urlparse

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.  Stamps are UTC, and a JSON
# object that repeats a key keeps the last value.
RUNTIME_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.variant.allowDuplicateKeys": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def local_session(cpus: int | str = "*", memory: str = "12g", **conf: str) -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    cores = 8 if cpus == "*" else int(cpus)
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("threadloom")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    Only a local session that names none gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    made = tempfile.mkdtemp(prefix="threadloom-")
    spark.sparkContext.setCheckpointDir(made)
    return spark.sparkContext.getCheckpointDir().rstrip("/")


# The scratch tables of this process, which nothing outside it reads.
_made: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder, removed when this process ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


@atexit.register
def remove_scratch() -> None:
    """Remove the scratch tables of this process; those of a lost process are
    left to the cluster's own clean-up."""
    paths, _made[:] = list(_made), []
    spark = SparkSession.getActiveSession()
    live = spark is not None and spark.sparkContext._jsc is not None
    for path in paths:
        where = urlparse(path)
        # A path without a scheme lies where Spark's default file system is.
        if where.scheme == "file" or (not where.scheme and not live and os.path.isdir(where.path)):
            shutil.rmtree(where.path, ignore_errors=True)
        elif live:
            hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hadoop_path, True)


def materialize(df: DataFrame, name: str = "table", compression: str | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage like a reliable checkpoint does, survives the loss of any
    executor, and keeps the result columnar so later readers prune columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
