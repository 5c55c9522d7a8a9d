"""Run counts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, functions as F

COUNTS = ("files", "wrote", "skipped", "empty")


def run_stats(threads: DataFrame) -> DataFrame:
    """Counts per (sub, kind) and one row of totals with null keys.

    ``threads`` has one row per thread: sub, kind and the columns of COUNTS.
    """
    totals = [F.sum(c).cast("bigint").alias(c) for c in COUNTS]
    return threads.groupingSets([["sub", "kind"], []], "sub", "kind").agg(
        F.count(F.lit(1)).alias("threads"), *totals
    )


def capture_stats(captures: DataFrame, idle: DataFrame | None = None) -> DataFrame:
    """D9 out of the keys of a run that has taken place: a row per capture that was
    at hand, with sub, kind, sid and whether the run ``wrote`` or ``skipped`` it.

    ``idle`` are (sub, kind, sid) of threads that have no capture.  A thread of which
    nothing was written or skipped counts as empty.  Captures are added up before
    the shuffle, so a thread may have any number of them."""
    keys = ("sub", "kind", "sid")
    rows = captures.select(*keys, F.lit(1).alias("_file"), "wrote", "skipped")
    if idle is not None:
        no = F.lit(False)
        rows = rows.unionByName(idle.select(*keys, F.lit(0).alias("_file"), no.alias("wrote"), no.alias("skipped")))
    threads = rows.groupBy(*keys).agg(
        F.sum("_file").alias("files"), F.count_if("wrote").alias("wrote"), F.count_if("skipped").alias("skipped")
    )
    return run_stats(threads.withColumn("empty", (F.col("wrote") + F.col("skipped") == 0).cast("int")))


def counted(df: DataFrame, name: str, **counts) -> tuple[DataFrame, Observation]:
    """Live counters that ride along with whatever job runs ``df``.  Where the
    optimizer finds ``df`` to be empty and drops it, nothing is reported.  A task
    that runs again because an executor was lost is counted again."""
    seen = Observation(name)
    exprs = [F.count(F.lit(1)).alias("rows")] + [F.count_if(test).alias(n) for n, test in counts.items()]
    return df.observe(seen, *exprs), seen
