"""First row, position and lowest-n over groups of any size."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from threadloom.session import materialize


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Equal columns, null being equal to null."""
    return reduce(lambda x, y: x & y, [F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)])


# So many keys are sent to the scan of the rows at most.
SENT_ALONG_KEYS = 200_000


# A row's place in a table: a hash of its file's path, and its number in the file.
PLACE = ("_file", "_row")
# So many blocks of 64 rows of a file are sent along at most.
SENT_ALONG_BLOCKS = 1_000_000


def with_place(scan: DataFrame) -> DataFrame:
    """A scan of Parquet files with the PLACE of each row."""
    return scan.withColumns({"_file": F.xxhash64("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def at_places(rows: DataFrame, chosen: DataFrame) -> DataFrame:
    """The rows, of a scan with PLACE, at the chosen places; PLACE is dropped."""
    return at_places_in_place(rows, chosen)[0].drop(*PLACE)


def at_places_in_place(rows: DataFrame, chosen: DataFrame) -> tuple[DataFrame, bool]:
    """The rows at the chosen places, and whether they lie as those of ``rows`` do.

    A place is sent along as one bit of a block of 64 rows, so that rows need no
    shuffle up to 64 million chosen ones of large files."""
    block, bit = F.expr("_row div 64"), F.expr("shiftleft(1L, cast(_row % 64 as int))")
    bits = chosen.select(F.col("_file").alias("_f"), block.alias("_b"), bit.alias("_bit"))
    blocks = materialize(bits.groupBy("_f", "_b").agg(F.bit_or("_bit").alias("_bits")), "places")
    sent = blocks.count() <= SENT_ALONG_BLOCKS
    found = rows.join(F.broadcast(blocks) if sent else blocks, (F.col("_file") == F.col("_f")) & (block == F.col("_b")))
    return found.where(F.col("_bits").bitwiseAND(bit) != 0).select(*rows.columns), sent


def matching(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The rows whose key is among ``wanted``; a key with a null is not.

    Rows are not shuffled where few keys are wanted, nor where few of their keys are
    not, as in a first run: the keys are compared alone, and the fewer are sent along.
    Between the two the rows' places are sent along where they are known; without
    them the join shuffles both sides.  ``rows`` is read twice."""
    return matching_in_place(rows, wanted, columns)[0]


def matching_in_place(rows: DataFrame, wanted: DataFrame, columns: Sequence[str]) -> tuple[DataFrame, bool]:
    """What matching gives, and whether its rows lie as those of ``rows`` do."""
    columns = list(columns)
    asked = wanted.select(*columns).distinct()
    wanted = materialize(asked, "wanted-keys")
    if wanted.count() <= SENT_ALONG_KEYS:
        # Few keys stay part of the plan, so that later filters reach their scan, too.
        return rows.join(F.broadcast(asked), columns, "left_semi"), True
    whole = rows.where(reduce(lambda x, y: x & y, [F.col(c).isNotNull() for c in columns]))
    others = materialize(whole.select(*columns).distinct().join(wanted, columns, "left_anti"), "other-keys")
    if others.count() <= SENT_ALONG_KEYS:
        return whole.join(F.broadcast(others), columns, "left_anti"), True
    if set(PLACE) <= set(rows.columns):
        return at_places_in_place(rows, rows.select(*columns, *PLACE).join(wanted, columns, "left_semi"))
    return rows.join(wanted, columns, "left_semi"), False


def _pick(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], best) -> DataFrame:
    marks = {f"_o{i}": F.col(c) if isinstance(c, str) else c for i, c in enumerate(order)}
    marked = df.withColumns(marks)
    names = [*keys, *marks]
    won = marked.groupBy(*keys).agg(best(F.struct(*marks)).alias("_best")).select(*keys, "_best.*")
    won = won.toDF(*[f"_w{i}" for i in range(len(names))])
    return marked.join(won, same(names, won.columns), "left_semi").drop(*marks)


def first_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row of every key group that comes first in ``order``, which must tell
    the rows of a group apart; rows that tie on all of it stay together.

    The winner is found over keys and order columns alone, by an aggregate that
    combines before the shuffle, and then matched with the rows, so a key that
    holds most of the rows costs no more than others and no payload is sorted.
    ``df`` is read twice: write it out first where it is costly to compute.
    """
    return _pick(df, keys, order, F.min)


def last_by(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str]) -> DataFrame:
    """The row of every key group that comes last in ``order``, see first_by."""
    return _pick(df, keys, order, F.max)


def one_per_key(df: DataFrame, keys: DataFrame, key: Sequence[str]) -> DataFrame:
    """``df`` with one row per ``key``; ``keys`` has its key columns.

    Only rows whose key comes more than once, usually none, are brought together."""
    names = [f"_k{i}" for i in range(len(key))]
    counted = keys.groupBy(*[F.col(c).alias(n) for c, n in zip(key, names)]).count()
    repeated = materialize(counted.where("count > 1").select(*names), "repeated")
    if repeated.isEmpty():
        return df
    place = F.row_number().over(Window.partitionBy(*key).orderBy(*key))
    firsts = df.join(repeated, same(key, names), "left_semi").withColumn("_place", place).where("_place = 1").drop("_place")
    return df.join(repeated, same(key, names), "left_anti").unionByName(firsts)


def positions(
    df: DataFrame, group: Sequence[str], order: Sequence[str], name: str = "pos", partitions: int | None = None
) -> DataFrame:
    """The 1-based position of every row in its group, in ``order``.

    Rows are laid out in ranges of (group, order), so a group of any size is
    shared by many tasks: a row's position is its place in its own range plus
    the group's rows in the ranges before it.  Group and order columns together
    must be unique.
    """
    keys = [*group, *order]
    ranged = df.repartitionByRange(partitions, *keys) if partitions else df.repartitionByRange(*keys)
    laid = materialize(
        ranged.sortWithinPartitions(*keys)
        .withColumn("_range", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id()),
        "ranges",
    )
    runs = laid.groupBy(*group, "_range").agg(F.min("_seq").alias("_lo"), F.count(F.lit(1)).alias("_n"))
    # A group has one run per range at most, so this window stays small.
    earlier = Window.partitionBy(*group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.withColumn("_before", F.coalesce(F.sum("_n").over(earlier), F.lit(0)))
    runs = runs.select(*[F.col(c).alias(f"_g{i}") for i, c in enumerate([*group, "_range"])], "_lo", "_before")
    return (
        laid.join(runs, same([*group, "_range"], [f"_g{i}" for i in range(len(group) + 1)]))
        .withColumn(name, (F.col("_seq") - F.col("_lo") + F.col("_before") + 1).cast("bigint"))
        .select(*df.columns, name)
    )


def _cut_key(keys: DataFrame, key: str, n: int):
    """The n-th smallest key, or None when there are not more than n."""
    laid = materialize(
        keys.repartitionByRange(key).withColumn("_range", F.spark_partition_id()),
        "ranges",
    )
    seen = 0
    for row in laid.groupBy("_range").count().orderBy("_range").collect():  # one row per range
        if seen + row["count"] >= n:
            inside = laid.where(F.col("_range") == row["_range"]).select(key)
            return inside.orderBy(key).offset(n - seen - 1).limit(1).first()[0]
        seen += row["count"]
    return None


def take_lowest(df: DataFrame, key: str, n: int) -> DataFrame:
    """the n rows with the lowest key; 0 or less means all of them.

    ``key`` must be unique.  Whole rows never go through one task: only keys are
    laid out in ranges, only the range the cut falls into is sorted, and the rows
    are filtered by the key at the cut.
    """
    if n <= 0:
        return df
    last = _cut_key(df.select(key), key, n)
    return df if last is None else df.where(F.col(key) <= F.lit(last))
