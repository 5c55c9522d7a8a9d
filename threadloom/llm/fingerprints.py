"""Threshold-scaled sketches of texts, and their likeness to a neighbour.

A sketch keeps every shingle hash below a fixed fraction of the hash range.  Two
sketches of one fraction can be merged (a union) and compared whatever the
lengths of the texts: the share of one sketch found in the other estimates how
much of the first text the second contains.

A shingle is five successive words, a text of fewer words is one shingle.  Words
are runs without ASCII white space, in lower case.  Everything is a built-in
expression.

Defined results: a null or empty text has no shingle and an empty sketch; texts
with the same words are alike to 1 even if no hash was kept, otherwise an empty
sketch is alike to nothing; rows with equal ids follow each other by text; one
document is its own neighbour; columns other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import range_bounds, range_part, shuffle_partitions, whole_text

SHINGLE_WORDS = 5
KEEP_ONE_IN = 8
RANGES_PER_PARTITION = 8
ASCII_BLANKS = "\t\n\x0b\x0c\r"


def with_words(df: DataFrame, text: str, name: str) -> DataFrame:
    """Adds the hashes of the words of a text."""
    blanks = F.translate(F.lower(F.col(text)), ASCII_BLANKS, " " * len(ASCII_BLANKS))
    words = F.filter(F.split(blanks, " "), lambda w: w != "")
    return df.withColumn(name, F.transform(words, lambda w: F.xxhash64(w)))


def sketch_of(words: Column, size: int = SHINGLE_WORDS, keep_one_in: int = KEEP_ONE_IN) -> Column:
    """The sketch out of the column of word hashes: number of shingles, hash of
    the whole sequence, and the sorted hashes that were kept."""
    below = F.lit(-(1 << 63) + (1 << 64) // keep_one_in)
    starts = F.slice(words, 1, F.greatest(F.size(words) - (size - 1), F.least(F.size(words), F.lit(1))))
    # get() past the end is null, which the hash passes over: short texts are one shingle.
    hashes = F.transform(starts, lambda x, i: F.xxhash64(x, *[F.get(words, i + k) for k in range(1, size)]))
    return F.struct(
        F.size(starts).alias("shingles"),
        F.xxhash64(words).alias("whole"),
        F.sort_array(F.array_distinct(F.filter(hashes, lambda h: h < below))).alias("kept"),
    )


def merged(a: Column, b: Column) -> Column:
    """The kept hashes of two texts together."""
    return F.sort_array(F.array_union(a["kept"], b["kept"]))


def containment(a: Column, b: Column) -> Column:
    """The estimated share of the first text's shingles that the second has."""
    return (
        F.when(a["whole"] == b["whole"], F.lit(1.0))
        .when(F.size(a["kept"]) == 0, F.lit(0.0))
        .otherwise(F.size(F.array_intersect(a["kept"], b["kept"])) / F.size(a["kept"]))
    )


def sketch_string(sketch: Column) -> Column:
    """shingles:whole:kept,kept,... with hashes in hexadecimal digits."""
    return F.concat_ws(
        ":",
        sketch["shingles"].cast("string"),
        F.hex(sketch["whole"]),
        F.array_join(F.transform(sketch["kept"], lambda h: F.hex(h)), ","),
    )


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, sketch) of every whole text."""
    texts = docs.select(F.col(id_col).alias("doc_id"), whole_text(text_col).alias("text"))
    return with_words(texts, "text", "words").select("doc_id", sketch_of(F.col("words")).alias("sketch"))


def with_neighbours(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, sketch, next_text, next_sketch): each document beside the
    next one by descending id; after the last comes the first.

    Texts are shuffled once, into ranges of ids.  The last document of a range is
    sent to the range above it too, where it is the neighbour of the first.
    """
    spark = docs.sparkSession
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    bounds = range_bounds(ids, "doc_id", RANGES_PER_PARTITION * shuffle_partitions(spark))
    part = range_part(F.col("doc_id"), bounds)
    tops = ids.groupBy(part.alias("p")).agg(F.max("doc_id").alias("top"))  # one row per range
    upward = Window.orderBy("p")
    whole = upward.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    edges = tops.select(
        "p", "top", F.coalesce(F.lead("p").over(upward), F.first("p").over(whole)).alias("above")
    )
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    own = F.struct(F.col("part").alias("part"), F.lit(0).alias("own"))
    lent = F.struct(F.col("above").alias("part"), F.lit(-1).alias("own"))
    dealt = (
        texts.withColumn("part", part)
        .join(F.broadcast(edges), (F.col("part") == F.col("p")) & F.col("doc_id").eqNullSafe(F.col("top")), "left")
        .select("doc_id", "text", F.explode(F.when(F.col("p").isNull(), F.array(own)).otherwise(F.array(own, lent))).alias("to"))
        .select("doc_id", "text", "to.part", "to.own")
        .repartition("part")
    )
    sketched = with_words(dealt, "text", "words").withColumn("sketch", sketch_of(F.col("words"))).drop("words")
    order = Window.partitionBy("part").orderBy("own", "doc_id", "text")
    return (
        sketched.withColumn("next_text", F.lag("text").over(order))
        .withColumn("next_sketch", F.lag("sketch").over(order))
        .where(F.col("own") == 0)
        .select("doc_id", "text", "sketch", "next_text", "next_sketch")
    )


def edited_likeness(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text beside its edited form, whose second half comes from the next document."""
    pairs = with_neighbours(docs, id_col, text_col).withColumn("n_chars", F.char_length("text").cast("long"))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    edited = pairs.withColumn(
        "edited", F.concat(F.left("text", F.col("n_chars").cast("int") - half), F.left("next_text", half))
    )
    both = with_words(edited, "edited", "words").withColumn("edited_sketch", sketch_of(F.col("words")))
    return both.select("doc_id", "n_chars", "edited", "sketch", "edited_sketch", "next_sketch")
