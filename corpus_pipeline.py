"""From raw documents to token ids, stage by stage.

Each stage takes (spark, docs, sf_dir) and works on all documents that the stage
before it kept.  What a stage returns is written as Parquet in the shared folder
and read again as the next stage's documents, so an executor can be lost at any
time and only the running stage is repeated.

Stages but the last return the columns they were given.  Empty tables pass as
empty tables; how each stage takes nulls, empty texts and repeated rows is said in
its operator's module.  A document without an id is not compared with others, so
the stages that look for copies and benchmark passages keep it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadloom.llm import decontam, language, near, pieces, secret_scan
from threadloom.llm.common import ids_for_join, table
from threadloom.llm.queries import vocabulary_path
from threadloom.session import materialize

# Below this share for its likeliest language a text counts as of none.
LEAST_LANGUAGE = 0.3


def unused(docs: DataFrame, name: str) -> str:
    """``name``, with underscores behind it where a column is called so."""
    taken = {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    return name


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose id is not among ``ids``, a table that was written."""
    gone = unused(docs, "_gone")
    return docs.join(ids_for_join(ids.select(F.col("doc_id").alias(gone))), F.col("doc_id") == F.col(gone), "left_anti")


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Language ID: texts without letters, or in no language learned, go."""
    net = language.train(docs)
    if net is None:  # nothing was learned that a text could be rejected by
        return docs
    found = language.predicted(docs, net, "text", F.struct(*docs.columns).alias("row"))
    sure = (F.col("lang_pred") != "und") & (F.col("score") >= LEAST_LANGUAGE)
    return found.where(sure).select("row.*")


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup: of documents alike to 0.8 in five-word shingles one row
    stays, of the smallest id.  Rows of one id are told apart by their texts; of
    rows that agree in id and text one stays.  Texts without words stay all."""
    groups = materialize(near.near_rows(docs).where(F.col("doc_id").isNotNull()), "near-groups")
    mark, the_id, the_hash = (unused(docs, n) for n in ("_text_hash", "_id", "_hash"))
    row = [F.col("doc_id").alias(the_id), F.col("text_hash").alias(the_hash)]
    gone = materialize(groups.where(~F.col("first")).select(*row).distinct(), "copies")
    firsts = groups.where("first AND n_shingles > 0").groupBy(*row).agg(F.count(F.lit(1)).alias("_n"))
    repeated = materialize(firsts.where("_n > 1").select(the_id, the_hash), "repeated")
    marked = docs.withColumn(mark, near.text_hash())
    named = (F.col("doc_id") == F.col(the_id)) & (F.col(mark) == F.col(the_hash))
    left = marked.join(ids_for_join(gone), named, "left_anti")
    if not repeated.isEmpty():
        once = left.join(ids_for_join(repeated), named, "left_semi").dropDuplicates(["doc_id", mark])
        left = left.join(ids_for_join(repeated), named, "left_anti").unionByName(once)
    return left.drop(mark)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Benchmark decontamination: documents that hold a benchmark passage go."""
    found = decontam.leaks(docs, table(spark, sf_dir, "benchmark"))
    return without(docs, materialize(found.select("doc_id").distinct(), "leaks"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secret scans: what looks like a secret is masked, and the length counted anew."""
    found = secret_scan.scan(docs, "text", F.struct(*docs.columns).alias("row"))
    hit, text = F.size("spans") > 0, F.col("row.text")
    masked = found.withColumn("masked", F.when(hit, secret_scan.masked(text, "spans")).otherwise(text))
    changed = {"text": F.col("masked")}
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        changed["n_chars"] = F.when(hit, F.char_length("masked").cast(kind)).otherwise(F.col("row.n_chars"))
    return masked.select(*[changed.get(c, F.col("row").getField(c)).alias(c) for c in docs.columns])


def as_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """SentencePiece encoding and decoding: the ids of every text, and digests."""
    return pieces.encoded(docs, vocabulary_path())


STAGES = [
    ("language", known_language),
    ("near_dedup", one_of_each_group),
    ("decontamination", without_benchmark),
    ("secrets", without_secrets),
    ("pieces", as_pieces),
]

# SQL cannot express a trained network or signatures; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return docs
