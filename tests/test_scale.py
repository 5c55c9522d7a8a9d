"""Skewed tables, and the shape of plans that must hold on large ones."""

import re

import __spark_entry__ as driver
import duckdb
import pytest
from conftest import SF, plan_of
from oracle import TABLES, compare, connect
from pyspark.sql import functions as F

from threadloom.functions.once import computed_once
from threadloom.operators import captures as cp
from threadloom.operators.documents import build_documents
from threadloom.plans.refresh import narrow_rows
from threadloom.sources import dumps, schemas
from threadloom.sources.captures import lookback, read_table

QUERIES, ORACLES = driver.queries(), driver.oracle_sql()

# A third of the rows: one text and one source, one thread, one user, one vector.
SKEWED = {
    "documents": """SELECT r * 200 + doc_id AS doc_id, lang, n_chars,
        CASE WHEN (doc_id + r) % 3 = 0 THEN (SELECT text FROM t WHERE doc_id = 5) ELSE text END AS text,
        CASE WHEN (doc_id + r) % 3 = 0 THEN 'src0' ELSE source END AS source FROM t, range(5) x(r)""",
    "conversations": """SELECT CASE WHEN (conv_id + r) % 3 = 0 THEN 0 ELSE r * 20 + conv_id + 1 END AS conv_id,
        CASE WHEN (conv_id + r) % 3 = 0 THEN (r * 20 + conv_id + 1) * 32 + turn ELSE turn END AS turn, role, text
        FROM t, range(20) x(r)""",
    "events": """SELECT r * 1000 + event_id AS event_id, ts, event_type, value, props,
        CASE WHEN (event_id + r) % 3 = 0 THEN 1 ELSE user_id + r * 15 END AS user_id FROM t, range(5) x(r)""",
    "embeddings": """SELECT r * 500 + vec_id AS vec_id, label,
        CASE WHEN (vec_id + r) % 3 = 0 THEN (SELECT embedding FROM t WHERE vec_id = 7) ELSE embedding END AS embedding
        FROM t, range(3) x(r)""",
    "labels": "SELECT r * 200 + doc_id AS doc_id, quality, toxic FROM t, range(5) x(r)",
}


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    out = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for name in TABLES:
        source = f"read_parquet('{SF}/{name}.parquet')"
        body = SKEWED.get(name, "SELECT * FROM t")
        con.execute(f"COPY (WITH t AS (SELECT * FROM {source}) {body}) TO '{out}/{name}.parquet' (FORMAT parquet)")
    return str(out)


@pytest.mark.parametrize(
    "name",
    """thread_group comment_order dedup_comments thread_fingerprint thread_join capture_time distinct_captures
    latest_capture latest_thread incremental_new build_documents index_diff index_budget_ranges text_export_new
    vector_topk vector_topk_batch vector_topk_grid rag_context import_threads import_comments run_stats""".split(),
)
def test_skewed_tables(spark, skewed, name):
    message, n = compare(spark, connect(skewed), QUERIES[name], ORACLES[name], skewed)
    assert message is None, message
    assert n > 0


PYTHON = re.compile("MapInArrow|MapInPandas|ArrowEvalPython|BatchEvalPython|FlatMap")


@pytest.mark.parametrize("name", sorted(set(ORACLES) - {"refresh", "refresh_noop", *(n for n in ORACLES if n.startswith("op"))}))
def test_no_cross_joins_and_python_only_where_needed(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    scoring = ("topk", "hits", "search", "context", "rag", "embed", "flatten")
    assert bool(PYTHON.search(plan)) <= any(word in name for word in scoring), plan


def test_only_needed_columns_are_read(spark, tmp_path):
    rows = spark.range(100).select(
        F.lit("a").alias("sub"), F.col("id").cast("string").alias("sid"),
        *[F.lit("x").alias(c) for c in ("hms", "cap14", "h16", "author", "title", "body", "comment_id", "parent_id")],
        F.lit("submissions").alias("kind"), F.lit("2024").alias("y"),
        F.format_string("%02d%02d", F.col("id") % 12 + 1, F.col("id") % 28 + 1).alias("md"),
    )
    rows.write.partitionBy(*schemas.PARTITIONS).parquet(str(tmp_path / "narrow"))
    table = read_table(spark, str(tmp_path / "narrow"), schemas.NARROW)
    newest = plan_of(build_documents(lookback(table, 3, "2024-06-10")))
    schemas_read = re.findall(r"ReadSchema: struct<(.*?)>", newest)
    assert any("body" not in s for s in schemas_read)  # versions are found over keys alone
    assert all("author" not in s for s in schemas_read)
    assert all("md#" in f for f in re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters", newest))
    kinds = plan_of(table.where("kind = 'comments'"))
    assert "kind#" in re.search(r"PartitionFilters: \[(.*?)\]", kinds).group(1)


def test_diffs_compare_keys(spark):
    plan = plan_of(cp.convert_new(*[spark.read.parquet(f"{SF}/labels.parquet")] * 2, ["doc_id"]))
    assert "LeftAnti" in plan and all("toxic" not in s for s in re.findall(r"ReadSchema: .*", plan)[1:])


def test_a_line_is_parsed_once(spark, tmp_path):
    (tmp_path / "x_posts.jsonl").write_text('{"id": "a", "subreddit": "j", "created_utc": 5}\n')
    from threadloom.plans.import_dump import linked_comments, valid_post_rows

    parsed = dumps.read_dump(spark, str(tmp_path / "x_posts.jsonl"))
    for rows in (valid_post_rows(parsed, 1), linked_comments(parsed)):
        assert plan_of(rows).count("parseJson") == 1


def test_captured_lines_are_opened_once(spark, rows):
    captures = rows([], schemas.CAPTURE).withColumn("h16", F.lit("x")).repartition(2)
    plan = plan_of(narrow_rows(captures))
    assert plan.count("from_json") <= 2  # one per kind
    kept = computed_once(rows([(1,)], "n int"), m=F.col("n") * 2).where("m > 1")
    assert [tuple(r) for r in kept.collect()] == [(1, 2)]
