"""Documents, index upkeep, search and contexts."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.operators import context, index as ix, search as se
from threadloom.operators.model import apply_model
from threadloom.plans.parameters import QuestionParameters, RefreshParameters, SearchParameters
from threadloom.operators.cells import build_cells, topk_cells
from threadloom.plans.refresh import refresh as run_refresh
from threadloom.plans.search import context_for, rag_context as rag, search
from threadloom.registry.base import register
from threadloom.registry.ingest_queries import imported
from threadloom.registry.views import (
    doc_idx,
    documents,
    idx,
    label_queries,
    row_queries,
    old_index,
    score_sql,
    sql,
    staged,
)
from threadloom.session import materialize, scratch_path
from threadloom.sources import ledger, schemas, sinks
from threadloom.sources.captures import read_table

MD = ("sub", "t", "sid", "pid", "h")


def flat(df, *columns, fields=MD):
    return df.select(*columns, *[F.col(f"metadata.{f}").alias(f) for f in fields])


# -- documents and index upkeep ----------------------------------------------------


@register("build_documents", sql("docs_v", "SELECT id, text, sub, t, sid, pid, h FROM docs_v"))
def build_documents(spark, sf):
    return flat(documents(spark, sf), "id", "text")


@register("index_diff", sql("changed_v", "SELECT id, text, h FROM changed_v"))
def index_diff(spark, sf):
    return flat(ix.changed(documents(spark, sf), old_index(spark, sf)), "id", "text", fields=["h"])


@register("index_budget", sql("changed_v", "SELECT id, h FROM changed_v ORDER BY id LIMIT 100"))
def index_budget(spark, sf):
    return flat(ix.plan_index(documents(spark, sf), old_index(spark, sf), 100), "id", fields=["h"])


@register("index_budget_ranges", sql("changed_v", "SELECT id, h FROM changed_v ORDER BY id LIMIT 1100"))
def index_budget_ranges(spark, sf):
    """A budget too large for one top-n task."""
    return flat(ix.plan_index(documents(spark, sf), old_index(spark, sf), 1100), "id", fields=["h"])


@register(
    "index_upsert",
    sql(
        "docs_v old_v changed_v",
        """SELECT id, h, CAST(length(text) AS FLOAT) AS size FROM changed_v
           UNION ALL SELECT o.id, o.h, CAST(length(d.text) AS FLOAT) FROM old_v o JOIN docs_v d ON d.id = o.id
           WHERE o.id NOT IN (SELECT id FROM changed_v)""",
    ),
)
def index_upsert(spark, sf):
    """Each changed document comes twice; the later record counts."""
    target = old_index(spark, sf)
    batch = ix.changed(documents(spark, sf), target)
    new = batch.select("id", F.array(F.length("text").cast("float")).alias("values"), "metadata", F.lit(2).alias("seq"))
    old = new.withColumn("metadata", F.col("metadata").withField("h", F.lit("late"))).withColumn("seq", F.lit(1))
    after = ix.upsert(target, old.unionByName(new), seq="seq")
    return after.select("id", F.col("metadata.h").alias("h"), F.col("values")[0].alias("size"))


@register("stale_ids", sql("docs_v old_v", "SELECT id FROM docs_v WHERE id NOT IN (SELECT id FROM old_v)"))
def stale_ids(spark, sf):
    return ix.stale_ids(documents(spark, sf), old_index(spark, sf))


@register(
    "vector_table",
    sql("docs_v", "SELECT id, h, 2::BIGINT AS version FROM docs_v"),
)
def vector_table(spark, sf):
    """Two upserts into a vector table; the second replaces every record."""
    root = scratch_path(spark, "index")
    rows = documents(spark, sf).select(
        "id", F.array(F.lit(1.0).cast("float")).alias("values"), "metadata", "y", "md"
    )
    first = rows.withColumn("metadata", F.col("metadata").withField("h", F.lit("old")))
    sinks.upsert_table(spark, root, first)
    sinks.upsert_table(spark, root, rows.withColumn("values", F.array(F.lit(2.0).cast("float"))))
    back = sinks.read_current(spark, root)
    return back.select("id", F.col("metadata.h").alias("h"), F.col("values")[0].cast("bigint").alias("version"))


@register(
    "vector_table_replay",
    sql("docs_v", "SELECT id, h, CASE WHEN t = 's' THEN 2 ELSE 1 END::BIGINT AS version FROM docs_v"),
)
def vector_table_replay(spark, sf):
    """A stream's batch of all records is written, then newer versions of the posts;
    the batch is run again under its own number, and changes nothing."""
    root = scratch_path(spark, "index")
    rows = documents(spark, sf).select(
        "id", F.array(F.lit(1.0).cast("float")).alias("values"), "metadata", "y", "md", F.lit("20240101000000-a").alias("version")
    )
    newer = rows.where("metadata.t = 's'").withColumns(
        {"values": F.array(F.lit(2.0).cast("float")), "version": F.lit("20240201000000-b")}
    )
    for batch in (rows, newer, rows):
        number = None if batch is newer else sinks.number_of_epoch(spark, root, "records", 0)
        sinks.upsert_table(spark, root, batch, number=number)
    back = sinks.read_current(spark, root)
    return back.select("id", F.col("metadata.h").alias("h"), F.col("values")[0].cast("bigint").alias("version"))


@register(
    "vector_records",
    sql(
        "idx_v",
        """SELECT id, t, sub, sid, array_to_string(list_transform(vec, lambda x: CAST(round(x * 1000000) AS BIGINT)), ',') AS vector
           FROM idx_v""",
    ),
)
def vector_records(spark, sf):
    """Written as JSON records and read back."""
    path = scratch_path(spark, "vectors")
    sinks.write_vectors(idx(spark, sf), path)
    back = spark.read.schema(schemas.VECTOR).json(path)
    numbers = F.transform("values", lambda x: F.round(x.cast("double") * 1_000_000).cast("bigint").cast("string"))
    return flat(back, "id", F.array_join(numbers, ",").alias("vector"), fields=["t", "sub", "sid"])


@register("vector_dim_check", sql("idx_v", "SELECT id, len(vec) AS n FROM idx_v"))
def vector_dim_check(spark, sf):
    return ix.check_dim(idx(spark, sf), 64).select("id", F.size("values").cast("bigint").alias("n"))


def letter_counts(texts: list[str]) -> list[list[float]]:
    """A stand-in for an embedding model."""
    return [[float(len(t)), float(t.count("e")), float(t.count(" "))] for t in texts]


@register(
    "embed_documents",
    sql(
        "docs_v",
        """SELECT id, h, length(text)::DOUBLE AS n, (length(text) - length(replace(text, 'e', '')))::DOUBLE AS e,
               (length(text) - length(replace(text, ' ', '')))::DOUBLE AS blanks, NULL::VARCHAR AS error FROM docs_v""",
    ),
)
def embed_documents(spark, sf):
    done = apply_model(documents(spark, sf), letter_counts, "array<float>")
    v = F.col("values")
    return done.select(
        "id", F.col("metadata.h").alias("h"), *[v[i].cast("double").alias(n) for i, n in enumerate(("n", "e", "blanks"))], "error"
    )


def picky_counts(texts: list[str]) -> list[list[float]]:
    """A model that refuses a list with a text it does not like."""
    if any("qu" in t for t in texts):
        raise ValueError("refused")
    return letter_counts(texts)


@register(
    "embed_with_failures",
    sql(
        "docs_v",
        """SELECT id, CASE WHEN NOT contains(text, 'qu') THEN length(text)::DOUBLE END AS n,
               CASE WHEN contains(text, 'qu') THEN 'refused' END AS error FROM docs_v""",
    ),
)
def embed_with_failures(spark, sf):
    done = apply_model(documents(spark, sf), picky_counts, "array<float>")
    return done.select("id", F.get("values", F.lit(0)).cast("double").alias("n"), "error")


KNOWN_SQL = """d.t = 's' AND d.sub || ':' || d.doc IN (SELECT sub || ':' || sid FROM posts_v)"""
KEY_SQL = "'reddit/v1/r/' || d.t || '/' || d.sub || '/' || d.doc || '/' || d.h || '.txt'"


def manifest(spark, sf):
    """The texts of the labelled posts are in the store."""
    docs = documents(spark, sf)
    return sinks.text_objects(docs.join(old_index(spark, sf).select("id"), "id", "left_semi"))


@register(
    "text_export_new",
    sql("docs_v posts_v", f"SELECT {KEY_SQL} AS key, d.t, d.sub, d.doc AS id, d.h, d.text FROM docs_v d WHERE NOT ({KNOWN_SQL})"),
)
def text_export_new(spark, sf):
    return sinks.new_texts(documents(spark, sf), manifest(spark, sf))


@register(
    "text_export_capped",
    sql("docs_v posts_v", f"SELECT {KEY_SQL} AS key, d.h FROM docs_v d WHERE NOT ({KNOWN_SQL}) ORDER BY key LIMIT 50"),
)
def text_export_capped(spark, sf):
    return sinks.new_texts(documents(spark, sf), manifest(spark, sf), max_objects=50).select("key", "h")


@register(
    "text_store",
    sql("docs_v", f"SELECT {KEY_SQL} AS key, d.t, d.sub, d.doc AS id, d.h, d.text, 1::BIGINT AS n FROM docs_v d"),
)
def text_store(spark, sf):
    """Exported twice; the second time adds nothing."""
    path = scratch_path(spark, "store")
    for _ in range(2):
        sinks.export_texts(documents(spark, sf), path)
    back = read_table(spark, path, schemas.STORE)
    return back.groupBy("key", "t", "sub", "id", "h", "text").agg(F.count(F.lit(1)).alias("n"))


REFRESHED_SQL = """SELECT id, h, t, length(text)::DOUBLE AS n, 1::BIGINT AS narrow, h || ':' || text AS stored FROM docs_v d
    WHERE d.t = 's' OR sub || ':' || sid IN (SELECT sub || ':' || sid FROM subs_v)"""


@register("refresh", sql("docs_v subs_v", REFRESHED_SQL))
def refresh(spark, sf):
    """Import, then refresh twice; index, narrow table and text store end with
    every document once.  Of a post's two versions the later capture counts, and
    they differ in no text."""
    paths = {n: scratch_path(spark, n) for n in ("captures", "narrow", "index", "store")}
    dump = imported(spark, sf)
    sinks.write_captures(dump.posts, paths["captures"], dump.posts_by_day, dump.partitions)
    sinks.write_captures(dump.comments, paths["captures"], by=dump.partitions)
    params = RefreshParameters(dim=3)
    for _ in range(2):
        run_refresh(spark, embed=letter_counts, params=params, **paths)
    index = flat(sinks.read_current(spark, paths["index"]), "id", F.col("values")[0].cast("double").alias("n"), fields=["h", "t"])
    is_post = F.col("kind") == "submissions"
    newest = read_table(spark, paths["narrow"], schemas.NARROW).select(
        F.concat_ws(":", F.lit("r"), F.when(is_post, "s").otherwise("c"), "sub", F.when(is_post, F.col("sid")).otherwise(F.col("comment_id"))).alias("_n"),
        "cap14", "h16",
    )
    narrow = newest.groupBy("_n").agg(F.max(F.struct("cap14", "h16")).alias("v"), F.count_distinct("cap14", "h16").alias("k"), F.count(F.lit(1)).alias("rows"))
    narrow = narrow.select("_n", F.expr("rows div k").alias("narrow"))
    store = read_table(spark, paths["store"], schemas.STORE).select(
        F.concat_ws(":", F.lit("r"), "t", "sub", "id").alias("_s"), F.concat_ws(":", "h", "text").alias("stored")
    )
    return index.join(narrow, F.col("id") == F.col("_n")).join(store, F.col("id") == F.col("_s")).select("id", "h", "t", "n", "narrow", "stored")


@register(
    "refresh_noop",
    sql(
        "docs_v subs_v",
        """SELECT 0::BIGINT AS converted, count(*) AS documents, 0::BIGINT AS vectors, 0::BIGINT AS failed, 0::BIGINT AS deferred,
               0::BIGINT AS opened, count(*) AS indexed, count(*) AS stored
           FROM docs_v d WHERE d.t = 's' OR sub || ':' || sid IN (SELECT sub || ':' || sid FROM subs_v)""",
    ),
)
def refresh_noop(spark, sf):
    """The third of three refreshes has nothing to do: no leaf differs from what is
    recorded for the index and the store, so none is opened."""
    paths = {n: scratch_path(spark, n) for n in ("captures", "narrow", "index", "store")}
    dump = imported(spark, sf)
    sinks.append_captures(dump.posts, paths["captures"], dump.posts_by_day, dump.partitions)
    sinks.append_captures(dump.comments, paths["captures"], by=dump.partitions)
    for _ in range(3):
        counts = run_refresh(spark, embed=letter_counts, params=RefreshParameters(dim=3), **paths)
    for name, path in (("indexed", paths["index"]), ("stored", paths["store"])):
        known = ledger.recorded(spark, path, ledger.data_files(spark, path))
        counts[name] = known.agg(F.sum("n")).first()[0]
    names = "converted documents vectors failed deferred opened indexed stored".split()
    return spark.createDataFrame([tuple(counts[n] for n in names)], ", ".join(f"{n} long" for n in names))


# -- search ------------------------------------------------------------------------

FIRST = "vec_id = 0"
IDX_SCORE = score_sql("i.vec", "q.vec")
HITS_SQL = f"""SELECT i.*, {IDX_SCORE} AS score FROM idx_v i, (SELECT vec FROM idx_v WHERE vec_id = 0) q"""


def first_hits(spark, sf, k, **options):
    index = idx(spark, sf)
    return se.topk(index, se.query_vector(index, FIRST), k, **options)


@register("vector_topk", sql("idx_v", f"SELECT id, score, sub, t, sid FROM ({HITS_SQL}) ORDER BY score DESC, id LIMIT 10"))
def vector_topk(spark, sf):
    return flat(first_hits(spark, sf, 10), "id", "score", fields=["sub", "t", "sid"])


@register(
    "filtered_topk",
    sql("idx_v", f"SELECT id, score FROM ({HITS_SQL}) WHERE sub = 'sub1' AND t = 's' ORDER BY score DESC, id LIMIT 10"),
)
def filtered_topk(spark, sf):
    return first_hits(spark, sf, 10, filter='{"sub": "sub1", "t": {"$eq": "s"}}').select("id", "score")


@register("topk_projection", sql("idx_v", f"SELECT id, score, 'r' AS src, sub, t FROM ({HITS_SQL}) ORDER BY score DESC, id LIMIT 20"))
def topk_projection(spark, sf):
    hits = se.project_hits(first_hits(spark, sf, 20, columns=["metadata", "values"]), "indexed")
    return hits.select("id", "score", "metadata.*")


BATCH_SQL = """SELECT query_id, id, score FROM (
    SELECT a.query_id, i.id, round(list_dot_product(i.vec, a.q), 9) AS score
    FROM idx_v i CROSS JOIN (SELECT vec_id AS query_id, vec AS q FROM idx_v WHERE vec_id % 20 = 0) a)
    QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) <= 10"""


@register("vector_topk_batch", sql("idx_v", BATCH_SQL))
def vector_topk_batch(spark, sf):
    index = idx(spark, sf)
    return se.topk_batch(index, row_queries(index), 10, metric="dot").select("query_id", "id", "score")


@register("vector_topk_grid", sql("idx_v", BATCH_SQL))
def vector_topk_grid(spark, sf):
    """The questions in several blocks."""
    index = idx(spark, sf)
    hits = se.topk_batch(index, row_queries(index), 10, metric="dot", block=16)
    return hits.select("query_id", "id", "score")


@register("vector_topk_cells", sql("idx_v", BATCH_SQL))
def vector_topk_cells(spark, sf):
    """The questions over an index in cells, of which some are skipped."""
    index = idx(spark, sf)
    cells = build_cells(index, metric="dot")
    return topk_cells(cells, row_queries(index), 10).select("query_id", "id", "score")


ONE = ()


@register(
    "dedup_hits",
    sql(
        "idx_v",
        f"""SELECT id, score, sid FROM (SELECT * FROM ({HITS_SQL}) ORDER BY score DESC, id LIMIT 16)
            QUALIFY row_number() OVER (PARTITION BY sid ORDER BY score DESC, id) = 1""",
    ),
)
def dedup_hits(spark, sf):
    return flat(se.dedup_hits(first_hits(spark, sf, 16), per=ONE), "id", "score", fields=["sid"])


@register(
    "ranked_hits",
    sql("idx_v", f"SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score FROM ({HITS_SQL}) QUALIFY rank <= 16"),
)
def ranked_hits(spark, sf):
    ranked = se.rank_hits(first_hits(spark, sf, 16).withColumn("query_id", F.lit(0)))
    return ranked.select(F.col("rank").cast("bigint"), "id", "score")


@register(
    "render_hits",
    sql(
        "idx_v",
        f"""SELECT id, rank || '. score=' || printf('%.6f', score) || ' id=' || id || chr(10) || '{{"src":"r","sub":"' || sub
                || '","t":"' || t || '","sid":"' || sid || '","h":""}}' || chr(10) || chr(10) AS line,
                '{{"id":"' || id || '","score":' || score || ',"metadata":{{"src":"r","sub":"' || sub || '","t":"' || t || '","sid":"' || sid || '","h":""}}}}' AS object
            FROM (SELECT *, row_number() OVER (ORDER BY score DESC, id) AS rank FROM ({HITS_SQL})) WHERE rank <= 10""",
    ),
)
def render_hits(spark, sf):
    ranked = se.rank_hits(first_hits(spark, sf, 10).withColumn("query_id", F.lit(0)))
    pretty = se.render_hits(ranked, "pretty").withColumnRenamed("line", "pretty")
    both = se.render_hits(pretty, "jsonl")
    return both.select("id", F.col("pretty").alias("line"), F.col("line").alias("object"))


TEXTS_SQL = """SELECT h.query_id, h.id, h.score, coalesce(d.text, '') AS {name}
    FROM hits_v h LEFT JOIN docs_v d ON d.id = h.id{pinned}"""


def asked(spark, sf, k=20):
    index = doc_idx(spark, sf)
    return materialize(se.topk_batch(index, label_queries(index), k), "hits")


@register("hits_with_pinned_text", sql("hits_v docs_v", TEXTS_SQL.format(name="text", pinned=" AND d.h = h.h")))
def hits_with_pinned_text(spark, sf):
    store = sinks.text_objects(documents(spark, sf))
    hits = asked(spark, sf)
    return context.with_pinned_text(hits, store).select("query_id", "id", "score", "text")


@register("hits_with_excerpt", sql("hits_v docs_v", TEXTS_SQL.format(name="excerpt", pinned="")))
def hits_with_excerpt(spark, sf):
    hits = asked(spark, sf)
    hits = context.with_latest_text(hits, staged(spark, sf))
    return hits.select("query_id", "id", "score", "excerpt")


SEARCH_SQL = f"""SELECT row_number() OVER (ORDER BY score DESC, id) AS rank, id, score, text FROM (
    SELECT i.id, {score_sql("i.vec", "q.vec")} AS score, coalesce(d.text, '') AS text
    FROM didx_v i LEFT JOIN docs_v d ON d.id = i.id AND d.h = i.h, (SELECT vec FROM didx_v WHERE vec_id = 0) q)
    QUALIFY rank <= 10"""


@register("search_with_text", sql("didx_v docs_v", SEARCH_SQL))
def search_with_text(spark, sf):
    index = doc_idx(spark, sf)
    store = sinks.text_objects(documents(spark, sf))
    params = SearchParameters(topk=10, with_text=True)
    hits = search(index, se.query_vector(index, FIRST), params, store=store)
    return hits.select(F.col("rank").cast("bigint"), "id", "score", "text")


# -- contexts ----------------------------------------------------------------------


@register("context_blocks", sql("blocks_v", "SELECT query_id, rank, block FROM blocks_v"))
def context_blocks(spark, sf):
    store = sinks.text_objects(documents(spark, sf))
    hits = asked(spark, sf)
    blocks = context.context_blocks(context.with_pinned_text(hits, store))
    return blocks.select("query_id", F.col("rank").cast("bigint"), "block")


BUDGET = 12000
BUDGET_SQL = f"""SELECT * FROM blocks_v
    QUALIFY sum(length(block)) OVER (PARTITION BY query_id ORDER BY rank ROWS UNBOUNDED PRECEDING) <= {BUDGET}"""


@register("context_budget", sql("blocks_v", f"SELECT query_id, rank, length(block) AS n FROM ({BUDGET_SQL})"))
def context_budget(spark, sf):
    store = sinks.text_objects(documents(spark, sf))
    params = QuestionParameters(topk=20, max_docs=20, budget=BUDGET, style="source")
    blocks = context_for(asked(spark, sf), params, store=store)
    return blocks.select("query_id", F.col("rank").cast("bigint"), F.length("block").cast("bigint").alias("n"))


TEMPLATE = context.PromptTemplate(header="Posts:\n", separator="\n\n", footer="\n\nQuestion: ", empty_header="No posts.")


def prompts_and_sources(spark, sf):
    index = doc_idx(spark, sf)
    params = QuestionParameters(topk=20, max_docs=8, budget=BUDGET, style="source")
    store = sinks.text_objects(documents(spark, sf))
    return rag(index, label_queries(index), params, store=store, template=TEMPLATE)


# At most 8 of the hits, before those without a text are dropped.
RAG_SQL = f"""SELECT * FROM (
    SELECT b.*, row_number() OVER (PARTITION BY b.query_id ORDER BY b.score DESC, b.id) AS place
    FROM blocks_v b JOIN hits_v h ON h.query_id = b.query_id AND h.id = b.id AND h.place <= 8)
    QUALIFY sum(length(block)) OVER (PARTITION BY query_id ORDER BY place ROWS UNBOUNDED PRECEDING) <= {BUDGET}"""


@register(
    "rag_context",
    sql(
        "asked_v blocks_v",
        f"""SELECT a.query_id, 'label ' || a.query_id AS question, coalesce(r.n, 0) AS n_blocks,
                CASE WHEN r.n IS NULL THEN 'No posts.' ELSE 'Posts:' || chr(10) || r.context END
                    || chr(10) || chr(10) || 'Question: label ' || a.query_id || chr(10) AS prompt
            FROM asked_v a LEFT JOIN (
                SELECT query_id, count(*) AS n, string_agg(block, chr(10) || chr(10) ORDER BY place) AS context
                FROM ({RAG_SQL}) GROUP BY query_id) r ON r.query_id = a.query_id""",
    ),
)
def rag_context(spark, sf):
    return prompts_and_sources(spark, sf)[0]


@register(
    "rag_sources",
    sql("blocks_v", f"SELECT query_id, place AS rank, id, score, sub, t, sid, '' AS pid, source FROM ({RAG_SQL})"),
)
def rag_sources(spark, sf):
    return prompts_and_sources(spark, sf)[1].withColumn("rank", F.col("rank").cast("bigint"))
