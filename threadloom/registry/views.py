"""Corpus-shaped views over the given tables, for Spark and as SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from threadloom.functions import ids, text
from threadloom.functions.text import BLANKS
from threadloom.operators.documents import build_documents
from threadloom.operators.narrow import union_kinds
from threadloom.session import configure

START = 1704067200
STEP = 3607

AS_OF = "2024-01-31"
NOW = 1735689600


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf}/{name}.parquet")


def tagged(prefix: str, number: Column | str) -> Column:
    return F.concat(F.lit(prefix), (F.col(number) if isinstance(number, str) else number).cast("string"))


def subs(spark: SparkSession, sf: str) -> DataFrame:
    """Posts: one per document; the first line is the title."""
    title = F.substring_index("text", "\n", 1)
    shape = F.col("doc_id") % 4
    return table(spark, sf, "documents").select(
        tagged("s", "doc_id").alias("sid"),
        F.when(shape == 0, F.concat(F.lit("r/"), "source"))
        .when(shape == 1, F.concat(F.lit("R_"), "source"))
        .otherwise(F.col("source"))
        .alias("sub_raw"),
        F.col("source").alias("sub"),
        F.when(F.col("doc_id") % 10 != 0, F.col("lang")).alias("author"),
        title.alias("title"),
        F.substr("text", F.length(title) + 2).alias("body"),
        (F.lit(START) + F.col("doc_id") * STEP).alias("created_utc"),
        "doc_id",
    )


def coms(spark: SparkSession, sf: str) -> DataFrame:
    """Comments: one per turn; a turn answers the one before it."""
    conv, turn = F.col("conv_id"), F.col("turn")
    post = tagged("s", "conv_id")

    def comment(n: Column) -> Column:
        return F.concat(tagged("c", "conv_id"), tagged("x", n))

    return table(spark, sf, "conversations").select(
        post.alias("sid"),
        tagged("src", conv % 20).alias("sub"),
        comment(turn).alias("comment_id"),
        F.when(turn == 0, F.concat(F.lit("t3_"), post))
        .otherwise(F.concat(F.lit("t1_"), comment(turn - 1)))
        .alias("parent_id"),
        F.concat(F.lit("t3_"), post).alias("link_id"),
        F.col("role").alias("author"),
        F.col("text").alias("body"),
        (F.lit(START) + conv * STEP + turn * 61).alias("created_utc"),
        "conv_id",
        "turn",
    )


def posts(spark: SparkSession, sf: str) -> DataFrame:
    """The posts that are known: those with a label."""
    labelled = table(spark, sf, "labels").select("doc_id")
    return subs(spark, sf).join(labelled, "doc_id", "left_semi")


def caps(spark: SparkSession, sf: str) -> DataFrame:
    """Captures: one per event."""
    hash = F.sha2(F.concat("event_type", F.lit("|"), "props"), 256)
    return table(spark, sf, "events").select(
        tagged("u", "user_id").alias("sid"),
        F.when(F.col("event_id") % 2 == 0, "submissions").otherwise("comments").alias("kind"),
        tagged("sub", F.col("user_id") % 3).alias("sub"),
        F.col("ts").alias("captured"),
        F.date_format("ts", "yyyyMMddHHmmss").alias("cap14"),
        F.date_format("ts", "yyyy").alias("y"),
        F.date_format("ts", "MMdd").alias("md"),
        F.date_format("ts", "HHmmss").alias("hms"),
        hash.alias("hash"),
        F.left(hash, F.lit(16)).alias("h16"),
        F.col("event_type").alias("payload"),
        "event_id",
    )


def idx(spark: SparkSession, sf: str) -> DataFrame:
    """A vector index: one entry per embedding, 40 threads."""
    label, vec = F.col("label"), F.col("vec_id")
    t = F.when(label % 2 == 0, "s").otherwise("c")
    sub = tagged("sub", label % 3)
    return table(spark, sf, "embeddings").select(
        F.concat_ws(":", F.lit("r"), t, sub, vec.cast("string")).alias("id"),
        F.col("embedding").alias("values"),
        F.struct(
            F.lit("r").alias("src"),
            sub.alias("sub"),
            t.alias("t"),
            tagged("s", vec % 40).alias("sid"),
            F.lit(None).cast("string").alias("pid"),
            F.lit("").alias("h"),
        ).alias("metadata"),
        "vec_id",
        "label",
    )


def post_objects(spark: SparkSession, sf: str) -> DataFrame:
    """Posts as JSON objects; some fields have the wrong type."""
    raw = F.to_json(
        F.struct(
            F.col("sid").alias("id"), F.concat(F.lit("t3_"), "sid").alias("name"), F.col("sub").alias("subreddit"),
            "author", F.lit(True).alias("is_self"), "title", F.col("body").alias("selftext"),
            F.col("doc_id").alias("domain"), F.lit(False).alias("edited"), F.col("author").isNull().alias("over_18"),
            F.lit("true").alias("spoiler"), F.col("created_utc"),
        )
    )
    return subs(spark, sf).select("sub", "sid", raw.alias("raw"))


def staged(spark: SparkSession, sf: str) -> DataFrame:
    """Staged rows of both kinds: the version of every post and thread, and
    before it an older one of the labelled posts."""

    def keyed(df: DataFrame, kind: str) -> DataFrame:
        return df.withColumns(
            {
                "kind": F.lit(kind),
                "y": F.lit("2024"),
                "md": F.lit("0101"),
                "hms": F.lit("000000"),
                "cap14": F.lit("20240102000000"),
                "h16": F.lit("b"),
            }
        )

    keys = ["sub", "kind", "y", "md", "hms", "sid", "cap14", "h16"]
    now = keyed(subs(spark, sf), "submissions").select(*keys, "author", "title", "body")
    older = keyed(posts(spark, sf), "submissions").withColumn("cap14", F.lit("20240101000000"))
    older = older.withColumn("title", F.concat(F.lit("old "), "title")).select(*keys, "author", "title", "body")
    said = keyed(coms(spark, sf), "comments").select(*keys, "author", "body", "comment_id", "parent_id")
    return union_kinds(now.unionByName(older), said)


def documents(spark: SparkSession, sf: str) -> DataFrame:
    """The documents of the corpus, whole texts."""
    return build_documents(staged(spark, sf))


def old_index(spark: SparkSession, sf: str) -> DataFrame:
    """An index that knows the labelled posts: with an old hash where the
    quality is 0, with none where the text is toxic."""
    rows = posts(spark, sf).join(table(spark, sf, "labels"), "doc_id")
    whole = text.compose_document("title", "body")
    h = F.when(F.col("toxic") == 1, "").when(F.col("quality") == 0, "0" * 16).otherwise(text.content_hash(whole))
    return rows.select(
        ids.document_id(F.lit("s"), F.col("sub"), F.col("sid")).alias("id"),
        F.array(F.length(whole).cast("float")).alias("values"),
        F.struct(
            F.lit("r").alias("src"), "sub", F.lit("s").alias("t"), "sid", F.lit(None).cast("string").alias("pid"),
            h.alias("h"),
        ).alias("metadata"),
    )


def doc_idx(spark: SparkSession, sf: str) -> DataFrame:
    """A vector index over the documents: an embedding stands for the first
    comment of its conversation where the label is odd and there is one,
    otherwise for its post."""
    docs = table(spark, sf, "documents").select("doc_id", "source", F.col("text").alias("post"))
    first = table(spark, sf, "conversations").where("turn = 0").select("conv_id", F.col("text").alias("said"))
    e = table(spark, sf, "embeddings")
    rows = e.join(docs, e.vec_id == docs.doc_id, "left").join(first, e.vec_id == first.conv_id, "left")
    title = F.substring_index("post", "\n", 1)
    whole = text.compose_document(title, F.substr("post", F.length(title) + 2))
    is_comment = (F.col("label") % 2 == 1) & F.col("said").isNotNull()
    body = F.when(is_comment, text.strip_text("said")).otherwise(whole)
    t = F.when(is_comment, "c").otherwise("s")
    sub = F.coalesce(F.when(is_comment, tagged("src", F.col("vec_id") % 20)).otherwise(F.col("source")), F.lit("none"))
    sid = tagged("s", "vec_id")
    local = F.when(is_comment, F.concat(tagged("c", "vec_id"), F.lit("x0"))).otherwise(sid)
    return rows.select(
        ids.document_id(t, sub, local).alias("id"),
        F.col("embedding").alias("values"),
        F.struct(
            F.lit("r").alias("src"), sub.alias("sub"), t.alias("t"), sid.alias("sid"),
            F.lit(None).cast("string").alias("pid"),
            F.when(body != "", text.content_hash(body)).otherwise("").alias("h"),
        ).alias("metadata"),
        "vec_id",
        "label",
    )


def label_queries(index: DataFrame) -> DataFrame:
    """One question per label: its entry with the lowest number."""
    best = F.min_by(F.struct("id", "values"), "vec_id")
    rows = index.groupBy("label").agg(best.alias("q"))
    return rows.select(
        F.col("label").cast("int").alias("query_id"),
        F.col("q.values").alias("vector"),
        tagged("label ", "label").alias("question"),
    )


def row_queries(index: DataFrame) -> DataFrame:
    """Every entry whose number is divisible by 20 as a question."""
    rows = index.where(F.col("vec_id") % 20 == 0)
    return rows.select(F.col("vec_id").alias("query_id"), F.col("values").alias("vector"))


# -- the same as SQL -----------------------------------------------------------

BLANK_SQL = "'" + BLANKS + "'"


def strip_sql(x: str) -> str:
    return f"trim(coalesce({x}, ''), {BLANK_SQL})"


def compose_sql(title: str, body: str) -> str:
    return f"concat_ws(chr(10) || chr(10), nullif({strip_sql(title)}, ''), nullif({strip_sql(body)}, ''))"


def h_sql(x: str) -> str:
    return f"left(sha256({x}), 16)"


def frame_sql(*texts: str) -> str:
    return " || ".join(f"length({t}) || ':' || {t}" for t in texts)


# The fields of a post's fingerprint.
POST_SQL = ["sid", "'t3_' || sid", "sub", "coalesce(author, '')", "'true'", "''", "title", "''", "body", "''", "''"]
POST_SQL += ["'false'", "CASE WHEN author IS NULL THEN 'true' ELSE 'false' END", "'false'", "'false'", "'false'", "''", "''"]

VIEWS = {
    "subs_v": f"""
        SELECT 's' || doc_id AS sid,
               CASE WHEN doc_id % 4 = 0 THEN 'r/' || source WHEN doc_id % 4 = 1 THEN 'R_' || source ELSE source END AS sub_raw,
               source AS sub, CASE WHEN doc_id % 10 = 0 THEN NULL ELSE lang END AS author,
               split_part(text, chr(10), 1) AS title,
               substr(text, length(split_part(text, chr(10), 1)) + 2) AS body,
               {START} + doc_id * {STEP} AS created_utc, doc_id
        FROM documents""",
    "coms_v": f"""
        SELECT 's' || conv_id AS sid, 'src' || (conv_id % 20) AS sub, 'c' || conv_id || 'x' || turn AS comment_id,
               CASE WHEN turn = 0 THEN 't3_s' || conv_id ELSE 't1_c' || conv_id || 'x' || (turn - 1) END AS parent_id,
               't3_s' || conv_id AS link_id, role AS author, text AS body,
               {START} + conv_id * {STEP} + turn * 61 AS created_utc, conv_id, turn
        FROM conversations""",
    "posts_v": "SELECT s.* FROM subs_v s WHERE s.doc_id IN (SELECT doc_id FROM labels)",
    "caps_v": """
        SELECT 'u' || user_id AS sid, CASE WHEN event_id % 2 = 0 THEN 'submissions' ELSE 'comments' END AS kind,
               'sub' || (user_id % 3) AS sub, ts AS captured, strftime(ts, '%Y%m%d%H%M%S') AS cap14,
               strftime(ts, '%Y') AS y, strftime(ts, '%m%d') AS md, strftime(ts, '%H%M%S') AS hms,
               sha256(event_type || '|' || props) AS hash, left(sha256(event_type || '|' || props), 16) AS h16,
               event_type AS payload, event_id
        FROM events""",
    "idx_v": """
        SELECT 'r:' || CASE WHEN label % 2 = 0 THEN 's' ELSE 'c' END || ':sub' || (label % 3) || ':' || vec_id AS id,
               CASE WHEN label % 2 = 0 THEN 's' ELSE 'c' END AS t, 'sub' || (label % 3) AS sub,
               's' || (vec_id % 40) AS sid, embedding::DOUBLE[] AS vec, vec_id, label
        FROM embeddings""",
    "docs_v": f"""
        SELECT 'r:' || t || ':' || sub || ':' || doc AS id, text, sub, t, sid, pid, {h_sql("text")} AS h, doc FROM (
            SELECT 's' AS t, sub, sid, sid AS doc, NULL AS pid, {compose_sql("title", "body")} AS text FROM subs_v
            UNION ALL
            SELECT 'c', sub, sid, comment_id, parent_id, {strip_sql("body")} FROM coms_v)
        WHERE text <> ''""",
    "old_v": f"""
        SELECT 'r:s:' || p.sub || ':' || p.sid AS id,
               CASE WHEN l.toxic = 1 THEN '' WHEN l.quality = 0 THEN repeat('0', 16)
                    ELSE {h_sql(compose_sql("p.title", "p.body"))} END AS h
        FROM posts_v p JOIN labels l ON l.doc_id = p.doc_id""",
    "changed_v": """
        SELECT d.* FROM docs_v d LEFT JOIN old_v o ON o.id = d.id
        WHERE nullif(o.h, '') IS DISTINCT FROM d.h""",
    "didx_v": f"""
        SELECT 'r:' || t || ':' || sub || ':' || doc AS id, t, sub, sid, vec, vec_id, label,
               CASE WHEN text <> '' THEN {h_sql("text")} ELSE '' END AS h
        FROM (SELECT e.vec_id, e.label, e.embedding::DOUBLE[] AS vec, 's' || e.vec_id AS sid,
                     CASE WHEN odd THEN 'c' ELSE 's' END AS t,
                     coalesce(CASE WHEN odd THEN 'src' || (e.vec_id % 20) ELSE p.sub END, 'none') AS sub,
                     CASE WHEN odd THEN 'c' || e.vec_id || 'x0' ELSE 's' || e.vec_id END AS doc,
                     CASE WHEN odd THEN {strip_sql("c.body")} ELSE {compose_sql("p.title", "p.body")} END AS text
              FROM embeddings e LEFT JOIN subs_v p ON p.doc_id = e.vec_id
                   LEFT JOIN coms_v c ON c.conv_id = e.vec_id AND c.turn = 0,
                   LATERAL (SELECT e.label % 2 = 1 AND c.body IS NOT NULL AS odd))""",
    "asked_v": "SELECT label AS query_id, arg_min(vec, vec_id) AS q FROM didx_v GROUP BY label",
}


def score_sql(a: str, b: str) -> str:
    dot = f"list_dot_product({a}, {b})"
    return f"round({dot} / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))), 9)"


# The 20 best entries of every question.
VIEWS["hits_v"] = f"""
        SELECT * FROM (
            SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS place FROM (
                SELECT a.query_id, d.id, d.t, d.sub, d.sid, d.h, {score_sql("d.vec", "a.q")} AS score
                FROM didx_v d CROSS JOIN asked_v a))
        WHERE place <= 20"""
# Their texts, one block each, numbered after hits without a text are dropped.
VIEWS["blocks_v"] = """
        SELECT *, 'SOURCE ' || source || chr(10) || text AS block FROM (
            SELECT h.query_id, h.id, h.t, h.sub, h.sid, h.score, d.text,
                   row_number() OVER (PARTITION BY h.query_id ORDER BY h.score DESC, h.id) AS rank,
                   'id=' || h.id || ' sub=' || h.sub || ' t=' || h.t || ' sid=' || h.sid
                       || ' score=' || printf('%.6f', h.score) AS source
            FROM hits_v h JOIN docs_v d ON d.id = h.id AND d.h = h.h)"""

NEEDS = {
    "posts_v": ("subs_v",),
    "docs_v": ("subs_v", "coms_v"),
    "old_v": ("posts_v",),
    "changed_v": ("docs_v", "old_v"),
    "didx_v": ("subs_v", "coms_v"),
    "asked_v": ("didx_v",),
    "hits_v": ("didx_v", "asked_v"),
    "blocks_v": ("hits_v", "docs_v"),
}


def sql(views: str, body: str) -> str:
    """``body`` with the named views, and those they need, before it."""
    ordered: list[str] = []

    def need(name: str) -> None:
        for other in NEEDS.get(name, ()):
            need(other)
        if name not in ordered:
            ordered.append(name)

    for name in views.split():
        need(name)
    head = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in ordered)
    return f"WITH {head}\n{body}" if head else body
