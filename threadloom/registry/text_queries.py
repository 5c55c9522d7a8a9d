"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from threadloom.functions import fingerprints, ids, text, times
from threadloom.registry.base import register
from threadloom.registry.views import (
    POST_SQL,
    caps,
    coms,
    compose_sql,
    frame_sql,
    h_sql,
    idx,
    post_objects,
    sql,
    strip_sql,
    subs,
    table,
)

PADDED_SQL = "chr(12288) || chr(160) || body || chr(133) || chr(28) || ' '"


@register("strip_text", sql("subs_v", f"SELECT sid, {strip_sql('title')} AS title, {strip_sql(PADDED_SQL)} AS body FROM subs_v"))
def strip_text(spark, sf):
    padded = F.concat(F.lit("　\xa0"), "body", F.lit("\x85\x1c "))
    return subs(spark, sf).select("sid", text.strip_text("title").alias("title"), text.strip_text(padded).alias("body"))


@register("truncate_text", sql("subs_v", f"SELECT sid, left({strip_sql('body')}, 200) AS body, body AS whole FROM subs_v"))
def truncate_text(spark, sf):
    body = text.strip_text("body")
    return subs(spark, sf).select(
        "sid", text.truncate_text(body, 200).alias("body"), text.truncate_text("body", 0).alias("whole")
    )


@register("content_hash", sql("subs_v", f"SELECT sid, {h_sql('body')} AS h FROM subs_v"))
def content_hash(spark, sf):
    return subs(spark, sf).select("sid", text.content_hash("body").alias("h"))


@register("compose_document", sql("subs_v", f"SELECT sid, {compose_sql('title', 'body')} AS text FROM subs_v"))
def compose_document(spark, sf):
    return subs(spark, sf).select("sid", text.compose_document("title", "body").alias("text"))


@register(
    "document_id",
    sql(
        "subs_v coms_v",
        """SELECT 'r:s:' || sub || ':' || sid AS id FROM subs_v
           UNION ALL SELECT 'r:c:' || sub || ':' || comment_id FROM coms_v""",
    ),
)
def document_id(spark, sf):
    def named(df, t, local):
        return df.select(ids.document_id(F.lit(t), F.col("sub"), F.col(local)).alias("id"))

    return named(subs(spark, sf), "s", "sid").unionByName(named(coms(spark, sf), "c", "comment_id"))


RAW_ID_SQL = """CASE doc_id % 5 WHEN 0 THEN 'r:s:' || sub || ':' || sid WHEN 1 THEN 'r:c:' || sub || ':' || sid
    WHEN 2 THEN 'r:x:' || sub || ':' || sid WHEN 3 THEN 'r:c:' || sub || ':a:' || sid ELSE sub END"""


@register(
    "parse_document_id",
    sql(
        "subs_v",
        f"""SELECT sid, raw, CASE WHEN ok THEN split_part(raw, ':', 2) END AS t, CASE WHEN ok THEN split_part(raw, ':', 3) END AS sub,
               CASE WHEN ok THEN split_part(raw, ':', 4) END AS doc,
               CASE WHEN doc_id % 2 = 0 AND contains(raw, ':') THEN string_split(raw, ':')[-1] ELSE '' END AS comment_id
        FROM (SELECT *, len(string_split(raw, ':')) = 4 AND raw[1:2] = 'r:' AND split_part(raw, ':', 2) IN ('s', 'c') AS ok
              FROM (SELECT sid, doc_id, {RAW_ID_SQL} AS raw FROM subs_v))""",
    ),
)
def parse_document_id(spark, sf):
    shape = F.col("doc_id") % 5
    raw = (
        F.when(shape == 0, F.concat_ws(":", F.lit("r:s"), "sub", "sid"))
        .when(shape == 1, F.concat_ws(":", F.lit("r:c"), "sub", "sid"))
        .when(shape == 2, F.concat_ws(":", F.lit("r:x"), "sub", "sid"))
        .when(shape == 3, F.concat_ws(":", F.lit("r:c"), "sub", F.lit("a"), "sid"))
        .otherwise(F.col("sub"))
    )
    part = ids.parse_document_id("raw")
    t = F.when(F.col("doc_id") % 2 == 0, "c").otherwise("s")
    return subs(spark, sf).withColumn("raw", raw).select(
        "sid", "raw", part["t"].alias("t"), part["sub"].alias("sub"), part["doc"].alias("doc"),
        ids.comment_id_of("raw", t).alias("comment_id"),
    )


@register(
    "object_key",
    sql(
        "subs_v",
        f"""SELECT sid, 'reddit/v1/r/s/' || sub || '/' || sid || '/' || {h_sql("body")} || '.txt' AS key,
               'r/s/' || sub || '/' || sid || '/' || {h_sql("body")} || '.txt' AS bare,
               CASE WHEN body = '' THEN '' ELSE 'a/b/r/s/' || sub || '/' || sid || '/' || body[1:8] || '.txt' END AS of_hit
        FROM subs_v""",
    ),
)
def object_key(spark, sf):
    parts = F.lit("s"), F.col("sub"), F.col("sid"), text.content_hash("body")
    id = ids.document_id(F.lit("s"), F.col("sub"), F.col("sid"))
    return subs(spark, sf).select(
        "sid",
        ids.object_key(*parts).alias("key"),
        ids.object_key(*parts, prefix=" / ").alias("bare"),
        ids.object_key_of_hit(id, F.left("body", F.lit(8)), "/a/b/ ").alias("of_hit"),
    )


SNIPPET_SQL = r"[\t-\r \x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}\x{feff}]+"


@register("snippet", sql("subs_v", f"SELECT sid, left(regexp_replace(body, '{SNIPPET_SQL}', ' ', 'g'), 120) AS snippet FROM subs_v"))
def snippet(spark, sf):
    return subs(spark, sf).select("sid", text.snippet("body").alias("snippet"))


@register(
    "bounded_message",
    sql("subs_v", f"SELECT sid, left(coalesce(nullif({strip_sql('body')}, ''), '（空）'), 1900) AS message FROM subs_v"),
)
def bounded_message(spark, sf):
    return subs(spark, sf).select("sid", text.bounded_message("body").alias("message"))


@register(
    "source_line",
    sql(
        "idx_v",
        """SELECT id, printf('%.6f', list_dot_product(vec, vec)) AS score,
               'id=' || id || ' sub=' || sub || ' t=' || t || ' sid=' || sid || ' score=0.500000' AS line FROM idx_v""",
    ),
)
def source_line(spark, sf):
    md = F.col("metadata")
    squares = F.aggregate("values", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    return idx(spark, sf).select(
        "id",
        text.score_text(squares).alias("score"),
        text.source_line(F.col("id"), md["sub"], md["t"], md["sid"], F.lit(0.5)).alias("line"),
    )


@register("utc_parts", sql("caps_v", "SELECT event_id, y, md, hms, cap14 FROM caps_v"))
def utc_parts(spark, sf):
    epoch = F.unix_timestamp(F.col("captured").cast("timestamp"))
    return caps(spark, sf).select("event_id", *[c.alias(n) for n, c in times.utc_parts(epoch).items()], times.stamp14(epoch).alias("cap14"))


@register(
    "lenient_number",
    """SELECT event_id, CASE event_type WHEN 'error' THEN NULL WHEN 'view' THEN CAST(trunc(-value) AS BIGINT)
           ELSE CAST(trunc(value) AS BIGINT) END AS epoch FROM events""",
)
def lenient_number(spark, sf):
    as_text = F.col("value").cast("string")
    given = (
        F.when(F.col("event_type") == "error", F.concat(as_text, F.lit("d")))
        .when(F.col("event_type") == "view", F.concat(F.lit(" -"), as_text))
        .otherwise(F.concat(as_text, F.lit("\n")))
    )
    return table(spark, sf, "events").select("event_id", times.lenient_epoch(given).alias("epoch"))


@register(
    "norm_sub",
    sql("subs_v", r"SELECT sid, sub_raw, regexp_replace(regexp_replace(trim(sub_raw), '^[rR]/', ''), '^[rR]_', '') AS sub FROM subs_v"),
)
def norm_sub(spark, sf):
    return subs(spark, sf).select("sid", "sub_raw", ids.norm_sub(F.concat(F.lit(" "), "sub_raw")).alias("sub"))


@register("submission_fingerprint", sql("subs_v", f"SELECT sid, sha256({frame_sql(*POST_SQL)}) AS hash FROM subs_v"))
def submission_fingerprint(spark, sf):
    parsed = post_objects(spark, sf).select("sid", F.parse_json("raw").alias("obj"))
    return parsed.select("sid", fingerprints.submission_fingerprint("obj").alias("hash"))


@register("canonical_json_hash", "SELECT event_id, sha256(CAST(json(props) AS VARCHAR)) AS hash FROM events")
def canonical_json_hash(spark, sf):
    return table(spark, sf, "events").select(
        "event_id", fingerprints.canonical_json_hash(F.try_parse_json("props")).alias("hash")
    )
