import hashlib
import re
import struct
import zlib

import xxhash
from conftest import SF
from oracle import compare, connect
from threadloom.llm import fingerprints, sharding
from threadloom.llm.common import bounded_sample, range_part, table
from threadloom.llm.queries import LLM_ORACLES, LLM_QUERIES

SCHEMA = "doc_id long, text string, shard string, size long, part int"


def edge_rows(rows):
    long = "wörd " * 40_000
    return rows(
        [(1, None, "x", 1, 1), (2, "", "x", 1, 1), (3, long, "x", 1, 1), (5, "a b", "x", 1, 1), (5, "a b", "y", 1, 1), (5, "c", "y", 2, 2), (9, "a b", "y", 1, 1)],
        SCHEMA,
    )


def test_shards_agree_with_sql(spark):
    found = compare(spark, connect(SF), LLM_QUERIES["op1_byte_shards"], LLM_ORACLES["op1_byte_shards"], SF)
    assert found[0] is None and found[1] == 200


def test_shards_of_edge_rows(rows):
    docs = edge_rows(rows)
    found = sorted(tuple(r) for r in sharding.shard_by_bytes(docs, 3).collect())
    texts = sorted((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    total, before, slots, want = sum(t[1] for t in texts), 0, {}, []
    for key in texts:
        shard = before * 3 // total
        want.append((*key, shard, slots.setdefault(shard, 0)))
        slots[shard] += 1
        before += key[1]
    assert found == sorted(want)
    assert sharding.shard_by_bytes(docs.limit(0), 3).collect() == []


def test_shards_are_balanced_and_written(spark, tmp_path):
    docs = table(spark, SF, "documents")
    placed = sharding.shard_by_bytes(docs, 5)
    sums = {r["shard"]: r["s"] for r in placed.groupBy("shard").agg({"size": "sum"}).withColumnRenamed("sum(size)", "s").collect()}
    largest = placed.agg({"size": "max"}).first()[0]
    assert set(sums) == set(range(5)) and max(sums.values()) - min(sums.values()) <= 2 * largest
    sharding.write_shards(docs, placed, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted((r["doc_id"], r["text"]) for r in back.collect()) == sorted((r["doc_id"], r["text"]) for r in docs.collect())


def test_range_part(spark):
    from pyspark.sql import functions as F

    for bounds in ([], [5], [3, 7, 8], list(range(0, 100, 9))):
        got = spark.range(-2, 110).select("id", range_part(F.col("id"), bounds).alias("p")).collect()
        assert all(r["p"] == sum(b <= r["id"] for b in bounds) for r in got)


def test_bounded_sample(spark):
    rows = spark.range(5000).selectExpr("id", "if(id % 50 = 0, 'rare', 'common') as kind")
    taken = bounded_sample(rows, "kind", "id", 150)
    assert {r["kind"]: r["count"] for r in taken.groupBy("kind").count().collect()} == {"rare": 100, "common": 150}
    assert sorted(taken.collect()) == sorted(bounded_sample(rows.repartition(7), "kind", "id", 150).collect())


MASK = (1 << 64) - 1


def hash_longs(values):
    seed = 42
    for v in values:
        seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
        seed = seed - (1 << 64) if seed >> 63 else seed
    return seed


def sketch(text):
    words = [xxhash.xxh64_intdigest(w.lower().encode(), 42) for w in re.findall(r"[^\x20\x09-\x0D]+", text)]
    words = [w - (1 << 64) if w >> 63 else w for w in words]
    n = max(len(words) - 4, min(len(words), 1))
    hashes = [hash_longs(words[i : i + 5]) for i in range(n)]
    kept = sorted({h for h in hashes if h < -(1 << 63) + (1 << 64) // 8})
    return n, hash_longs(words), kept


def likeness(a, b):
    if a[1] == b[1]:
        return 1.0
    return len(set(a[2]) & set(b[2])) / len(a[2]) if a[2] else 0.0


def brute(rows):
    rows = sorted(rows)
    out = []
    for i, (doc_id, text) in enumerate(rows):
        following = rows[i - 1][1]
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        a, b, c = sketch(text), sketch(edited), sketch(following)
        written = lambda s: f"{s[0]}:{s[1] & MASK:X}:{','.join(f'{h & MASK:X}' for h in s[2])}"
        out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), written(a), written(b), likeness(a, b), likeness(a, c)))
    return sorted(out)


def test_sketches_of_the_table(spark):
    docs = [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").collect()]
    assert sorted(tuple(r) for r in LLM_QUERIES["op2_scaled_sketches"](spark, SF).collect()) == brute(docs)


def test_sketches_of_edge_rows(rows, tmp_path, spark):
    docs = edge_rows(rows)
    for part, given in enumerate((docs, docs.where("doc_id = 3"), docs.limit(0), docs.repartition(9))):
        given.write.parquet(f"{tmp_path}/{part}/documents.parquet")
        got = LLM_QUERIES["op2_scaled_sketches"](spark, f"{tmp_path}/{part}").collect()
        assert sorted(tuple(r) for r in got) == brute([(r["doc_id"], r["text"] or "") for r in given.collect()])


def test_sketches_merge(spark, rows):
    from pyspark.sql import functions as F

    words = [f"w{i}" for i in range(400)]
    got = fingerprints.sketches(rows([(1, " ".join(words[:250])), (2, " ".join(words[246:])), (3, " ".join(words))], "doc_id long, text string")).collect()
    one, two, whole = (set(r["sketch"]["kept"]) for r in sorted(got))
    assert one | two == whole and len(whole) > 20
    pair = fingerprints.sketches(rows([(1, " ".join(words[:250]))], "doc_id long, text string")).select(F.col("sketch").alias("a")).join(
        fingerprints.sketches(rows([(3, " ".join(words))], "doc_id long, text string")).select(F.col("sketch").alias("b"))
    )
    r = pair.select(fingerprints.containment(F.col("a"), F.col("b")).alias("c"), fingerprints.merged(F.col("a"), F.col("b")).alias("m")).first()
    assert r["c"] == 1.0 and set(r["m"]) == whole
