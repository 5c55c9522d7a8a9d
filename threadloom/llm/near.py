"""Groups of near copies by SuperMinHash signatures.

A text is the set of its word shingles.  In a signature every shingle draws a
random number for each step of a random permutation of the places; a place keeps
the smallest step plus number it was given.  The steps of one shingle go to
different places, so the places are correlated and their answers vary less than
those of independent hashes.  A text stops as soon as each of its places is
filled, since later steps can only give higher values: long texts need one step.

Texts with equal sets are put together first.  One text of each set goes on: its
signature is cut into bands, and texts that share a band form a bucket.  Within a
bucket its first member is compared with the others on the full sets, and links
join groups by union-find.  That settles most buckets with as many comparisons as
they have members.  In the others, the members outside the largest group are
compared with all: the bucket is dealt into chunks of a bounded size, a task holds
one, and the outsiders pass by each.  No pair is written down, and none is left
out unless it is already joined.

Defined results: null and empty texts, and texts of blanks, have no shingle and
are alone; a text of fewer words than a shingle is one shingle; equal rows are
one group; a null id belongs to the group of its text but names none; a tie
between sets is broken by the smallest id; an empty table gives no rows; columns
other than id and text are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from threadloom.llm.common import bounded_batches, ids_for_join, kept_by_worker, whole_text
from threadloom.llm.components import components
from threadloom.llm.words import BASE, distinct_by_text, grouped, mixed, shingle_hashes, word_hashes
from threadloom.session import materialize

BANDS = 40
ROWS = 6
SHINGLE_WORDS = 5
THRESHOLD = (80, 100)
MEMBERS_PER_TASK_GROUP = 256


def signatures(values, owner, n_texts: int, places: int):
    """The signature of each text, from its distinct shingles sorted by text."""
    import numpy as np

    best = np.full((n_texts, places), np.inf)
    flat = best.reshape(-1)
    counts = np.bincount(owner, minlength=n_texts)
    active = np.arange(len(values))
    order = None
    for step in range(places):
        seed = mixed(values[active] + np.uint64((step + 1) * BASE & ((1 << 64) - 1)))
        draw = (seed >> np.uint64(11)).astype(np.float64) * 2.0**-53
        # The lower bits choose the place, the upper ones are the number drawn.
        chosen = step + ((mixed(seed) >> np.uint64(33)) % np.uint64(places - step)).astype(np.int64)
        if order is None:
            place = chosen
        else:
            rows = np.arange(len(active))
            place = order[rows, chosen].astype(np.int64)
            order[rows, chosen] = order[:, step]
        np.minimum.at(flat, owner[active] * places + place, draw + step)
        unfilled = np.isinf(best).any(axis=1) & (counts > 0)
        going = unfilled[owner[active]]
        if not going.any():
            break
        if order is None:
            active = active[going]
            order = np.tile(np.arange(places, dtype=np.uint16), (len(active), 1))
            order[np.arange(len(active)), chosen[going]] = 0  # step 0 swapped places
        elif not going.all():
            active, order = active[going], order[going]
    return best


def band_keys(signature, bands: int, rows: int):
    """A 64-bit key for each band, different between bands."""
    import numpy as np

    bits = np.ascontiguousarray(signature).view(np.uint64).reshape(len(signature), bands, rows)
    key = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), bits.shape[:2]).copy()
    for j in range(rows):
        key = mixed(key * np.uint64(BASE) + bits[:, :, j])
    return key


def described(docs: DataFrame, id_col: str, text_col: str, size: int, bands: int, rows: int, threshold) -> DataFrame:
    """(doc_id, text_hash, n_shingles, key1, key2, bands) of each text.

    The keys are sums over the set, equal for equal sets.  A set so small that
    only an equal one can reach the threshold has no bands."""
    least = threshold[0] / (threshold[1] - threshold[0]) if threshold[1] > threshold[0] else float("inf")

    bounded_batches(docs.sparkSession)
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            n = batch.num_rows
            sizes, keys = np.zeros(n, np.int64), np.zeros((2, n), np.uint64)
            found = [None] * n
            for low, high, data, starts, ends in grouped(batch.column(2)):
                hashes, owner, _, _ = word_hashes(data, starts, ends)
                values, owner = distinct_by_text(*shingle_hashes(hashes, owner, high - low, size))
                counts = np.bincount(owner, minlength=high - low)
                sizes[low:high] = counts
                if not len(values):
                    continue
                full = np.flatnonzero(counts)
                firsts = (np.cumsum(counts) - counts)[full]
                for k, salt in enumerate((1, 2)):
                    keys[k, low + full] = np.add.reduceat(mixed(values + np.uint64(salt)), firsts)
                wanted = counts >= least - 1e-9
                if wanted.any():
                    taken = wanted[owner]
                    rank = np.cumsum(wanted) - 1
                    signature = signatures(values[taken], rank[owner[taken]], int(wanted.sum()), bands * rows)
                    for i, row in zip(np.flatnonzero(wanted), band_keys(signature, bands, rows).view(np.int64)):
                        found[low + i] = row
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(sizes),
                    pa.array(keys[0].view(np.int64)),
                    pa.array(keys[1].view(np.int64)),
                    pa.array(found, pa.list_(pa.int64())),
                ],
                names=["doc_id", "text_hash", "n_shingles", "key1", "key2", "bands"],
            )

    given = identified(docs, id_col, text_col)
    return given.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, key1 long, key2 long, bands array<long>")


def text_hash(text_col: str = "text"):
    """What tells rows of one id with different texts apart."""
    return F.xxhash64(whole_text(text_col))


def identified(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), text_hash(text_col).alias("text_hash"), whole_text(text_col).alias("text"))


def compared(pairs: DataFrame, texts: DataFrame, size: int, threshold) -> DataFrame:
    """The pairs (a, b) whose full shingle sets reach the threshold.

    The members b of one a are dealt into groups of a bounded expected size; the
    text of a goes to each of them and comes first, so that a task holds one set
    and passes over the others."""
    counts = pairs.groupBy(F.col("a").alias("hub")).agg(F.count(F.lit(1)).alias("n"))
    spread = F.expr(f"cast((n + {MEMBERS_PER_TASK_GROUP - 1}) div {MEMBERS_PER_TASK_GROUP} as int)")
    sized = counts.select("hub", spread.alias("groups"))
    members = pairs.join(sized, F.col("a") == F.col("hub")).select(
        "hub", F.pmod(F.xxhash64("b"), F.col("groups")).cast("int").alias("group"), F.col("b").alias("id"), F.lit(1).alias("member")
    )
    hubs = sized.select(
        "hub", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), F.col("hub").alias("id"), F.lit(0).alias("member")
    )
    given = (
        members.union(hubs)
        .join(texts.select(F.col("doc_id").alias("_id"), "text"), F.col("id") == F.col("_id"))
        .select("hub", "group", "member", "id", "text")
        .repartition("hub", "group")
        .sortWithinPartitions("hub", "group", "member", "id")
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        hub, hub_set = None, None
        for batch in batches:
            found = ([], [])
            hub_ids, member, ids = batch.column(0).to_pylist(), batch.column(2).to_pylist(), batch.column(3).to_pylist()
            for low, high, data, starts, ends in grouped(batch.column(4)):
                hashes, owner, _, _ = word_hashes(data, starts, ends)
                values, owner = distinct_by_text(*shingle_hashes(hashes, owner, high - low, size))
                cuts = np.searchsorted(owner, np.arange(high - low + 1))
                for i in range(low, high):
                    own = values[cuts[i - low] : cuts[i - low + 1]]
                    if not member[i]:
                        hub, hub_set = hub_ids[i], own.copy()
                        continue
                    assert hub == hub_ids[i], "a member without the text it is compared with"
                    at = np.minimum(np.searchsorted(hub_set, own), len(hub_set) - 1)
                    common = int((hub_set[at] == own).sum())
                    if threshold[1] * common >= threshold[0] * (len(own) + len(hub_set) - common):
                        found[0].append(hub)
                        found[1].append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    return given.mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, *args, **kwargs) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept) of every document, see near_rows."""
    return near_rows(docs, *args, **kwargs).select("doc_id", "n_shingles", "component_id", "kept")


def near_rows(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = SHINGLE_WORDS,
    threshold: tuple[int, int] = THRESHOLD,
    bands: int = BANDS,
    rows: int = ROWS,
) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, text_hash, first) of every document.

    What is grouped are sets, so rows of one id with different texts are different
    members.  ``component_id`` is the smallest id among a group's rows, and ``kept``
    tells rows of that id.  ``first`` tells one text's rows of that id in each group,
    and rows that are linked with nothing.

    ``threshold`` is a fraction of two integers; links are confirmed by
    ``threshold[1] * common >= threshold[0] * together``.  The default signature
    misses a pair right at 0.8 with a probability of 5e-6.
    """
    table = materialize(described(docs, id_col, text_col, size, bands, rows, threshold), "described")
    set_key = ["n_shingles", "key1", "key2"]
    sets = materialize(
        table.where("n_shingles > 0")
        .groupBy(*set_key)
        .agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "text_hash"))).alias("row"))
        .select(*set_key, "row.*")
        .repartitionByRange("doc_id", "text_hash")
        .sortWithinPartitions("doc_id", "text_hash")
        .withColumn("node", F.monotonically_increasing_id()),
        "sets",
    )  # nodes are numbered in the order of ids
    chosen = sets.where(F.col("doc_id").isNotNull()).select(
        F.col("node").alias("id"), F.col("n_shingles").alias("n"), F.col("doc_id").alias("d"), F.col("text_hash").alias("t")
    )
    banded = (
        table.where(F.col("bands").isNotNull() & F.col("doc_id").isNotNull())
        .join(chosen, (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("t")))
        .select("id", "n", F.explode("bands").alias("band"))
    )
    shared = banded.groupBy(F.col("band").alias("shared")).agg(F.count(F.lit(1)).alias("n_members")).where("n_members > 1")
    buckets = materialize(banded.join(shared, F.col("band") == F.col("shared")).select("band", "id", "n").distinct(), "buckets")
    involved = materialize(buckets.select("id").distinct(), "involved")
    rows_of = materialize(chosen.join(involved, "id", "left_semi").select("id", "d", "t"), "involved-rows")
    # Rows that agree in id and text are one text.
    texts = materialize(
        identified(docs, id_col, text_col)
        .join(ids_for_join(rows_of), (F.col("doc_id") == F.col("d")) & (F.col("text_hash") == F.col("t")))
        .select(F.col("id").alias("doc_id"), "text")
        .dropDuplicates(["doc_id"]),
        "texts",
    )
    labels = _joined(buckets, texts, size, threshold)
    leaders = sets.select(F.col("node").alias("_leader"), F.col("doc_id").alias("component_id"), F.col("text_hash").alias("_first"))
    named = (
        sets.join(labels.withColumnRenamed("id", "_v"), F.col("node") == F.col("_v"), "left")
        .withColumn("_leader_of", F.coalesce("component", "node"))
        .join(leaders, F.col("_leader_of") == F.col("_leader"))
        .select(*[F.col(c).alias(f"_{c}") for c in set_key], "component_id", "_first")
    )
    same = [F.col(c) == F.col(f"_{c}") for c in set_key]
    alone = F.col("n_shingles") == 0
    found = table.join(named, same[0] & same[1] & same[2], "left").select(
        "doc_id", "n_shingles", F.when(alone, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"), "text_hash", "_first"
    )
    kept = F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))
    first = alone | (kept & F.coalesce(F.col("text_hash") == F.col("_first"), F.lit(False)))
    return found.select("doc_id", "n_shingles", "component_id", kept.alias("kept"), "text_hash", first.alias("first"))


def settled(rows: DataFrame, texts: DataFrame, size: int, threshold) -> DataFrame:
    """Links (a, b) between groups inside buckets.

    ``rows`` are (band, chunk, query, id, component): a chunk of a bucket's
    members, query 0, and the members that are compared with all of them, query
    1.  A task holds one chunk's shingles, sorted, and passes over the queries;
    of several links with one group it names the first."""
    given = (
        rows.join(texts.select(F.col("doc_id").alias("_id"), "text"), F.col("id") == F.col("_id"))
        .select("band", "chunk", "query", "id", "component", "text")
        .repartition("band", "chunk")
        .sortWithinPartitions("band", "chunk", "query", "id")
    )

    def run(batches):
        import numpy as np
        import pyarrow as pa

        key, members, index = None, [], None
        for batch in batches:
            found = ([], [])
            band, chunk, query, ids, groups = (batch.column(k).to_pylist() for k in range(5))
            for low, high, data, starts, ends in grouped(batch.column(5)):
                hashes, owner, _, _ = word_hashes(data, starts, ends)
                values, owner = distinct_by_text(*shingle_hashes(hashes, owner, high - low, size))
                cuts = np.searchsorted(owner, np.arange(high - low + 1))
                for i in range(low, high):
                    own = values[cuts[i - low] : cuts[i - low + 1]]
                    if key != (band[i], chunk[i]):
                        key, members, index = (band[i], chunk[i]), [], None
                    if not query[i]:
                        members.append((ids[i], groups[i], own.copy()))
                        continue
                    if not members:
                        continue  # no member was dealt into this chunk
                    if index is None:
                        sizes = np.array([len(m[2]) for m in members])
                        every = np.concatenate([m[2] for m in members])
                        order = np.argsort(every, kind="stable")
                        index = every[order], np.repeat(np.arange(len(members)), sizes)[order], sizes
                    left, right = (np.searchsorted(index[0], own, side) for side in ("left", "right"))
                    counts = right - left
                    at = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts) + np.repeat(left, counts)
                    common = np.bincount(index[1][at], minlength=len(members))
                    alike = threshold[1] * common >= threshold[0] * (index[2] + len(own) - common)
                    seen = {groups[i]}
                    for j in np.flatnonzero(alike):
                        if members[j][1] not in seen:
                            seen.add(members[j][1])
                            found[0].append(members[j][0])
                            found[1].append(ids[i])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["a", "b"])

    return given.mapInArrow(run, "a long, b long")


def _joined(buckets: DataFrame, texts: DataFrame, size: int, threshold) -> DataFrame:
    """(id, component) of the ids that have a link."""
    # Every member of a bucket with its first member.
    firsts = buckets.groupBy(F.col("band").alias("b")).agg(F.min(F.struct("id", "n")).alias("hub"))
    pairs = (
        buckets.join(firsts, F.col("band") == F.col("b"))
        .where(F.col("hub.id") != F.col("id"))
        .where(threshold[1] * F.least("n", "hub.n") >= threshold[0] * F.greatest("n", "hub.n"))
        .select(F.col("hub.id").alias("a"), F.col("id").alias("b"))
        .distinct()
    )
    links = materialize(compared(materialize(pairs, "pairs"), texts, size, threshold), "links")
    labels = materialize(components(links), "labels")
    named = buckets.join(labels.withColumnRenamed("id", "_v"), F.col("id") == F.col("_v"), "left").select(
        "band", "id", F.coalesce("component", "id").alias("component")
    )
    # Buckets that still hold several groups, one of each set of members.
    groups = named.groupBy("band", "component").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("x")
    )
    whole = groups.groupBy("band").agg(
        F.sum("n").alias("size"),
        F.max_by("component", F.struct("n", "component")).alias("main"),
        F.min("component").alias("low"),
        F.max("component").alias("high"),
        F.sum("x").alias("x"),
    )
    open_ = whole.where("low < high").groupBy("size", "x", "low", "high").agg(F.min(F.struct("band", "main")).alias("one"))
    chunks = F.expr(f"cast((size + {MEMBERS_PER_TASK_GROUP - 1}) div {MEMBERS_PER_TASK_GROUP} as int)")
    open_ = open_.select(F.col("one.band").alias("b"), "one.main", chunks.alias("chunks"))
    left = materialize(named.join(open_, F.col("band") == F.col("b")).drop("b"), "left")
    members = left.select(
        "band", F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("query"), "id", "component"
    )
    queries = left.where(F.col("component") != F.col("main")).select(
        "band", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"), F.lit(1).alias("query"), "id", "component"
    )
    more = materialize(settled(members.union(queries), texts, size, threshold), "more-links")
    return components(links.union(more)) if more.head(1) else labels
