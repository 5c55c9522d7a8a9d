"""The trie of conversations that share their first turns, by composable fingerprints.

A conversation is rebuilt from the head of another one and the rest of its own
turns.  No rebuilt text is made.  A turn has a number in each of three prime
fields, and a run of turns the pair (length, sum of the numbers times powers of a
base).  Runs are composed by (m, s) (n, t) = (m + n, s + base^m t), a monoid, so
the fingerprint of every rebuilt prefix comes out of the head's sum and of the own
sums before and after: the own part of a conversation needs its prefix sums only,
which are made block by block, so that a conversation of any length is spread over
many tasks.

A rebuilt turn is a reference (conversation, place) with the turn's digest.  Rows
of one depth and fingerprint are a node.  The turns they refer to must have one
digest (240 bits of SHA-256 over role and text), and the prefixes they follow one
fingerprint; where they do not, all is made anew with other bases.

Sums over subtrees take no walk.  A node is named by its smallest member and its
depth, and a conversation names a run of nodes down to its own end.  So what lies
below a node is the rest of its namesake's run, and the whole runs of its other
members.

Defined results: rows without conv_id take no part; null roles and texts are
empty; turns are ordered by turn (nulls first), then role, then the digest of the
text, so repeated rows stay.  An empty table gives no rows, also no root.  Other
columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from threadloom.llm.common import range_bounds, range_part, shuffle_partitions, whole_text
from threadloom.operators.ranking import positions
from threadloom.session import materialize

# Primes below 2^31, so that a product of two rests fits a long.
PRIMES = (2147483647, 2147483629, 2147483587)
# Turns of a conversation, or nodes of its run, that one window covers.
BLOCK_BITS = 10
LONGEST_HEAD = 3
WORDS = r"[^\x20\x09-\x0D]+"

LANES = [f"f{i}" for i in range(len(PRIMES))]
PARENT = [f"p{i}" for i in range(len(PRIMES))]
DIGEST = [f"g{i}" for i in range(4)]
KEY = ["depth", *LANES]


def fields(attempt: int) -> list[tuple[int, int]]:
    """(prime, base) of each lane, other bases in each attempt."""
    return [(p, pow(1_000_003 + 2 * attempt, 5 + i, p)) for i, p in enumerate(PRIMES)]


def _power(prime: int, base: int, exponent: Column, bits: int, step: int = 1) -> Column:
    """base^(step * exponent) modulo the prime, for exponents of so many bits."""
    found = F.lit(1).cast("long")
    for j in range(bits):
        is_set = exponent.bitwiseAND(F.lit(1 << j).cast("long")) != 0
        found = (found * F.when(is_set, pow(base, step << j, prime)).otherwise(1)) % prime
    return found


def _joined(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Left's columns and right's others, by keys that hold no null."""
    renamed = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    on = [left[k] == renamed[f"_{k}"] for k in keys]
    return left.join(renamed, on, how).drop(*[f"_{k}" for k in keys])


def stored_turns(conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, words, digest as four numbers): every turn at its place from
    0, without its text.  Written once."""
    text, role = whole_text("text"), whole_text("role")
    small = conversations.where(F.col("conv_id").isNotNull()).select(
        F.col("conv_id").cast("long").alias("conv_id"),
        "turn",
        role.alias("role"),
        F.sha2(text.cast("binary"), 256).alias("text_hash"),
        F.regexp_count(text, F.lit(WORDS)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("tie"),
    )
    # The tie tells equal rows apart, whose order does not matter.
    placed = positions(small, ["conv_id"], ["turn", "role", "text_hash", "tie"])
    whole = F.sha2(F.concat_ws(" ", "text_hash", F.hex("role")).cast("binary"), 256)
    hashed = placed.withColumn("whole", whole)
    digest = [F.conv(F.substring("whole", 1 + 15 * i, 15), 16, 10).cast("long").alias(g) for i, g in enumerate(DIGEST)]
    return materialize(hashed.select("conv_id", (F.col("pos") - 1).alias("pos"), "words", *digest), "turns")


def heads(turns: DataFrame) -> DataFrame:
    """(conv_id, n_own, head): the number of turns and the first three of them."""
    first = F.when(F.col("pos") < LONGEST_HEAD, F.struct("pos", "words", *DIGEST))
    return turns.groupBy("conv_id").agg(
        F.count(F.lit(1)).alias("n_own"), F.sort_array(F.collect_list(first)).alias("head")
    )


def _lane(i: int, prime: int, *digest: Column) -> Column:
    return F.pmod(F.xxhash64(*digest, F.lit(i)), F.lit(prime))


def rebuilt(turns: DataFrame, lanes: list[tuple[int, int]], group: int = 20) -> DataFrame:
    """Every prefix of every rebuilt conversation: member, depth, the fingerprints of
    the prefix and of the one before it, the last turn's words and digest, whether
    the conversation ends there, and a block to tell parts of a long one apart."""
    convs = heads(turns)
    bases = convs.select(F.col("conv_id").alias("b"), F.col("head").alias("base_head"))
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(LONGEST_HEAD + 1)).cast("int")
    taken = F.least(F.col("h"), F.coalesce(F.size("base_head"), F.lit(0)))

    def head_sums(head: Column, upto: Column, i: int) -> Column:
        """The sum of a head's first turns, up to three."""
        prime, base = lanes[i]
        total = F.lit(0).cast("long")
        for k in range(LONGEST_HEAD):
            turn = F.get(head, F.lit(k))
            own = _lane(i, prime, *[turn[g] for g in DIGEST]) * pow(base, k, prime) % prime
            total = total + F.when((upto > k) & turn.isNotNull(), own).otherwise(0)
        return total % prime

    known = convs.join(bases, F.col("conv_id") - F.col("conv_id") % group == F.col("b"), "left")
    known = known.withColumn("h", h).withColumn("taken", taken).withColumn("length", taken + F.greatest(F.col("n_own") - F.col("h"), F.lit(0)))
    back = {}
    for i, (prime, base) in enumerate(lanes):
        inverse = pow(base, -1, prime)
        shift = F.lit(pow(inverse, LONGEST_HEAD, prime))
        for less in range(LONGEST_HEAD):
            shift = F.when(F.col("h") - F.col("taken") == less, pow(inverse, less, prime)).otherwise(shift)
        back[f"back{i}"] = shift.cast("long")
    known = known.select(
        "*",
        *[head_sums(F.col("base_head"), F.col("taken"), i).alias(f"lead{i}") for i in range(len(lanes))],
        *[head_sums(F.col("head"), F.col("h"), i).alias(f"skip{i}") for i in range(len(lanes))],
        *[c.alias(name) for name, c in back.items()],
    )
    known = materialize(known, "rebuilt")

    # Rows of the borrowed head and of the empty prefix: at most four a conversation.
    def short(depth: int) -> Column:
        last = F.get("base_head", F.lit(depth - 1)) if depth else None
        sums = [head_sums(F.col("base_head"), F.lit(depth), i) for i in range(len(lanes))]
        before = [head_sums(F.col("base_head"), F.lit(depth - 1), i) for i in range(len(lanes))]
        nothing = F.lit(0).cast("long")
        return F.struct(
            F.lit(depth).cast("long").alias("depth"),
            *[c.alias(n) for n, c in zip(LANES, sums)],
            *[c.alias(n) for n, c in zip(PARENT, before)],
            (last["words"] if depth else nothing).alias("words"),
            *[(last[g] if depth else nothing).alias(g) for g in DIGEST],
            (F.col("length") == depth).alias("ends"),
        )

    borrowed = F.array(*[short(d) for d in range(LONGEST_HEAD + 1)])
    lent = known.select(
        F.col("conv_id").alias("member"), F.lit(0).cast("long").alias("block"), F.inline(F.slice(borrowed, F.lit(1), F.col("taken") + 1))
    )

    # Own turns: sums inside a block of turns, and of the blocks before it.
    inside = F.col("pos").bitwiseAND(F.lit((1 << BLOCK_BITS) - 1).cast("long"))
    cut = turns.withColumn("block", F.shiftright("pos", BLOCK_BITS))
    valued = cut.select(
        "*",
        *[
            (_lane(i, p, *[F.col(g) for g in DIGEST]) * _power(p, b, inside, BLOCK_BITS) % p).alias(f"v{i}")
            for i, (p, b) in enumerate(lanes)
        ],
    )
    numbers = range(len(lanes))
    blocks = valued.groupBy("conv_id", "block").agg(*[(F.sum(f"v{i}") % lanes[i][0]).alias(f"v{i}") for i in numbers])
    scaled = blocks.select(
        "conv_id", "block", *[f"v{i}" for i in numbers],
        *[_power(p, b, F.col("block"), 40, 1 << BLOCK_BITS).alias(f"scale{i}") for i, (p, b) in enumerate(lanes)],
    )
    above = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    offsets = scaled.select(
        "conv_id", "block", *[f"scale{i}" for i in numbers],
        *[(F.coalesce(F.sum(F.col(f"v{i}") * F.col(f"scale{i}") % p).over(above), F.lit(0)) % p).alias(f"offset{i}") for i, (p, _) in enumerate(lanes)],
    )
    carried = ["n_own", "h", "taken", *[f"{n}{i}" for n in ("lead", "skip", "back") for i in numbers]]
    offsets = _joined(offsets, known.select("conv_id", *carried), ["conv_id"])
    upto = Window.partitionBy("conv_id", "block").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    summed = valued.select("*", *[F.sum(f"v{i}").over(upto).alias(f"s{i}") for i in numbers])
    placed = _joined(summed, offsets, ["conv_id", "block"]).where(F.col("pos") >= F.col("h"))

    def column(name: str, i: int) -> Column:
        return F.col(f"{name}{i}")

    def prefix(i: int) -> Column:
        p = lanes[i][0]
        own = (column("offset", i) + (column("s", i) % p) * column("scale", i)) % p
        return (column("lead", i) + F.pmod(own - column("skip", i), F.lit(p)) * column("back", i)) % p

    def last(i: int) -> Column:
        p = lanes[i][0]
        return (column("v", i) * column("scale", i) % p) * column("back", i) % p

    rest = placed.select("*", *[prefix(i).alias(n) for i, n in enumerate(LANES)], *[last(i).alias(f"t{i}") for i in numbers])
    own = rest.select(
        F.col("conv_id").alias("member"),
        "block",
        (F.col("taken") + F.col("pos") - F.col("h") + 1).cast("long").alias("depth"),
        *LANES,
        *[F.pmod(F.col(n) - F.col(f"t{i}"), F.lit(lanes[i][0])).alias(PARENT[i]) for i, n in enumerate(LANES)],
        "words",
        *DIGEST,
        (F.col("pos") == F.col("n_own") - 1).alias("ends"),
    )
    return lent.unionByName(own)


def _nodes(rows: DataFrame) -> DataFrame:
    same = [F.min(c).alias(c) for c in ("words", *PARENT, *DIGEST)]
    most = [F.max(c).alias(f"max_{c}") for c in (*PARENT, *DIGEST)]
    return rows.groupBy(*KEY).agg(F.min("member").alias("conv_id"), F.count(F.lit(1)).alias("n_convs"), *same, *most)


def ends_digests(rows: DataFrame) -> DataFrame:
    """(KEY, ends_sha256) of nodes that are the end of a conversation.

    The ids are listed in ranges first; a digest is fed with one range after the
    other, so a task holds one range of a node's ids at most."""
    ends = rows.where("ends").select(*KEY, "member")
    bounds = range_bounds(ends, "member", shuffle_partitions(rows.sparkSession))
    parts = ends.groupBy(*KEY, range_part(F.col("member"), bounds).alias("part")).agg(
        F.concat_ws(",", F.transform(F.sort_array(F.collect_list("member")), lambda m: m.cast("string"))).alias("ids")
    )
    laid = parts.repartition(*KEY).sortWithinPartitions(*KEY, "part")

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import pyarrow as pa

        def batch(rows):
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=[*KEY, "ends_sha256"])

        key, digest, done = None, None, []
        for given in batches:
            keys = list(zip(*[given.column(k).to_pylist() for k in KEY]))
            for own, ids in zip(keys, given.column("ids").to_pylist()):
                if own == key:
                    digest.update(b",")
                else:
                    if key is not None:
                        done.append((*key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                digest.update(ids.encode())
            if len(done) >= 1000:
                yield batch(done)
                done = []
        if key is not None:
            done.append((*key, digest.hexdigest()))
            yield batch(done)

    return laid.mapInArrow(run, ", ".join(f"{k} long" for k in KEY) + ", ends_sha256 string")


def prefix_trie(conversations: DataFrame, group: int = 20) -> DataFrame:
    """(conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens,
    ends_sha256) of every node."""
    turns = stored_turns(conversations)
    for attempt in range(8):
        rows = materialize(rebuilt(turns, fields(attempt), group), "prefixes")
        nodes = materialize(_nodes(rows), "nodes")
        clash = " OR ".join(f"{c} <> max_{c}" for c in (*PARENT, *DIGEST))
        if nodes.where(clash).isEmpty():
            break
    else:
        raise RuntimeError("fingerprints clash with every base")
    nodes = nodes.select(*KEY, "conv_id", "n_convs", "words", *PARENT)
    children = (
        nodes.where("depth > 0")
        .groupBy((F.col("depth") - 1).alias("depth"), *[F.col(p).alias(f) for p, f in zip(PARENT, LANES)])
        .agg(F.count(F.lit(1)).alias("n_children"))
    )
    counted = _joined(nodes, children, KEY, "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)).cast("long"))
    counted = counted.select(
        "*",
        F.shiftright("depth", BLOCK_BITS).alias("run_block"),
        F.when(F.col("n_children") == 0, 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("words")).alias("saved"),
    )
    counted = materialize(counted, "nodes")
    # Sums along a conversation's run from its end, block by block.
    sums = ["leaves", "saved"]
    blocks = counted.groupBy("conv_id", "run_block").agg(
        *[F.sum(c).alias(f"{c}_block") for c in sums], F.min("depth").alias("first")
    )
    run = Window.partitionBy("conv_id")
    after = run.orderBy(F.desc("run_block")).rowsBetween(Window.unboundedPreceding, -1)
    blocks = blocks.select(
        "conv_id",
        "run_block",
        F.min("first").over(run).alias("first"),
        *[F.sum(f"{c}_block").over(run).alias(f"{c}_run") for c in sums],
        *[F.coalesce(F.sum(f"{c}_block").over(after), F.lit(0)).alias(f"{c}_after") for c in sums],
    )
    blocks = materialize(blocks, "runs")
    below = Window.partitionBy("conv_id", "run_block").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    placed = counted.select("*", *[F.sum(c).over(below).alias(f"{c}_below") for c in sums])
    placed = _joined(placed, blocks, ["conv_id", "run_block"])
    # A node's own run counts from the node on, those of its other members wholly.
    runs = blocks.select(F.col("conv_id").alias("member"), *[f"{c}_run" for c in sums]).distinct()
    runs = runs.where(" OR ".join(f"{c}_run <> 0" for c in sums))
    of_member = _joined(rows.select("member", "block").distinct(), runs, ["member"])
    members = _joined(rows.select(*KEY, "member", "block"), of_member, ["member", "block"])
    members = members.groupBy(*KEY).agg(*[F.sum(f"{c}_run").alias(f"{c}_members") for c in sums])
    total = {
        c: F.coalesce(f"{c}_members", F.lit(0)) - F.col(f"{c}_run") + F.col(f"{c}_below") + F.col(f"{c}_after") for c in sums
    }
    found = _joined(_joined(placed, members, KEY, "left"), ends_digests(rows), KEY, "left").select(
        *KEY,
        *PARENT,
        "conv_id",
        "first",
        "n_convs",
        "n_children",
        total["leaves"].cast("long").alias("n_leaves"),
        total["saved"].cast("long").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
    )
    return with_parents(materialize(found, "trie"))


def with_parents(nodes: DataFrame) -> DataFrame:
    """The parent's conv_id of every node.  Below the first node of a conversation's
    run it is the same conversation, so only first nodes look their parent up."""
    out = ["n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    root = nodes.where("depth = 0").select("conv_id").first()
    if root is None:
        return nodes.select("conv_id", "depth", F.col("conv_id").alias("parent_conv_id"), *out)
    within = F.when(F.col("depth") == 1, root["conv_id"]).when(F.col("depth") > 1, F.col("conv_id")).cast("long")
    looked_up = (F.col("depth") > 1) & (F.col("depth") == F.col("first"))
    plain = nodes.where(~looked_up).select("conv_id", "depth", within.alias("parent_conv_id"), *out)
    parents = nodes.select((F.col("depth") + 1).alias("depth"), *[F.col(f).alias(p) for f, p in zip(LANES, PARENT)], F.col("conv_id").alias("parent_conv_id"))
    firsts = _joined(nodes.where(looked_up), parents, ["depth", *PARENT])
    return plain.unionByName(firsts.select("conv_id", "depth", "parent_conv_id", *out))
