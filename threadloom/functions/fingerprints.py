"""Fingerprints of submissions, comments and threads."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.text import col
from threadloom.functions.times import lenient_double, variant_number_text

# The fields a submission's fingerprint covers, with their types.
SUBMISSION_FIELDS = (
    ("id", "string"),
    ("name", "string"),
    ("subreddit", "string"),
    ("author", "string"),
    ("is_self", "boolean"),
    ("domain", "string"),
    ("title", "string"),
    ("selftext_html", "string"),
    ("selftext", "string"),
    ("url", "string"),
    ("permalink", "string"),
    ("edited", "any"),
    ("over_18", "boolean"),
    ("spoiler", "boolean"),
    ("locked", "boolean"),
    ("stickied", "boolean"),
    ("link_flair_text", "string"),
    ("link_flair_css_class", "string"),
)

# The fields a comment adds to its thread's fingerprint.
COMMENT_FIELDS = (
    ("id", "string"),
    ("parent_id", "string"),
    ("author", "string"),
    ("body", "string"),
    ("body_html", "string"),
    ("edited", "any"),
    ("stickied", "boolean"),
    ("distinguished", "any"),
    ("is_submitter", "boolean"),
    ("permalink", "string"),
)

LIMBS = 4
LIMB_DIGITS = 15


def variant_field(v: Column, name: str, kind: str) -> Column:
    """One field as text: a value of the wrong type counts as '' or false, a
    field of any type as its JSON text."""
    path = f"$.{name}"
    found = F.try_variant_get(v, path, "variant")
    if kind == "any":
        return F.coalesce(F.to_json(found), F.lit("null"))
    fits = F.schema_of_variant(found) == kind.upper()
    return F.when(fits, F.try_variant_get(v, path, "string")).otherwise(F.lit("" if kind == "string" else "false"))


def framed(*texts: Column) -> Column:
    """Join texts so that no two different lists give the same result: every
    text follows its own length."""
    return F.concat(*[F.concat(F.length(t).cast("string"), F.lit(":"), t) for t in texts])


def submission_fingerprint(v: Column | str) -> Column:
    """H5 over a VARIANT object."""
    return F.sha2(framed(*[variant_field(col(v), n, k) for n, k in SUBMISSION_FIELDS]), 256)


def comment_hash(v: Column | str) -> Column:
    """One comment's share of D8, over a VARIANT object: its fields, and the time
    it is ordered by.  Parent and id, the rest of the order, are among the fields."""
    created = F.coalesce(lenient_double(variant_number_text(col(v), "$.created_utc")), F.lit(0.0))
    fields = [variant_field(col(v), n, k) for n, k in COMMENT_FIELDS]
    return F.sha2(framed(*fields, created.cast("decimal(26,6)").cast("string")), 256)


def canonical_json_hash(v: Column | str) -> Column:
    """H6: SHA-256 over the JSON text with sorted keys and no spaces."""
    return F.sha2(F.to_json(col(v)), 256)


def set_hash_sums(row_hash: Column | str, prefix: str = "_limb") -> list[Column]:
    """Aggregates for D8: 240 bits of every row's hash, added up in four
    numbers.

    A row's hash covers all that it is ordered by, so the rows as a set fix the
    sequence, a thread in another order has another hash, and no sort is needed.  Sums are combined before the
    shuffle and keep a fixed size, however many rows one thread has.
    """
    return [
        F.sum(
            F.conv(F.substring(col(row_hash), 1 + i * LIMB_DIGITS, LIMB_DIGITS), 16, 10).cast("decimal(19,0)")
        ).alias(f"{prefix}{i}")
        for i in range(LIMBS)
    ]


def set_hash(count: Column | str, prefix: str = "_limb") -> Column:
    """The fingerprint out of the row count and the sums."""
    return F.sha2(F.concat_ws(":", col(count), *[F.col(f"{prefix}{i}") for i in range(LIMBS)]), 256)
