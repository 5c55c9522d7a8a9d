"""Ids, object keys, corpus names and file names."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.text import BLANKS, col, strip_text, text_or_empty

KINDS = ("submissions", "comments")
# The source in ids and keys, and the folder of text objects.
SRC = "r"
DEFAULT_PREFIX = "reddit/v1"

# The layouts of the file trees.
#   raw and narrow  r_<sub>/<kind>/YYYY/MMDD/HHMMSS_<sid>/<cap14>_<hash>.<ext>
#   staged          r_<sub>/<kind>/YYYY/MMDD/HHMMSS_<sid>_<cap14>_<h16>.parquet
CAPTURE_FILE = (
    r"/r_([^/]+)/(submissions|comments)/([0-9]{4})/([0-9]{4})/([^/_]+)_([^/]+)/([^/_]+)_([^/]+)\.(?:jsonl|parquet)$"
)
STAGED_FILE = (
    r"/r_([^/]+)/(submissions|comments)/([0-9]{4})/([0-9]{4})/"
    r"([0-9]{6})_([A-Za-z0-9]+)_([0-9]{14})_([0-9a-fA-F]+)\.parquet$"
)
STAMP = r"^[0-9]{14}$"

PATH_KEYS = ("sub", "kind", "y", "md", "hms", "sid", "cap14", "hash")


def kind_letter(kind: Column | str) -> Column:
    return F.when(col(kind) == "submissions", F.lit("s")).when(col(kind) == "comments", F.lit("c"))


def kind_of_letter(t: Column | str) -> Column:
    return F.when(col(t) == "s", F.lit("submissions")).when(col(t) == "c", F.lit("comments"))


def document_id(t: Column, sub: Column, local_id: Column) -> Column:
    """H7: r:s:<sub>:<sid> or r:c:<sub>:<comment id>."""
    return F.concat_ws(":", F.lit(SRC), t, sub, local_id)


def parse_document_id(id: Column | str) -> Column:
    """H8, strict form: struct(src, t, sub, doc), or null unless the id has
    exactly four parts, the source r and the kind s or c."""
    parts = F.split(col(id), ":")
    good = (F.size(parts) == 4) & (parts[0] == SRC) & parts[1].isin("s", "c")
    return F.when(
        good,
        F.struct(parts[0].alias("src"), parts[1].alias("t"), parts[2].alias("sub"), parts[3].alias("doc")),
    )


def comment_id_of(id: Column | str, t: Column | str) -> Column:
    """H8, lenient form: the last part of a comment's id, otherwise ''."""
    whole = col(id)
    return F.when((col(t) == "c") & whole.contains(":"), F.substring_index(whole, ":", -1)).otherwise(F.lit(""))


def norm_prefix(prefix: str | None) -> str:
    return (prefix or "").strip().strip("/")


def object_key(t: Column, sub: Column, local_id: Column, h: Column, prefix: str | None = DEFAULT_PREFIX) -> Column:
    """H9: [<prefix>/]r/<t>/<sub>/<id>/<h>.txt"""
    head = norm_prefix(prefix)
    parts = ([F.lit(head)] if head else []) + [F.lit(SRC), t, sub, local_id, F.concat(h, F.lit(".txt"))]
    return F.concat_ws("/", *parts)


def object_key_of_hit(id: Column | str, h: Column | str, prefix: str | None = DEFAULT_PREFIX) -> Column:
    """The key of a hit's pinned text, '' when the id or the hash is no good."""
    p = parse_document_id(id)
    usable = p.isNotNull() & (text_or_empty(h) != "")
    return F.when(usable, object_key(p["t"], p["sub"], p["doc"], col(h), prefix)).otherwise(F.lit(""))


def _without(c: Column, *prefixes: str) -> Column:
    """``c`` without its first two characters where they are one of
    ``prefixes``."""
    return F.when(F.left(c, F.lit(2)).isin(*prefixes), F.substr(c, F.lit(3))).otherwise(c)


def norm_sub(c: Column | str) -> Column:
    """Strip, drop a leading r/ then a leading r_ (either case), strip."""
    return F.btrim(_without(_without(strip_text(c), "r/", "R/"), "r_", "R_"), F.lit(BLANKS))


def valid_stamp(c: Column | str) -> Column:
    """H14"""
    return F.coalesce(col(c).rlike(STAMP), F.lit(False))


def path_keys(path: Column | str, staged: bool = False) -> Column:
    """A3: the keys that directory and file names carry, as an array in the
    order of PATH_KEYS; an array of one where a name does not follow the
    layout.  The path is matched once for all keys."""
    pattern = ".*" + (STAGED_FILE if staged else CAPTURE_FILE)
    found = "/".join(f"${i}" for i in range(1, len(PATH_KEYS) + 1))
    return F.split(F.regexp_replace(col(path), pattern, found + "/."), "/")


def path_key_columns(keys: Column | str) -> dict[str, Column]:
    """The columns out of the array that path_keys gives, '' for none."""
    whole = F.size(col(keys)) == len(PATH_KEYS) + 1
    good = whole & (F.element_at(col(keys), -1) == ".")
    return {name: F.when(good, F.get(col(keys), F.lit(i))).otherwise(F.lit("")) for i, name in enumerate(PATH_KEYS)}


def thread_path(sub: Column, kind: Column, y: Column, md: Column, hms: Column, sid: Column) -> Column:
    return F.concat(
        F.lit("r_"), sub, F.lit("/"), kind, F.lit("/"), y, F.lit("/"), md, F.lit("/"), hms, F.lit("_"), sid
    )
