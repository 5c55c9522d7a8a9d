"""Explicit schemas: nothing is inferred, a field a line lacks is null."""

from __future__ import annotations

SUBMISSION = "id string, name string, subreddit string, author string, title string, selftext string, created_utc string"
COMMENT = "id string, parent_id string, link_id string, subreddit string, author string, body string, created_utc string"

NARROW_FILE = "author string, title string, body string, comment_id string, parent_id string"

CAPTURE = (
    "sub string, sid string, hms string, created bigint, cap14 string, hash string, line_no bigint, raw string, "
    "kind string, y string, md string"
)
NARROW = (
    "sub string, sid string, hms string, cap14 string, h16 string, author string, title string, body string, "
    "comment_id string, parent_id string, h string, kind string, y string, md string"
)

# Tables are partitioned by kind and day, which is what a lookback asks for.
# With the corpus as a third level there would be a folder for every corpus
# and day; instead files are sorted by corpus, and their statistics tell which
# of them a corpus filter can leave out.
PARTITIONS = ("kind", "y", "md")
# Where days are many and small, tables lie by year, and rows are sorted by day:
# the statistics of files and pages tell which rows a lookback can leave out.
YEARLY = ("kind", "y")
CLUSTERED = ("sub", "sid")

METADATA = "struct<src:string,sub:string,t:string,sid:string,pid:string,h:string>"
VECTOR = f"id string, values array<float>, metadata {METADATA}"
INDEX = f"{VECTOR}, y string, md string"
STORE = "key string, id string, h string, text string, t string, sub string"
