"""Text normalisation, excerpts and rendering."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# The white space str.strip removes.
BLANKS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The white space that a snippet collapses (that of ECMAScript).
SNIPPET_BLANKS = r"\t-\r \xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000\ufeff"

# Lengths of excerpts and messages, and what stands for an empty one.
SNIPPET_CHARS = 120
MESSAGE_CHARS = 1900
EMPTY_MESSAGE = "（空）"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_or_empty(c: Column | str) -> Column:
    """Null becomes the empty string."""
    return F.coalesce(col(c), F.lit(""))


def none_if_empty(c: Column | str) -> Column:
    return F.nullif(col(c), F.lit(""))


def strip_text(c: Column | str) -> Column:
    """H1: strip Unicode white space at both ends, null as ''.

    ``trim`` with a character set looks at the two ends only, so the cost does
    not depend on blank runs inside the text.
    """
    return F.btrim(text_or_empty(c), F.lit(BLANKS))


def truncate_text(c: Column | str, max_chars: int) -> Column:
    """H3: the first ``max_chars`` code points; 0 or less means no limit."""
    return F.left(col(c), F.lit(int(max_chars))) if max_chars > 0 else col(c)


def compose_document(title: Column | str, body: Column | str) -> Column:
    """H2: title, blank line, body; whichever is blank is left out."""
    return F.concat_ws("\n\n", none_if_empty(strip_text(title)), none_if_empty(strip_text(body)))


def content_hash(c: Column | str) -> Column:
    """H4: the first 16 hex digits of SHA-256 over the UTF-8 text."""
    return F.left(F.sha2(col(c), 256), F.lit(16))


def snippet(c: Column | str, max_chars: int = SNIPPET_CHARS) -> Column:
    """Blank runs become one space, then the first characters.

    Only as many blank runs and characters as the snippet shows are looked at.
    """
    shown = rf"^(?:[{SNIPPET_BLANKS}]++|[^{SNIPPET_BLANKS}]){{0,{int(max_chars)}}}+"
    return F.regexp_replace(F.regexp_extract(text_or_empty(c), shown, 0), f"[{SNIPPET_BLANKS}]+", " ")


def score_text(c: Column | str) -> Column:
    """Six decimals."""
    return F.format_string("%.6f", col(c))


def source_line(id: Column, sub: Column, t: Column, sid: Column, score: Column) -> Column:
    """The line that names a source."""
    return F.concat(
        F.lit("id="), id,
        F.lit(" sub="), text_or_empty(sub),
        F.lit(" t="), text_or_empty(t),
        F.lit(" sid="), text_or_empty(sid),
        F.lit(" score="), score_text(score),
    )


def bounded_message(c: Column | str, max_chars: int = MESSAGE_CHARS, empty: str = EMPTY_MESSAGE) -> Column:
    """Strip, a default when nothing is left, cut to the channel's limit."""
    return truncate_text(F.coalesce(none_if_empty(strip_text(c)), F.lit(empty)), max_chars)
