"""Epoch numbers, UTC stamps and day windows."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

from threadloom.functions.text import BLANKS, col

# What float() accepts as a finite decimal number.
NUMBER = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def lenient_double(c: Column | str) -> Column:
    """Text to double, null for anything that is not a plain number."""
    bare = F.btrim(col(c), F.lit(BLANKS))
    return F.when(bare.rlike(NUMBER), bare.try_cast("double"))


def lenient_epoch(c: Column | str) -> Column:
    """Text to whole seconds, fractions cut off, null when unusable."""
    return lenient_double(c).try_cast("bigint")


def variant_number_text(v: Column, path: str) -> Column:
    """The text of a JSON number or string; a JSON boolean counts as 1 or 0."""
    plain = F.try_variant_get(v, path, "string")
    is_flag = F.schema_of_variant(F.try_variant_get(v, path, "variant")) == "BOOLEAN"
    return F.when(is_flag, F.when(plain == "true", F.lit("1")).otherwise(F.lit("0"))).otherwise(plain)


def _moment(epoch: Column | str) -> Column:
    e = col(epoch).cast("bigint")
    return F.timestamp_seconds(F.when(e > 0, e))


def stamp14(epoch: Column | str) -> Column:
    """YYYYMMDDHHMMSS in UTC; '' for null, zero and negative."""
    return F.coalesce(F.date_format(_moment(epoch), "yyyyMMddHHmmss"), F.lit(""))


def utc_parts(epoch: Column | str) -> dict[str, Column]:
    """Year, month-day and time of day in UTC."""
    moment = _moment(epoch)
    return {
        "y": F.coalesce(F.date_format(moment, "yyyy"), F.lit("")),
        "md": F.coalesce(F.date_format(moment, "MMdd"), F.lit("")),
        "hms": F.coalesce(F.date_format(moment, "HHmmss"), F.lit("")),
    }


def as_day(as_of: dt.date | str | None) -> dt.date:
    if as_of is None:
        return dt.datetime.now(dt.UTC).date()
    return dt.date.fromisoformat(as_of) if isinstance(as_of, str) else as_of


def day_window(days: int, as_of: dt.date | str | None = None) -> list[tuple[str, str]]:
    """The (y, md) pairs of as_of and the ``days`` days before it."""
    last = as_day(as_of)
    return [(d.strftime("%Y"), d.strftime("%m%d")) for d in (last - dt.timedelta(days=i) for i in range(days + 1))]


def in_lookback(days: int, as_of: dt.date | str | None = None, y: str = "y", md: str = "md") -> Column:
    """A4: a predicate on the partition columns alone, so it prunes folders."""
    if days <= 0:
        return F.lit(True)
    return on_days(day_window(days, as_of), y, md)


def on_days(pairs: Iterable[tuple[str, str]], y: str = "y", md: str = "md") -> Column:
    """A predicate for the given (y, md) pairs, one list of days per year."""
    by_year: dict[str, list[str]] = {}
    for year, month_day in sorted(set(pairs)):
        by_year.setdefault(year, []).append(month_day)
    tests = [(F.col(y) == year) & F.col(md).isin(month_days) for year, month_days in by_year.items()]
    return reduce(or_, tests) if tests else F.lit(False)
