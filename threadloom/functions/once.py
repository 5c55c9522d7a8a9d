"""Costly columns that later filters must not repeat."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def computed_once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with columns that are costly to compute.

    They come out of a generator, which filters are not pushed through.
    Pushed below a plain projection, a filter repeats the whole expression at
    every use: a line of JSON would be parsed once per test on its fields.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))
