"""Metadata given as JSON text."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from threadloom.functions.text import col


def metadata_fields(c: Column | str) -> Column:
    """The fields of a JSON object by name, each as text; text that is no
    JSON object, and null, count as an object without fields."""
    return F.coalesce(F.from_json(col(c), "map<string,string>"), F.create_map().cast("map<string,string>"))
