"""Parsing of JSON text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from millrace.catalog import READING_ARRAY


def parse_readings(values: str | Column = "values") -> Column:
    """JSON text to an array of readings; null where the text is no JSON. A single object is one reading."""
    return F.from_json(values, READING_ARRAY)


def json_field(text: str | Column, name: str, data_type: str) -> Column:
    """One top-level field of a JSON object."""
    return F.from_json(text, f"`{name}` {data_type}").getField(name)
