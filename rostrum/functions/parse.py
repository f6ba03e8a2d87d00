"""Values out of free text (FIL-7, MTH-2, PRJ-18)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import js_trim


def leading_int(c: Column) -> Column:
    """The integer that a text begins with, or null (MTH-2)."""
    return F.nullif(F.regexp_extract(c, r"^\s*([+-]?\d+)", 1), F.lit("")).try_cast("bigint")


def keywords(c: Column) -> Column:
    """Parts between commas, trimmed, without empty ones (FIL-7)."""
    return F.filter(F.transform(F.split(c, ","), js_trim), lambda k: k != "")


def keyword_text(c: Column) -> Column:
    return F.array_join(c, ", ")
