"""Dates as they are shown; a date that can't be read takes its label instead of failing (DAT-1 to DAT-5)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import missing, or_default

UNKNOWN_DAY = "Unknown"


def day_key(c: Column) -> Column:
    """Date part of an ISO string; ``Unknown`` if missing (DAT-1)."""
    return or_default(F.split_part(c, F.lit("T"), F.lit(1)), UNKNOWN_DAY)


def parsed(c: Column) -> Column:
    """Date of an ISO string, or null (DAT-5)."""
    return F.try_to_date(F.split_part(c, F.lit("T"), F.lit(1)), "yyyy-MM-dd")


def long_date(c: Column) -> Column:
    """``Monday 15 January 2024`` (DAT-2)."""
    none = missing(c) | (c == UNKNOWN_DAY)
    return F.when(none, "Unknown Date").otherwise(F.coalesce(F.date_format(parsed(c), "EEEE d MMMM yyyy"), F.lit("Invalid Date")))


def short_date(c: Column) -> Column:
    """``15 Jan 2024`` (DAT-3)."""
    return F.when(missing(c), "Unknown date").otherwise(F.coalesce(F.date_format(parsed(c), "d MMM yyyy"), F.lit("Invalid Date")))


def month_year(c: Column) -> Column:
    """``January 2024``, or null (DAT-4)."""
    return F.date_format(parsed(c), "MMMM yyyy")
