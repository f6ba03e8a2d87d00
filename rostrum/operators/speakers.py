"""Speakers of debates, and days of sittings (AGG-1, AGG-3 to AGG-7, WIN-2, SRT-1, SRT-3)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from ..functions.dates import day_key
from ..functions.text import missing
from .places import CELLS, numbered


def speakers(items: DataFrame, debate: str = "debate_id", pos: str = "pos") -> DataFrame:
    """One row per speaker of each debate: debate, member_id, name, party, contributions, first_pos, rank.

    A speaker is known by member id, or by name where there is no id (0 is none); a number and a like-looking
    name stay apart.  Name and party are those of the first contribution, even if missing there.
    """
    spoken = items.where((F.col("ItemType") == "Contribution") & ~missing(F.col("AttributedTo")))
    member = F.nullif(F.col("MemberId"), F.lit(0))
    keyed = spoken.select(F.col(debate), F.col(pos).cast("bigint").alias("pos"), member.alias("key_id"), F.when(member.isNull(), F.col("AttributedTo")).alias("key_name"), "MemberId", "AttributedTo", "MemberParty")
    first = F.min_by(F.struct("MemberId", "AttributedTo", "MemberParty"), "pos")
    found = keyed.groupBy(debate, "key_id", "key_name").agg(F.count(F.lit(1)).alias("contributions"), F.min("pos").alias("first_pos"), first.alias("first"))
    order = Window.partitionBy(debate).orderBy(F.col("contributions").desc(), "first_pos")
    return found.select(debate, F.col("first.MemberId").alias("member_id"), F.col("first.AttributedTo").alias("name"), F.col("first.MemberParty").alias("party"), "contributions", "first_pos", F.row_number().over(order).cast("bigint").alias("rank"))


def with_day(rows: DataFrame, date: str, day: str = "day") -> DataFrame:
    """Rows with their sitting day.  Grouping keeps rows as rows: a day of any size stays distributed (AGG-3)."""
    return rows.withColumn(day, day_key(F.col(date).cast("string")))


def by_day(rows: DataFrame, date: str, pos: str, cells: int = CELLS) -> DataFrame:
    """Rows of each day in input order: day, place (from 1) and the rows.  A day may hold any part of all rows (see ``places``)."""
    placed = numbered(with_day(rows, date), [F.col("day")], [F.col(pos)], "place", cells)
    return placed.withColumn("place", F.col("place") + 1)


def days(rows: DataFrame, date: str) -> DataFrame:
    """Distinct days, latest first; ``Unknown`` stands before them (AGG-4, SRT-3)."""
    return with_day(rows, date).select("day").distinct().orderBy(F.col("day").desc())


def per_day(rows: DataFrame, date: str) -> DataFrame:
    return with_day(rows, date).groupBy("day").agg(F.count(F.lit(1)).alias("n"))


def held(keys: DataFrame, rows: DataFrame, key: str, of: str) -> DataFrame:
    """``keys`` with ``held``: does ``rows`` have the key (AGG-6 for many at once)."""
    there = rows.select(F.col(of).alias(key)).distinct().withColumn("held", F.lit(True))
    return keys.join(there, key, "left").withColumn("held", F.coalesce("held", F.lit(False)))


def holds(rows: DataFrame, key: str, value) -> bool:
    """Is there such a row (AGG-6)."""
    return not rows.where(F.col(key) == value).isEmpty()
