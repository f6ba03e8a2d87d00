"""Members: merged detail, watch flags, navigation (JOIN-1, JOIN-3 to JOIN-5, PRJ-16)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..sources.sinks import NotFound


def detail(members: DataFrame, contacts: DataFrame, synopses: DataFrame, key: str = "id") -> DataFrame:
    """Members with contact and synopsis where there are any (JOIN-1, PRJ-16).  In bulk: Spark broadcasts what is
    small by its own measure and shuffles what is not."""
    return members.join(contacts, key, "left").join(synopses, key, "left")


def detail_of(members: DataFrame, contacts: DataFrame, synopses: DataFrame, member_id: int, key: str = "id") -> DataFrame:
    """One member's detail; ``NotFound`` without the member (SRC-12)."""
    one = detail(*(t.where(F.col(key) == member_id) for t in (members, contacts, synopses)), key)
    if one.isEmpty():
        raise NotFound("Member not found")
    return one


def synopsis_of(members: DataFrame, synopses: DataFrame, key: str = "id") -> DataFrame:
    """Null, not an error, where there is none (SRC-7)."""
    return members.select(key).join(synopses, key, "left")


def with_watch_flag(rows: DataFrame, watchlist: DataFrame, key: str, watched_key: str = "id") -> DataFrame:
    """Rows with ``watched`` (JOIN-3)."""
    ids = watchlist.select(F.col(watched_key).alias(key)).distinct().withColumn("_on", F.lit(True))
    return rows.join(ids, key, "left").withColumn("watched", F.coalesce("_on", F.lit(False))).drop("_on")


def watched_only(rows: DataFrame, watchlist: DataFrame, key: str, watched_key: str = "id") -> DataFrame:
    return rows.join(watchlist.select(F.col(watched_key).alias(key)), key, "left_semi")
