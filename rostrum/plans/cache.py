"""Results kept for a while, by key (CCH-1 to CCH-3, MTH-1)."""

from __future__ import annotations

import time
from collections.abc import Callable, Hashable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

MINUTE = 60.0
# Seconds until a result is stale, and until it goes, by kind.
LIFETIMES = {"debates": (5 * MINUTE, 30 * MINUTE), "members": (15 * MINUTE, 60 * MINUTE), "search": (2 * MINUTE, 10 * MINUTE), "topics": (5 * MINUTE, 30 * MINUTE)}
RETRIES = 3


def retry_delay_ms(attempt: int) -> int:
    return min(1000 * 2**attempt, 30_000)


def delay_ms(attempt: Column) -> Column:
    """MTH-1 for rows."""
    return F.least(F.lit(1000) * F.pow(F.lit(2), F.least(attempt, F.lit(30))), F.lit(30_000)).cast("bigint")


def again(attempt: Column) -> Column:
    """Is there another try after this many failures (CCH-3)."""
    return attempt < RETRIES


def retried(make: Callable[[], DataFrame], sleep: Callable[[float], None] = time.sleep) -> DataFrame:
    """What ``make`` gives, tried again after a growing delay; the last failure is raised (CCH-3)."""
    for attempt in range(RETRIES):
        try:
            return make()
        except Exception:
            sleep(retry_delay_ms(attempt) / 1000)
    return make()


def freshness(kind: Column, age: Column) -> Column:
    """fresh, stale or gone, by kind and seconds since a result was made and last used (CCH-1)."""
    state = F.lit(None).cast("string")
    for name, (stale, gone) in LIFETIMES.items():
        state = F.when(kind == name, F.when(age < stale, "fresh").when(age < gone, "stale").otherwise("gone")).otherwise(state)
    return state


#: Names and parts of the keys of results, by what is asked for (CCH-2).
KEYS = {"recent": ("debates", "recent"), "debate": ("debate",), "topic": ("topic-search",), "member": ("members", "search"), "contributions": ("contributions",)}


def result_key(what: str, *parts) -> tuple:
    return (*KEYS[what], *parts)


def key_text(what: str, *parts: Column) -> Column:
    """A result's key as JSON, for rows of parameters."""
    return F.to_json(F.array(*map(F.lit, KEYS[what]), *[p.cast("string") for p in parts]))


def topic_key(topic_id: str, keywords: list[str]) -> tuple:
    """With the keywords: an edited topic is another query."""
    return result_key("topic", topic_id, *keywords)


@dataclass
class _Kept:
    rows: DataFrame
    made: float
    used: float


class ResultCache:
    """DataFrames persisted under a key; made again when stale, unpersisted when not used for long."""

    def __init__(self, clock: Callable[[], float] = time.monotonic, sleep: Callable[[float], None] = time.sleep):
        self.clock, self.sleep, self.kept = clock, sleep, {}

    def get(self, kind: str, key: Hashable, make: Callable[[], DataFrame]) -> DataFrame:
        stale, _ = LIFETIMES[kind]
        self.evict()
        now = self.clock()
        held = self.kept.get((kind, key))
        if held and now - held.made < stale:
            held.used = now
            return held.rows
        rows = retried(make, self.sleep).persist()
        if held:
            held.rows.unpersist()
        self.kept[kind, key] = _Kept(rows, now, now)
        return rows

    def evict(self) -> int:
        now = self.clock()
        old = [k for k, held in self.kept.items() if now - held.used >= LIFETIMES[k[0]][1]]
        for k in old:
            self.kept.pop(k).rows.unpersist()
        return len(old)
