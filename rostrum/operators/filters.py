"""Predicates and scans over flat tables.  Parameters that are missing add no predicate, so that Catalyst sees
plain filters and pushes what it can (SRC-1 to SRC-11, FIL-1 to FIL-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import found_in, missing
from ..sources.sinks import NotFound


def page(rows: DataFrame, order: Sequence[Column], take: int | None, default: int, skip: int = 0) -> DataFrame:
    """``take`` rows (0 or none: the default) after ``skip``, in a total order (LIM-1, LIM-2)."""
    ordered = rows.orderBy(*order)
    return (ordered.offset(skip) if skip else ordered).limit(take or default)


def recent(rows: DataFrame, date: str, key: str, house: str | None = None, house_column: str = "house", take: int | None = 30) -> DataFrame:
    """The latest rows, of one house if one is given (SRC-1)."""
    kept = rows.where(F.col(house_column) == house) if house else rows
    return page(kept, [F.col(date).desc(), F.col(key)], take, 30)


def lookup(rows: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key; ``NotFound`` if there are none (SRC-2)."""
    found = rows.where(F.col(key) == value)
    if found.isEmpty():
        raise NotFound(f"no {key} {value!r}")
    return found


def search(rows: DataFrame, term: str, text: Sequence[str], key: str, *, take: int | None = None, skip: int = 0, default: int = 20, member: str | None = None, member_id: int | None = None, date: str | None = None, start: str | None = None, end: str | None = None, house: str | None = None, house_column: str = "house", order: Sequence[Column] = ()) -> DataFrame:
    """Case-insensitive text search with optional member, dates (both inclusive) and house (SRC-3, SRC-5, SRC-8, SRC-10)."""
    kept = rows.where(found_in(term, *map(F.col, text)))
    if member_id:
        kept = kept.where(F.col(member) == member_id)
    if start:
        kept = kept.where(F.col(date) >= F.lit(start).cast(rows.schema[date].dataType))
    if end:
        kept = kept.where(F.col(date) < F.date_add(F.lit(end).cast("date"), 1).cast(rows.schema[date].dataType))
    if house:
        kept = kept.where(F.col(house_column) == house)
    return page(kept, [*order, F.col(key)], take, default, skip)


def contributions(rows: DataFrame, member: str, member_id: int, key: str, take: int | None = 20, kind: str | None = None, spoken: str = "Spoken") -> DataFrame:
    """One member's rows, the spoken ones where a kind tells (SRC-4)."""
    kept = rows.where(F.col(member) == member_id)
    if kind:
        kept = kept.where(F.col(kind) == spoken)
    return page(kept, [F.col(key)], take, 20)


def in_section(kind: Column, section: str | None) -> Column:
    """A section's type holds the wanted one; a missing type does not (FIL-6)."""
    wanted = (section or "").strip()
    return F.contains(F.lower(kind), F.lower(F.lit(wanted))) if wanted else F.lit(True)


def sections_in(sections: Column, section: str | None) -> Column:
    """The same, over an array of sections."""
    wanted = (section or "").strip()
    return F.filter(sections, lambda s: F.contains(F.lower(s["Type"]), F.lower(F.lit(wanted)))) if wanted else sections


def item_kind(item_type: Column, value: Column) -> Column:
    """contribution, procedural, or null for what is not shown (FIL-1)."""
    return F.when(item_type == "Contribution", "contribution").when(~missing(value), "procedural")


def transcript(items: DataFrame, speaker: int | None = None, term: str = "", *, member: str = "MemberId", value: str = "Value", who: str = "AttributedTo") -> DataFrame:
    """Items of one speaker (0 or none: all) that hold the term (FIL-3, FIL-4)."""
    kept = items.where(F.col(member) == speaker) if speaker else items
    return kept.where(found_in(term, F.col(value), F.col(who)))


def lookup_if(rows: DataFrame, key: str, value) -> DataFrame:
    """The rows of one key; none, without a scan, while the key is not known yet (FIL-12)."""
    return nothing(rows) if value is None or value == "" else rows.where(F.col(key) == value)


def nothing(rows: DataFrame) -> DataFrame:
    """The empty relation of a query whose inputs are missing (FIL-12)."""
    return rows.limit(0)


SORTS = {
    "DateUpdatedDescending": lambda updated, title: [F.col(updated).desc()],
    "DateUpdatedAscending": lambda updated, title: [F.col(updated)],
    "TitleAscending": lambda updated, title: [F.col(title)],
    "TitleDescending": lambda updated, title: [F.col(title).desc()],
}


def bill_order(sort: str | None, updated: str, title: str) -> list[Column]:
    """One of four orders; any other name is the first (SRT-4)."""
    return SORTS.get(sort or "", SORTS["DateUpdatedDescending"])(updated, title)


def visible(rows: DataFrame, order: Sequence[Column], first: int, shown: int, overscan: int = 5) -> DataFrame:
    """The rows that a list shows from place ``first`` on, with some more on either side (WIN-3)."""
    start = max(0, first - overscan)
    return rows.orderBy(*order).offset(start).limit(first + shown + overscan - start)
