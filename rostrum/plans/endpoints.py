"""Requests as plans: parameters as text in, a DataFrame out (SRC-8 to SRC-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.text import found_in
from ..operators import filters, members
from . import validate as v


def search(rows: DataFrame, params: dict, *, text: list[str], key: str, date: str, member: str, house: str = "house") -> DataFrame:
    """Text search, of one house (Commons unless named), with dates, a member and paging (SRC-8)."""
    term = v.text(params.get("q") or params.get("query"), required=True, longest=200)
    named = v.house(params.get("house"))
    start, end = v.date(params.get("startDate")), v.date(params.get("endDate"))
    who = v.integer(params.get("member"), least=1, most=99_999)
    paging = v.paging(params)
    if not term:
        raise v.Invalid("q or query parameter required")
    return filters.search(rows, term, text, key, member=member, member_id=who, date=date, start=start, end=end, house=named, house_column=house, **paging)


def day(rows: DataFrame, params: dict, *, date: str = "Date", house: str = "House", kind: str = "Type") -> DataFrame:
    """Sections of one day and house whose type holds the wanted one (SRC-9)."""
    when = v.date(params.get("date"), required=True)
    named = v.house(params.get("house"))
    section = v.text(params.get("section"), longest=100)
    return rows.where((F.col(date).cast("date") == F.lit(when).cast("date")) & (F.col(house) == named) & filters.in_section(F.col(kind), section))


def people(rows: DataFrame, params: dict, *, name: str, key: str, house: str, current: str | None = None) -> DataFrame:
    """Members by name, house and whether they sit now (SRC-10)."""
    term = v.text(params.get("name"), longest=100) or ""
    named = v.text(params.get("house"), longest=20)
    sits = v.flag(params.get("current"))
    kept = rows.where(F.col(current) == sits) if current else rows
    return filters.search(kept, term, [name], key, house=named, house_column=house, **v.paging(params))


def current_members(rows: DataFrame, name: str, *, column: str, key: str, current: str, take: int | None = 20) -> DataFrame:
    """Members who sit now, by name (SRC-5)."""
    return filters.search(rows.where(F.col(current)), name, [column], key, take=take)


def bills(rows: DataFrame, params: dict, *, title: str, key: str, updated: str, house: str | None = None) -> DataFrame:
    """Bills by title, in one of four orders (SRC-11)."""
    term = v.text(params.get("search"), longest=200) or ""
    paging = v.paging(params)
    named = v.text(params.get("house"), longest=20)
    order = filters.bill_order(v.text(params.get("sort"), longest=50), updated, title)
    kept = rows.where(found_in(term, F.col(title)))
    if named and house:
        kept = kept.where(F.col(house) == named)
    return filters.page(kept, [*order, F.col(key)], paging["take"], 20, paging["skip"])


def member(people: DataFrame, contacts: DataFrame, synopses: DataFrame, member_id, key: str = "id") -> DataFrame:
    return members.detail_of(people, contacts, synopses, v.member_id(member_id), key)
