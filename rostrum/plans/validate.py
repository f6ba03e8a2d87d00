"""Parameters, checked before a plan is made (VAL-1 to VAL-8).

Each kind of parameter is a table of rules, a test and what to say when it fails, tried in order on what was
read from the text.  ``checks`` has the same rules for columns.
"""

from __future__ import annotations

import datetime
import re
from collections.abc import Callable

from ..functions.text import BLANK

HOUSES = ("Commons", "Lords")

#: What is said of a value, by what is wrong with it.
SAYS = {
    "missing": "a value is needed here",
    "type": "this has to be text",
    "long": "the text is too long: at most {most} characters",
    "pattern": "the text does not have the form that is asked for",
    "number": "this is not a whole number",
    "range": "the number has to lie between {least} and {most}",
    "form": "a date is written as year-month-day, such as 2024-01-31",
    "calendar": "the calendar has no such day",
    "house": "the house is either Commons or Lords",
}

#: An integer of more digits is out of any range; the first ones say so as well.
DIGITS = 19

Rule = tuple[str, Callable[[object], bool]]


class Invalid(ValueError):
    """A parameter out of its bounds."""

    status = 400

    def body(self) -> dict:
        return {"error": str(self)}


def _held(value, rules: list[Rule], **bounds):
    """``value``, if it passes every rule."""
    for fault, passes in rules:
        if not passes(value):
            raise Invalid(SAYS[fault].format(**bounds))
    return value


def _given(value, required: bool) -> bool:
    given = value is not None and value != ""
    _held(given, [("missing", lambda g: g or not required)])
    return given


def _on_calendar(value: str) -> bool:
    try:
        return bool(datetime.date.fromisoformat(value))
    except ValueError:
        return False


def text(value: str | None, *, longest: int = 500, required: bool = False, pattern: str | None = None) -> str | None:
    if not _given(value, required):
        return None
    bare = _held(value, [("type", lambda v: isinstance(v, str))]).strip(BLANK)
    return _held(bare, [("long", lambda v: len(v.encode("utf-16-le")) // 2 <= longest), ("pattern", lambda v: not pattern or re.search(pattern, v))], most=longest)


def integer(value, *, least: int = 0, most: int = 10_000, default: int | None = None, required: bool = False) -> int | None:
    """The integer that the value begins with: ``12abc`` is 12."""
    if not _given(value, required):
        return default
    found = _held(re.match(r"[+-]?\d+", str(value).lstrip(BLANK), re.ASCII), [("number", bool)])
    return _held(int(found[0].lstrip("+-0")[:DIGITS] or "0") * (-1 if found[0][0] == "-" else 1), [("range", lambda n: least <= n <= most)], least=least, most=most)


def date(value: str | None, *, required: bool = False) -> str | None:
    if not _given(value, required):
        return None
    return _held(value, [("form", lambda v: re.fullmatch(r"\d{4}-\d{2}-\d{2}", v, re.ASCII)), ("calendar", _on_calendar)])


def house(value: str | None, default: str = HOUSES[0]) -> str:
    return _held(value[0].upper() + value[1:].lower(), [("house", HOUSES.__contains__)]) if value else default


def member_id(value) -> int:
    return integer(value, least=1, most=99_999, required=True)


def flag(value: str | None) -> bool:
    """Everything but the literal ``false`` (FIL-11)."""
    return value != "false"


def paging(params: dict) -> dict:
    return {"skip": integer(params.get("skip"), default=0), "take": integer(params.get("take"), least=1, most=100, default=20)}
