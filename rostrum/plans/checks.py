"""The rules of ``validate`` for columns of raw parameters: each gives a struct of ``value`` (null if it fails) and
``error`` (null if it holds).  Built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..functions.text import capitalised, js_trim, missing
from .validate import HOUSES, SAYS


def _outcome(value: Column, *faults: tuple[Column, str]) -> Column:
    error = F.lit(None).cast("string")
    for bad, what in reversed(faults):
        error = F.when(bad, what).otherwise(error)
    return F.struct(F.when(error.isNull(), value).alias("value"), error.alias("error"))


def text(raw: Column, *, longest: int = 500, required: bool = False, pattern: str | None = None) -> Column:
    """VAL-1, STR-6: trimmed; lengths count UTF-16 units: a character beyond the first 65,536 is two."""
    bare = F.when(~missing(raw), js_trim(raw))
    units = F.length(bare) + F.length(F.regexp_replace(bare, r"[\x{0}-\x{ffff}]", ""))
    form = (~bare.rlike(pattern)) if pattern else F.lit(False)
    return _outcome(bare, (missing(raw) & F.lit(required), SAYS["missing"]), (F.coalesce(units > longest, F.lit(False)), SAYS["long"].format(most=longest)), (F.coalesce(form, F.lit(False)), SAYS["pattern"]))


def integer(raw: Column, *, least: int = 0, most: int = 10_000, default: int | None = None, required: bool = False) -> Column:
    """VAL-2: the integer that the text begins with."""
    digits = F.regexp_extract(js_trim(raw), r"^[+-]?\d+", 0)
    number = F.when(missing(raw), F.lit(default).cast("bigint")).otherwise(F.nullif(digits, F.lit("")).try_cast("bigint"))
    return _outcome(number, (missing(raw) & F.lit(required), SAYS["missing"]), (~missing(raw) & (digits == ""), SAYS["number"]), (~missing(raw) & ~F.coalesce(number.between(least, most), F.lit(False)), SAYS["range"].format(least=least, most=most)))


def date(raw: Column, *, required: bool = False) -> Column:
    """VAL-3."""
    formed = raw.rlike(r"^\d{4}-\d{2}-\d{2}$")
    return _outcome(F.nullif(raw, F.lit("")), (missing(raw) & F.lit(required), SAYS["missing"]), (~missing(raw) & ~formed, SAYS["form"]), (formed & raw.try_cast("date").isNull(), SAYS["calendar"]))


def house(raw: Column, default: str = HOUSES[0]) -> Column:
    """VAL-4."""
    named = F.when(missing(raw), default).otherwise(capitalised(raw))
    return _outcome(named, (~named.isin(*HOUSES), SAYS["house"]))


def member_id(raw: Column) -> Column:
    """VAL-5."""
    return integer(raw, least=1, most=99_999, required=True)


def flag(raw: Column) -> Column:
    """FIL-11."""
    return F.coalesce(raw != "false", F.lit(True))


def body(error: Column) -> Column:
    """The JSON body that answers a failed parameter (VAL-6, VAL-7, SNK-6); null where nothing failed."""
    return F.when(error.isNotNull(), F.to_json(F.struct(error.alias("error"))))
