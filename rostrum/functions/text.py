"""Text: search, trimming, highlighting, sanitising (STR-1 to STR-14)."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from .markup import sanitise

#: White space, fixed values (STR-3).
BLANK = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF]))
_BLANK_RUN = "[" + "".join(f"\\x{{{ord(c):x}}}" for c in BLANK) + "]+"
MARK = '<mark class="highlight-match">'


def missing(c: Column) -> Column:
    """Null or empty."""
    return c.isNull() | (c == "")


def or_default(c: Column, label: str) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit(label))


def js_trim(c: Column) -> Column:
    """Without white space of any kind at either end (STR-3)."""
    return F.regexp_replace(c, f"^{_BLANK_RUN}|{_BLANK_RUN}\\z", "")


def found_in(term: str, *columns: Column) -> Column:
    """Case-insensitive substring of any of the columns; the empty term is in every row (FIL-4)."""
    if not term:
        return F.lit(True)
    hit = F.lit(False)
    for c in columns:
        hit = hit | F.contains(F.lower(F.coalesce(c, F.lit(""))), F.lower(F.lit(term)))
    return hit


def capitalised(c: Column) -> Column:
    """First letter upper, the rest lower (STR-5)."""
    return F.concat(F.upper(F.substring(c, 1, 1)), F.lower(F.substring(c, 2, 2_147_483_647)))


def escaped(term: str) -> str:
    """``term`` as a regular expression for itself (STR-7)."""
    return re.sub(r"[.*+?^${}()|\[\]\\]", lambda m: "\\" + m[0], term)


def highlighted(c: Column, term: str | None) -> Column:
    """Every case-insensitive match in a mark (STR-8, STR-9)."""
    return F.regexp_replace(c, f"(?iu)({escaped(term)})", f"{MARK}$1</mark>") if term else c


def match_count(c: Column, term: str) -> Column:
    return F.regexp_count(c, F.lit(f"(?iu){escaped(term)}")).cast("bigint")


def parts(c: Column, term: str) -> Column:
    """Pieces of plain text in order, as structs of part and is_match (STR-9); U+0001, which marks the cuts, is dropped from
    the text."""
    cut = F.split(F.regexp_replace(F.translate(c, "\x01", ""), f"(?iu)({escaped(term)})", "\x01$1\x01"), "\x01")
    return F.transform(cut, lambda p: F.struct(p.alias("part"), (F.lower(p) == term.lower()).alias("is_match")))


def is_markup(c: Column) -> Column:
    return F.contains(c, F.lit("<"))


def stripped(c: Column) -> Column:
    """Text of HTML by regular expressions alone: script and style bodies and all tags go (STR-12, JVM side)."""
    return F.regexp_replace(F.regexp_replace(c, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>", ""), r"(?s)<[^>]*>", "")


@F.pandas_udf(T.StringType())
def sanitised(html: pd.Series) -> pd.Series:
    """The allow-list (STR-12).  Trees are needed, so this one runs in Python, in Arrow batches."""
    return html.map(sanitise)


def shown(c: Column, term: str | None = None) -> Column:
    """What a reader sees: nothing for empty text; markup sanitised; matches marked (STR-8 to STR-11)."""
    # Python functions run on all rows, whatever the condition around them: plain text does not travel
    clean = F.when(is_markup(c), sanitised(F.when(is_markup(c), c))).otherwise(c)
    return F.when(~missing(c), highlighted(clean, term))
