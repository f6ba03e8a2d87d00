"""Labels, colours and links derived from a row (PRJ-3 to PRJ-20)."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .text import missing, or_default

# A party's colour by the first of these names, in this order, found in its own.
PARTY_COLOURS = {
    "labour": "#E4003B",
    "conservative": "#0087DC",
    "liberal democrat": "#FAA61A",
    "green": "#6AB023",
    "scottish national": "#FDF38E",
    "snp": "#FDF38E",
    "plaid": "#005B54",
    "dup": "#D46A4C",
    "sinn": "#326760",
}
NO_COLOUR = "#808080"
PHOTOS = "https://members-api.parliament.uk/api/Members"
AVATARS = "https://ui-avatars.com/api/?name="


def coloured(party: Column, colours: dict[str, str] = PARTY_COLOURS, default: str = NO_COLOUR) -> Column:
    """PRJ-20."""
    name = F.lower(party)
    first = None
    for key, colour in colours.items():
        hit = F.contains(name, F.lit(key))
        first = F.when(hit, colour) if first is None else first.when(hit, colour)
    return F.coalesce(first.otherwise(default), F.lit(default)) if first is not None else F.lit(default)


def house_style(house: Column) -> Column:
    """Two styles: one house, and everything else (PRJ-8)."""
    return F.when(house == "Commons", "green").otherwise("red")


def house_label(house: Column) -> Column:
    """PRJ-7."""
    return F.when(~missing(house), F.concat(F.lit("House of "), house))


def seat_prefix(code: Column) -> Column:
    """PRJ-9."""
    return F.when(code == 1, "MP for ").otherwise("")


def photo_url(member_id: Column, base: str = PHOTOS) -> Column:
    """PRJ-10: null where there is no id; 0 is none."""
    return F.concat(F.lit(base + "/"), F.nullif(member_id.cast("bigint"), F.lit(0)).cast("string"), F.lit("/Thumbnail"))


def uri_component(c: Column) -> Column:
    """Percent-encoding in which letters, digits and ``-_.!~*'()`` stand for themselves (STR-14)."""
    out = F.url_encode(c)
    for encoded, literal in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(encoded), F.lit(literal))
    return out


def avatar_url(name: Column, size: int | None = None, base: str = AVATARS) -> Column:
    """PRJ-11."""
    return F.concat(F.lit(base), uri_component(name), F.lit("&background=e2e8f0&color=64748b" + (f"&size={size}" if size else "")))


def debate_link(ext_id: Column) -> Column:
    return F.concat(F.lit("/debate/"), ext_id.cast("string"))


def member_link(member_id: Column) -> Column:
    return F.concat(F.lit("/tracker?member="), F.nullif(member_id.cast("bigint"), F.lit(0)).cast("string"))


def with_house(text: Column, house: Column) -> Column:
    """PRJ-13: the house after a dot, where there is one."""
    return F.when(missing(house), text).otherwise(F.concat(text, F.lit(" • "), house))


def row_key(first: Column, *others: Column) -> Column:
    """PRJ-15."""
    return F.coalesce(*[F.nullif(c.cast("string"), F.lit("")) for c in (first, *others)])


def shown_keywords(keywords: Column, n: int = 4) -> tuple[Column, Column]:
    """The first ``n`` keywords, and the note of how many more there are or null (PRJ-17)."""
    more = F.size(keywords) - n
    return F.slice(keywords, 1, n), F.when(more > 0, F.concat(F.lit("+"), more.cast("string"), F.lit(" more")))


title = lambda c: or_default(c, "Untitled Debate")
house_name = lambda c: or_default(c, "Unknown house")
party_name = lambda c: or_default(c, "Independent")
constituency_name = lambda c: or_default(c, "Unknown constituency")
speaker_name = lambda c: or_default(c, "Unknown Speaker")
debate_title = lambda c: or_default(c, "Debate")
topic_party = lambda c: or_default(c, "Unknown")
topic_seat = lambda c: or_default(c, "-")
