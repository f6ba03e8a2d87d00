"""Schemas of the documents that the library reads."""

from __future__ import annotations

PARTY = "struct<id: bigint, name: string, abbreviation: string, backgroundColour: string, foregroundColour: string>"
STATUS = "struct<statusIsActive: boolean, statusDescription: string, statusStartDate: string>"
MEMBERSHIP = (
    "struct<membershipFrom: string, membershipFromId: bigint, house: int, membershipStartDate: string, "
    f"membershipEndDate: string, membershipEndReason: string, membershipEndReasonNotes: string, membershipStatus: {STATUS}>"
)
MEMBER = (
    "struct<id: bigint, nameListAs: string, nameDisplayAs: string, nameFullTitle: string, nameAddressAs: string, "
    f"latestParty: {PARTY}, latestHouseMembership: {MEMBERSHIP}, gender: string, thumbnailUrl: string>"
)
LINKS = "array<struct<rel: string, href: string>>"
CONTACTS = (
    "array<struct<type: string, typeDescription: string, typeId: int, isPreferred: boolean, isWebAddress: boolean, notes: string, "
    "line1: string, line2: string, line3: string, line4: string, line5: string, postcode: string, phone: string, fax: string, email: string>>"
)
OVERVIEW = "struct<Id: string, Title: string, Date: string, House: string, Location: string, SittingDate: string>"
ITEM = (
    "struct<Id: string, ItemType: string, Value: string, AttributedTo: string, MemberId: bigint, MemberParty: string, "
    "MemberConstituency: string, Timecode: string, OrderIndex: int>"
)
DEBATE = f"Overview {OVERVIEW}, Items array<{ITEM}>"
HIT = (
    "struct<DebateSectionExtId: string, Title: string, SittingDate: string, House: string, DebateSection: string, AttributedTo: string, "
    "MemberId: bigint, MemberParty: string, MemberConstituency: string, TextHighlight: string>"
)
HITS = f"Results array<{HIT}>, TotalResults bigint, SearchTerms array<string>"
MEMBERS = f"items array<struct<value: {MEMBER}, links: {LINKS}>>, totalResults bigint, resultContext string"
DAY = "Date string, House string, Sections array<struct<Id: string, Title: string, Type: string>>"
WATCHED = f"id bigint, nameDisplayAs string, latestParty {PARTY}, latestHouseMembership {MEMBERSHIP}"
TOPIC = "id string, name string, keywords array<string>"
