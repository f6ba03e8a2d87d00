"""Document fingerprints by one-permutation MinHash, with DataFrame operations only.

Each shingle of five words is hashed once.  The top bits of the hash name one of ``BINS`` bins, which keeps
its least hash.  An empty bin takes the value of a filled one, chosen by optimal densification: each
empty bin draws bins in a random order of its own, the same for every document, until one is
filled (``DRAWS`` draws by hash, then, for short texts, the filled bin of least hash).  The low byte of each
bin is stored.  Two unrelated bins agree once in 256 times, which the likeness is corrected for.

Defined cases: a null text counts as the empty one; a text without words has the empty fingerprint,
which is like itself (1) and unlike all others (0); fewer than five words make one shingle; repeated
rows get equal fingerprints; extra columns pass through; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import fresh, longs, partitions

BIN_BITS = 8
BINS = 1 << BIN_BITS
WORDS = 5
#: Draws of an empty bin before all filled bins are ranked at once.
DRAWS = 24
#: White space of a text, as ``\\s`` has it.
BLANKS = " \t\n\x0b\f\r"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` with its argument evaluated once; the optimizer does not inline a lambda's argument."""
    return F.transform(F.array(value), body)[0]


def shingles(text: Column) -> Column:
    """64-bit hashes of runs of five words."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS))

    def of(words: Column) -> Column:
        each = F.transform(F.sequence(F.lit(0), F.size(words) - WORDS), lambda i: F.xxhash64(*[F.get(words, i + k) for k in range(WORDS)]))
        return F.when(F.size(words) < WORDS, F.array(F.xxhash64(words))).otherwise(each)

    return F.when(bare == "", F.array().cast("array<bigint>")).otherwise(let(F.split(bare, r"\s+"), of))


def _bin(x: Column) -> Column:
    return F.shiftrightunsigned(x, 64 - BIN_BITS)


def fingerprint(text: Column) -> Column:
    """``BINS`` bytes, or none for a text without words."""

    def least(ordered: Column) -> Column:
        return F.filter(ordered, lambda x, i: (i == 0) | (_bin(x) != _bin(F.get(ordered, i - 1))))

    def packed(kept: Column) -> Column:
        def dense(filled: Column) -> Column:
            def borrowed(b: Column) -> Column:
                drawn = F.aggregate(F.sequence(F.lit(1), F.lit(DRAWS)), F.lit(None).cast("bigint"), lambda got, k: F.coalesce(got, F.element_at(filled, F.pmod(F.xxhash64(b, k), F.lit(BINS)))))
                ranked = F.transform(kept, lambda x: F.struct(F.xxhash64(b, _bin(x)).alias("rank"), x.bitwiseAND(255).alias("low")))
                return F.coalesce(drawn, F.array_min(ranked)["low"])

            own = F.transform(F.sequence(F.lit(0).cast("bigint"), F.lit(BINS - 1).cast("bigint")), lambda b: F.coalesce(F.element_at(filled, b), borrowed(b)))
            return F.unhex(F.array_join(F.transform(own, lambda v: F.lpad(F.hex(v), 2, "0")), ""))

        return let(F.map_from_arrays(F.transform(kept, _bin), F.transform(kept, lambda x: x.bitwiseAND(255))), dense)

    return F.when(F.btrim(F.coalesce(text, F.lit("")), F.lit(BLANKS)) == "", F.lit(b"")).otherwise(let(let(F.sort_array(shingles(text)), least), packed))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard likeness of two packed fingerprints, corrected for chance agreement."""
    same = F.size(F.filter(F.sequence(F.lit(1), F.lit(BINS)), lambda i: F.substring(a, i, F.lit(1)) == F.substring(b, i, F.lit(1)))) / float(BINS)
    chance = 1 / 256
    both = F.greatest(F.lit(0.0), (same - chance) / (1 - chance))
    return F.when((F.length(a) == 0) | (F.length(b) == 0), (a == b).cast("double")).otherwise(both)


def range_of(value: Column, cuts: list[int]) -> Column:
    """How many of the ascending ``cuts`` are below ``value``: first among every g-th cut, then within its group,
    so that a row meets about twice the square root of their number."""
    if not cuts:
        return F.lit(0)
    g = math.isqrt(len(cuts)) + 1
    groups = [cuts[k : k + g] for k in range(0, len(cuts), g)]
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < value))
    whole = below(longs([c[-1] for c in groups]))
    inside = F.slice(longs(cuts), whole * g + 1, g)
    # the last group may be short
    return F.least(whole * g + below(inside), F.lit(len(cuts)))


def with_next(docs: DataFrame, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<c>`` for each of ``columns``: the row after, in descending order of doc_id (nulls at
    the end, ties by text hash), the first after the last.

    Rows are dealt once, by ranges of doc_id; the first row of each range also goes to the range before it.
    The driver holds one boundary and one doc_id a range.  Columns of ``docs`` named ``next_<c>`` are replaced.
    """
    spark = docs.sparkSession
    ranges = partitions(spark)
    ids = docs.select("doc_id")
    at = F.split(F.lit(",".join(repr(k / max(ranges, 2)) for k in range(1, max(ranges, 2)))), ",").cast("array<double>")
    cuts = ids.agg(F.percentile_approx("doc_id", at, 20_000)).first()[0] or []
    bucket = F.when(F.col("doc_id").isNull(), 0).otherwise(range_of(F.col("doc_id"), sorted(set(cuts))))
    tops = sorted(((r["bucket"], r["top"]) for r in ids.groupBy(bucket.alias("bucket")).agg(F.max("doc_id").alias("top")).collect()), key=lambda r: r[0])
    # the range before in descending order is the next one above; before the first comes the last
    # by range: its first id, whether that is null, and the range above; literals, whatever the number of ranges
    n = max([0, *(r for r, _ in tops)]) + 1
    top, none, above = [0] * n, [1] * n, [0] * n
    for k, (r, last) in enumerate(tops):
        top[r], none[r], above[r] = last or 0, int(last is None), tops[(k + 1) % len(tops)][0]
    own, place = fresh(docs, "own_range"), fresh(docs, "place_of_range")
    at = lambda values: F.get(longs(values), F.col(own))
    first = F.when(at(none) == 1, F.col("doc_id").isNull()).otherwise(F.col("doc_id") == at(top))
    also = F.when(first, at(above).cast("int"))
    dealt = docs.withColumn(own, bucket.cast("int"))
    dealt = dealt.withColumn(place, F.explode(F.array(F.struct(F.col(own).alias("at"), F.lit(False).alias("copy")), F.struct(also.alias("at"), F.lit(True).alias("copy"))))).where(F.col(place)["at"].isNotNull())
    line = Window.partitionBy(F.col(place)["at"]).orderBy(F.col(place)["copy"], F.col("doc_id").desc_nulls_last(), F.xxhash64("text"))
    kept = [F.col(f"`{c}`") for c in docs.columns if c.lower() not in {f"next_{x}".lower() for x in columns}]
    return dealt.select(*kept, place, *[F.lead(c).over(line).alias(f"next_{c}") for c in columns]).where(~F.col(place)["copy"]).drop(place)


def fingerprints(docs: DataFrame, text: str = "text", out: str = "fingerprint") -> DataFrame:
    """``docs`` with the packed fingerprint of each whole text."""
    return docs.withColumn(out, fingerprint(F.col(text)))
