"""Keyword tables against a corpus: posting lists of runs of bytes (JOIN-2, SET-1, WIN-1 for any number of keywords).

``topics.keyword_hits`` takes a handful of literals.  Here keywords are rows of a table, and thousands of them meet the
corpus in one pass, by equality and without a nested loop: of each keyword in lower case one run of ``Q`` bytes (a shorter
keyword: all of it) is its anchor, the one that the fewest keywords of the table hold.  The anchors' numbers, each with its keyword, are a posting list.  A text is one row of a scan: numpy
passes over the bytes of a batch of texts (``functions.runs``), once for each length of anchors, with a filter of fixed size that drops nearly all runs that are no
anchor.  The distinct ones that are left are exploded and meet the posting list in a broadcast hash join, and a
keyword longer than its anchor is held against the text itself; a run's number is the run, so that a shorter one is there.  As a keyword has one anchor and a text has a run once,
a text gives one row a keyword: no aggregate makes hits distinct, and what leaves the scan is hits.

The posting list is broadcast in blocks of at most ``BLOCK_BYTES``, by its measured size: a table over the bound is
scanned in as many passes as it has blocks.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from ..functions import runs
from ..session import bounded_batches

Q = runs.LONGEST
BLOCK_BYTES = 48 << 20
#: Besides its characters, what a row takes in a hash table.
ROW_BYTES = 160


def cleaned(keywords: DataFrame, keyword: str = "keyword", order: str = "kw_ord") -> DataFrame:
    """kw_ord, keyword of the keywords that are not blank (FIL-7)."""
    return keywords.select(F.col(order).alias("kw_ord"), F.col(keyword).alias("keyword")).where(F.trim("keyword") != "")


def postings(keywords: DataFrame) -> DataFrame:
    """kw_ord, keyword, bytes, length, hash, at: each keyword's anchor, ``length`` bytes from ``at`` (from 0) on, and its number."""
    low = keywords.withColumn("bytes", F.lower("keyword").cast("binary")).withColumn("length", F.least(F.octet_length("bytes"), F.lit(Q)))
    every = low.select("*", F.explode(F.sequence(F.lit(0), F.octet_length("bytes") - F.col("length"))).alias("at"))
    every = every.withColumn("hash", runs.number(F.substring("bytes", F.col("at") + 1, F.col("length"))))
    shared = every.groupBy("hash").agg(F.count_distinct("kw_ord", "keyword").alias("shared"))
    best = Window.partitionBy("kw_ord", "keyword").orderBy("shared", "at")
    return every.join(shared, "hash").withColumn("place", F.row_number().over(best)).where(F.col("place") == 1).drop("place", "shared")


def _found(lengths: list[int], bits: bytes):
    """The anchors that a text may hold, as a function of its bytes; ``bits``: the filter."""

    @F.arrow_udf(T.ArrayType(T.LongType()))
    def found(low: pa.Array) -> pa.Array:
        return runs.wanted_runs(low, lengths, np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool))

    return found


def all_hits(corpus: DataFrame, keywords: DataFrame, text: str) -> DataFrame:
    """A row for each row of ``corpus`` and keyword of the table (see ``cleaned``) that its text holds, in any case:
    the row's other columns, kw_ord and keyword.  Equal entries of the table count once, equal rows once each
    row; null and empty texts hold nothing."""
    bounded_batches(corpus.sparkSession)
    listed = postings(keywords)
    place = listed.select("keyword", "bytes", "length", (runs.slot("hash") + 1).alias("slot"))
    size = F.sum(4 * F.length("keyword") + F.octet_length("bytes") + ROW_BYTES)
    # a row for each 32,768 slots
    parts = place.groupBy(F.bitmap_bucket_number("slot").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("slot")).alias("bits"), size.alias("size"), F.collect_set("length").alias("lengths")).collect()
    blocks, lengths = max(1, math.ceil(sum(r["size"] for r in parts) / BLOCK_BYTES)), sorted({n for r in parts for n in r["lengths"]})
    others = [c for c in corpus.columns if c != text]
    if not lengths:
        return corpus.limit(0).select(*[F.col(f"`{c}`") for c in others], F.lit(None).cast(keywords.schema["kw_ord"].dataType).alias("kw_ord"), F.lit("").alias("keyword"))
    held = {r["bucket"]: bytes(r["bits"]) for r in parts}
    found = _found(lengths, b"".join(held.get(k + 1, bytes(4096)) for k in range(runs.SLOTS >> 15)))
    read = corpus.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias("_row"), F.lower(F.col(f"`{text}`")).alias("_low"))
    runs_of = read.select("_row", "_low", found(F.col("_low").cast("binary")).alias("_runs"))
    # outer: else the optimizer infers a filter on the number of runs and makes them again there
    opened = runs_of.select("_row", "_low", F.explode_outer("_runs").alias("hash"))
    hits = []
    for k in range(blocks):
        met = opened.join(F.broadcast(listed.where(F.pmod("hash", F.lit(blocks)) == k).select("hash", "kw_ord", "keyword", F.lower("keyword").alias("_wanted"))), "hash")
        whole = (F.octet_length("_wanted") <= Q) | F.contains("_low", "_wanted")
        hits.append(met.where(whole).select("_row", "kw_ord", "keyword"))
    return reduce(DataFrame.union, hits).select("_row.*", "kw_ord", "keyword")


def top_hits(corpus: DataFrame, keywords: DataFrame, text: str, key: str, per_keyword: int = 50) -> DataFrame:
    """``all_hits`` with rn: the first ``per_keyword`` rows of each entry of the table, by key.  Each task keeps its
    own first ones before anything is shuffled.  ``topics.ranking`` takes these rows."""
    rank = F.row_number().over(Window.partitionBy("kw_ord", "keyword").orderBy(key))
    return all_hits(corpus, keywords, text).withColumn("rn", rank).where(F.col("rn") <= per_keyword)
