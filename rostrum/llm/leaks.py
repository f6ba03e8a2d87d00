"""Benchmark decontamination: a broadcast hash set of test n-grams, scanned by every training document.

Texts are lower-cased in A to Z, and words are maximal runs of digits, letters and all beyond ASCII
(``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``).  A window is ``WORDS`` consecutive words of a benchmark item; an item of fewer
words, but not none, is one window.  The distinct windows, each with its 64-bit hash and its words, are the set.

A document is one row of a scan: its places are exploded, the window at each place is hashed, for each length that the
set has, and met with the set by a broadcast hash join, all within one stage of generated code that copies no words.  A
hit counts if its words are the window's, so hashes never decide.  Each document also ends with a marker that meets a
row of the set, so that documents without hits come out of the same scan, and one aggregate by document turns hits into
spans: no text and no window without a hit is ever shuffled.

The set is broadcast in blocks of at most ``BLOCK_BYTES``: its size is counted first, and a set over the bound is dealt
by hash into as many blocks as it needs, each scanned in turn.  Which items a document's windows belong to is found
for contaminated documents only, by classes: windows with the same items are one class.

Defined cases: a null text has no words, and neither has a text of separators; such documents are clean and such items
have no window.  A window that stands several times, overlaps another or belongs to several items hits each word
once.  Items without an id hit words but are not counted or named.  Rows equal in id and text stay as many rows;
rows with one id and several texts, or without an id, are documents of their own; extra columns are dropped by
``scan`` and kept by ``remove``; empty tables give an empty result, or clean documents.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .common import fresh, materialize

WORDS = 10
#: Estimated bytes of one broadcast block of the set.
BLOCK_BYTES = 48 << 20
#: Besides its words, what a row of the set takes in a hash table.
ROW_BYTES = 160
#: Words, and what stands between them, of texts as they are and of lower-cased texts.
WORD = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def lowered(text: Column) -> Column:
    """``text`` with A to Z in lower case and nothing else changed."""
    plain = F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    # the quick function does the same where no letter beyond ASCII has a lower case (nor is unknown to the pattern)
    return F.when(text.rlike(r"[\p{IsUppercase}\p{Lt}\p{Cn}&&[^A-Z]]"), plain).otherwise(F.lower(text))


def normal_words(text: Column) -> Column:
    return F.array_remove(F.split(lowered(F.coalesce(text, F.lit(""))), BETWEEN), "")


def window_hash(words: Column, place: Column, length: int) -> Column:
    """Of ``length`` words from ``place`` (from 0)."""
    return F.xxhash64(*[F.get(words, place + k) for k in range(length)])


def windows(items: DataFrame, length: int = WORDS, id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, n, gram (an array of words): the distinct windows of each item."""
    words = items.select(F.col(id).alias("item_id"), normal_words(F.col(text)).alias("words")).where(F.size("words") > 0)
    n = F.least(F.size("words"), F.lit(length))
    starts = F.sequence(F.lit(1), F.size("words") - n + 1)
    return words.select("item_id", n.alias("n"), F.explode(F.transform(starts, lambda i: F.slice("words", i, n))).alias("gram")).distinct()


class Grams:
    """The set: ``rows`` (hash, n, gram, class_id) in ``blocks`` of bounded size, ``members`` (class_id, item_id)."""

    def __init__(self, items: DataFrame, length: int = WORDS, id: str = "item_id", text: str = "text"):
        found = materialize(windows(items, length, id, text), "grams")
        # sums of hashes name a window's items; the count and two sums make a clash as unlikely as one of 128 bits
        whole = lambda c: F.sum(F.xxhash64("item_id", F.lit(c)).cast("decimal(38,0)"))
        class_id = F.md5(F.concat_ws(",", F.count("item_id").cast("string"), whole(1).cast("string"), whole(2).cast("string")))
        self.rows = materialize(found.groupBy("n", "gram").agg(class_id.alias("class_id")), "gram-classes")
        self.members = found.where("item_id is not null").join(self.rows, ["n", "gram"]).select("class_id", "item_id").distinct()
        size = self.rows.agg(F.sum(F.octet_length(F.array_join("gram", "")) + 32 * F.col("n") + ROW_BYTES), F.collect_set("n")).first()
        self.blocks, self.lengths = max(1, math.ceil((size[0] or 0) / BLOCK_BYTES)), sorted(size[1] or [])

    def block(self, k: int) -> DataFrame:
        """The rows of one block with their hashes, and the row that documents' markers meet."""
        marker = self.rows.sparkSession.range(1).select(F.lit(0).alias("n"), F.lit(0).cast("bigint").alias("hash"), F.lit(None).cast("array<string>").alias("gram"), F.lit(None).cast("string").alias("class_id"))
        made = None
        for n in self.lengths:
            rows = self.rows.where(F.col("n") == n).select("n", window_hash(F.col("gram"), F.lit(0), n).alias("hash"), "gram", "class_id")
            made = rows if made is None else made.union(rows)
        return marker if made is None else made.where(F.pmod("hash", F.lit(self.blocks)) == k).union(marker)


def scan(docs: DataFrame, items: DataFrame, length: int = WORDS, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Of each row of ``docs``: doc_id, text_md5, n_words, spans (of all occurrences: first word from 1, words; in order),
    items (the ids with occurring windows)."""
    grams = Grams(items, length)
    words = F.col("words")
    read = docs.select(F.col(id).alias("doc_id"), F.md5(F.coalesce(F.col(text), F.lit(""))).alias("text_md5"), normal_words(F.col(text)).alias("words"))
    # a row for each place, the last of which is the marker's.  Outer, though there is always one: else the optimizer
    # infers a filter on the number of places and finds the words again there
    places = read.select("*", F.explode_outer(F.sequence(F.lit(0), F.size(words))).alias("place"))
    lengths = grams.lengths or [length]
    places = places.withColumn("length", F.explode(F.array(*map(F.lit, lengths))) if len(lengths) > 1 else F.lit(lengths[0]))
    end = (F.col("place") == F.size(words)) & (F.col("length") == lengths[0])
    hashed = F.when(end, F.lit(0).cast("bigint"))
    for n in lengths:
        hashed = hashed.when((F.col("length") == n) & (F.col("place") + n <= F.size(words)), window_hash(words, F.col("place"), n))
    places = places.withColumn("hash", hashed)
    parts = []
    for k in range(grams.blocks):
        met = places.join(F.broadcast(grams.block(k)), "hash")
        met = met.where(F.when(F.col("n") == 0, end).otherwise((F.col("n") == F.col("length")) & (F.slice(words, F.col("place") + 1, F.col("n")) == F.col("gram"))))
        parts.append(met.select("doc_id", "text_md5", F.when(F.col("n") == 0, F.size(words)).alias("n_words"), (F.col("place") + 1).alias("at"), "n", "class_id", F.lit(k).alias("block")))
    met = reduce(DataFrame.union, parts)
    span = F.when(F.col("n") > 0, F.struct("at", "n"))
    # a marker comes once a block: the first block's tell how many rows are equal in id and text
    found = met.groupBy("doc_id", "text_md5").agg(F.max("n_words").alias("n_words"), F.count(F.when((F.col("n") == 0) & (F.col("block") == 0), 1)).alias("rows"), F.collect_set(span).alias("spans"), F.collect_set("class_id").alias("classes"))
    found = materialize(found.withColumn("spans", F.array_sort("spans")), "leaks")
    named = found.where(F.size("classes") > 0).select("doc_id", "text_md5", F.explode("classes").alias("class_id")).join(grams.members, "class_id").groupBy("doc_id", "text_md5").agg(F.collect_set("item_id").alias("items"))
    named = named.select(F.col("doc_id").alias("of_id"), F.col("text_md5").alias("of_md5"), "items")
    keys = F.col("doc_id").eqNullSafe(F.col("of_id")) & (F.col("text_md5") == F.col("of_md5"))
    out = found.join(named, keys, "left").withColumn("items", F.coalesce("items", F.array().cast(named.schema["items"].dataType)))
    return out.select("doc_id", "text_md5", "n_words", "spans", "items", F.explode(F.sequence(F.lit(1), "rows")).alias("copy")).drop("copy")


def merged(spans: Column) -> Column:
    """Occurrences in order, those that overlap or touch as one: (first word from 1, words)."""
    kind = "array<struct<at:int,n:int>>"
    step = lambda out, s: F.when((F.size(out) > 0) & (F.element_at(out, -1)["at"] + F.element_at(out, -1)["n"] >= s["at"]), F.concat(F.slice(out, 1, F.size(out) - 1), F.array(F.struct(F.element_at(out, -1)["at"].alias("at"), F.greatest(F.element_at(out, -1)["n"], s["at"] + s["n"] - F.element_at(out, -1)["at"]).alias("n"))))).otherwise(F.concat(out, F.array(s)))
    return F.aggregate(spans, F.array().cast(kind), step)


def n_hit(spans: Column) -> Column:
    """Words inside any occurrence; ``spans`` in order."""
    zero = F.struct(F.lit(0).cast("bigint").alias("hit"), F.lit(0).alias("end"))
    add = lambda t, s: F.struct((t["hit"] + F.greatest(F.lit(0), s["at"] + s["n"] - F.greatest(t["end"], s["at"]))).alias("hit"), F.greatest(t["end"], s["at"] + s["n"]).alias("end"))
    return F.aggregate(spans, zero, add, lambda t: t["hit"])


def remove(docs: DataFrame, items: DataFrame, whole: bool = False, length: int = WORDS) -> DataFrame:
    """``docs`` without what the benchmark holds: without contaminated documents (``whole``), or with the words of all
    occurrences, and what stands between words of one, cut from their texts; all columns stay."""
    id, md5, spans = (fresh(docs, c) for c in ("_hit_id", "_hit_md5", "_hit_spans"))
    hits = scan(docs, items, length).where(F.size("spans") > 0).select(F.col("doc_id").alias(id), F.col("text_md5").alias(md5), merged(F.col("spans")).alias(spans)).dropDuplicates([id, md5])
    same = docs["doc_id"].eqNullSafe(F.col(id)) & (F.md5(F.coalesce(docs["text"], F.lit(""))) == F.col(md5))
    if whole:
        return docs.join(hits, same, "left_anti")
    words, gaps = F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), F.split("text", WORD)
    # text = gap 1, word 1, gap 2, word 2, ..., last gap; between two spans stand a gap, the words and gaps kept, a gap
    piece = lambda a, b: F.concat(gaps[a - 1], F.array_join(F.zip_with(F.slice(words, a, b - a), F.slice(gaps, a + 1, b - a), lambda w, g: F.concat(w, g)), ""))
    starts = F.concat(F.array(F.lit(1)), F.transform(spans, lambda s: s["at"] + s["n"]))
    ends = F.concat(F.transform(spans, lambda s: s["at"]), F.array(F.size(words) + 1))
    kept = F.array_join(F.zip_with(starts, ends, piece), "")
    cut = docs.join(hits, same, "left")
    return cut.select(*[F.when(F.col(spans).isNull(), F.col("text")).otherwise(kept).alias("text") if c == "text" else F.col(f"`{c}`") for c in docs.columns])
