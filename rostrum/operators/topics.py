"""Topics: keywords against a corpus, ranked by member (SRC-15, JOIN-2, WIN-1, SET-1, AGG-2, SRT-2)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from .slices import Ranked

# The seed topics.
SEED_TOPICS = [
    ("1", "Climate & Environment", ["climate change", "net zero", "carbon emissions", "renewable energy", "biodiversity"]),
    ("2", "Healthcare", ["NHS", "healthcare", "mental health", "hospitals", "doctors"]),
    ("3", "Economy", ["inflation", "interest rates", "cost of living", "GDP", "unemployment"]),
]
PER_KEYWORD = 50


def seed_topics(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(SEED_TOPICS, "id string, name string, keywords array<string>")


def keyword_hits(corpus: DataFrame, keywords: Sequence[str], text: str, key: str, per_keyword: int = PER_KEYWORD) -> DataFrame:
    """The first ``per_keyword`` rows, by key, that hold each keyword: the row, kw_ord, keyword and rn.

    Keywords are parameters of a query, a handful of literals, so one pass over the corpus lower-cases a text
    once and tests all of them; a row without a hit leaves the scan no further.  Each keyword then keeps its
    least keys by a top-n of its own, which every task runs before anything is shuffled: what moves is at most
    ``per_keyword`` rows a task and keyword.
    """
    words = [k.lower() for k in keywords]
    if not words:
        return corpus.limit(0).select("*", F.lit(0).alias("kw_ord"), F.lit("").alias("keyword"), F.lit(0).alias("rn"))
    low = F.lower(F.col(text))
    tests = F.filter(F.array(*[F.when(F.contains(F.col("_low"), F.lit(w)), F.lit(k)) for k, w in enumerate(words)]), lambda k: k.isNotNull())
    others = [c for c in corpus.columns if c != text]
    met = corpus.withColumn("_low", low).select(*others, F.explode(tests).alias("kw_ord"))
    rank = F.row_number().over(Window.partitionBy("kw_ord").orderBy(key))
    names = F.element_at(F.array(*map(F.lit, keywords)), F.col("kw_ord") + 1)
    return met.withColumn("rn", rank).where(F.col("rn") <= per_keyword).withColumn("keyword", names)


def ranking(hits: DataFrame, member: str, name: str, party: str, constituency: str | None = None, distinct_on: str | None = None) -> DataFrame:
    """Members by number of hits: member_id, name, party, constituency, mentions, rank.

    A row that two keywords hit counts twice, as each hit is a mention; ``distinct_on`` counts distinct rows
    instead.  Name (``Unknown`` if missing), party and constituency are those of the member's first hit, in the
    order of keywords, then of rows.  Ties stand in that order too.  The ranks come from one sorted task: there
    are at most ``per_keyword`` members a keyword.
    """
    found = _counted(hits, F.col("kw_ord").cast("bigint") * (1 << 32) + F.col("rn"), member, name, party, constituency, distinct_on)
    rank = F.row_number().over(Window.orderBy(F.col("mentions").desc(), "pos"))
    return found.withColumn("rank", rank.cast("bigint")).drop("pos")


def _counted(hits: DataFrame, place: Column, member: str, name: str, party: str, constituency: str | None, distinct_on: str | None) -> DataFrame:
    """member_id, name, party, constituency, mentions, pos."""
    kept = hits.where(F.col(member).isNotNull() & (F.col(member).cast("string") != "0") & (F.col(member).cast("string") != ""))
    none = F.lit(None).cast("string")
    kept = kept.select(F.col(member).alias("member_id"), place.alias("pos"), F.struct(F.col(name).alias("name"), F.col(party).alias("party"), (F.col(constituency) if constituency else none).alias("constituency")).alias("who"), *([F.col(distinct_on).alias("row_id")] if distinct_on else []))
    count = F.count_distinct("row_id") if distinct_on else F.count(F.lit(1))
    found = kept.groupBy("member_id").agg(count.alias("mentions"), F.min("pos").alias("pos"), F.min_by("who", "pos").alias("who"))
    return found.select("member_id", F.coalesce(F.nullif("who.name", F.lit("")), F.lit("Unknown")).alias("name"), "who.party", "who.constituency", "mentions", "pos")


def full_ranking(hits: DataFrame, key: str, member: str, name: str, party: str, path: str, ranges: int, constituency: str | None = None, distinct_on: str | None = None) -> Ranked:
    """``ranking`` for hits and members of any number: laid out under ``path`` by ranges of (mentions, first hit), no task above
    its range; slices of it are pages of the ranking, and ``place`` + 1 is the rank.

    ``hits`` have kw_ord and ``key``, by which a member's first hit is found; no place within a keyword is needed, so no
    keyword is numbered or cut.
    """
    found = _counted(hits, F.struct("kw_ord", F.col(key).alias("key")), member, name, party, constituency, distinct_on)
    flat = found.select("*", F.col("pos.kw_ord").alias("first_keyword"), F.col("pos.key").alias("first_row")).drop("pos")
    return Ranked.build(flat, [F.col("mentions").desc(), F.col("first_keyword"), F.col("first_row")], path, ranges)
