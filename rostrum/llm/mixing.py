"""Mixing sources to target weights by temperature, with DataFrame operations only.

A source with token share p gets the weight ``p^a / sum(p^a)``.  The exponent ``a`` in [0, 1] is bisected:
the largest that reaches the target entropy, but not so small that any source is repeated more than
the limit allows.  The budget in tokens is given, or else the least with which every source is read
whole at least once, so that no document is lost.

The weights are realised as block permutations.  A source's documents are dealt into ``BLOCKS`` blocks by
hash; each pass over the source orders the blocks anew, again by hash; the last pass stops where the
source's budget is spent, within a block at a step of 1/65536 of it.  All of this is decided from sums
by (source, block), so that texts are read once and never shuffled, and a hot source is spread over
all tasks.

Defined cases: null is a source of its own; documents without tokens (null, empty, blank) cost nothing
and follow their blocks; a source without any token is read once; equal shares are fixed points of any
exponent; repeated rows fall into one block together; extra columns pass through, those named like an
output column are replaced; an empty table gives an empty result.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import materialize

BLOCKS = 256
STEPS = 1 << 16
#: Sources whose settings are broadcast; more are joined by a shuffle.
BROADCAST_SOURCES = 50_000
#: Columns of the output; those of the input with these names are replaced.
OUTPUTS = ["tokens", "copy", "block", "schedule", "weight", "share"]


def tokens_of(text: Column) -> Column:
    """Blank-separated words."""
    return F.coalesce(F.regexp_count(text, F.lit(r"\S+")), F.lit(0)).cast("long")


def _key() -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("null"))


def _block() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(21)), F.lit(BLOCKS)).cast("int")


def _step() -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(22)), F.lit(STEPS)).cast("int")


def _turn(copy: Column) -> Column:
    """Place of a block in the permutation of a pass, in [0, 1)."""
    return F.pmod(F.xxhash64("key", "block", copy.cast("int"), F.lit(23)), F.lit(1 << 40)) / float(1 << 40)


def exponent(shares: DataFrame, target_entropy: float, repeat_limit: float, sections: int = 32, passes: int = 5) -> float:
    """Bisect on a DataFrame with the column ``share``.  Each pass evaluates ``sections - 1`` exponents at
    once, that is five halvings of the interval.  ``target_entropy`` is a part of the logarithm of the
    number of sources."""
    low, high = 0.0, 1.0
    n = F.count(F.lit(1))
    for _ in range(passes):
        grid = [low + (high - low) * k / sections for k in range(sections + 1)]
        tried = shares.select("share", F.explode(F.array(*map(F.lit, grid))).alias("a")).withColumn("w", F.pow("share", "a"))
        entropy = F.log(F.sum("w")) - F.sum(F.col("w") * F.log("w")) / F.sum("w")
        # relative to a single pass over the largest source
        repeats = F.max(F.col("w") / F.col("share")) / F.min(F.col("w") / F.col("share"))
        fits = {r["a"]: (r["h"] >= target_entropy * r["most"] - 1e-12, r["r"] <= repeat_limit + 1e-12) for r in tried.groupBy("a").agg(entropy.alias("h"), F.log(n).alias("most"), repeats.alias("r")).collect()}
        if not fits:
            return 1.0
        flat = max((a for a in grid if fits[a][0]), default=grid[0])
        least = min((a for a in grid if fits[a][1]), default=grid[-1])
        best = max(flat, least)
        k = grid.index(best)
        low, high = (grid[max(0, k - 1)], best) if least >= flat else (best, grid[min(sections, k + 1)])
        if low == high:
            break
    return high if least >= flat else low


def mix(docs: DataFrame, target_entropy: float = 0.97, repeat_limit: float = 2.0, budget: int | None = None) -> DataFrame:
    """``docs`` with ``tokens``, ``copy`` (number of the pass), ``block``, ``schedule`` (place in the mixture, in
    [0, 1)), ``weight`` and ``share`` of the source; a row for each time that the document is read."""
    kept = [c for c in docs.columns if c.lower() not in OUTPUTS]
    # the columns that pass through travel as one, so that no name of theirs meets one of these
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in kept]).alias("row"), "doc_id", tokens_of(F.col("text")).alias("tokens"), _key().alias("key"), _block().alias("block"))
    sums = materialize(rows.withColumn("step", _step()).groupBy("key", "block", "step").agg(F.sum("tokens").alias("tokens")), "blocks")
    sources = sums.groupBy("key").agg(F.sum("tokens").alias("total"))
    total, n = sources.agg(F.coalesce(F.sum("total"), F.lit(0)), F.count(F.lit(1))).first()
    sources = sources.withColumn("share", F.col("total") / F.lit(float(total or 1)))
    a = exponent(sources.where("total > 0").select("share"), target_entropy, repeat_limit)
    norm, most = sources.where("total > 0").agg(F.coalesce(F.sum(F.pow("share", F.lit(a))), F.lit(1.0)), F.coalesce(F.max("share"), F.lit(1.0))).first()
    weight = F.when(F.col("total") > 0, F.pow("share", F.lit(a)) / norm).otherwise(0.0)
    spent = float(budget) if budget is not None else total * most / (math.pow(most, a) / norm)
    settings = sources.withColumn("weight", weight).withColumn("due", F.when(F.col("total") > 0, F.round(F.lit(spent) * F.col("weight"))).otherwise(0).cast("long"))
    settings = settings.withColumn("whole", F.when(F.col("total") > 0, F.floor(F.col("due") / F.col("total"))).otherwise(1).cast("int")).withColumn("rest", F.when(F.col("total") > 0, F.col("due") - F.col("whole") * F.col("total")).otherwise(0))
    # the block in which the last pass ends, and the step within it
    blocks = sums.groupBy("key", "block").agg(F.sum("tokens").alias("tokens")).join(settings.select("key", "whole", "rest"), "key").withColumn("turn", _turn(F.col("whole")))
    line = Window.partitionBy("key").orderBy("turn", "block")
    ends = blocks.withColumn("upto", F.sum("tokens").over(line)).where(F.col("upto") >= F.col("rest")).withColumn("first", F.row_number().over(line)).where("first = 1 and rest > 0")
    ends = ends.select("key", F.col("block").alias("end_block"), F.col("turn").alias("end_turn"), (F.col("rest") - F.col("upto") + F.col("tokens")).alias("room"))
    inner = sums.join(ends.select("key", F.col("end_block").alias("block"), "room"), ["key", "block"])
    fits = inner.withColumn("upto", F.sum("tokens").over(Window.partitionBy("key").orderBy("step"))).where(F.col("upto") <= F.col("room")).groupBy("key").agg(F.max("step").alias("end_step"))
    settings = settings.join(ends, "key", "left").join(fits, "key", "left").select("key", "weight", "share", "whole", "end_block", "end_turn", F.coalesce("end_step", F.lit(-1)).alias("end_step"), F.when(F.col("total") > 0, F.col("due") / F.col("total")).otherwise(1.0).alias("repeats"))
    settings = materialize(settings, "sources")
    met = rows.withColumn("step", _step()).join(F.broadcast(settings) if n <= BROADCAST_SOURCES else settings, "key")
    turn = _turn(F.col("whole"))
    extra = F.col("end_turn").isNotNull() & ((turn < F.col("end_turn")) | ((F.col("block") == F.col("end_block")) & (F.col("step") <= F.col("end_step"))))
    copies = F.col("whole") + F.coalesce(extra, F.lit(False)).cast("int")
    read = met.where(copies > 0).withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    schedule = F.least((F.col("copy") + _turn(F.col("copy"))) / F.greatest("repeats", F.lit(1e-12)), F.lit(1.0))
    return read.select("row.*", "tokens", "copy", "block", schedule.alias("schedule"), "weight", "share")
