"""Exact top-k by inner product of integer vectors: MaxScore over sharded posting lists.

A dimension is a term; a shard holds, for each term, the weights of its vectors above the shard's least
weight of that term (below it for terms of negative query weight), so that every posting adds a
non-negative part to a query's base score.  A term's bound is the largest part that any posting of the
shard adds.  Per query, terms stand in order of bounds; the longest tail whose bounds together do not
reach the current k-th score is non-essential: vectors that only have postings there can't enter.
Essential postings are traversed and summed, then the non-essential terms are probed, greatest bound
first, only for the vectors that are still competitive; each probe lowers what is left to gain and may
drop more.  The k-th score starts at the best that a few vectors of the shard reach exactly, so bounds
bite from the first term on.  Shards' results are merged by one more top-k.

Queries and candidates meet in pairs of blocks, each bounded: a task holds one shard and one block of
queries.  Scores are sums of integers, computed exactly: where sums may pass 2^53, floats only tell which
vectors can't enter, and whole numbers of any length score the others.

Defined cases: vectors that are null, or hold a null or a non-finite component, take no part; nor do
vectors of another length than the query's; rows with a null id take no part; a query is left out of
its own candidates by id, with all rows of it; equal vectors tie, and the smaller id comes first; rows
equal in id and vector count once, an id with several vectors is a candidate with each, and as a query
has the best of all; a component or a score that no 64-bit integer holds counts as the nearest that one holds, so that no
row ends a job; fewer than k candidates give as many rows; extra
columns are dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ship

#: Vectors of a shard, queries of a block: each vector is dealt once for every block, each query once for every shard.
SHARD = 8192
QUERIES = 8192
#: What 64 bits hold.
MOST = (1 << 63) - 1
SCHEMA = "query_id long, vec_id long, score long"


def quantized(vectors: DataFrame, column: str = "embedding", scale: int = 256) -> DataFrame:
    """vec_id and ``v``: floor(scale * x) of each component; without the vectors that take no part."""
    finite = lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False))

    def floored(x: Column) -> Column:
        y = x.cast("double") * scale
        return F.when(F.abs(y) < float(1 << 63), F.floor(y)).when(finite(x), F.when(y > 0, F.lit(MOST)).otherwise(F.lit(-MOST)))

    whole = F.transform(column, floored)
    fit = F.col("vec_id").isNotNull() & F.col(column).isNotNull() & F.forall(column, finite)
    return vectors.where(fit).select("vec_id", F.size(column).alias("dims"), whole.alias("v"))


class Shard:
    """Weights of some vectors by term, with what bounds need."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids)
        self.ids, self.whole = ids[order], vectors[order]
        self.by_term = np.ascontiguousarray(self.whole.T.astype(np.float64))
        self.low, self.high = self.by_term.min(1), self.by_term.max(1)
        self.most = np.maximum(np.abs(self.low), np.abs(self.high))

    def top(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """(score, id) of the k best, ties to the smaller id.  Floats hold the integers exactly, or ``_wide`` is asked."""
        exactly, q = q, q.astype(np.float64)
        if 4 * (np.abs(q) @ self.most) >= 2.0**53:
            return self._wide(query_id, exactly, k)
        base = np.minimum(q * self.low, q * self.high)
        bound = np.maximum(q * self.low, q * self.high) - base
        order = np.argsort(-bound, kind="stable")
        left = np.concatenate([np.cumsum(bound[order][::-1])[::-1], [0.0]])
        own = self.ids == query_id
        n = len(self.ids) - int(own.sum())
        if n <= 0:
            return []
        # a first threshold from the exact scores of the vectors that lead in the strongest terms
        few = min(len(self.ids), 4 * k + int(own.sum()))
        lead = q[order[:8]] @ self.by_term[order[:8]]
        lead[own] = -np.inf
        seed = np.argpartition(-lead, few - 1)[:few]
        seed = seed[~own[seed]]
        exact = q @ self.by_term[:, seed]
        floor = np.sort(exact)[-k] if len(exact) >= k else -math.inf
        # essential: the terms before the first tail that can't reach the threshold on its own
        need = floor - base.sum()
        essential = int(np.argmax(left < need)) if (left < need).any() else len(q)
        head = order[:essential]
        gained = q[head] @ self.by_term[head] - base[head].sum() if essential else np.zeros(len(self.ids))
        alive = np.flatnonzero((gained + left[essential] >= need) & ~own)
        gained = gained[alive]
        at = essential
        while at < len(order):
            if len(alive) <= 4 * k:  # few are left: probe what remains at once
                rest = order[at:]
                gained = gained + (q[rest] @ self.by_term[np.ix_(rest, alive)] - base[rest].sum())
                break
            step = order[at : at + 4]
            gained = gained + (q[step] @ self.by_term[np.ix_(step, alive)] - base[step].sum())
            at += len(step)
            if len(gained) >= k:
                need = max(need, np.partition(gained, len(gained) - k)[len(gained) - k])
            keep = gained + left[at] >= need
            alive, gained = alive[keep], gained[keep]
        score = np.rint(gained + base.sum()).astype(np.int64)
        best = np.lexsort((self.ids[alive], -score))[:k]
        return [(int(score[b]), int(self.ids[alive[b]])) for b in best]

    def _wide(self, query_id: int, q: np.ndarray, k: int) -> list[tuple[int, int]]:
        """``top`` for sums that floats do not hold: rounding is bounded, what can still enter is summed in Python's integers."""
        other = np.flatnonzero(self.ids != query_id)
        about = q.astype(np.float64) @ self.by_term[:, other]
        off = np.abs(q.astype(np.float64)) @ np.abs(self.by_term[:, other]) * ((len(q) + 8) * 2.0**-52)
        if len(other) > k:
            enter = np.clip(about + off, -MOST, MOST) >= np.sort(np.clip(about - off, -MOST, MOST))[-k]
            other = other[enter]
        asked = [int(x) for x in q]
        exact = lambda i: sum(a * b for a, b in zip(asked, map(int, self.whole[i]), strict=True))
        scored = [(min(max(exact(i), -MOST), MOST), int(self.ids[i])) for i in other]
        return sorted(scored, key=lambda r: (-r[0], r[1]))[:k]


def _distinct(rows: pd.DataFrame, key: str) -> pd.DataFrame:
    """Without rows equal in id and vector."""
    return rows[~pd.DataFrame({"id": rows[key], "v": [np.asarray(v).tobytes() for v in rows["v"]]}).duplicated()]


def _searched(k: int):
    def run(_, queries: pd.DataFrame, shard: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, list]] = []
        if len(queries) and len(shard):
            shard = _distinct(shard, "vec_id")
            index = Shard(shard["vec_id"].to_numpy(np.int64), np.stack(shard["v"].to_numpy()))
            for query_id, q in zip(queries["query_id"].tolist(), queries["v"], strict=True):
                found.append((query_id, index.top(query_id, np.asarray(q), k)))
        rows = [(q, i, s) for q, best in found for s, i in best]
        return pd.DataFrame({"query_id": pd.Series([r[0] for r in rows], dtype="int64"), "vec_id": pd.Series([r[1] for r in rows], dtype="int64"), "score": pd.Series([r[2] for r in rows], dtype="int64")})

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 5) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's ``k`` best by integer inner product among all
    other rows.  ``vectors`` has vec_id, dims and v (see ``quantized``)."""
    ship(vectors.sparkSession)
    n, asked = vectors.agg(F.count(F.lit(1)), F.count(F.when(is_query, 1))).first()
    shards, blocks = max(1, math.ceil(n / SHARD)), max(1, math.ceil(asked / QUERIES))
    every = lambda m, name: F.explode(F.sequence(F.lit(0), F.lit(m - 1))).alias(name)
    dealt = vectors.select("vec_id", "dims", "v", F.pmod(F.xxhash64("vec_id"), F.lit(shards)).cast("int").alias("shard"), every(blocks, "block"))
    asked_rows = vectors.where(is_query).dropDuplicates(["vec_id", "v"])
    queries = asked_rows.select(F.col("vec_id").alias("query_id"), "dims", "v", F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block"), every(shards, "shard"))
    key = ["shard", "block", "dims"]
    found = queries.groupBy(*key).cogroup(dealt.groupBy(*key)).applyInPandas(lambda q, d: _searched(k)(None, q, d), SCHEMA)
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
