import math
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from rostrum.llm import mixing, sharding

from . import corpus


def placed(spark, pairs, n=4):
    return sharding.shards(corpus.frame(spark, pairs), n_shards=n).collect()


def test_every_row_has_a_shard_and_a_slot_without_gaps(spark):
    pairs = corpus.rows(120)
    got = placed(spark, pairs)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in pairs)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_bytes_are_even_and_equal_texts_stay_together(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = sharding.shards(docs, n_shards=8)
    sums = [r[0] for r in got.groupBy("shard").agg(F.sum("size")).select("sum(size)").collect()]
    assert len(sums) == 8 and max(sums) / (sum(sums) / 8) < 1.02
    groups = got.join(docs.select("doc_id", F.md5("text").alias("m")), "doc_id").groupBy("m").agg(F.count_distinct("shard").alias("n")).where("n > 1").count()
    assert groups == 0


def test_links_are_cut_less_than_by_chance(spark):
    import random

    rng = random.Random(3)
    pairs = []
    for g in range(150):
        head = " ".join(corpus.words(rng, 60))
        pairs += [(g * 10 + k, head + " " + " ".join(corpus.words(rng, 60))) for k in range(3)]
    got = {r["doc_id"]: r["shard"] for r in placed(spark, pairs, 4)}
    together = sum(len({got[g * 10 + k] for k in range(3)}) == 1 for g in range(150))
    assert together > 90  # by chance 1/16 of 150


def test_a_group_over_a_shard_is_split_and_sizes_stay_even(spark):
    pairs = [(i, "the same text in very many rows " * 5) for i in range(400)] + [(1000 + i, f"text number {i} " * (5 + i % 9)) for i in range(400)]
    got = placed(spark, pairs, 8)
    sums = Counter()
    for r in got:
        sums[r["shard"]] += r["size"]
    assert max(sums.values()) < 1.05 * sum(sums.values()) / 8


def test_sharding_of_nothing(spark):
    assert placed(spark, []) == []


def brute_exponent(shares, target, limit):
    def fits(a):
        w = [p**a for p in shares]
        z = sum(w)
        h = -sum(x / z * math.log(x / z) for x in w)
        r = [x / p for x, p in zip(w, shares)]
        return h >= target * math.log(len(shares)) - 1e-12, max(r) / min(r) <= limit + 1e-12

    grid = [k / 20000 for k in range(20001)]
    flat = max((a for a in grid if fits(a)[0]), default=0.0)
    least = min((a for a in grid if fits(a)[1]), default=1.0)
    return max(flat, least)


@pytest.mark.parametrize("target,limit", [(0.97, 2.0), (0.999, 100.0), (0.5, 1.5), (1.0, 1.0)])
def test_exponent_is_bisected(spark, target, limit):
    shares = [0.5, 0.2, 0.15, 0.1, 0.05]
    got = mixing.exponent(spark.createDataFrame([(p,) for p in shares], "share double"), target, limit)
    assert got == pytest.approx(brute_exponent(shares, target, limit), abs=2e-4)


def test_mixture_meets_its_budgets(spark):
    pairs = corpus.rows(200)
    docs = corpus.frame(spark, pairs).withColumn("source", F.when(F.col("doc_id") % 10 < 7, "big").when(F.col("doc_id") % 10 < 9, "mid").otherwise("low"))
    got = mixing.mix(docs, 0.99, 3.0)
    assert [c for c in got.columns if c not in mixing.OUTPUTS] == [c for c in docs.columns if c not in mixing.OUTPUTS]
    rows = got.collect()
    seen = Counter((r["doc_id"], r["text"]) for r in rows)
    assert set(seen) == set(pairs)  # nothing is lost
    tokens, weight = Counter(), {}
    for r in rows:
        assert r["tokens"] == len((r["text"] or "").split())
        assert 0 <= r["schedule"] <= 1
        tokens[r["source"]] += r["tokens"]
        weight[r["source"]] = r["weight"]
    total = sum(tokens.values())
    once = Counter()
    for r in docs.collect():
        once[r["source"]] += len((r["text"] or "").split())
    largest = max(len((t or "").split()) for i, t in pairs if (i or 0) % 10 >= 7)
    for s in weight:  # to within the document at the end of the last pass
        if once[s]:
            assert abs(tokens[s] - weight[s] * total) <= 2 * largest + 0.02 * total
    assert max(r["copy"] for r in rows) <= 3


def test_mixture_under_a_given_budget_and_of_nothing(spark):
    docs = corpus.frame(spark, [(i, "w " * 20) for i in range(500)])
    assert mixing.mix(docs, budget=5000).agg(F.sum("tokens")).first()[0] == pytest.approx(5000, rel=0.05)
    assert mixing.mix(docs.limit(0)).count() == 0


def test_a_blank_source_is_read_once(spark):
    docs = spark.createDataFrame([(1, "", "a"), (2, None, None), (3, "some words here", "b")], "doc_id long, text string, source string")
    assert sorted(r["doc_id"] for r in mixing.mix(docs).collect()) == [1, 2, 3]
