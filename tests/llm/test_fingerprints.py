import hashlib

import pytest
from pyspark.sql import functions as F

from rostrum.llm import fingerprints as fp
from rostrum.llm.queries import op4_fingerprints

from . import corpus
from .test_near import jaccard


def shingles(t):
    w = (t or "").split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def test_next_rows_and_likeness(spark, tmp_path):
    pairs = [(i, t) for i, t in corpus.rows(90) if i is not None]
    corpus.frame(spark, pairs).write.parquet(str(tmp_path / "documents.parquet"))
    got = op4_fingerprints(spark, str(tmp_path)).collect()
    assert len(got) == len(pairs)
    # a repeated row stands beside its twin
    order = [(i, t or "") for i, t in sorted(pairs, key=lambda p: -p[0])]
    after = {p: order[(k + 1) % len(order)][1] for k, p in enumerate(order)}
    text = {i: t for i, t in order}
    for r in got:
        t = text[r["doc_id"]]
        n = len(t) // 3
        edits = {t[: len(t) - n] + u[:n] for u in (after[r["doc_id"], t], t)}
        edited = [e for e in edits if hashlib.sha256(e.encode()).hexdigest() == r["edited_sha256"]]
        assert edited and r["n_chars"] == len(t)
        assert r["near_edited"] == pytest.approx(jaccard(shingles(t), shingles(edited[0])), abs=0.2)
        assert 0 <= r["near_next"] <= 1
        if r["doc_id"] not in (1000, 1001):
            assert r["near_next"] == pytest.approx(jaccard(shingles(t), shingles(after[r["doc_id"], t])), abs=0.2)


def test_equal_texts_have_equal_fingerprints(spark):
    rows = fp.fingerprints(corpus.frame(spark, corpus.rows(40)), out="packed").select(F.coalesce("text", F.lit("")).alias("t"), F.hex("packed").alias("p")).collect()
    seen = {}
    for r in rows:
        assert seen.setdefault(r["t"], r["p"]) == r["p"]
        assert len(r["p"]) == (0 if not r["t"].split() else 2 * fp.BINS)


def test_estimates_are_unbiased(spark):
    import random

    rng = random.Random(5)
    pairs, want = [], []
    for i in range(120):
        a = [f"w{rng.randrange(10**6)}" for _ in range(rng.choice([30, 120, 500]))]
        k = int(len(a) * rng.random())
        b = a[:k] + [f"v{rng.randrange(10**6)}" for _ in range(len(a) - k)]
        pairs.append((" ".join(a), " ".join(b)))
        want.append(jaccard(shingles(pairs[-1][0]), shingles(pairs[-1][1])))
    df = spark.createDataFrame(pairs, "a string, b string").select(fp.fingerprint(F.col("a")).alias("fa"), fp.fingerprint(F.col("b")).alias("fb"))
    got = [r[0] for r in df.select(fp.likeness(F.col("fa"), F.col("fb"))).collect()]
    errors = [g - w for g, w in zip(got, want)]
    assert abs(sum(errors) / len(errors)) < 0.015 and max(map(abs, errors)) < 0.2


def test_nothing_and_one(spark):
    df = corpus.frame(spark, [])
    assert fp.with_next(df, ["text"]).count() == 0
    one = fp.with_next(corpus.frame(spark, [(5, "only")]), ["text"]).collect()
    assert [r["next_text"] for r in one] == ["only"]
    nulls = fp.with_next(corpus.frame(spark, [(None, "c"), (9, "a"), (4, "b")]), ["text"]).collect()
    assert {r["text"]: r["next_text"] for r in nulls} == {"a": "b", "b": "c", "c": "a"}


@pytest.mark.parametrize("n", [0, 1, 2, 7, 100])
def test_ranges_are_those_of_bisection(spark, n):
    from bisect import bisect_left

    cuts = [3 * k - 50 for k in range(n)]
    rows = spark.range(-60, 300).select("id", fp.range_of(F.col("id"), cuts).alias("r")).collect()
    assert [(r["id"], r["r"]) for r in rows] == [(r["id"], bisect_left(cuts, r["id"])) for r in rows]
