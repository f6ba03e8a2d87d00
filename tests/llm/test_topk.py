import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import topk


def brute(rows, every, k):
    fit = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            fit[i] = [int(np.floor(256 * float(np.float32(x)))) for x in v]
    out = []
    for q in (i for i in fit if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(fit[q], v)), i) for i, v in fit.items() if i != q and len(v) == len(fit[q]))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows, every=5, k=5):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit(1)).withColumn("v", F.lit("clash"))
    return sorted(map(tuple, topk.top_k(topk.quantized(df), F.col("vec_id") % every == 0, k).collect()))


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk, "SHARD", 40)
    monkeypatch.setattr(topk, "QUERIES", 10)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in rng.normal(0, 0.3, 16)]) for i in range(200)]
    rows += [(200 + i, rows[3][1]) for i in range(9)]  # ties
    rows += [(300, None), (305, [float("nan")] * 16), (310, [1.0, None] + [0.0] * 14), (315, [float("inf")] * 16), (None, rows[0][1]), rows[7], rows[10]]
    assert run(spark, rows) == brute(rows, 5, 5)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_rows(spark, n):
    rows = [(5 * i, [0.1 * i, 1.0]) for i in range(n)]
    assert run(spark, rows) == brute(rows, 5, 5)


def test_a_shard_prunes_and_stays_exact():
    rng = np.random.default_rng(2)
    for heavy in (1, 50):
        x = rng.integers(-60, 60, (500, 24)) * np.r_[heavy, np.ones(23, int)]
        shard = topk.Shard(np.arange(500), x)
        for q in range(20):
            s = x @ x[q]
            s[q] = np.iinfo(int).min
            want = sorted((-int(v), i) for i, v in enumerate(s))[:5]
            assert shard.top(q, x[q], 5) == [(-v, i) for v, i in want]
