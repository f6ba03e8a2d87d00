import numpy as np
from pyspark.sql import functions as F

from rostrum.llm import topk


def brute(rows, every, k):
    fit = {(i, tuple(int(np.floor(256 * float(np.float32(x)))) for x in v)) for i, v in rows}
    out = []
    for q in {i for i, _ in fit if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(u, v)), i) for j, u in fit if j == q for i, v in fit if i != q)
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:k])]
    return sorted(out)


def run(spark, rows):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    return sorted(map(tuple, topk.top_k(topk.quantized(df), F.col("vec_id") % 5 == 0, 5).collect()))


def test_large_components_take_part(spark):
    rng = np.random.default_rng(4)
    for scale in (2e5, 3e6):
        rows = [(i, [float(x) for x in rng.normal(0, scale, 6)]) for i in range(60)]
        rows += [(60 + i, [1e6, 1e6 + i % 2, 0.0, 0.0, 0.0, 0.0]) for i in range(20)]  # sums that differ past 2^53
        assert run(spark, rows) == brute(rows, 5, 5)


def test_an_id_with_several_vectors_keeps_them(spark):
    rng = np.random.default_rng(5)
    rows = [(i % 20, [float(x) for x in rng.normal(0, 0.3, 8)]) for i in range(50)]
    assert run(spark, rows + rows[:7]) == brute(rows, 5, 5)


def test_wide_scores_are_exact():
    rng = np.random.default_rng(6)
    x = rng.integers(-(1 << 29), 1 << 29, (300, 8)) + (1 << 29)
    shard = topk.Shard(np.arange(300), x)
    for q in range(10):
        want = sorted((-sum(int(a) * int(b) for a, b in zip(x[q], v)), i) for i, v in enumerate(x) if i != q)[:5]
        assert shard.top(q, x[q], 5) == [(-s, i) for s, i in want]


def test_what_no_integer_holds_counts_as_the_nearest(spark):
    most = topk.MOST
    near = lambda x: min(max(x, -most), most)
    rows = [(5, [1e30, 0.0]), (6, [1.0, 0.0]), (7, [-1e30, 1.0]), (10, [1e8, 1e8]), (11, [1e8, 1e8]), (12, [2e8, 3e8]), (13, [-1e20, 2.0]), (15, [0.5, -1e9]), (20, [0.0, 1.0])]
    fit = {i: [near(int(256 * float(np.float32(x))) if x % 1 == 0 else int(np.floor(256 * x))) for x in v] for i, v in rows}
    want = []
    for q in (i for i in fit if i % 5 == 0):
        scored = sorted((-near(sum(a * b for a, b in zip(fit[q], v))), i) for i, v in fit.items() if i != q)
        want += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored[:5])]
    assert run(spark, rows) == sorted(want)
