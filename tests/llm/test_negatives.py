import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import negatives

LONG = 2**63 - 1


def whole(x):
    return math.floor(256 * x) if abs(x) < 2**53 else 256 * int(x)


def brute(rows, every, n_pos=5, n_neg=10):
    fit = []
    for i, label, v in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            row = (i, label, tuple(whole(float(np.float32(x))) for x in v))
            if row not in fit or i % every:
                fit.append(row)
    out = []
    for a, label, q in fit:
        if a % every:
            continue
        scored = {(min(max(sum(x * y for x, y in zip(q, v)), -LONG), LONG), i, other == label) for i, other, v in fit if i != a and len(v) == len(q)}
        best = sorted(scored, key=lambda r: (-r[0], r[1]))
        for p, i, _ in [r for r in best if r[2]][:n_pos]:
            low, high = -((-30 * p) // 100), 90 * p // 100
            found = [r for r in best if not r[2] and low <= r[0] <= high][:n_neg]
            out += [(a, i, k, j, p, s) for k, (s, j, _) in enumerate(found, 1)]
    return sorted(out)


def run(spark, rows, every):
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<float>").withColumn("cell", F.lit("clash")).withColumn("v", F.lit(1)).withColumn("unit", F.lit(1))
    return sorted(map(tuple, negatives.mine(negatives.quantized(df, F.col("label")), F.col("vec_id") % every == 0).collect()))


def clusters(rng, n, dims=8, kinds=6):
    centres = rng.normal(0, 1, (kinds, dims))
    return [(i, int(rng.integers(0, 4)) if i % 5 == 0 else i % kinds, [float(x) for x in centres[i % kinds] + rng.normal(0, 0.15, dims)]) for i in range(n)]


def odd(rng, rows):
    out = list(rows)
    out += [(5000 + k, 1, rows[3][2]) for k in range(14)] + [(5100 + k, 2, rows[3][2]) for k in range(14)]  # ties
    out += [rows[7]] * 13 + [rows[20]] * 3  # repeated rows, an anchor among them
    out += [(6000, None, rows[0][2]), (6020, 1, None), (6040, 1, [float("nan")] * 8), (6060, 1, [1.0, None] + [0.0] * 6), (6080, 1, [float("inf")] * 8), (None, 1, rows[0][2])]
    out += [(7000 + 10 * k, k % 2, [0.5, 0.25 * k, -0.5]) for k in range(8)]  # another length
    out += [(40, 3, rows[41][2]), (41, 0, rows[40][2])]  # an id with two labels and vectors
    return out


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 7)
    monkeypatch.setattr(negatives, "BATCH", 60)
    rng = np.random.default_rng(4)
    rows = odd(rng, clusters(rng, 400))
    assert run(spark, rows, 20) == brute(rows, 20)


def test_vectors_of_any_size(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ANCHORS", 5)
    rng = np.random.default_rng(6)
    rows = clusters(rng, 120)
    rows += [(1000, 1, [1e30] * 8), (1001, 1, [2e30] * 8), (1002, 2, [1e15] * 8), (1003, 2, [-1e20] * 8), (1020, 1, [3e14] * 8), (1021, 1, [1e-20] * 8)]
    assert run(spark, rows, 20) == brute(rows, 20)


def test_without_a_summary(spark, monkeypatch):
    monkeypatch.setattr(negatives, "SUMMARY", 3)
    rows = clusters(np.random.default_rng(8), 150)
    assert run(spark, rows, 10) == brute(rows, 10)


@pytest.mark.parametrize("rows", [[], [(1, 1, [1.0])], [(20, 1, [1.0])], [(20, 1, [1.0]), (21, 1, [1.0])], [(20, 1, [1.0, 0.0]), (21, 1, [1.0, 0.0]), (22, 2, [0.5, 0.0]), (40, 1, [])]])
def test_few_rows(spark, rows):
    assert run(spark, rows, 20) == brute(rows, 20)


def test_bounds_exclude_rows_of_other_clusters(spark):
    rng = np.random.default_rng(9)  # of one norm, as most embeddings are
    rows = negatives.quantized(spark.createDataFrame([(i, i % 3, [float(x) for x in np.array(v) / np.linalg.norm(v)]) for i, (_, _, v) in enumerate(clusters(rng, 1200))], "vec_id long, label int, embedding array<float>"), F.col("label"))
    where = negatives.space(rows, F.col("vec_id") % 7 == 0)
    anchors = negatives.in_cells(rows.where("vec_id % 7 = 0"), where, True).cache()
    reach = negatives.positive_reach(rows, anchors, where, 5)
    sent, every = 0, 0
    for r in negatives.in_cells(rows, where, False).collect():
        far = where.distances(np.floor(256 * np.array([r["v"]])))[0]
        for (label, cell), most in reach.items():
            if label == r["label"]:
                every += 1
                sent += far[cell] <= most
    assert len(reach) > 3 and 0 < sent < every


def test_best_keeps_ties_by_id_and_drops_repeats():
    rng = np.random.default_rng(1)
    best, seen = negatives.Best(6, 4), [set() for _ in range(6)]
    for _ in range(30):
        own, ids = np.sort(rng.choice(6, 4, replace=False)), rng.integers(0, 50, 25)
        score, fit = rng.integers(-3, 4, (4, 25)), rng.random((4, 25)) < 0.7
        best.offer(own, score, fit, ids)
        for a, row in enumerate(own):
            seen[row] |= {(-int(s), int(i)) for s, i, f in zip(score[a], ids, fit[a]) if f}
    at, ids, score = best.rows()
    assert [(int(a), int(i), int(s)) for a, i, s in zip(at, ids, score)] == [(a, i, -s) for a in range(6) for s, i in sorted(seen[a])[:4]]
