import numpy as np
import pytest
from pyspark.sql import functions as F

from rostrum.llm import near
from rostrum.llm.common import materialize
from rostrum.llm.components import components

from . import corpus


def shingles(t):
    w = (t or "").lower().split()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else frozenset()


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def brute(pairs, threshold=0.8):
    sets = [shingles(t) for _, t in pairs]
    links = [[j for j in range(len(pairs)) if j != i and jaccard(sets[i], sets[j]) >= threshold] for i in range(len(pairs))]
    name = list(range(len(pairs)))
    for _ in pairs:
        for i, js in enumerate(links):
            for j in js:
                name[i] = name[j] = min(name[i], name[j])
    ids = {}
    for i, n in enumerate(name):
        d = pairs[i][0]
        ids.setdefault(n, []).append(d)
    low = {n: min((d for d in ds if d is not None), default=None) for n, ds in ids.items()}
    return sorted(((str(pairs[i][0]), str(low[name[i]]), len(links[i])) for i in range(len(pairs))))


def run(spark, pairs):
    return sorted((str(r["doc_id"]), str(r["class_id"]), r["n_links"]) for r in near.near_join(corpus.frame(spark, pairs)).collect())


def test_against_brute_force(spark):
    pairs = corpus.rows(80)
    assert run(spark, pairs) == brute(pairs)


def test_blocks_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(near, "BLOCK", 7)
    rng = np.random.default_rng(0)
    base = [f"w{i}" for i in range(200)]
    pairs = []
    for i in range(60):
        w = list(base)
        for k in rng.choice(200, 3, replace=False):
            w[k] = f"e{i}_{k}"
        pairs.append((i, " ".join(w)))
    assert run(spark, pairs) == brute(pairs)


def test_chains_are_one_class_and_thresholds_are_inclusive(spark):
    # 9 shingles, 8 shared of 10: exactly 0.8
    a = "a b c d e f g h i j k l m"
    pairs = [(3, a), (2, a[:-1] + "z"), (9, "q r s t u v w x y z 1 2 3 4")]
    assert run(spark, pairs) == brute(pairs)
    words = [f"t{i}" for i in range(300)]
    chain = [(100 + k, " ".join(words[k * 8 : k * 8 + 120])) for k in range(8)]
    assert run(spark, chain) == brute(chain)


def test_one_document_of_each_class_stays(spark):
    pairs = corpus.rows(80)
    kept = near.keep_one(corpus.frame(spark, pairs))
    assert kept.columns == corpus.frame(spark, []).columns
    want = {c for _, c, _ in brute(pairs)}
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == sorted(want)


def test_nothing(spark):
    assert run(spark, []) == []
    assert near.keep_one(corpus.frame(spark, [])).count() == 0


def test_prefixes_are_shortened_as_the_links_ask():
    d = near.shortest()
    assert near.chance(0.8, d) >= near.RECALL > near.chance(0.8, d + 1)
    high, low = {960: 10_000_000}, {960: 10_000_000, 800: 1_000_000}
    assert near.recall_at(9, 12, high, 0.8) >= near.RECALL > near.recall_at(9, 12, low, 0.8)
    assert near.recall_at(d, 12, low, 0.8) >= near.RECALL


def test_tries_connect_what_shares_a_prefix(spark, monkeypatch):
    rng = np.random.default_rng(2)
    rows = [(i, [int(h) for h in rng.integers(0, 3, 4)], [int(x) for x in rng.integers(0, 3, 4) * 256**6 + rng.integers(0, 2, 4)]) for i in range(60)]
    edges = near.forest(spark.createDataFrame(rows, "id long, heads array<long>, tails array<long>").repartition(3), 5)
    got = [(r["a"], r["b"], r["shared"]) for r in edges.collect()]
    for depth in (5, 6, 12):
        name = list(range(60))
        want = list(range(60))
        for _ in range(60):
            for a, b, s in got:
                if s >= depth:
                    name[a] = name[b] = min(name[a], name[b])
        same = lambda x, y: any(h == k and (depth == 5 or s >> 48 == t >> 48) and (depth < 12 or s == t) for h, s in zip(*rows[x][1:]) for k, t in zip(*rows[y][1:]))  # noqa: E731, B023
        for _ in range(8):
            for x in range(60):
                for y in range(x):
                    if same(x, y):
                        want[x] = want[y] = min(want[x], want[y])
        assert name == want


def test_large_groups_of_few_kinds(spark, monkeypatch):
    """Copies edited apart: common kinds, and pairs that only rare shingles decide."""
    monkeypatch.setattr(near, "BLOCK", 20)
    monkeypatch.setattr(near, "RARE", 3)
    monkeypatch.setattr(near, "KINDS", 9)
    rng = np.random.default_rng(1)
    base = [f"w{i}" for i in range(60)]
    pairs = []
    for i in range(120):
        w = list(base)
        for k in rng.choice(60, rng.integers(1, 3), replace=False):
            w[k] = f"e{rng.integers(0, 6)}"
        pairs.append((i, " ".join(w)))
    pairs += [(200 + i, pairs[i][1]) for i in range(0, 30, 3)]
    assert run(spark, pairs) == brute(pairs)


def test_recall_against_exact_pairs(spark):
    """Pairs at and above the threshold, most of them near it."""
    rng = np.random.default_rng(3)
    pairs = []
    for k in range(150):
        w = [f"v{k}_{i}" for i in range(100)]
        e = list(w)
        for at in rng.choice(20, rng.integers(1, 3), replace=False):
            e[at * 5 + 2] = f"x{k}_{at}"
        pairs += [(2 * k, " ".join(w)), (2 * k + 1, " ".join(e))]
    want = {r[0]: r[2] for r in brute(pairs)}
    got = {r[0]: r[2] for r in run(spark, pairs)}
    assert sum(got.values()) >= 0.999 * sum(want.values()) > 0


def test_components_of_a_long_path(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).union(spark.createDataFrame([(1000, 2000), (5, 5)], "a long, b long"))
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 2000: 1000}


def test_components_take_few_rounds_whatever_the_ids(spark, monkeypatch):
    from rostrum.llm import components as module

    written = []
    monkeypatch.setattr(module, "materialize", lambda df, label="": written.append(label) or materialize(df, label))
    name = np.random.default_rng(3).permutation(3001).tolist()
    edges = spark.createDataFrame([(name[i], name[i + 1]) for i in range(3000) if i != 1000] + [(9000 + k, 9999) for k in range(200)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {v: min(part) for part in (name[:1001], name[1001:]) for v in part} | {9000 + k: 9000 for k in range(200)} | {9999: 9000}
    assert written.count("joined") <= 20


@pytest.mark.parametrize("rest", [0, 50, 1 << 16])
def test_the_rest_of_a_graph_takes_no_rounds(spark, monkeypatch, rest):
    from rostrum.llm import components as module

    written = []
    monkeypatch.setattr(module, "REST", rest)
    monkeypatch.setattr(module, "materialize", lambda df, label="": written.append(label) or materialize(df, label))
    name = np.random.default_rng(7).permutation(401).tolist()
    edges = spark.createDataFrame([(name[i], name[i + 1]) for i in range(400) if i != 150] + [(900 + k, 999) for k in range(60)] + [(999, 900)], "a long, b long")
    got = {r["id"]: r["component"] for r in components(edges).collect()}
    assert got == {v: min(part) for part in (name[:151], name[151:]) for v in part} | {900 + k: 900 for k in range(60)} | {999: 900}
    assert (written.count("joined") == 0) == (rest > 50) and (written.count("rest") == 1) == (rest > 0) and written.count("joined") <= 20


def test_components_against_sets(spark):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 400, (260, 2))]
    part = {v: {v} for e in edges if e[0] != e[1] for v in e}
    for a, b in edges:
        if a != b and part[a] is not part[b]:
            part[a] |= part[b]
            part |= {v: part[a] for v in part[a]}
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {v: min(p) for v, p in part.items()}
    assert components(spark.createDataFrame([(1, 1)], "a long, b long")).collect() == []


def test_overlaps_agree_with_sets():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 90, rng.integers(1, 60)).astype(np.uint64)) for _ in range(30)]
    r, c = np.nonzero(np.ones((30, 30), bool))
    assert near.overlaps(sets, r, c).tolist() == [len(np.intersect1d(sets[a], sets[b])) for a, b in zip(r, c)]
