"""Operators that SQL can't express, held to slow versions of themselves in plain Python."""

import math
import random
import struct

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from rostrum.llm import fingerprints as fp, langid, sharding

from . import corpus

SEED = 42


def chained(*values):
    """Spark's hash of several values: each one's hash seeds the next."""
    h = SEED
    for kind, v in values:
        data = v.encode() if kind == "string" else struct.pack({"long": "<q", "int": "<i"}[kind], v)
        h = xxhash.xxh64_intdigest(data, h)
    return h


def signed(h):
    return h - (1 << 64) if h >> 63 else h


def slow_fingerprint(text):
    words = (text or "").split()
    if not words:
        return b""
    runs = [words] if len(words) < fp.WORDS else [words[i : i + fp.WORDS] for i in range(len(words) - fp.WORDS + 1)]
    least = {}
    for run in runs:
        h = chained(*[("string", w) for w in run])
        least[h >> 56] = min(h, least.get(h >> 56, h))
    out = []
    for b in range(fp.BINS):
        if b in least:
            out.append(least[b] & 255)
            continue
        drawn = [chained(("long", b), ("int", k)) % fp.BINS for k in range(1, fp.DRAWS + 1)]
        drawn = [d for d in drawn if d in least]
        lender = drawn[0] if drawn else min(least, key=lambda f: (signed(chained(("long", b), ("long", f))), least[f] & 255))
        out.append(least[lender] & 255)
    return bytes(out)


def test_bins_and_densification(spark):
    docs = corpus.frame(spark, corpus.rows(40))
    got = docs.select("text", fp.fingerprint(F.col("text")).alias("packed")).collect()
    assert {len((r["text"] or "").split()) for r in got} >= {0, 1}
    for r in got:
        assert bytes(r["packed"]) == slow_fingerprint(r["text"]), (r["text"] or "")[:60]


@pytest.mark.parametrize("lot", [sharding.LOT, 5])
def test_votes_of_one_round(spark, monkeypatch, lot):
    monkeypatch.setattr(sharding, "LOT", lot)  # the smaller one makes hot links, which are salted
    monkeypatch.setattr(sharding, "HOT", 10**6)
    rng, n = random.Random(2), 4
    nodes = [(k, sorted({rng.choice([1, rng.randrange(2, 60)]) for _ in range(rng.randint(0, 6))})) for k in range(120)]
    shard = {k: rng.randrange(n) for k, _ in nodes}
    table = spark.createDataFrame(nodes, "node long, links array<long>")
    at = spark.createDataFrame(list(shard.items()), "node long, shard int")
    got = {r["node"]: r["votes"] for r in sharding._votes(sharding._ends(table).join(at, "node"), n).collect()}
    members = {}
    for k, own in nodes:
        for link in own:
            members.setdefault(link, []).append(k)
    assert max(map(len, members.values())) > 5
    want = {}
    for k, own in nodes:
        for link in own:
            others = [m for m in members[link] if m != k]
            if others:
                votes = want.setdefault(k, [0] * n)
                for m in others:
                    votes[shard[m]] += max(1, sharding.VOTE // len(others))
    assert got == want


def test_a_round_moves_towards_neighbours_within_capacity(spark):
    rng, n, slack = random.Random(3), 4, 0.1
    nodes = [(k, [k // 6, 1000 + rng.randrange(20)]) for k in range(240)]
    shard = {k: rng.randrange(n) for k, _ in nodes}
    size = {k: rng.randint(50, 150) for k, _ in nodes}
    start = spark.createDataFrame([(k, size[k], True, shard[k]) for k, _ in nodes], "node long, bytes long, movable boolean, shard int")
    state = start.join(sharding._ends(spark.createDataFrame(nodes, "node long, links array<long>")), "node")
    votes = {r["node"]: r["votes"] for r in sharding._votes(state, n).collect()}
    mean = sum(size.values()) / n
    before = [sum(size[k] for k in shard if shard[k] == s) for s in range(n)]
    after, _ = sharding._round(state, [0] * n, n, mean, 0, slack)
    to = {r["node"]: r["shard"] for r in after.select("node", "shard").collect()}
    moved = [k for k in to if to[k] != shard[k]]
    assert moved and set(to) == set(shard)
    for k in moved:
        assert votes[k][to[k]] == max(votes[k]) > votes[k][shard[k]]
    load = [sum(size[k] for k in to if to[k] == s) for s in range(n)]
    for s in range(n):  # within the quotas, or not further from them than before
        assert load[s] <= max(before[s], mean * (1 + slack)) and load[s] >= min(before[s], mean * (1 - slack))


def slow_states(d, window):
    size = d.inner.shape[0]
    h, out = [0.0] * size, []
    for byte in window:
        e = d.table[byte].astype(float)
        gate = [min(1.0, max(0.0, 0.25 * (e[j] + sum(h[i] * float(d.gates[i, j]) for i in range(size))) + 0.5)) for j in range(2 * size)]
        c = [math.tanh(e[2 * size + j] + sum(gate[i] * h[i] * float(d.inner[i, j]) for i in range(size))) for j in range(size)]
        h = [c[j] + gate[size + j] * (h[j] - c[j]) for j in range(size)]
        out.append(h)
    return out


def slow_pooled(model, text):
    raw, sums = text.encode(), np.zeros(len(model.labels))
    for k in range(0, len(raw), langid.SPAN):
        part = raw[k : k + langid.SPAN]
        window = part.ljust(langid.SPAN)
        f, b = slow_states(model.forward, window), slow_states(model.backward, window[::-1])[::-1]
        for t in range(len(part)):
            y = np.array(f[t] + b[t]) @ model.out.astype(float) + model.bias
            p = np.exp(y - y.max())
            sums += p / p.sum()
    return sums / len(raw)


def test_every_position_is_labelled_and_pooled():
    rng = random.Random(4)
    model = langid.fit([b"aaaa bbbb " * 8, b"cccc dddd " * 8, b"eeee aaaa " * 8] * 4, ["x", "y", "z"] * 4, hidden=4, steps=30)
    texts = ["a", "é aaaa", "".join(rng.choice("abcde ") for _ in range(63)) + "a", "".join(rng.choice("abcde ") for _ in range(65)) + "a", "aaaa " * 60 + "dddd " * 41]
    names, scores = model.predict(texts)
    for text, name, score in zip(texts, names, scores):
        pooled = slow_pooled(model, text)
        assert model.labels[int(pooled.argmax())] == name
        assert score == pytest.approx(pooled.max(), abs=1e-4)


def test_equal_windows_have_equal_results_wherever_they_stand():
    rng = np.random.default_rng(5)
    model = langid.fit([b"aaaa bbbb " * 8, b"cccc dddd " * 8] * 4, ["x", "y"] * 4, steps=60)
    x = rng.choice(np.frombuffer(b"abcd ", np.uint8), (langid.SPAN, 700))
    alone = model.positions(np.ascontiguousarray(x))
    for n, shift in [(1, 0), (3, 0), (140, 0), (700, 1), (700, 37), (700, 333)]:
        again = model.positions(np.ascontiguousarray(np.roll(x, shift, 1)[:, :n]))
        assert (again == np.roll(alone, shift, 1)[:, :n]).all()
