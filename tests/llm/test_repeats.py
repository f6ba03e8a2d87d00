import hashlib
import random
import re

import numpy as np
import pytest

from rostrum.llm import repeats

from . import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(pairs, k=13):
    rows = [((1 << 63) if i is None else i, WORD.findall(t or ""), i) for i, t in pairs]
    first = {}
    for i, w, _ in rows:
        for a in range(len(w) - k + 1):
            x = tuple(w[a : a + k])
            first[x] = min(first.get(x, i), i)
    out = []
    for i, w, d in rows:
        gone = [False] * len(w)
        for a in range(len(w) - k + 1):
            if first[tuple(w[a : a + k])] < i:
                gone[a : a + k] = [True] * k
        kept = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((str(d), len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out)


def run(spark, pairs):
    got = repeats.remove_repeats(corpus.frame(spark, pairs).repartition(3)).collect()
    return sorted((str(r["doc_id"]), r["n_words"], r["n_removed"], r["kept_sha256"]) for r in got)


@pytest.mark.parametrize("chunk", [50, 600_000])
def test_against_brute_force(spark, monkeypatch, chunk):
    monkeypatch.setattr(repeats, "CHUNK", chunk)
    pairs = corpus.rows(90)
    assert run(spark, pairs) == brute(pairs)


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_few_words_many_runs(spark, seed):
    rng = random.Random(seed)
    pairs = [(i, " ".join(rng.choice("ab") if rng.random() < 0.8 else rng.choice("abc") * rng.randint(1, 3) for _ in range(rng.randint(0, 90)))) for i in range(40)]
    pairs += [(100 + i, " ".join(["run"] * n)) for i, n in enumerate([12, 13, 14, 30, 25])]
    assert run(spark, pairs) == brute(pairs)


def test_texts_of_one_id_do_not_erase_each_other(spark):
    a = " ".join(f"w{i}" for i in range(40))
    pairs = [(5, a), (5, a + " end"), (7, "x " + a), (7, "x " + a), (2, "none of it here at all")]
    assert run(spark, pairs) == brute(pairs)


def test_nothing(spark):
    assert run(spark, []) == []


def test_anchors_depend_on_the_window_alone():
    rng = np.random.default_rng(0)
    vocabulary = rng.integers(0, 2**63, 6).astype(np.uint64)
    text = vocabulary[rng.choice(6, 4000, p=[0.5, 0.2, 0.1, 0.1, 0.05, 0.05])]
    is_window, anchor, place = repeats.anchors(text, np.zeros(len(text), int), 13, *repeats.named(text, np.zeros(len(text), int)))
    for a in rng.choice(np.flatnonzero(is_window), 300):
        part = text[a : a + 13].copy()
        alone = repeats.anchors(part, np.zeros(13, int), 13, *repeats.named(part, np.zeros(13, int)))
        assert alone[1][0] == anchor[a] and alone[2][0] == (place[a] - a if place[a] >= 0 else -1)


def test_kept_words_are_given(spark):
    a = " ".join(f"w{i}" for i in range(20))
    got = {r["doc_id"]: r["kept"] for r in repeats.remove_repeats(corpus.frame(spark, [(1, a), (2, "before " + a + " after")]), with_text=True).collect()}
    assert got[2] == "before after"


def test_long_repeats_share_their_highest_symbols():
    rng = np.random.default_rng(1)
    words = lambda n: rng.integers(0, 2**63, n).astype(np.uint64)
    passage = words(3000)
    texts = [np.concatenate([words(50), passage, words(70)]), np.concatenate([words(400), passage, words(9)])]
    found = []
    for t in texts:
        doc = np.zeros(len(t), int)
        name, first, last = repeats.risen(*(lambda low, start, end: (low, doc, start, end))(*repeats.named(t, doc)), repeats.LEVELS - 1)
        assert first[0] == 0 and last[-1] == len(t) - 1 and (first[1:] == last[:-1] + 1).all() and len(name) < len(t) / 30
        found.append({int(x): int(b - a + 1) for x, a, b in zip(name, first, last)})
    shared = sum(n for x, n in found[0].items() if found[1].get(x) == n)
    assert 2000 < shared <= 3000


def test_a_task_holds_one_lot_at_a_time(spark, monkeypatch):
    """Ten times the lots hold a tenth of the units each, with the same result."""
    pairs = corpus.rows(60)
    seen = []
    lots = repeats._lots
    monkeypatch.setattr(repeats, "SUB", 1)
    few = run(spark, pairs)
    monkeypatch.setattr(repeats, "SUB", 10)
    assert run(spark, pairs) == few == brute(pairs)
    import pyarrow as pa

    rows = [repeats._row(k // 3, repeats._UNITS, b"%d" % k) for k in range(9)] + [repeats._row(9, repeats._DOCUMENT, None, 1, 0, 2, "x")]
    for held, other in lots([repeats._batch(rows[:4], repeats._FIRST), repeats._batch(rows[4:], repeats._FIRST)], repeats._UNITS):
        seen.append(([int(x) for x in held], len(other)))
    assert [h for h, _ in seen if h] == [[0, 1, 2], [3, 4, 5], [6, 7, 8]] and sum(n for _, n in seen) == 1
    assert isinstance(repeats._batch(rows, repeats._FIRST), pa.RecordBatch)
