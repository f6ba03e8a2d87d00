"""Properties of the pure parts, over drawn inputs."""

import numpy as np
from hypothesis import given, settings, strategies as st

from rostrum.llm import near, packing, repeats
from rostrum.llm.tokens import windows

SOME = settings(max_examples=60, deadline=None)


@SOME
@given(st.lists(st.integers(1, 90), max_size=40), st.integers(1, 6), st.integers(0, 8))
def test_packing_keeps_every_id_in_order(sizes, limit, slack):
    packer = packing.Packer(0, 32, limit, slack)
    closed = []
    streams = {}
    for doc, n in enumerate(sizes):
        streams[doc] = np.arange(n, dtype="<u4").tobytes()
        closed += list(packer.add(doc, streams[doc]))
    left = [p for _, pieces in packer.leftovers() for p in pieces]
    closed += list(packing.merged(iter(left), 10_000, 32))
    assert len({n for n, _ in closed}) == len(closed)
    got = {}
    for _, pieces in closed:
        assert sum(len(p[2]) for p in pieces) <= 4 * 32
        for doc, start, ids, total in pieces:
            assert total == sizes[doc]
            got.setdefault(doc, []).append((start, ids))
    assert {d: b"".join(ids for _, ids in sorted(p)) for d, p in got.items()} == streams


@SOME
@given(st.lists(st.integers(0, 3), min_size=13, max_size=120), st.lists(st.integers(0, 3), max_size=30), st.lists(st.integers(0, 3), max_size=30))
def test_an_equal_window_has_an_equal_anchor_anywhere(body, before, after):
    name = np.array([11, 222, 3333, 44444], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    alone = name[body]
    inside = name[before + body + after]
    a, b = (repeats.anchors(x, np.zeros(len(x), int), 13) for x in (alone, inside))
    n = len(body) - 12
    k = len(before)
    assert (a[1][:n] == b[1][k : k + n]).all()
    p, q = a[2][:n], b[2][k : k + n]
    assert (np.where(p >= 0, p, -1) == np.where(q >= 0, q - k, -1)).all()


@SOME
@given(st.lists(st.integers(0, 5), max_size=60), st.integers(1, 13))
def test_window_hashes_tell_windows_apart(words, k):
    h = (np.array(words, np.uint64) + np.uint64(1)) * np.uint64(0xBF58476D1CE4E5B9)
    for f in (lambda: repeats.window_hashes(h, k), lambda: windows(h, k)):
        got = f()
        runs = [tuple(words[i : i + k]) for i in range(len(words) - k + 1)]
        assert len(got) == len(runs)
        assert len(set(zip(runs, got.tolist()))) == len(set(runs)) == len(set(got.tolist()))


@SOME
@given(st.lists(st.sampled_from(["a", "b", "c", "d e", " ", "\n"]), max_size=40))
def test_shingles_are_those_of_the_words(parts):
    text = " ".join(parts)
    w = text.split()
    want = {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()
    assert len(near.shingles(text)) == len(want)
