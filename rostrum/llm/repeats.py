"""Substring dedup by recompression: consistent names for runs and pairs of words find the windows of
``WINDOW`` words that also start in a document with a smaller id.

Naming rounds, over all documents: a maximal run of one symbol gets the name of (symbol, length); then of
two neighbouring runs, the first of a "left" symbol and the second of a "right" one, the pair gets the
name of both.  Names are 64-bit hashes of what they stand for, so they are the same everywhere without
a shared dictionary.  Each round shortens the strings by about a quarter; after ``LEVELS`` rounds a symbol
stands for a hundred words or so, and equal passages have equal symbols but for those at their ends.
Texts meet in Spark twice, by the names of two levels:

1. by the symbols of the highest level: where documents share one, and a second hash of its words agrees,
   all windows inside are repeats, except in the document of the smallest id.  Long repeats end here;
2. by second-level symbols, for all windows that are left.  Whether a symbol forms depends on the symbols
   beside it, and those on the words beside them: its context.  Of the second-level symbols whose context
   lies within a window, the one with the least hash is the window's anchor; a window too repetitive to have
   one is its own.  Neighbouring windows with one anchor make a unit.  Equal units of an anchor: all but those
   of the smallest id are repeats, whole; an anchor with different units (where copies begin, end or differ):
   the units' first documents are compared window by window, by 128 bits of hash.

A task takes the symbols and units that it deals with in ``SUB`` lots, one at a time, as they come sorted.
A very frequent passage reaches a reducer once for each chunk of input, not once for each document.
Texts are shuffled once, and only those in question are kept.

Defined cases: a null text has no words; fewer than ``WINDOW`` words make no window; a window repeated
within one document, or in another row of the same doc_id, is not a repeat; null ids count as larger
than all others; repeated rows get equal results each; extra columns are dropped; an empty table gives
an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_batches, materialize, partitions
from .tokens import hash_words, joined, mix

WINDOW = 13
#: Words that one step of a task holds.
CHUNK = 600_000
#: Naming rounds; the symbols of the last one find long repeats.
LEVELS = 16
#: Lots of a partition that a task holds one at a time.
SUB = 16
#: Units that a task gathers before it deals them out.
DEALT = 400_000
LAST = (1 << 63) - 1
_BASE = np.uint64(0xD1342543DE82EF95)
_BACK = np.uint64(pow(0xD1342543DE82EF95, -1, 1 << 64))


def words_of(text: str | None) -> list[bytes]:
    """Runs of bytes other than 0x20 and 0x09 to 0x0D, which is what ``bytes.split`` gives."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def window_hashes(h: np.ndarray, window: int) -> np.ndarray:
    """Hash of the window that starts at each of the first ``len(h) - window + 1`` words."""
    n = len(h) - window + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    with np.errstate(over="ignore"):
        power = np.cumprod(np.full(len(h), _BASE, np.uint64))
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)])
        back = np.cumprod(np.full(n, _BACK, np.uint64))
        return mix((total[window:] - total[:n]) * back)


def named(name: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One round of recompression: names of the next level's symbols, and the first and last item of each."""
    fresh = np.ones(len(name), bool)
    fresh[1:] = (name[1:] != name[:-1]) | (doc[1:] != doc[:-1])
    first = np.flatnonzero(fresh)
    last = np.r_[first[1:], len(name)] - 1
    base = name[first]
    up = joined(base, (last - first + 1).astype(np.uint64))
    left = (mix(base + np.uint64(0xABCD)) & np.uint64(1)).astype(bool)
    pair = np.zeros(len(first), bool)
    pair[:-1] = left[:-1] & ~left[1:] & (doc[first[1:]] == doc[first[:-1]])
    second = np.r_[False, pair[:-1]]
    at = np.flatnonzero(pair)
    up[at] = joined(up[at], up[at + 1])
    last[at] = last[at + 1]
    return up[~second], first[~second], last[~second]


def risen(name: np.ndarray, doc: np.ndarray, start: np.ndarray, end: np.ndarray, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Names, first and last words of the symbols after ``rounds`` more rounds."""
    for _ in range(rounds):
        name, first, last = named(name, doc[start])
        start, end = start[first], end[last]
    return name, start, end


def _spanned(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums and powers by which ``_content`` names any run of words."""
    power = np.cumprod(np.full(len(h), _BASE, np.uint64))
    return np.concatenate([np.zeros(1, np.uint64), np.cumsum(h * power, dtype=np.uint64)]), np.cumprod(np.full(len(h), _BACK, np.uint64))


def _content(total: np.ndarray, back: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    return mix((total[last + 1] - total[first]) * back[first])


def anchors(h: np.ndarray, doc: np.ndarray, window: int, low: np.ndarray | None = None, start: np.ndarray | None = None, end: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each word position: is it the start of a window, the name of the window's anchor, and the position
    at which the anchor's context begins (-1 where the window is its own anchor).  ``low``, ``start`` and ``end`` are
    the names, first and last words of the first level's symbols; they are made here if not given."""
    n = len(h)
    is_window = np.zeros(n, bool)
    if n >= window:
        is_window[: n - window + 1] = doc[: n - window + 1] == doc[window - 1 :]
    anchor, place = np.zeros(n, np.uint64), np.full(n, -1)
    if not is_window.any():
        return is_window, anchor, place
    with np.errstate(over="ignore"):
        if low is None:
            low, start, end = named(h, doc)
        high, first, last = named(low, doc[start])
        # a symbol of the second level depends on the symbols beside it, and those on the words beside them
        inner = np.flatnonzero((first > 0) & (last < len(low) - 1))
        before, after = start[first[inner] - 1] - 1, end[last[inner] + 1] + 1
        fits = (before >= 0) & (after < n) & (after - before < window)
        inner, before, after = inner[fits], before[fits], after[fits]
        fits = (doc[before] == doc[start[first[inner]]]) & (doc[after] == doc[before])
        inner, before, after = inner[fits], before[fits], after[fits]
        # the name stands for the symbol and all of its context
        name = joined(high[inner], _content(*_spanned(h), before, after))
        order = mix(name ^ np.uint64(0x1F123BB5159A55E5))
    begins, ends = np.zeros(n + 1, np.int32), np.zeros(n, np.int32)
    begins[before + 1], ends[after] = 1, 1
    at = np.flatnonzero(is_window)
    lo = np.cumsum(begins)[at]
    hi = np.cumsum(ends)[at + window - 1] - 1
    best, pick = np.full(len(at), np.iinfo(np.uint64).max, np.uint64), np.full(len(at), -1)
    for k in range(int((hi - lo).max(initial=-1)) + 1):
        now = np.minimum(lo + k, len(order) - 1)
        better = (lo + k <= hi) & (order[now] < best)
        best[better] = order[now[better]]
        pick[better] = now[better]
    found = pick >= 0
    anchor[at[found]], place[at[found]] = name[pick[found]], before[pick[found]]
    return is_window, anchor, place


class _Dealer:
    """Columns of units that wait to be dealt out, a row for each bucket."""

    def __init__(self, buckets: int):
        self.buckets, self.units, self.waiting = buckets, [], 0

    def add(self, columns: list[np.ndarray]) -> None:
        self.units.append(columns)
        self.waiting += len(columns[0])

    def dealt(self) -> list[tuple]:
        if not self.waiting:
            return []
        columns = [np.concatenate(c) for c in zip(*self.units, strict=True)]
        self.units, self.waiting = [], 0
        bucket = (columns[0] % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((columns[2], bucket))
        bucket = bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        return [_row(int(bucket[a]), _UNITS, _packed(_KINDS, [c[order[a:b]] for c in columns])) for a, b in zip(cuts, np.r_[cuts[1:], len(bucket)], strict=True)]


class _Chunk:
    """Documents of one task until they have ``CHUNK`` words, and what waits to be dealt out: the highest symbols with
    the units inside them, and the units that cross their borders."""

    def __init__(self, window: int, buckets: int):
        self.window, self.buckets = window, buckets
        self.direct = _Dealer(buckets)
        self.symbols, self.inside, self.waiting = [], [], 0
        self.clear()

    def clear(self) -> None:
        self.docs, self.hashes, self.size = [], [], 0

    def add(self, doc: int, version: int, text: str | None) -> None:
        words = words_of(text)
        self.docs.append((doc, version, len(words), hashlib.sha256(b" ".join(words)).hexdigest()))
        self.hashes.append(hash_words(words))
        self.size += len(words)

    def rows(self) -> list[tuple]:
        """The documents' own rows, with the repeats that the chunk itself shows."""
        sizes = np.array([d[2] for d in self.docs], np.int64)
        h = np.concatenate(self.hashes) if self.docs else np.empty(0, np.uint64)
        spans: dict[int, list] = {}
        if len(h) >= self.window:
            self._found(h, sizes, spans)
        return [_row(doc_id % self.buckets, _DOCUMENT, np.array(_merged(spans.get(k, [])), np.int32).tobytes(), doc_id, version, n, sha) for k, (doc_id, version, n, sha) in enumerate(self.docs)]

    def _found(self, h: np.ndarray, sizes: np.ndarray, spans: dict[int, list]) -> None:
        window = self.window
        which = np.repeat(np.arange(len(sizes)), sizes)
        first_word = np.cumsum(sizes) - sizes
        ids, versions = (np.array([d[k] for d in self.docs], np.int64) for k in (0, 1))
        with np.errstate(over="ignore"):
            low, start, end = named(h, which)
            is_window, anchor, place = anchors(h, which, window, low, start, end)
            name, first, last = risen(low, which, start, end, LEVELS - 1)
            content = _content(*_spanned(h), first, last)
        hashed = np.zeros(len(h), np.uint64)
        own = window_hashes(h, window)
        hashed[: len(own)] = own
        alone = is_window & (place < 0)
        anchor[alone] = hashed[alone]
        place[alone] = -1 - np.flatnonzero(alone)
        # the highest symbols: long repeats within the chunk
        owner = which[first]
        long = last - first >= window - 1
        gone = long.copy()
        gone[long] = ids[owner[long]] > _least(name[long], content[long], ids[owner[long]])
        for o, a, b in zip(owner[gone].tolist(), (first - first_word[owner])[gone].tolist(), (last + 1 - first_word[owner])[gone].tolist(), strict=True):
            spans.setdefault(o, []).append((a, b))
        # units: neighbouring windows of one document with one anchor
        at = np.flatnonzero(is_window)
        if not len(at):
            return
        head = np.ones(len(at), bool)
        head[1:] = (at[1:] != at[:-1] + 1) | (place[at[1:]] != place[at[:-1]]) | (which[at[1:]] != which[at[:-1]])
        heads = np.flatnonzero(head)
        count = np.diff(np.r_[heads, len(at)])
        with np.errstate(over="ignore"):
            step = (np.arange(len(at)) - np.repeat(heads, count)).astype(np.uint64)
            unit = np.add.reduceat(mix(hashed[at] + step * _BASE), heads)
        begin = at[heads]
        symbol = np.repeat(np.arange(len(first)), last - first + 1)
        inside = symbol[begin] == symbol[begin + count + window - 2]
        alive = np.flatnonzero(~(inside & gone[symbol[begin]]))
        unit, begin, count, inside = unit[alive], begin[alive], count[alive], inside[alive]
        name_of, doc, o = anchor[begin], ids[which[begin]], which[begin]
        least = _least(name_of, unit, doc)
        again = doc > least
        for k, b, c in zip(o[again].tolist(), (begin - first_word[o])[again].tolist(), count[again].tolist(), strict=True):
            spans.setdefault(k, []).append((b, b + c + window - 1))
        put = ~again & ~inside
        where = (versions[o] << 40) | (begin - first_word[o])
        self.direct.add([c[put] for c in (name_of, unit, doc, where, count)])
        # a symbol is dealt if any of its units is
        put = np.flatnonzero(~again & inside)
        parents = symbol[begin[put]]
        kept = np.zeros(len(first), bool)
        kept[parents] = True
        number = np.cumsum(kept) - 1 + sum(len(x[0]) for x in self.symbols)
        self.inside.append([name_of[put], unit[put], begin[put] - first[parents], count[put], number[parents]])
        k = np.flatnonzero(kept)
        self.symbols.append([name[k], content[k], ids[owner[k]], (versions[owner[k]] << 40) | (first[k] - first_word[owner[k]]), last[k] - first[k] + 1])
        self.waiting += len(put)

    def dealt(self) -> list[tuple]:
        """What has gathered, a row for each bucket."""
        out = self.direct.dealt()
        if not self.symbols:
            return out
        symbols, units = ([np.concatenate(c) for c in zip(*x, strict=True)] for x in (self.symbols, self.inside))
        self.symbols, self.inside, self.waiting = [], [], 0
        bucket = (symbols[0] % np.uint64(self.buckets)).astype(np.int64)
        order = np.lexsort((symbols[2], bucket))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        units[4] = rank[units[4]]
        by = np.argsort(units[4], kind="stable")
        symbols, units, bucket = [c[order] for c in symbols], [c[by] for c in units], bucket[order]
        cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]]) if len(bucket) else np.empty(0, np.int64)
        for a, b in zip(cuts.tolist(), np.r_[cuts[1:], len(bucket)].tolist(), strict=True):
            x, y = np.searchsorted(units[4], [a, b])
            inner = [*[c[x:y] for c in units[:4]], units[4][x:y] - a]
            out.append(_row(int(bucket[a]), _SYMBOLS, _packed(_KINDS, [c[a:b] for c in symbols]) + _packed(_INNER, inner)))
        return out


def _merged(spans: list) -> list:
    out: list = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


def _least(name: np.ndarray, unit: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Smallest id among the occurrences with the same anchor and unit."""
    order = np.lexsort((doc, unit, name))
    n, u = name[order], unit[order]
    head = np.ones(len(order), bool)
    head[1:] = (n[1:] != n[:-1]) | (u[1:] != u[:-1])
    out = np.empty(len(order), np.int64)
    out[order] = doc[order][np.maximum.accumulate(np.where(head, np.arange(len(order)), 0))]
    return out


#: Columns of a unit (anchor, unit, id, version and start, windows) or symbol (name, words' hash, id, version and start,
#: words), and of a unit inside a symbol (anchor, unit, start there, windows, number of the symbol).
_KINDS = (np.uint64, np.uint64, np.int64, np.int64, np.int32)
_INNER = (np.uint64, np.uint64, np.int32, np.int32, np.int32)


def _packed(kinds: tuple, columns: list[np.ndarray]) -> bytes:
    return np.int64(len(columns[0])).tobytes() + b"".join(c.astype(k).tobytes() for c, k in zip(columns, kinds, strict=True))


def _unpacked(kinds: tuple, data: bytes, at: int = 0) -> tuple[list[np.ndarray], int]:
    """The columns, and where they end."""
    n, at, out = int(np.frombuffer(data, np.int64, 1, at)[0]), at + 8, []
    for k in kinds:
        out.append(np.frombuffer(data, k, n, at))
        at += n * np.dtype(k).itemsize
    return out, at


#: Kinds of rows: a document, symbols with their units, units, a repeat (start, count).
_DOCUMENT, _SYMBOLS, _UNITS, _REPEAT = range(4)
_FIRST = "bucket long, kind int, id long, version long, n_words long, sha string, payload binary, start int, count int"
_SECOND = "id long, version long, n_words long, sha string, spans binary, start int, count int, anchor long"


def _row(bucket: int, kind: int, payload: bytes | None, doc: int | None = None, version: int | None = None, n: int | None = None, sha: str | None = None, start: int | None = None, count: int | None = None) -> tuple:
    return bucket, kind, doc, version, n, sha, payload, start, count


def _batch(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "binary": pa.binary()}
    fields = [f.split() for f in schema.split(", ")]
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields, strict=True)], [n for n, _ in fields])


def _scan(window: int, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunk = _Chunk(window, buckets)
        for b in batches:
            for doc, version, text in zip(b.column("id").to_pylist(), b.column("version").to_pylist(), b.column("text"), strict=True):
                chunk.add(doc, version, text.as_py())
                if chunk.size >= CHUNK:
                    yield _batch(chunk.rows() + (chunk.dealt() if chunk.waiting + chunk.direct.waiting >= DEALT else []), _FIRST)
                    chunk.clear()
        yield _batch(chunk.rows() + chunk.dealt(), _FIRST)

    return run


def _lots(batches: Iterator[pa.RecordBatch], kind: int) -> Iterator[tuple[list[bytes], list[dict]]]:
    """The payloads of ``kind`` of one bucket after another, and the other rows as they come."""
    now, held = None, []
    for b in batches:
        other = []
        for r in b.to_pylist():
            if r["kind"] != kind:
                other.append(r)
                continue
            if r["bucket"] != now and held:
                yield held, []
                held = []
            now = r["bucket"]
            held.append(r["payload"])
        yield [], other
    if held:
        yield held, []


def _rise(window: int, buckets: int):
    """Symbols of the highest level, bucket by bucket: repeats, and the units of each symbol's first document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units = _Dealer(buckets)
        for held, other in _lots(batches, _SYMBOLS):
            out = []
            for r in other:
                if r["kind"] == _UNITS:
                    units.add(_unpacked(_KINDS, r["payload"])[0])
                else:
                    out.append(tuple(r.values()))
            symbols, inner, n = [], [], 0
            for data in held:
                s, end = _unpacked(_KINDS, data)
                u, _ = _unpacked(_INNER, data, end)
                symbols.append(s)
                inner.append([*u[:4], u[4] + n])
                n += len(s[0])
            if n:
                name, content, doc, place, size = (np.concatenate(c) for c in zip(*symbols, strict=True))
                gone = doc > _least(name, content, doc)
                out += [_row(d % buckets, _REPEAT, None, d, p >> 40, start=p & ((1 << 40) - 1), count=k - window + 1) for d, p, k in zip(doc[gone].tolist(), place[gone].tolist(), size[gone].tolist(), strict=True)]
                anchor, unit, start, count, parent = (np.concatenate(c) for c in zip(*inner, strict=True))
                stay = ~gone[parent]
                anchor, unit, start, count, parent = (c[stay] for c in (anchor, unit, start, count, parent))
                units.add([anchor, unit, doc[parent], place[parent] + start, count])
            yield _batch(out + (units.dealt() if units.waiting >= DEALT else []), _FIRST)
        yield _batch(units.dealt(), _FIRST)

    return run


def _meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors of one partition, bucket by bucket: repeats (anchor null), units in question, and the documents' own rows."""
    names = [f.split()[0] for f in _SECOND.split(", ")]
    for held, other in _lots(batches, _UNITS):
        yield _batch([(r["id"], r["version"], r["n_words"], r["sha"], r["payload"], r["start"], r["count"], None) for r in other], _SECOND)
        if not held:
            continue
        name, unit, doc, start, count = (np.concatenate(c) for c in zip(*[_unpacked(_KINDS, x)[0] for x in held], strict=True))
        gone = doc > _least(name, unit, doc)
        order = np.lexsort((unit, name))
        n, u = name[order], unit[order]
        other_unit = np.zeros(len(order), np.int64)
        other_unit[1:] = (n[1:] == n[:-1]) & (u[1:] != u[:-1])
        _, group = np.unique(n, return_inverse=True)
        several = np.zeros(len(order), bool)
        several[order] = np.bincount(group, other_unit)[group] > 0
        for pick, with_name in ((np.flatnonzero(gone), False), (np.flatnonzero(~gone & several), True)):
            for k in range(0, len(pick), 50_000):
                p = pick[k : k + 50_000]
                null = lambda t: pa.nulls(len(p), t)  # noqa: E731, B023
                yield pa.RecordBatch.from_arrays([pa.array(doc[p]), pa.array(start[p] >> 40), null(pa.int64()), null(pa.string()), null(pa.binary()), pa.array((start[p] & ((1 << 40) - 1)).astype(np.int32)), pa.array(count[p]), pa.array(name[p].view(np.int64)) if with_name else null(pa.int64())], names)


_STATE = "id long, version long, n_words long, n_removed long, kept_sha256 string, spans binary, units binary"


def _settle(window: int):
    """Documents that need no text get their result; the others their merged spans and units in question."""
    nothing = hashlib.sha256(b"").hexdigest()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                spans = np.frombuffer(r["spans"] or b"", np.int32).reshape(-1, 2).tolist()
                spans = _merged(spans + [[u["start"], u["start"] + u["count"] + window - 1] for u in r["units"] if u["anchor"] is None])
                units = [(u["start"], u["count"], u["anchor"]) for u in r["units"] if u["anchor"] is not None]
                units = [u for u in units if not any(a <= u[0] and u[0] + u[1] + window - 1 <= e for a, e in spans)] if len(spans) == 1 and spans[0] == [0, r["n_words"]] else units
                gone = sum(e - a for a, e in spans)
                if not units and gone in (0, r["n_words"]):
                    out.append((r["id"], r["version"], r["n_words"], gone, nothing if gone else r["sha"], None, None))
                else:
                    out.append((r["id"], r["version"], r["n_words"], None, None, np.array(spans, np.int32).tobytes(), np.array(units, np.int64).tobytes()))
            yield _batch(out, _STATE)

    return run


def _compare(window: int):
    """The windows of the units in question."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "hash", "id", "version", "start"]
        for b in batches:
            parts = []
            for r in b.to_pylist():
                units = np.frombuffer(r["units"], np.int64).reshape(-1, 3)
                if not len(units):
                    continue
                hashed = window_hashes(hash_words(words_of(r["text"])), window)
                start = np.repeat(units[:, 0], units[:, 1])
                start = start + np.arange(len(start)) - np.repeat(np.cumsum(units[:, 1]) - units[:, 1], units[:, 1])
                parts.append((np.repeat(units[:, 2], units[:, 1]), hashed[start].view(np.int64), np.full(len(start), r["id"]), np.full(len(start), r["version"]), start))
            columns = [np.concatenate(c) for c in zip(*parts, strict=True)] if parts else [np.empty(0, np.int64)] * 5
            yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in columns], names)

    return run


def _cut(window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for r in b.to_pylist():
                words = words_of(r["text"])
                gone = np.zeros(len(words) + 1, np.int32)
                spans = np.frombuffer(r["spans"], np.int32).reshape(-1, 2)
                starts = np.array(r["starts"] or [], np.int64)
                np.add.at(gone, np.r_[spans[:, 0], starts], 1)
                np.add.at(gone, np.r_[spans[:, 1], starts + window], -1)
                gone = np.cumsum(gone[:-1]) > 0
                kept = b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])
                out.append((r["id"], r["version"], len(words), int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode("utf-8", "surrogatepass")))
            yield _batch(out, _RESULT)

    return run


_RESULT = "id long, version long, n_words long, n_removed long, kept_sha256 string, kept string"


def remove_repeats(docs: DataFrame, window: int = WINDOW, with_text: bool = False) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by blanks, and
    with ``with_text`` those words as ``kept`` (null where nothing or everything is removed)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    rows = docs.select("doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(LAST)).alias("id"), F.xxhash64("text").alias("text_hash"), "text")
    repeated = rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    several = not repeated.isEmpty()
    if several:  # different texts of one id are told apart by a version
        versions = rows.join(repeated.select("id"), "id").select("id", "text_hash").distinct().groupBy("id").agg(F.sort_array(F.collect_list("text_hash")).alias("hashes"))
        versions = materialize(versions.select("id", F.posexplode("hashes").alias("version", "text_hash")), "versions")
        numbered = rows.join(versions, ["id", "text_hash"], "left").withColumn("version", F.coalesce("version", F.lit(0)).cast("long"))
        texts = numbered.select("id", "version", "text").dropDuplicates(["id", "version"])
    else:
        texts = rows.select("id", F.lit(0).cast("long").alias("version"), "text")
    n = partitions(spark)
    lots = n * SUB
    by_bucket = lambda df: df.repartition(n, "bucket").sortWithinPartitions("bucket")
    risen_units = by_bucket(texts.mapInArrow(_scan(window, lots), _FIRST)).mapInArrow(_rise(window, lots), _FIRST)
    met = materialize(by_bucket(risen_units).mapInArrow(_meet, _SECOND), "met")
    units = F.collect_list(F.when(F.col("start").isNotNull(), F.struct("start", "count", "anchor")))
    by_doc = met.groupBy("id", "version").agg(F.max("n_words").alias("n_words"), F.max("sha").alias("sha"), F.max("spans").alias("spans"), units.alias("units"))
    state = materialize(by_doc.mapInArrow(_settle(window), _STATE), "state")
    done = state.where("n_removed is not null").select("id", "version", "n_words", "n_removed", "kept_sha256", F.lit(None).cast("string").alias("kept"))
    open_docs = materialize(texts.join(state.where("n_removed is null").select("id", "version", "spans", "units"), ["id", "version"]), "texts")
    windows = materialize(open_docs.mapInArrow(_compare(window), "anchor long, hash long, id long, version long, start long"), "windows")
    least = windows.groupBy("anchor", "hash").agg(F.min("id").alias("low"), F.max("id").alias("high")).where("low < high").drop("high")
    again = windows.join(least, ["anchor", "hash"]).where("id > low").groupBy("id", "version").agg(F.collect_list("start").alias("starts"))
    cut = open_docs.join(again, ["id", "version"], "left").select("id", "version", "text", "spans", "starts").mapInArrow(_cut(window), _RESULT)
    result = done.unionByName(cut)
    if several:
        result = numbered.select("doc_id", "id", "version").join(result, ["id", "version"])
    else:
        result = result.withColumn("doc_id", F.when(F.col("id") != LAST, F.col("id")))
    return result.select("doc_id", "n_words", "n_removed", "kept_sha256", *["kept"] * with_text)
