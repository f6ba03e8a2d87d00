"""Quality classifier: a factorisation machine over hashed words, structure statistics and
document metadata.

Scoring is linear in the number of active features:
``y = w0 + sum(w_j x_j) + 1/2 * sum_f ((sum_j v_jf x_j)^2 - sum_j v_jf^2 x_j^2)``.

Fields: (a) hashed lower-case words with their share of the text (square root), (b) structure
statistics (character classes, repeats, line shapes) one-hot in fixed bins, (c) metadata: the length
of the text in characters, one-hot in powers of two.

Defined cases: a null text counts as the empty one; the empty text has only structure and length
features and gets the model's score for them; very long texts are read whole, a text at a time; a row without a
doc_id is scored as any other; repeated rows get equal scores; extra columns pass
through untouched; an empty table gives an empty result; with no usable labels, or labels of one
class, every score is that class's share (0.5 without labels).
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_batches, with_fields

WORD_BUCKETS = 1 << 14
#: Bins of each structure statistic, all of them shares in [0, 1].
BINS = 12
STATS = ("upper", "digit", "punct", "pipe", "non_ascii", "space", "repeat_next", "distinct", "top_word", "distinct_line", "short_word", "long_word")
LENGTHS = 24
FEATURES = WORD_BUCKETS + BINS * len(STATS) + LENGTHS

_PUNCT = np.array([chr(c) in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~" for c in range(256)])
_bucket_of: dict[str, int] = {}


def _buckets(words: list[str]) -> np.ndarray:
    if len(_bucket_of) > 100_000:
        _bucket_of.clear()
    get = _bucket_of.get
    out = []
    for w in words:
        b = get(w)
        if b is None:
            b = _bucket_of[w] = zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORD_BUCKETS
        out.append(b)
    return np.array(out, dtype=np.int64)


def features(text: str | None) -> tuple[np.ndarray, np.ndarray]:
    """Active feature indices (distinct, ascending) and values of one whole text."""
    text = text or ""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words = text.lower().split()
    stats = np.zeros(len(STATS))
    idx, val = np.empty(0, np.int64), np.empty(0)
    if len(raw):
        count = np.bincount(raw, minlength=256)
        n = len(raw)
        stats[:6] = count[65:91].sum() / n, count[48:58].sum() / n, count[_PUNCT].sum() / n, min(1.0, 10 * count[124] / n), count[128:].sum() / n, (count[32] + count[9:14].sum()) / n
        lines = text.split("\n")
        stats[9] = len(set(lines)) / len(lines)
    if words:
        b = _buckets(words)
        idx, times = np.unique(b, return_counts=True)
        val = np.sqrt(times / len(b))
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        stats[6] = (b[1:] == b[:-1]).mean() if len(b) > 1 else 0.0
        stats[7] = len(idx) / len(b)
        stats[8] = times.max() / len(b)
        stats[10], stats[11] = (sizes <= 2).mean(), (sizes >= 12).mean()
    bins = WORD_BUCKETS + np.arange(len(STATS)) * BINS + np.minimum((np.sqrt(stats) * BINS).astype(np.int64), BINS - 1)
    length = WORD_BUCKETS + BINS * len(STATS) + min(len(text).bit_length(), LENGTHS - 1)
    idx = np.concatenate([idx, bins, [length]])
    return idx, np.concatenate([val, np.full(len(STATS) + 1, 0.3)])


@dataclass
class FactorizationMachine:
    bias: float
    weights: np.ndarray
    factors: np.ndarray

    def score(self, texts: list[str | None]) -> np.ndarray:
        if not texts:
            return np.empty(0)
        rows = [features(t) for t in texts]
        return _sigmoid(self._raw(np.concatenate([i for i, _ in rows]), np.concatenate([v for _, v in rows]), np.cumsum([0] + [len(i) for i, _ in rows[:-1]]))[0])

    def _raw(self, idx, val, at):
        vx = self.factors[idx] * val[:, None]
        total = np.add.reduceat(vx, at, axis=0)
        pairs = 0.5 * (total**2 - np.add.reduceat(vx**2, at, axis=0)).sum(1)
        return self.bias + np.add.reduceat(self.weights[idx] * val, at) + pairs, vx, total


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def fit(rows: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, rank: int = 6, epochs: int = 12, batch: int = 128, rate: float = 0.02, decay: float = 1e-4, seed: int = 7) -> FactorizationMachine:
    """Adam on the logistic loss over sparse rows."""
    rng = np.random.default_rng(seed)
    y = np.asarray(labels, float)
    share = float(y.mean()) if len(y) else 0.5
    model = FactorizationMachine(0.0, np.zeros(FEATURES), rng.normal(0, 0.05, (FEATURES, rank)))
    if share in (0.0, 1.0) or not len(y):
        return FactorizationMachine(30.0 if share == 1.0 else -30.0 if share == 0.0 and len(y) else 0.0, model.weights, np.zeros((FEATURES, rank)))
    model.bias = float(np.log(share / (1 - share)))
    state = [[np.zeros_like(p), np.zeros_like(p)] for p in (model.weights, model.factors)]
    step = 0
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for k in range(0, len(order), batch):
            pick = order[k : k + batch]
            sizes = [len(rows[i][0]) for i in pick]
            idx, val = np.concatenate([rows[i][0] for i in pick]), np.concatenate([rows[i][1] for i in pick])
            raw, vx, total = model._raw(idx, val, np.cumsum([0] + sizes[:-1]))
            g = (_sigmoid(raw) - y[pick]) / len(pick)
            each = np.repeat(np.arange(len(pick)), sizes)
            step += 1
            model.bias -= rate * g.sum()
            touched, back = np.unique(idx, return_inverse=True)
            gw = np.bincount(back, g[each] * val)
            gv = (g[each] * val)[:, None] * (total[each] - vx)
            gv = np.stack([np.bincount(back, gv[:, f]) for f in range(rank)], 1)
            for p, grad, (m, v) in ((model.weights, gw, state[0]), (model.factors, gv, state[1])):
                grad = grad + decay * p[touched]
                m[touched] = 0.9 * m[touched] + 0.1 * grad
                v[touched] = 0.99 * v[touched] + 0.01 * grad**2
                p[touched] -= rate * (m[touched] / (1 - 0.9**step)) / (np.sqrt(v[touched] / (1 - 0.99**step)) + 1e-8)
    return model


def train(docs: DataFrame, labels: DataFrame, train_rows: Column, max_labels: int = 4000) -> FactorizationMachine:
    """Fit on at most ``max_labels`` labelled rows (lowest ``xxhash64(doc_id)`` first, a bound
    that does not grow with the corpus); labels and rows without a doc_id are not learned from.  Their features, not their texts, reach the driver."""
    bounded_batches(docs.sparkSession)
    picked = labels.where(F.col("quality").isNotNull() & F.col("doc_id").isNotNull()).where(train_rows).groupBy("doc_id").agg(F.max("quality").cast("int").alias("quality")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_labels)
    met = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select("text", "quality", F.xxhash64("doc_id", "text").alias("place"))
    # a doc_id may have several rows: the bound holds for what reaches the driver, too
    rows = met.mapInArrow(_featurized, "idx array<int>, val array<float>, quality int, place long").orderBy("place", "quality").limit(max_labels).toArrow()
    # a deterministic order whatever the order of arrival; big-endian bytes of numbers from 0 on are in the numbers' order
    got = sorted((q, i.astype(">i4").tobytes(), v.astype(">f4").tobytes()) for q, i, v in zip(rows["quality"].to_pylist(), _lists(rows["idx"]), _lists(rows["val"]), strict=True))
    return fit([(np.frombuffer(i, ">i4").astype(np.int64), np.frombuffer(v, ">f4").astype(float)) for _, i, v in got], np.array([q for q, _, _ in got]))


def _lists(column: pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The lists of a column in numpy: as Python's numbers they would take the driver many times their size."""
    for part in column.chunks:
        at, values = part.offsets.to_numpy(), part.values.to_numpy()
        yield from (values[a:b] for a, b in zip(at[:-1], at[1:], strict=True))


def _featurized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        rows = [features(t) for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([pa.array([i.astype(np.int32) for i, _ in rows], pa.list_(pa.int32())), pa.array([v.astype(np.float32) for _, v in rows], pa.list_(pa.float32())), b.column("quality"), b.column("place")], ["idx", "val", "quality", "place"])


def score(docs: DataFrame, model: FactorizationMachine, text: str = "text", out: str = "quality_score") -> DataFrame:
    """``docs`` with the column ``out`` (replaced if it is there)."""
    bounded_batches(docs.sparkSession)
    weights, factors, bias = model.weights.astype(np.float32), model.factors.astype(np.float32), model.bias
    kept = [c for c in docs.columns if c != out]

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = FactorizationMachine(bias, weights, factors)
        for b in batches:
            values = machine.score(b.column(kept.index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(values, pa.float64())], [*kept, out])

    rows = docs.select(*kept)
    return rows.mapInArrow(scored, with_fields(rows, **{out: "double"}))
