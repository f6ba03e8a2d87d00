"""Language identification: a bidirectional gated recurrent network over UTF-8 bytes.

Trained in numpy by backpropagation through time; every byte position gets a label distribution, and
a document's distribution is the mean over its positions.  Whole texts are read: each is cut into
windows of ``SPAN`` bytes, all of which run through both directions.

Defined cases: a null text, or one with no letter, gets ``und`` with score 0; equal texts get equal
results, wherever they stand in a batch; a row without a doc_id is predicted as any other (the query gives it a null ``held_out`` and does not learn
from it); extra columns pass through; an empty table gives an empty result; without any training row
every text gets ``und`` with score 0.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded_batches, with_fields

SPAN = 64
HIDDEN = 10
UNDETERMINED = "und"
_LETTER = re.compile(r"[^\W\d_]")


def has_letter(text: str) -> bool:
    found = _LETTER.search(text)
    # the pattern also takes numerals that are no digits
    return bool(found) and (found[0].isalpha() or any(c.isalpha() for c in text))


#: Where exact sums are wanted, states (of at most 1) are rounded to multiples of 2^-GRAIN.
GRAIN = 20
_MIDDLE = np.float32(3 << (22 - GRAIN))  # floats around it are multiples of 2^-GRAIN


def grained(w: np.ndarray) -> np.ndarray:
    """Weights in steps so wide that no sum of their products with rounded states needs more than the 53 bits of a float."""
    w = w.astype(np.float64)
    step = 2.0 ** (np.ceil(np.log2(np.abs(w).sum(0).max(initial=0) + 1)) + GRAIN - 52)
    return np.rint(w / step) * step


def exactly(states: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """``states @ weights`` for weights from ``grained``.  Sums are exact, so a row's result is the same whatever rows
    stand beside it, and in whatever order the machine adds."""
    return ((states + _MIDDLE) - _MIDDLE).astype(np.float64) @ weights


@dataclass
class Direction:
    """A gated recurrent layer: reset and update gates (hard sigmoids) and a candidate, with the byte embedding and
    input projection folded into one table of 256 rows."""

    table: np.ndarray  # 256 x 3H: reset, update, candidate
    gates: np.ndarray  # H x 2H
    inner: np.ndarray  # H x H

    def run(self, x: np.ndarray, keep: bool = False, exact: bool = False):
        """x: bytes, steps x batch.  Returns the states, steps x batch x H."""
        steps, n = x.shape
        gates, inner, product = (grained(self.gates), grained(self.inner), exactly) if exact else (self.gates, self.inner, np.matmul)
        h = np.zeros((n, self.inner.shape[0]), self.table.dtype)
        size = h.shape[1]
        states = np.empty((steps, n, size), self.table.dtype)
        tape = []
        for t in range(steps):
            e = self.table[x[t]]
            a = product(h, gates).astype(self.table.dtype, copy=False)
            a += e[:, : 2 * size]
            a *= 0.25
            a += 0.5
            np.clip(a, 0, 1, out=a)
            r, z = a[:, :size], a[:, size:]
            c = product(r * h, inner).astype(self.table.dtype, copy=False)
            c += e[:, 2 * size :]
            np.tanh(c, out=c)
            if keep:
                tape.append((h, r, z, c))
            h = c + z * (h - c)
            states[t] = h
        return (states, tape) if keep else states

    def back(self, x, tape, grad):
        """Gradients of table, gates and inner from those of the states."""
        size = self.inner.shape[0]
        gt, gg, gi = np.zeros_like(self.table), np.zeros_like(self.gates), np.zeros_like(self.inner)
        dh = np.zeros_like(grad[0])
        for t in range(len(tape) - 1, -1, -1):
            h, r, z, c = tape[t]
            d = grad[t] + dh
            dc = d * (1 - z) * (1 - c * c)
            dz = d * (h - c) * 0.25 * ((z > 0) & (z < 1))
            drh = dc @ self.inner.T
            dr = drh * h * 0.25 * ((r > 0) & (r < 1))
            dg = np.concatenate([dr, dz], 1)
            dh = d * z + drh * r + dg @ self.gates.T
            gg += h.T @ dg
            gi += (r * h).T @ dc
            np.add.at(gt, x[t], np.concatenate([dg, dc], 1))
        assert gt.shape[1] == 3 * size
        return gt, gg, gi


@dataclass
class ByteTagger:
    labels: list[str]
    forward: Direction
    backward: Direction
    out: np.ndarray  # 2H x labels
    bias: np.ndarray

    def positions(self, x: np.ndarray) -> np.ndarray:
        """Label probabilities of each byte: steps x batch x labels."""
        steps, n = x.shape
        f = self.forward.run(x, exact=True)
        b = self.backward.run(x[::-1], exact=True)[::-1]
        size = f.shape[2]
        p = exactly(f.reshape(-1, size), grained(self.out[:size]))
        p += exactly(np.ascontiguousarray(b).reshape(-1, size), grained(self.out[size:]))
        p = p.astype(self.out.dtype)
        p += self.bias
        p -= p.max(1, keepdims=True)
        np.exp(p, out=p)
        p /= p.sum(1, keepdims=True)
        return p.reshape(steps, n, -1)

    def predict(self, texts: list[str | None]) -> tuple[list[str], np.ndarray]:
        """Label and pooled probability of each whole text, in bounded blocks of windows."""
        raw = [(t or "").encode("utf-8", "surrogatepass") for t in texts]
        sums = np.zeros((len(raw), len(self.labels)))
        sizes = np.array([len(r) for r in raw], np.int64)
        spans = -(-sizes // SPAN)
        if self.labels and spans.sum():
            padded = np.frombuffer(b"".join(r + b" " * (-len(r) % SPAN) for r in raw), np.uint8).reshape(-1, SPAN)
            owner = np.repeat(np.arange(len(raw)), spans)
            left = np.full(len(owner), SPAN)
            left[np.cumsum(spans)[spans > 0] - 1] -= (-sizes % SPAN)[spans > 0]
            for k in range(0, len(owner), 2048):
                x = np.ascontiguousarray(padded[k : k + 2048].T)
                p = self.positions(x)
                p *= (np.arange(SPAN)[:, None] < left[None, k : k + 2048])[:, :, None]
                np.add.at(sums, owner[k : k + 2048], p.sum(0))
        names, scores = [], np.zeros(len(raw))
        for i, t in enumerate(texts):
            if not self.labels or not t or not has_letter(t):
                names.append(UNDETERMINED)
                continue
            best = int(sums[i].argmax())
            names.append(self.labels[best])
            scores[i] = min(1.0, sums[i, best] / sizes[i])
        return names, scores


def fit(windows: list[bytes], labels: list[str], hidden: int = HIDDEN, steps: int = 400, batch: int = 192, rate: float = 0.02, seed: int = 11) -> ByteTagger:
    """Adam with classes drawn evenly; every position of a window carries the document's label."""
    rng = np.random.default_rng(seed)
    names = sorted(set(labels))
    kind = np.float32
    f, b = (Direction(rng.normal(0, 0.3, (256, 3 * hidden)).astype(kind), rng.normal(0, 0.3, (hidden, 2 * hidden)).astype(kind), rng.normal(0, 0.3, (hidden, hidden)).astype(kind)) for _ in "fb")
    model = ByteTagger(names, f, b, rng.normal(0, 0.3, (2 * hidden, len(names))).astype(kind), np.zeros(len(names), kind))
    if len(names) < 1:
        return model
    x = np.frombuffer(b"".join(w[:SPAN].ljust(SPAN) for w in windows), np.uint8).reshape(-1, SPAN)
    y = np.searchsorted(names, labels)
    by = [np.flatnonzero(y == k) for k in range(len(names))]
    params = [f.table, f.gates, f.inner, b.table, b.gates, b.inner, model.out, model.bias]
    m, v = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    for step in range(1, steps + 1):
        kinds = rng.integers(0, len(names), batch)
        pick = np.array([rng.choice(by[k]) for k in kinds])
        xt = np.ascontiguousarray(x[pick].T)
        hf, tf = f.run(xt, keep=True)
        hb, tb = b.run(xt[::-1], keep=True)
        both = np.concatenate([hf, hb[::-1]], 2)
        p = both @ model.out + model.bias
        p = np.exp(p - p.max(2, keepdims=True))
        p /= p.sum(2, keepdims=True)
        p[:, np.arange(batch), kinds] -= 1
        p /= batch * SPAN
        dboth = p @ model.out.T
        grads = [*f.back(xt, tf, dboth[:, :, :hidden]), *b.back(xt[::-1], tb, dboth[::-1, :, hidden:]), np.einsum("tbh,tbl->hl", both, p), p.sum((0, 1))]
        pace = rate * min(1.0, 2 * (1 - step / (steps + 1)))
        for q, g, mi, vi in zip(params, grads, m, v, strict=True):
            g = g * min(1.0, 1.0 / (np.sqrt((g * g).sum()) + 1e-6))
            mi += 0.1 * (g - mi)
            vi += 0.01 * (g * g - vi)
            q -= pace * (mi / (1 - 0.9**step)) / (np.sqrt(vi / (1 - 0.99**step)) + 1e-7)
    return model


def train(docs: DataFrame, train_rows: Column, per_label: int = 500, windows: int = 4) -> ByteTagger:
    """Learn from text and language of at most ``per_label`` documents of each language (lowest
    ``xxhash64(doc_id)`` first, out of the about ``4 * per_label`` that reach the ranking) and ``windows`` windows of each, a bound that does not grow with the
    corpus.  The set of language names must be small, as it is for any labelled corpus."""
    order = Window.partitionBy("lang").orderBy("place", F.xxhash64("text"))
    ids = docs.where(train_rows & F.col("lang").isNotNull() & F.col("text").isNotNull() & (F.length("text") > 0)).select("doc_id", "lang", "text", F.xxhash64("doc_id").alias("place"))
    # a language of very many rows is thinned by its hash before anything moves: four times what is wanted stays
    many = {r["lang"]: r["n"] for r in ids.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 4 * per_label).collect()}
    below = F.create_map(*[F.lit(x) for lang, n in sorted(many.items()) for x in (lang, int(4 * per_label / n * 2**64) - 2**63)])[F.col("lang")] if many else F.lit(None).cast("bigint")
    ids = ids.where(F.col("place") <= F.coalesce(below, F.lit(2**63 - 1)))
    # cut on the executors, before anything moves: what is ranked are a few short windows of each document
    size = F.length("text")
    places = [F.substring("text", (1 + F.pmod(F.xxhash64("doc_id", F.lit(k)), F.greatest(size - SPAN, F.lit(1)))).cast("int"), F.lit(SPAN)) for k in range(windows)]
    cut = ids.select("place", "lang", F.array(*places).alias("cuts"), F.xxhash64("text").alias("text"))
    got = cut.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= per_label).select("lang", "rank", "cuts").toArrow()
    rows = sorted(zip(got["lang"].to_pylist(), got["rank"].to_pylist(), got["cuts"].to_pylist(), strict=True))
    pairs = [(lang, c.encode("utf-8", "surrogatepass")) for lang, _, cuts in rows for c in cuts if has_letter(c)]
    return fit([c for _, c in pairs], [lang for lang, _ in pairs])


def predict(docs: DataFrame, model: ByteTagger, text: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` (replaced if there)."""
    bounded_batches(docs.sparkSession)
    kept = [c for c in docs.columns if c not in ("lang_pred", "score")]

    def labelled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names, scores = model.predict(b.column(kept.index(text)).to_pylist())
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(names, pa.string()), pa.array(scores, pa.float64())], [*kept, "lang_pred", "score"])

    rows = docs.select(*kept)
    return rows.mapInArrow(labelled, with_fields(rows, lang_pred="string", score="double"))
