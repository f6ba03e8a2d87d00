"""Hard-negative mining: a distributed kNN join over Voronoi cells.

Inner products become distances by one more component: every vector x is augmented by sqrt(M^2 - |x|^2), M being the
greatest norm, and an anchor q by 0, so that |q - x|^2 = |q|^2 + M^2 - 2 qx.  A bounded sample of rows gives the pivots
of a Voronoi partition of that space; anchors belong to the cell of their nearest pivot, and cells of more than
``ANCHORS`` anchors are split into groups.  Rows are replicated to those groups only that they might serve:

* positives: of each label and cell, the nearest rows to the pivot bound the distance of the k-th positive of all
  anchors of a label in a cell; a row of that label is sent where its own distance to the pivot, less the anchors'
  greatest, is within that bound;
* negatives: the positives found give the scores that negatives may have; a row is sent to a cell where the scores that
  the triangle inequality leaves it overlap those that any anchor there may use.

Then groups join locally and exactly.  A group's rows are dealt to several tasks; each streams its part past the group's
anchors and keeps the best of each, so that it holds a bounded number of anchors and one batch of rows, however many rows
a cell has, and what tasks give is merged by a windowed top-k.  Where vectors are spread evenly in many dimensions no
bound excludes anything, and rows go to all groups: their number is anchors over ``ANCHORS``.

Quantized components are floor(256 * x).  Scores are exact integers: floats where no sum can pass 2^53, else Python's.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component, take no part; vectors of
another length than the anchor's are neither its positives nor its negatives; rows with the anchor's id are neither;
rows equal in id and score to an anchor count once; equal anchor rows count once, an id with several vectors or labels
is an anchor with each; a score that 64 bits do not hold counts as the nearest that they hold; vectors of another than
the most common length, or of a norm over 2^25, go to all groups; fewer candidates give fewer rows; extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import bounded_batches, gathered, longs, materialize, partitions

#: Anchors of a group, at most about this many; cells of the Voronoi partition, at least and at most.
ANCHORS = 2048
CELLS = (4, 1024)
#: Rows scored at once, and rows of the summary (by label and cell) that the driver takes: without it rows go by label only.
BATCH = 1024
SUMMARY = 100_000
#: Squared norms from here on take no part in bounds, and products from here on are summed in Python's integers.
WIDE = 2.0**50
NONE = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, label: Column, column: str = "embedding", id: str = "vec_id") -> DataFrame:
    """vec_id, label, v (components as they are) of the rows that take part."""
    finite = lambda x: F.coalesce((F.abs(x.cast("double")) < float("inf")) & ~F.isnan(x), F.lit(False))
    kind = "array<float>" if dict(vectors.dtypes)[column] == "array<float>" else "array<double>"
    fit = F.col(id).isNotNull() & label.isNotNull() & F.col(column).isNotNull() & F.forall(column, finite)
    return vectors.where(fit).select(F.col(id).cast("long").alias("vec_id"), label.cast("long").alias("label"), F.col(column).cast(kind).alias("v"))


def matrices(column: pa.Array | pa.ChunkedArray) -> list[tuple[np.ndarray, np.ndarray]]:
    """Of a column of vectors: (rows, their quantized components) for each length."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat, sizes = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64), np.asarray(column.value_lengths())
    starts = np.cumsum(sizes) - sizes
    with np.errstate(over="ignore"):
        whole = np.clip(np.floor(256.0 * flat), -np.finfo(np.float64).max, np.finfo(np.float64).max)
    return [(at, whole[starts[at][:, None] + np.arange(n)]) for n in np.unique(sizes) for at in [np.flatnonzero(sizes == n)]]


def squares(x: np.ndarray) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.einsum("ij,ij->i", x, x)


def products(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products as 64-bit integers, exact, or the nearest that 64 bits hold."""
    with np.errstate(over="ignore", invalid="ignore"):
        about, wide = q @ x.T, np.outer(np.sqrt(squares(q)), np.sqrt(squares(x))) >= 4 * WIDE
    if not wide.any():
        return about.astype(np.int64)
    out = np.where(wide, 0, about).astype(np.int64)
    for i, j in zip(*np.nonzero(wide), strict=True):
        exact = sum(int(a) * int(b) for a, b in zip(q[i], x[j], strict=True))
        out[i, j] = min(max(exact, NONE + 1), -(NONE + 1))
    return out


class Best:
    """The ``k`` best (score, id) of each of ``n`` anchors: greater scores first, ties to the smaller id, none twice."""

    def __init__(self, n: int, k: int):
        self.score, self.id, self.k = np.full((n, k), NONE), np.zeros((n, k), np.int64), k

    def offer(self, own: np.ndarray, score: np.ndarray, fit: np.ndarray, ids: np.ndarray) -> None:
        """To the anchors ``own``: the scores of ``ids`` where they ``fit``."""
        score = np.where(fit, score, NONE)
        enter = (score >= self.score[own, -1][:, None]) & (score > NONE)
        if len(ids) > self.k and enter.sum() > 4 * self.k * len(own) and len(np.unique(ids)) == len(ids):
            enter &= score >= np.partition(score, len(ids) - self.k, axis=1)[:, -self.k][:, None]
        new, at = np.nonzero(enter)
        if not len(new):
            return
        touched = np.zeros(len(self.score), bool)
        touched[own[new]] = True
        old, place = np.nonzero((self.score > NONE) & touched[:, None])
        row, s, i = np.r_[old, own[new]], np.r_[self.score[old, place], score[new, at]], np.r_[self.id[old, place], ids[at]]
        order = np.lexsort((i, -s, row))
        row, s, i = row[order], s[order], i[order]
        same = np.r_[False, (row[1:] == row[:-1]) & (s[1:] == s[:-1]) & (i[1:] == i[:-1])]
        row, s, i = row[~same], s[~same], i[~same]
        rank = np.arange(len(row)) - np.searchsorted(row, row)
        row, s, i, rank = (x[rank < self.k] for x in (row, s, i, rank))
        self.score[touched] = NONE
        self.score[row, rank], self.id[row, rank] = s, i

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, id, score), anchor by anchor."""
        at, place = np.nonzero(self.score > NONE)
        return at, self.id[at, place], self.score[at, place]


class Space:
    """Pivots and the augmented distances to them.  The last cell, number ``cells - 1``, is of what no bound holds for."""

    def __init__(self, pivots: np.ndarray, most: float):
        self.most, self.length = most, pivots.shape[1]
        self.pivots = self.augmented(pivots)
        self.cells = len(pivots) + 1

    def augmented(self, x: np.ndarray) -> np.ndarray:
        return np.c_[x, np.sqrt(np.maximum(0.0, self.most - squares(x)))]

    def distances(self, x: np.ndarray, anchors: bool = False) -> np.ndarray:
        """To each pivot."""
        full = np.c_[x, np.zeros(len(x))] if anchors else self.augmented(x)
        return np.sqrt(np.maximum(0.0, squares(full)[:, None] + squares(self.pivots) - 2 * full @ self.pivots.T))

    def regular(self, x: np.ndarray) -> np.ndarray:
        return (squares(x) < WIDE) & (x.shape[1] == self.length)

    @property
    def slack(self) -> float:
        """More than rounding moves a distance."""
        return 1e-6 * (1 + math.sqrt(self.most))


def space(rows: DataFrame, is_anchor: Column) -> Space | None:
    """Of ``rows``; None if there are no anchors.  The driver takes one row of figures and the sample of pivots."""

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[int, list] = {}
        for b in batches:
            anchor = b.column("anchor").to_numpy(zero_copy_only=False)
            for at, x in matrices(b.column("v")):
                n = squares(x)
                got = found.setdefault(x.shape[1], [0, 0, 0.0])
                got[0] += len(at)
                got[1] += int(anchor[at].sum())
                got[2] = max(got[2], float(n[n < WIDE].max(initial=0.0)))
        yield pa.RecordBatch.from_arrays([pa.array([*found], pa.int32()), *[pa.array([x[k] for x in found.values()], t) for k, t in enumerate((pa.int64(), pa.int64(), pa.float64()))]], ["dims", "n", "anchors", "most"])

    sizes = rows.select("v", is_anchor.alias("anchor")).mapInArrow(measured, "dims int, n long, anchors long, most double").groupBy("dims").agg(*[F.sum(c).alias(c) for c in ("n", "anchors")], F.max("most").alias("most"))
    main = sizes.agg(F.sum("anchors").alias("anchors"), F.max_by(F.struct("dims", "most"), F.struct("n", "dims")).alias("main")).first()
    if not main["anchors"]:
        return None
    cells = min(max(CELLS[0], math.ceil(main["anchors"] / ANCHORS)), CELLS[1])
    sample = rows.where(F.size("v") == main["main"]["dims"]).select("v", F.xxhash64("vec_id", F.lit(3)).alias("order"), "vec_id").orderBy("order", "vec_id").limit(cells).collect()
    x = matrices(pa.array([r["v"] for r in sample], pa.list_(pa.float64())))[0][1]
    x = np.unique(x[squares(x) < WIDE], axis=0)
    return Space(x if len(x) else np.zeros((1, main["main"]["dims"])), main["main"]["most"])


def in_cells(rows: DataFrame, where: Space, anchors: bool) -> DataFrame:
    """``rows`` (vec_id, label, v) with cell, far (distance to the pivot) and norm (squared)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            cell, far, norm = np.full(b.num_rows, where.cells - 1, np.int32), np.zeros(b.num_rows), np.zeros(b.num_rows)
            for at, x in matrices(b.column("v")):
                fit = where.regular(x)
                if fit.any():
                    d = where.distances(x[fit], anchors)
                    cell[at[fit]], far[at[fit]], norm[at[fit]] = d.argmin(1), d.min(1), squares(x[fit])
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(far), pa.array(norm)], [*b.schema.names, "cell", "far", "norm"])

    return rows.mapInArrow(run, f"vec_id long, label long, v {dict(rows.dtypes)['v']}, cell int, far double, norm double")


def positive_reach(rows: DataFrame, anchors: DataFrame, where: Space, k: int) -> dict[tuple[int, int], float] | None:
    """Of each (label, cell) of anchors, the greatest distance to the pivot at which a row may be one of the ``k`` best; None:
    there are too many for a summary."""
    groups = anchors.groupBy("label", "cell").agg(F.max("far").alias("far"))
    if groups.limit(SUMMARY + 1).count() > SUMMARY:
        return None
    nearest = Window.partitionBy("label", "cell").orderBy("far", "vec_id")
    known = in_cells(rows, where, False).where(F.col("cell") < where.cells - 1).select("label", "cell", "vec_id", "far").withColumn("place", F.row_number().over(nearest)).where(F.col("place") <= k + 1)
    known = materialize(known, "nearest")
    found: dict[int, list] = {}
    if known.limit(SUMMARY + 1).count() <= SUMMARY:
        for r in known.collect():
            found.setdefault(r["label"], []).append((r["cell"], r["far"], r["vec_id"]))
    between = where.distances(where.pivots[:, :-1])
    reach = {}
    for r in groups.collect():
        label, cell, far = r["label"], r["cell"], r["far"]
        reach[label, cell] = math.inf
        if cell < where.cells - 1 and label in found:
            bounds = sorted((far + between[cell, c] + d, i) for c, d, i in found[label])
            first = {}
            for bound, i in bounds:  # the anchor may be one of the rows: one id more than k
                first.setdefault(i, bound)
            if len(first) > k:
                reach[label, cell] = sorted(first.values())[k] + far + 4 * where.slack
    return reach


def routed(rows: DataFrame, where: Space, serves) -> DataFrame:
    """A row for each cell that it might serve: ``serves(labels, distances or None)`` tells them, rows by cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            label, to = b.column("label").to_numpy(), np.zeros((b.num_rows, where.cells), bool)
            for at, x in matrices(b.column("v")):
                fit = where.regular(x)
                if fit.any():
                    to[at[fit]] = serves(label[at[fit]], where.distances(x[fit]))
                if not fit.all():
                    to[at[~fit]] = serves(label[at[~fit]], None)
            for cell in np.flatnonzero(to.any(0)):
                sent = b.filter(pa.array(to[:, cell]))
                yield pa.RecordBatch.from_arrays([*sent.columns, pa.array(np.full(sent.num_rows, cell, np.int32))], [*b.schema.names, "cell"])

    return rows.mapInArrow(run, f"vec_id long, label long, v {dict(rows.dtypes)['v']}, cell int")


class Joined:
    """The local join of units: streams of rows, anchors first.  ``state(block)`` takes batches and gives the result."""

    def __init__(self, state):
        self.state = state

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unit, head, state = None, [], None
        for t in gathered(batches, BATCH):
            t = t.combine_chunks()
            units, kinds = t.column("unit").to_numpy(), t.column("kind").to_numpy()
            cuts = np.flatnonzero((units[1:] != units[:-1]) | (kinds[1:] != kinds[:-1])) + 1
            for a, z in zip(np.r_[0, cuts], np.r_[cuts, len(units)], strict=True):
                if units[a] != unit:
                    yield from state.result() if state else ()
                    unit, head, state = units[a], [], None
                part = t.slice(a, z - a)
                if kinds[a] == 0:
                    head.append(part)
                elif head:
                    state = state or self.state(pa.concat_tables(head).combine_chunks())
                    state.take(part)
        yield from state.result() if state else ()


class Positives:
    """The ``k`` best rows of an anchor's own label."""

    NAMES, SCHEMA = ["anchor_id", "anchor", "positive_id", "score"], "anchor_id long, anchor long, positive_id long, score long"

    def __init__(self, block: pa.Table, k: int):
        self.parts = [(at, q) for at, q in matrices(block.column("v"))]
        self.ids, self.keys, self.labels = (block.column(c).to_numpy() for c in ("vec_id", "anchor", "label"))
        self.best = Best(len(self.ids), k)

    def scored(self, rows: pa.Table):
        """(anchors, scores, whether labels agree, whether ids differ, ids) for each length of vectors."""
        ids, labels = rows.column("vec_id").to_numpy(), rows.column("label").to_numpy()
        known = {q.shape[1]: (at, q) for at, q in self.parts}
        for at, x in matrices(rows.column("v")):
            if x.shape[1] in known:
                own, q = known[x.shape[1]]
                yield own, products(q, x), self.labels[own][:, None] == labels[at], self.ids[own][:, None] != ids[at], ids[at]

    def take(self, rows: pa.Table) -> None:
        for own, score, alike, other, ids in self.scored(rows):
            self.best.offer(own, score, alike & other, ids)

    def result(self) -> Iterator[pa.RecordBatch]:
        at, ids, score = self.best.rows()
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (self.ids[at], self.keys[at], ids, score)], self.NAMES)


class Negatives(Positives):
    """For each positive the ``k`` best rows of other labels with scores from its ``low`` to its ``high``."""

    NAMES, SCHEMA = ["anchor_id", "anchor", "place", "negative_id", "score"], "anchor_id long, anchor long, place int, negative_id long, score long"

    def __init__(self, block: pa.Table, k: int):
        super().__init__(block, k)
        bands = block.column("bands").to_pylist()
        self.low, self.high = np.full((len(bands), max(map(len, bands))), -(NONE + 1)), np.full((len(bands), max(map(len, bands))), NONE + 1)
        for i, b in enumerate(bands):
            self.low[i, : len(b)], self.high[i, : len(b)] = [x["low"] for x in b], [x["high"] for x in b]
        self.each = [Best(len(bands), k) for _ in range(self.low.shape[1])]

    def take(self, rows: pa.Table) -> None:
        for own, score, alike, other, ids in self.scored(rows):
            for r, best in enumerate(self.each):
                best.offer(own, score, ~alike & other & (score >= self.low[own, r][:, None]) & (score <= self.high[own, r][:, None]), ids)

    def result(self) -> Iterator[pa.RecordBatch]:
        for r, best in enumerate(self.each):
            at, ids, score = best.rows()
            yield pa.RecordBatch.from_arrays([pa.array(self.ids[at]), pa.array(self.keys[at]), pa.array(np.full(len(at), r + 1, np.int32)), pa.array(ids), pa.array(score)], self.NAMES)


def joined(anchors: DataFrame, rows: DataFrame, groups: list[int], state: type[Positives], k: int) -> DataFrame:
    """``state`` of each unit: a group of anchors and one part of the rows sent to its cell.  ``groups``: how many each cell has."""
    first = np.cumsum([0, *groups]).tolist()
    parts = max(1, math.ceil(partitions(rows.sparkSession) / max(1, first[-1])))
    group = longs(first)[F.col("cell")] + F.pmod(F.xxhash64("vec_id", F.lit(5)), F.greatest(longs(groups)[F.col("cell")], F.lit(1)))
    rest = [c for c in anchors.columns if c not in ("vec_id", "label", "v", "cell", "far", "norm")]
    spread = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    heads = anchors.withColumn("part", spread(F.lit(parts).cast("bigint"))).select((group * parts + F.col("part")).cast("int").alias("unit"), F.lit(0).alias("kind"), "vec_id", "label", "v", *rest)
    sent = rows.where(longs(groups)[F.col("cell")] > 0).withColumn("block", spread(longs(groups)[F.col("cell")]))
    sent = sent.select(((longs(first)[F.col("cell")] + F.col("block")) * parts + F.pmod(F.xxhash64("vec_id", F.lit(7)), F.lit(parts))).cast("int").alias("unit"), F.lit(1).alias("kind"), "vec_id", "label", "v")
    both = heads.unionByName(sent, allowMissingColumns=True).repartitionById(first[-1] * parts, "unit").sortWithinPartitions("unit", "kind")
    return both.mapInArrow(Joined(lambda block: state(block, k)), state.SCHEMA)


def mine(rows: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score of ``rows`` (see ``quantized``): each
    anchor's ``positives`` best other rows of its label, and for each its ``negatives`` best rows of other labels whose
    score is from ``low`` to ``high`` percent of the positive's."""
    spark = rows.sparkSession
    bounded_batches(spark)
    where = space(rows, is_anchor)
    schema = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    if where is None:
        return spark.createDataFrame([], schema)
    anchors = in_cells(rows.where(is_anchor).dropDuplicates(["vec_id", "label", "v"]), where, True)
    anchors = materialize(anchors.withColumn("anchor", F.xxhash64("vec_id", "label", "v")), "anchors")
    counted = dict(map(tuple, anchors.groupBy("cell").count().collect()))
    groups = [math.ceil(counted.get(c, 0) / ANCHORS) for c in range(where.cells)]

    reach = positive_reach(rows, anchors, where, positives)
    table = {} if reach is None else {label: np.full(where.cells, -math.inf) for label, _ in reach}
    for (label, cell), far in (reach or {}).items():
        table[label][cell] = far

    def may_be_positive(labels: np.ndarray, far: np.ndarray | None) -> np.ndarray:
        if reach is None:
            return np.ones((len(labels), where.cells), bool)
        most = np.stack([table.get(x, np.full(where.cells, -math.inf)) for x in labels.tolist()])
        return most > -math.inf if far is None else np.c_[far <= most[:, :-1], most[:, -1] > -math.inf]

    found = joined(anchors, routed(rows, where, may_be_positive), groups, Positives, positives)
    best = Window.partitionBy("anchor_id", "anchor").orderBy(F.col("score").desc(), "positive_id")
    found = found.withColumn("place", F.row_number().over(best)).where(F.col("place") <= positives)
    bound = lambda percent, up: (F.floor if not up else F.ceil)(F.col("score").cast("decimal(20,0)") * percent / F.lit(100).cast("decimal(3,0)")).cast("decimal(20,0)")
    band = F.struct("place", "positive_id", "score", *[F.least(F.greatest(bound(p, up), F.lit(NONE + 1)), F.lit(-(NONE + 1))).cast("long").alias(n) for n, p, up in (("low", low, True), ("high", high, False))])
    bands = found.groupBy(F.col("anchor_id").alias("vec_id"), "anchor").agg(F.array_sort(F.collect_list(band)).alias("bands"))
    anchors = materialize(anchors.join(bands, ["vec_id", "anchor"]), "positives")

    every = anchors.groupBy("cell").agg(F.max("far"), F.min("norm"), F.max("norm"), F.min(F.array_min("bands.low")), F.max(F.array_max("bands.high")), F.count(F.lit(1))).collect()
    groups, limits = [0] * where.cells, np.full((where.cells, 5), np.nan)
    for r in every:
        groups[r[0]], limits[r[0]] = math.ceil(r[6] / ANCHORS), r[1:6]
    used = np.array([g > 0 for g in groups])

    def may_be_negative(labels: np.ndarray, far: np.ndarray | None) -> np.ndarray:
        to = np.broadcast_to(used, (len(labels), where.cells)).copy()
        if far is not None:
            reach, least, most, lowest, highest = limits[:-1].T
            slack = where.slack
            upper = (most + where.most - np.maximum(0.0, far - reach - slack) ** 2) / 2
            lower = (least + where.most - (far + reach + slack) ** 2) / 2
            rough = 1 + 1e-9 * where.most
            to[:, :-1] &= (upper >= lowest - rough) & (lower <= highest + rough)
        return to

    met = joined(anchors.select("vec_id", "label", "v", "cell", "anchor", "bands"), routed(rows, where, may_be_negative), groups, Negatives, negatives) if any(groups) else None
    if met is None:
        return spark.createDataFrame([], schema)
    best = Window.partitionBy("anchor_id", "anchor", "place").orderBy(F.col("score").desc(), "negative_id")
    met = met.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= negatives).withColumnRenamed("score", "negative_score")
    known = anchors.select(F.col("vec_id").alias("anchor_id"), "anchor", F.inline("bands")).select("anchor_id", "anchor", "place", "positive_id", F.col("score").alias("positive_score"))
    return met.join(known, ["anchor_id", "anchor", "place"]).select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
