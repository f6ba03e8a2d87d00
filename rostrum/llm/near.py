"""N-gram Jaccard join: a MinHash LSH forest with exact verification.

Each distinct set of five-word shingles has a signature of ``TREES`` strings of ``DEEPEST`` minimum hashes.
A tree is the prefix trie of one string of every set.  All tries are made by one global sort: sets that
share a prefix stand together, and the length that a row shares with the row before it is the depth of
their node.  Each row gives one edge, to the first row of the run that shares that length; the edges of
at least a given length connect exactly what the nodes of that depth hold.

Prefixes start at full length and are shortened in rounds.  After a round the links found so far, with
their exact similarities, tell how many links the tries hold in all (each stands for one over the chance
``1 - (1 - s^d)^trees`` that it meets at depth d; one more at the threshold is added, for what no link
shows).  The next length is the longest at which that estimate promises the target recall; the rounds end
when it is reached, or at the length at which a pair at the threshold itself reaches it.

Sets whose nodes connect make a coarse group, and all pairs of a group are held to their exact sets:

* a group of at most ``BLOCK`` sets and ``BLOCK_WORDS`` shingles is one unit of a task;
* of a larger one, the shingles that more than ``RARE`` of its sets have make a set's *kind*: copies of one
  text that were edited apart have few kinds.  Pairs of kinds are decided once for all their sets (in
  blocks of ``KINDS`` kinds); pairs that still need rare shingles in common are found by those.  So what is
  shuffled grows with the sets, and with the square of the kinds, not of the sets, over the block size.

Out come, for each set, the number of documents linked to it, and a spanning forest of the links, whose
components are the classes.

Words are blank-separated and compared in lower case.  Defined cases: fewer than five words make one
shingle; null texts and texts without words have the empty set and are copies of each other; documents
with equal sets are linked and are in one class; repeated rows are copies; extra columns are dropped;
an empty table gives an empty result; similarity exactly at the threshold is a link; a target recall that
no prefix reaches at the threshold is an error.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import bounded_batches, gathered, materialize, partitions
from .components import components
from .tokens import hash_words, mix, seeds, windows

WORDS = 5
THRESHOLD = 0.8
RECALL = 0.99999
TREES = 32
DEEPEST = 12
#: Members and shingles of a group that one task compares at once.
BLOCK = 400
BLOCK_WORDS = 400_000
#: Sets of a large group that share a rare shingle, at most.
RARE = 16
#: Kinds of a block of a large group.
KINDS = 400
#: Steps of similarity in which links are counted.
BINS = 1000


def chance(similarity, depth: int, trees: int = TREES):
    """That two sets agree in some tree down to ``depth``."""
    return 1 - (1 - similarity**depth) ** trees


def shortest(threshold: float = THRESHOLD, recall: float = RECALL, trees: int = TREES) -> int:
    """The longest prefix that reaches the target recall for pairs at the threshold: rounds go no further."""
    for d in range(DEEPEST, 0, -1):
        if chance(threshold, d, trees) >= recall:
            return d
    raise ValueError("no prefix reaches the target recall; plant more trees")


def recall_at(depth: int, met_at: int, counts: dict[int, int], threshold: float) -> float:
    """The share of all links expected at ``depth``, from counts of links by step of similarity found at ``met_at``."""
    s = np.array([*(k / BINS for k in counts), threshold])
    n = np.array([*(float(c) for c in counts.values()), 1.0])
    n[:-1] /= chance(s[:-1], met_at)  # each link found stands for those like it that did not meet
    return float((n * chance(s, depth)).sum() / n.sum())


def shingles(text: str | None) -> np.ndarray:
    """Distinct shingle hashes of a whole text, ascending."""
    words = (text or "").lower().encode("utf-8", "surrogatepass").split()
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(hash_words(words), min(WORDS, len(words))))


_SALT = (seeds(TREES * DEEPEST, 17) >> np.uint64(32)).astype(np.uint32)
_ODD = (seeds(TREES * DEEPEST, 18) >> np.uint64(32)).astype(np.uint32) | np.uint32(1)


def minima(items: np.ndarray) -> np.ndarray:
    """The minimum hashes of one set, tree by tree."""
    low = (items ^ (items >> np.uint64(32))).astype(np.uint32)[:, None]
    least = np.full(TREES * DEEPEST, np.iinfo(np.uint32).max, np.uint32)
    for k in range(0, len(low), 64):
        np.minimum(least, ((low[k : k + 64] ^ _SALT) * _ODD).min(0), out=least)
    return least


def strings(least: np.ndarray, floor: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each row of minimum hashes one string for each tree: a name of its first ``floor`` ones (and the tree), and a
    byte of each further one, the first in the highest place."""
    values = mix(least.astype(np.uint64)).reshape(-1, TREES, DEEPEST)
    head, tail = np.tile(np.arange(TREES, dtype=np.uint64), (len(values), 1)), np.zeros(values.shape[:2], np.int64)
    for d in range(floor):
        head = mix(head * np.uint64(0x9E3779B97F4A7C15) + values[:, :, d])
    for d in range(floor, DEEPEST):
        tail = (tail << 8) | (values[:, :, d] & np.uint64(255)).astype(np.int64)
    return head.view(np.int64), tail


def shared_lengths(heads: np.ndarray, tails: np.ndarray, floor: int) -> np.ndarray:
    """Length of the prefix that each string but the first shares with the one before; 0 if under ``floor``."""
    same, apart = heads[1:] == heads[:-1], tails[1:] ^ tails[:-1]
    length = np.full(len(same), floor)
    for d in range(DEEPEST - floor):
        length += (apart >> (8 * (DEEPEST - floor - 1 - d))) == 0
    return np.where(same, length, 0)


def _sketched(floor: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, first, second, least = [], [], [], []
            for t in b.column("text").to_pylist():
                s = shingles(t)
                sizes.append(len(s))
                with np.errstate(over="ignore"):
                    first.append(int(mix(s).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                    second.append(int(mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64).view(np.int64)) if len(s) else 0)
                if len(s):
                    least.append(minima(s))
            head, tail = strings(np.array(least, np.uint32).reshape(-1, TREES * DEEPEST), floor)
            ends = np.cumsum([0] + [TREES * (n > 0) for n in sizes]).astype(np.int32)
            lists = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x.ravel())) for x in (head, tail)]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("text_hash"), pa.array(sizes, pa.int32()), pa.array(first, pa.int64()), pa.array(second, pa.int64()), *lists], ["doc_id", "text_hash", "size", "set1", "set2", "heads", "tails"])

    return run


_EDGES = "a long, b long, shared int, head long, tail long, at int"


def _tries(floor: int):
    """Sorted strings of one partition: an edge for each that shares a prefix with the one before it (``at`` null),
    and the partition's first (0) and last (1) row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, carry = None, np.zeros(DEEPEST + 1, np.int64)
        for t in gathered(batches, 50_000):
            head, tail, ids = (t.column(c).to_numpy() for c in ("head", "tail", "id"))
            before = last if last is not None else (head[0] ^ 1, tail[0], ids[0])
            length = shared_lengths(np.r_[before[0], head], np.r_[before[1], tail], floor)
            at, first = np.arange(len(ids)), np.zeros(len(ids), np.int64)
            for d in range(floor, DEEPEST + 1):
                start = np.maximum.accumulate(np.where(length < d, at, -1))
                own = np.where(start >= 0, ids[start], carry[d])
                first[length == d] = own[length == d]
                carry[d] = own[-1]
            edge = np.flatnonzero(length)
            rows = [(first[edge], ids[edge], length[edge], None)]
            if last is None:
                rows.append((ids[:1], ids[:1], head[:1], tail[:1], 0))
            last = (head[-1], tail[-1], ids[-1])
            yield _edge_batch(*rows)
        if last is not None:
            one = [np.array([x]) for x in last]
            yield _edge_batch((one[2][:0],) * 3, (one[2], one[2], one[0], one[1], 1))

    return run


def _edge_batch(edges: tuple, end: tuple | None = None) -> pa.RecordBatch:
    a, b, length = edges[:3]
    n, m = len(a), 0 if end is None else 1
    null = lambda kind: pa.nulls(n, kind)
    cat = lambda x, y, kind: pa.concat_arrays([x, pa.array(y, kind)])
    ends = end or ((),) * 4
    return pa.RecordBatch.from_arrays(
        [cat(pa.array(a, pa.int64()), ends[0], pa.int64()), cat(pa.array(b, pa.int64()), ends[1], pa.int64()), cat(pa.array(length.astype(np.int32)), [None] * m, pa.int32()),
         cat(null(pa.int64()), ends[2], pa.int64()), cat(null(pa.int64()), ends[3], pa.int64()), cat(null(pa.int32()), [end[4]] if end else [], pa.int32())],
        [f.split()[0] for f in _EDGES.split(", ")],
    )


def forest(classes: DataFrame, floor: int) -> DataFrame:
    """Edges (a, b, shared) of the sorted prefix tries over ``classes`` (id, heads, tails).  The driver sees two rows
    of each partition of the sort, to join the runs that its borders cut."""
    spark = classes.sparkSession
    rows = classes.select("id", F.explode(F.arrays_zip("heads", "tails")).alias("s")).select(F.col("s.heads").alias("head"), F.col("s.tails").alias("tail"), "id")
    order = ["head", "tail", "id"]
    found = materialize(rows.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order).mapInArrow(_tries(floor), _EDGES), "tries")
    ends = sorted((r["head"], r["tail"], r["a"], r["at"]) for r in found.where("at is not null").select("head", "tail", "a", "at").collect())
    joints = []
    for x, y in zip(ends, ends[1:]):
        if (x[3], y[3]) == (1, 0):
            shared = int(shared_lengths(np.array([x[0], y[0]]), np.array([x[1], y[1]]), floor)[0])
            joints += [(x[2], y[2], shared)] * (shared > 0)
    edges = found.where("at is null").select("a", "b", "shared")
    if joints:
        edges = edges.union(spark.createDataFrame(joints, "a long, b long, shared int"))
    return materialize(edges.where("a <> b").groupBy("a", "b").agg(F.max("shared").alias("shared")), "edges")


def overlaps(sets: list[np.ndarray], rows: np.ndarray, cols: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of the sets' pairs (rows[k], cols[k])."""
    if len(rows) < 40:
        return np.array([np.isin(sets[a], sets[b], assume_unique=True).sum() for a, b in zip(rows, cols, strict=True)], np.int64)
    used, place = np.unique(np.concatenate([rows, cols]), return_inverse=True)
    r, c = place[: len(rows)], place[len(rows) :]
    owner = np.repeat(np.arange(len(used)), [len(sets[k]) for k in used])
    _, item, times = np.unique(np.concatenate([sets[k] for k in used]), return_inverse=True, return_counts=True)
    keep = times[item] > 1
    owner, item = owner[keep], item[keep]
    order = np.argsort(item, kind="stable")
    owner, item = owner[order], item[order]
    # items of equal owners count together
    starts = np.flatnonzero(np.r_[True, item[1:] != item[:-1]]) if len(item) else np.empty(0, np.int64)
    kinds: dict[bytes, int] = {}
    for a, b in zip(starts, np.r_[starts[1:], len(item)], strict=True):
        key = owner[a:b].astype(np.int32).tobytes()
        kinds[key] = kinds.get(key, 0) + 1
    total = np.zeros((len(used), len(used)), np.float32)
    lists = list(kinds.items())
    for k in range(0, len(lists), 2048):
        part = lists[k : k + 2048]
        x = np.zeros((len(used), len(part)), np.float32)
        for j, (key, _) in enumerate(part):
            x[np.frombuffer(key, np.int32), j] = 1
        total += (x * np.array([n for _, n in part], np.float32)) @ x.T
    return np.rint(total[r, c]).astype(np.int64)


def linked(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, threshold: float, size: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (one of ``left``, one of ``right``) that are alike, and their similarities.  With ``size``, sets are parts
    of larger ones of those sizes that share nothing else."""
    size = np.array([len(s) for s in sets]) if size is None else size
    high = np.maximum(size[left][:, None], size[right][None, :])
    low = np.minimum(size[left][:, None], size[right][None, :])
    i, j = np.nonzero(low >= threshold * high - 1e-9)
    rows, cols = left[i], right[j]
    if left is right:
        rows, cols = rows[i < j], cols[i < j]
    if not len(rows):
        return rows, cols, np.empty(0)
    both = overlaps(sets, rows, cols)
    alike = both >= threshold * (size[rows] + size[cols] - both) - 1e-9
    rows, cols, both = rows[alike], cols[alike], both[alike]
    return rows, cols, both / np.maximum(size[rows] + size[cols] - both, 1)


#: Rows of what was verified: an edge of a spanning forest (a, b), the links of a set (a, links), or links by step of
#: similarity (bin, links); ``own``: links also to the others of its kind.
_FOUND = "a long, b long, links long, bin int, own boolean"


def _found(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * 5
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.bool_()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["a", "b", "links", "bin", "own"])


def _spanning(pairs: Iterator[tuple[int, int]], n: int) -> Iterator[tuple[int, int]]:
    root = list(range(n))
    for x, y in pairs:
        while root[x] != x:
            root[x] = x = root[root[x]]
        while root[y] != y:
            root[y] = y = root[root[y]]
        if x != y:
            root[max(x, y)] = min(x, y)
            yield x, y


def _by_step(similarity: np.ndarray, weight: np.ndarray | None = None) -> list[tuple]:
    steps, which = np.unique((similarity * BINS + 1e-9).astype(np.int32), return_inverse=True)
    return [(None, None, int(n), int(k), None) for k, n in zip(steps, np.bincount(which, weight), strict=True)]


def _together(key: list[str], work):
    """Run ``work`` on the rows of each key, which stand together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        for b in batches:
            out = []
            for r in b.to_pylist():
                k = tuple(r[c] for c in key)
                if k != now and held:
                    out += work(held)
                    held = []
                now = k
                held.append(r)
            yield _found(out)
        if held:
            yield _found(work(held))

    return run


def _small(threshold: float):
    """All pairs of one group."""

    def work(rows: list[dict]) -> list[tuple]:
        rows = list({r["id"]: r for r in rows}.values())
        every = np.arange(len(rows))
        a, b, s = linked([shingles(r["text"]) for r in rows], every, every, threshold)
        copies = np.array([r["copies"] for r in rows], np.int64)
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        out = [(rows[x]["id"], rows[y]["id"], None, None, None) for x, y in _spanning(zip(a.tolist(), b.tolist(), strict=True), len(rows))]
        return out + _by_step(s) + [(r["id"], None, int(n), None, None) for r, n in zip(rows, links, strict=True) if n]

    return work


def _exploded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        sets = [shingles(t) for t in b.column("text").to_pylist()]
        sizes = [len(s) for s in sets]
        item = np.concatenate(sets).view(np.int64) if sets else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(c).to_numpy(), sizes)) for c in ("group", "id")] + [pa.array(item)], ["group", "id", "item"])


def _kinds(threshold: float):
    """All pairs of kinds of one block, or of two."""

    def work(rows: list[dict]) -> list[tuple]:
        sets = [np.array(r["common"], np.int64).view(np.uint64) for r in rows]
        size, n = np.array([r["size"] for r in rows]), np.array([r["n"] for r in rows], np.int64)
        copies = np.array([r["copies"] for r in rows], np.int64)
        i, j, block = rows[0]["i"], rows[0]["j"], np.array([r["block"] for r in rows])
        left = np.flatnonzero(block == i)
        a, b, s = linked(sets, left, left if i == j else np.flatnonzero(block == j), threshold, size)
        links = np.bincount(a, copies[b], len(rows)) + np.bincount(b, copies[a], len(rows))
        out = [(rows[x]["id"], rows[y]["id"], None, None, None) for x, y in _spanning(zip(a.tolist(), b.tolist(), strict=True), len(rows))]
        out += _by_step(s, n[a] * n[b])
        own = np.zeros(len(rows), bool)
        if i == j:  # sets of one kind share all that is common
            common = np.array([len(x) for x in sets])
            own = (n > 1) & (common >= threshold * (2 * size - common) - 1e-9)
            out += _by_step((common / np.maximum(2 * size - common, 1))[own], (n * (n - 1) // 2)[own])
        return out + [(r["id"], None, int(k), None, bool(o)) for r, k, o in zip(rows, links, own, strict=True) if k or o]

    return work


def _large(rows: DataFrame, threshold: float) -> DataFrame:
    """``_FOUND`` of the large groups' sets (group, id, copies, size, text)."""
    spark = rows.sparkSession
    n = partitions(spark)
    rows = rows.dropDuplicates(["id"])
    items = materialize(rows.select("group", "id", "text").mapInArrow(_exploded, "group long, id long, item long"), "items")
    times = materialize(items.groupBy("group", "item").agg(F.count(F.lit(1)).alias("times")).where("times > 1"), "times")
    # a common shingle has very many rows: they are dealt by a salt as well
    salted = times.where(F.col("times") > RARE).select("group", "item", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(15).cast("bigint"))).alias("salt"))
    common = items.withColumn("salt", F.pmod("id", F.lit(16))).join(salted, ["group", "item", "salt"]).groupBy("id").agg(F.sort_array(F.collect_list("item")).alias("common"))
    kind = F.struct(F.xxhash64("common"), F.xxhash64("common", F.lit(1)))
    sets = rows.select("group", "id", "copies", "size").join(common, "id", "left").withColumn("common", F.coalesce("common", F.array().cast("array<bigint>"))).withColumn("kind", kind)
    sets = materialize(sets, "sets")
    by_kind = ["group", "size", "kind"]
    kinds = materialize(sets.groupBy(*by_kind).agg(F.min("id").alias("id"), F.sum("copies").alias("copies"), F.count(F.lit(1)).alias("n"), F.first("common").alias("common")), "kinds")
    blocks = F.greatest(F.ceil(F.count(F.lit(1)) / KINDS), F.ceil(F.sum(F.size("common")) / BLOCK_WORDS)).cast("int")
    met = kinds.join(kinds.groupBy("group").agg(blocks.alias("blocks")), "group").withColumn("block", F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int"))
    tasks = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda k: F.struct(F.least(k, F.col("block")).alias("i"), F.greatest(k, F.col("block")).alias("j")))
    met = met.withColumn("task", F.explode(tasks)).select("group", "task.i", "task.j", "block", "id", "copies", "n", "size", "common")
    met = met.repartition(n, "group", "i", "j").sortWithinPartitions("group", "i", "j")
    of_kinds = materialize(met.mapInArrow(_together(["group", "i", "j"], _kinds(threshold)), _FOUND), "kinds")
    # what holds of a kind holds of its sets
    told = of_kinds.where("own is not null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"), F.max("own").alias("own"))
    told = kinds.select("id", *by_kind, F.col("copies").alias("all")).join(told, "id").withColumnRenamed("id", "least")
    of_sets = sets.select("id", "copies", *by_kind).join(told, by_kind).select(F.col("id").alias("a"), F.when(F.col("id") != F.col("least"), F.col("least")).alias("b"), (F.col("links") + F.when(F.col("own"), F.col("all") - F.col("copies")).otherwise(0)).alias("links"))
    # pairs that the kinds leave open must share rare shingles
    few = items.join(times.where(F.col("times") <= RARE).select("group", "item"), ["group", "item"]).groupBy("group", "item").agg(F.sort_array(F.collect_list("id")).alias("ids"))
    pairs = F.flatten(F.transform("ids", lambda x, k: F.transform(F.slice("ids", k + 2, RARE), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    pairs = few.select(F.explode(pairs).alias("p")).groupBy("p.a", "p.b").agg(F.count(F.lit(1)).alias("rare"))
    end = lambda c: sets.select(F.col("id").alias(c), F.struct("copies", "size", "common").alias(f"set_{c}"))
    both = F.size(F.array_intersect("set_a.common", "set_b.common"))
    alike = lambda x: x >= threshold * (F.col("set_a.size") + F.col("set_b.size") - x) - 1e-9
    pairs = pairs.join(end("a"), "a").join(end("b"), "b").withColumn("both", both).where(alike(F.col("both") + F.col("rare")) & ~alike(F.col("both")))
    similarity = (F.col("both") + F.col("rare")) / (F.col("set_a.size") + F.col("set_b.size") - F.col("both") - F.col("rare"))
    pairs = materialize(pairs.select("a", "b", F.col("set_a.copies").alias("n_a"), F.col("set_b.copies").alias("n_b"), F.floor(similarity * BINS + 1e-9).cast("int").alias("bin")), "pairs")
    none = lambda kind: F.lit(None).cast(kind)
    shape = lambda df, **c: df.select(*[c.get(f.split()[0], none(f.split()[1])).alias(f.split()[0]) for f in _FOUND.split(", ")])
    a, b = F.col("a"), F.col("b")
    parts = [
        of_kinds.where("own is null"),
        shape(of_sets, a=a, links=F.col("links")),
        shape(of_sets.where("b is not null"), a=a, b=b),
        shape(pairs, a=a, b=b),
        shape(pairs, a=a, links=F.col("n_b")),
        shape(pairs, a=b, links=F.col("n_a")),
        shape(pairs.groupBy("bin").agg(F.count(F.lit(1)).alias("links")), bin=F.col("bin"), links=F.col("links")),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def verified(texts: DataFrame, groups: DataFrame, threshold: float) -> DataFrame:
    """``_FOUND`` of all pairs within the coarse ``groups`` (id, group) of ``texts`` (id, copies, size, text)."""
    spark = texts.sparkSession
    sizes = groups.join(texts.select("id", "size"), "id").groupBy("group").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("words"))
    large = materialize(sizes.where((F.col("n") > BLOCK) | (F.col("words") > BLOCK_WORDS)).select("group"), "large")
    met = texts.join(groups, "id")
    if large.isEmpty():
        small, out = met, None
    else:
        small, out = met.join(large, "group", "left_anti"), _large(met.join(large, "group"), threshold)
    dealt = small.select("group", "id", "copies", "text").repartition(partitions(spark), "group").sortWithinPartitions("group")
    found = dealt.mapInArrow(_together(["group"], _small(threshold)), _FOUND)
    return materialize(found if out is None else found.unionByName(out), "links")


def near_join(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document: doc_id, class_id (least doc_id of its class), set_id (least doc_id with the same
    set of shingles), n_links (other documents at or above the threshold)."""
    spark = docs.sparkSession
    bounded_batches(spark)
    floor = shortest(threshold, recall)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    sketches = materialize(texts.mapInArrow(_sketched(floor), "doc_id long, text_hash long, size int, set1 long, set2 long, heads array<long>, tails array<long>"), "sketches")
    same = ["size", "set1", "set2"]
    # a set's id is a number of its own, as doc_id may be null or repeated; written once, it stays
    classes = sketches.groupBy(*same).agg(F.count(F.lit(1)).alias("copies"), F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_hash", "heads", "tails")).alias("m"))
    classes = materialize(classes.select(*same, "copies", "m.doc_id", "m.text_hash", "m.heads", "m.tails", F.monotonically_increasing_id().alias("id")), "classes")
    edges = forest(classes, floor)
    ends = edges.select(F.col("a").alias("id")).union(edges.select(F.col("b").alias("id"))).distinct()
    members = classes.select("id", "doc_id", "text_hash", "copies", "size").join(ends, "id").alias("m")
    in_question = texts.alias("t").join(members, F.col("t.doc_id").eqNullSafe(F.col("m.doc_id")) & (F.col("t.text_hash") == F.col("m.text_hash")))
    in_question = materialize(in_question.select("m.id", "m.copies", "m.size", "t.text"), "texts")
    depth = DEEPEST
    while True:
        groups = materialize(components(edges.where(F.col("shared") >= depth).select("a", "b")).withColumnRenamed("component", "group"), "groups")
        found = verified(in_question, groups, threshold)
        counts = {r["bin"]: r["n"] for r in found.where("bin is not null").groupBy("bin").agg(F.sum("links").alias("n")).collect()}
        if depth == floor or recall_at(depth, depth, counts, threshold) >= recall:
            break
        depth = max([d for d in range(floor, depth) if recall_at(d, depth, counts, threshold) >= recall], default=floor)
    links = found.where("links is not null and bin is null").groupBy(F.col("a").alias("id")).agg(F.sum("links").alias("links"))
    parts = components(found.where("b is not null").select("a", "b"))
    sets = classes.select("id", *same, "copies", F.col("doc_id").alias("set_id"), F.col("text_hash").alias("set_hash")).join(links, "id", "left").join(parts, "id", "left").withColumn("component", F.coalesce("component", "id"))
    named = materialize(sets, "named")
    names = named.groupBy("component").agg(F.min(F.struct(F.col("set_id").isNull().alias("none"), "set_id", "set_hash")).alias("m")).select("component", F.col("m.set_id").alias("class_id"), F.col("m.set_hash").alias("class_hash"))
    named = named.join(names, "component").select(*same, "copies", "set_id", "links", "class_id", "class_hash")
    return sketches.select("doc_id", *same).join(named, same).select("doc_id", "class_id", "set_id", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).cast("long").alias("n_links"), "class_hash")


def keep_one(docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with one document of each class, the one of the least doc_id (then of the least text hash,
    nulls last); of repeated rows, one.  All columns pass through, whatever their names."""
    kept = near_join(docs, threshold).select("class_id", "class_hash").distinct().alias("kept")
    out = docs.alias("row").join(kept, F.col("row.doc_id").eqNullSafe(F.col("kept.class_id")) & (F.xxhash64("row.text") == F.col("kept.class_hash")), "left_semi")
    repeated = docs.select("doc_id").groupBy("doc_id").agg(F.count(F.lit(1)).alias("times")).where("times > 1")
    return out if repeated.isEmpty() else out.dropDuplicates(["doc_id", "text"])
