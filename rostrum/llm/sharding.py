"""Sharding by balanced label propagation, with DataFrame operations only.

Documents with equal texts form one node; a group of copies larger than a quarter of a shard is split
into pieces by ``doc_id``.  Nodes are linked through shared keys of the whole text, so that a link shared
by many nodes is one hyperedge: votes are counts by (link, shard), never pairs, and each link's votes
are divided by its other nodes, so that a line of very many texts does not drown out a near copy.  The
keys are hashes of runs of five words, taken wherever in the text the first of the five is an anchor: its
own hash says so (one of ``EVERY`` words), or is the least of the text.  Equal passages therefore have equal
keys, and every text of a word or more has one.
Keys that only one node has are dropped before the rounds.  Each round moves nodes towards the shard that holds most of their neighbours, as far as the
shards' capacities allow; only half of the nodes, drawn anew by hash, may move in a round, so that two
neighbours can't trade places for ever.  Then nodes, those with fewest neighbours first, leave the
shards over the mean for those under it until the bytes are equal to within a small node.

What the driver sees is bounded: sums by (from, to, gain, cell), and the nodes larger than 1/64 of a
shard, of which there are at most 64 a shard.

Defined cases: a null text has size 1 and CRC 0 and groups with the other null texts; equal texts are
in one shard unless their group had to be split; fewer than five words are one run, a blank text has no
links; repeated rows are rows of their own with slots of their own; extra columns are dropped; an empty table
gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from .common import discard, longs, materialize
from .fingerprints import BLANKS, let

#: One of so many words is an anchor; a power of two.
EVERY = 16
#: A link with more than this part of all ends, or this many, is dealt by ``SALTS`` salts; there are at most ``HOT`` such.
HOT = 4096
LOT = 2000
SALTS = 32
#: A vote of all other nodes of a link; votes are whole numbers, so that sums do not depend on their order.
VOTE = 1 << 20
#: Cells by which moves are admitted.
CELLS = 128
BIG = 64
#: A group of copies over this share of a shard is split.
SPLIT = 4
ROWS_A_CELL = 20_000

GROUP = ["text_hash", "text_crc32", "size"]


def links(text: Column) -> Column:
    """The link keys of a text, without repeats."""
    bare = F.btrim(F.lower(text), F.lit(BLANKS))

    def of(hashes: Column) -> Column:
        # evaluated once: the least hash, not once a word
        def anchored(least: Column) -> Column:
            anchor = lambda h, i: ((h.bitwiseAND(EVERY - 1) == 0) | (h == least)) & (i <= F.size(hashes) - 5)
            return F.array_distinct(F.array_compact(F.transform(hashes, lambda h, i: F.when(anchor(h, i), F.xxhash64(F.slice(hashes, i + 1, 5))))))

        return F.when(F.size(hashes) < 5, F.array(F.xxhash64(hashes))).otherwise(let(F.array_min(F.slice(hashes, 1, F.size(hashes) - 4)), anchored))

    return F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<bigint>")).otherwise(let(F.transform(F.split(bare, r"\s+"), lambda w: F.xxhash64(w)), of))


def sized(docs: DataFrame) -> DataFrame:
    """doc_id, size, CRC and hash of each row, with its link keys."""
    text = F.col("text")
    return docs.select(
        "doc_id",
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(text.cast("binary")), F.lit(0)).alias("text_crc32"),
        F.xxhash64(text, F.lit(1)).alias("text_hash"),
        links(text).alias("links"),
    )


def _place_big(big: list, heavy: set, n: int, mean: float) -> dict[int, int]:
    """Shards of the largest nodes (a bounded list): the pieces of a split group side by side, the others
    where most room is."""
    load = [0.0] * n
    shard_of = {}
    pieces = sorted((r for r in big if tuple(r[c] for c in GROUP) in heavy), key=lambda r: ([-r["size"], r["text_hash"], r["text_crc32"]], r["piece"]))
    at = 0
    for r in pieces:
        if load[at] + r["bytes"] > 0.97 * mean:
            at = min(range(n), key=lambda s: load[s])
        shard_of[r["node"]] = at
        load[at] += r["bytes"]
    for r in sorted((r for r in big if r["node"] not in shard_of), key=lambda r: (-r["bytes"], r["node"])):
        at = min(range(n), key=lambda s: load[s])
        shard_of[r["node"]] = at
        load[at] += r["bytes"]
    return shard_of


def _in_table(cell: Column, table: dict[int, int]) -> Column:
    """Lookup in a bounded table by number."""
    row = longs([table.get(k, -1) for k in range(max(table, default=0) + 1)])
    return F.nullif(F.get(row, cell.cast("int")), F.lit(-1).cast("bigint")).cast("int")


def _loads(state: DataFrame, n: int) -> list[int]:
    got = {r["shard"]: r["b"] for r in state.groupBy("shard").agg(F.sum("bytes").alias("b")).collect()}
    return [got.get(s, 0) for s in range(n)]


def _salts(hot: Column) -> Column:
    return F.explode(F.when(hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0))))


def _ends(nodes: DataFrame) -> DataFrame:
    """node and its ``ends`` (link, salt, hot), for the links that other nodes have too.  The few links of very many
    nodes are salted, here and in the rounds."""
    ends = materialize(nodes.select("node", F.explode("links").alias("link")), "ends")
    met = materialize(ends.groupBy("link").agg(F.count(F.lit(1)).alias("all")).where("all > 1"), "met")
    total = met.agg(F.coalesce(F.sum("all"), F.lit(0))).first()[0]
    hot = met.where(F.col("all") > max(LOT, total / HOT)).select("link", F.lit(True).alias("hot"))  # fewer than HOT rows
    flag = F.coalesce("hot", F.lit(False))
    salted = ends.join(F.broadcast(hot), "link", "left").select("node", "link", flag.alias("hot"), F.when(flag, F.pmod(F.xxhash64("node", F.lit(9)), F.lit(SALTS))).otherwise(0).cast("int").alias("salt"))
    shared = met.join(F.broadcast(hot), "link", "left").select("link", _salts(flag).alias("salt"))
    return salted.join(shared, ["link", "salt"]).groupBy("node").agg(F.collect_list(F.struct("link", "salt", "hot")).alias("ends"))


def _votes(state: DataFrame, n: int) -> DataFrame:
    """State with ``votes``: linked neighbours of a node by shard, itself left out, a link's together ``VOTE``."""
    ends = state.select("node", "shard", F.explode("ends").alias("e")).select("node", "shard", "e.*")
    count = [F.sum(F.when(F.col("shard") == s, 1).otherwise(0)).alias(f"c{s}") for s in range(n)]
    by_link = ends.groupBy("link").agg(F.count(F.lit(1)).alias("all"), F.max("hot").alias("hot"), *count).withColumn("w", F.greatest(F.lit(1), F.floor(VOTE / (F.col("all") - 1))))
    by_link = by_link.select("link", "w", *[f"c{s}" for s in range(n)], _salts(F.col("hot")).alias("salt"))
    around = ends.join(by_link, ["link", "salt"]).groupBy("node", "shard").agg(F.sum("w").alias("own"), *[F.sum(F.col("w") * F.col(f"c{s}")).alias(f"c{s}") for s in range(n)])
    votes = F.array(*[F.col(f"c{s}") - F.when(F.col("shard") == s, F.col("own")).otherwise(0) for s in range(n)])
    return state.join(around.select("node", votes.alias("votes")), "node")


def _gain(more: Column) -> Column:
    """2 for at least a whole link's votes, 1 for less, 0 for none."""
    return F.when(more >= VOTE, 2).when(more > 0, 1).otherwise(0)


def _moved(cells: DataFrame, moves: dict[int, int]) -> DataFrame:
    to = _in_table(F.col("cell"), moves)
    return cells.select(*[c for c in cells.columns if c not in ("shard", "cell")], F.coalesce(to, F.col("shard")).cast("int").alias("shard"))


def _round(state: DataFrame, rest: list[int], n: int, mean: float, seed: int, slack: float) -> tuple[DataFrame, DataFrame]:
    """One round of propagation of the linked nodes under the shards' capacities, of which the ``rest`` is taken: the new
    state, and the written table that it reads."""
    voted = _votes(state, n)
    shard = F.col("shard")
    best = F.array_max("votes")
    drawn = F.pmod(F.xxhash64("node", F.lit(1000 + seed)), F.lit(2)) == 0
    voted = voted.withColumn("gain", _gain(best - F.col("votes")[shard])).withColumn("to", (F.array_position("votes", best) - 1).cast("int"))
    cell = ((F.col("gain").cast("int") * n + shard) * n + F.col("to")) * CELLS + F.pmod(F.xxhash64("node", F.lit(3)), F.lit(CELLS)).cast("int")
    voted = materialize(voted.withColumn("cell", F.when(F.col("movable") & drawn & (F.col("gain") > 0), cell).cast("int")).drop("votes", "gain", "to"), "votes")
    load = [a + b for a, b in zip(_loads(voted, n), rest, strict=True)]
    wanted = [(r["cell"], r["b"]) for r in voted.where("cell is not null").groupBy("cell").agg(F.sum("bytes").alias("b")).collect()]
    moves: dict[int, int] = {}
    left = sorted(wanted, key=lambda r: (-(r[0] // CELLS // n // n), r[0] % CELLS, r[0]))  # the largest gains first
    while left:  # what leaves a shard makes room for others
        waiting = []
        for c, size in left:
            a, b = c // CELLS // n % n, c // CELLS % n
            if load[b] + size <= mean * (1 + slack) and load[a] - size >= mean * (1 - slack):
                load[a] -= size
                load[b] += size
                moves[c] = b
            else:
                waiting.append((c, size))
        if len(waiting) == len(left):
            break
        left = waiting
    return _moved(voted, moves), voted


def _balanced(state: DataFrame, n: int, mean: float, seed: int) -> DataFrame:
    """Nodes leave shards over the mean for those under it, the ones with fewest links first."""
    size = F.when(F.col("bytes") * 1024 < mean, 0).when(F.col("bytes") * 256 < mean, 1).otherwise(2)
    cell = F.when(F.col("movable"), ((F.col("linked").cast("int") * 3 + size) * n + F.col("shard")) * CELLS + F.pmod(F.xxhash64("node", F.lit(seed)), F.lit(CELLS)))
    cells = state.withColumn("cell", cell.cast("int"))
    load = _loads(state, n)
    over, moves = [b - mean for b in load], {}
    for r in sorted(cells.where("cell is not null").groupBy("cell").agg(F.sum("bytes").alias("b")).collect(), key=lambda r: r["cell"]):
        a = r["cell"] // CELLS % n
        b = min(range(n), key=lambda s: over[s])
        if over[a] > 0 and r["b"] <= over[a] + 1 and r["b"] <= -over[b] + 1:
            over[a] -= r["b"]
            over[b] += r["b"]
            moves[r["cell"]] = b
    out = materialize(_moved(cells, moves), "labels")
    discard(state)
    return out


def shards(docs: DataFrame, n_shards: int = 8, rounds: int = 6, slack: float = 0.04, passes: int = 4) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot (gapless from 0 within a shard) of each row."""
    base = materialize(sized(docs), "sized")
    rows, total = base.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    mean = total / n_shards
    groups = base.groupBy(*GROUP).agg(F.sum("size").alias("bytes"))
    # over a quarter of a shard: fewer than 4 * n_shards groups
    heavy = groups.where(F.col("bytes") > mean / SPLIT).collect() if rows else []
    splits = {(r["text_hash"], r["text_crc32"], r["size"]): max(1, int(r["bytes"] * 2 * BIG / mean)) for r in heavy}
    parts = F.lit(1)
    for (h, crc, size), k in splits.items():
        parts = F.when((F.col("text_hash") == h) & (F.col("text_crc32") == crc) & (F.col("size") == size), k).otherwise(parts)
    pieced = base.withColumn("piece", F.pmod(F.xxhash64("doc_id", F.lit(5)), parts).cast("int"))
    pieced = pieced.withColumn("node", F.xxhash64(*GROUP, "piece"))
    nodes = materialize(pieced.groupBy("node").agg(F.sum("size").alias("bytes"), *[F.first(c).alias(c) for c in [*GROUP, "piece", "links"]]), "nodes")
    split_keys = F.lit(False)
    for h, crc, size in splits:
        split_keys = split_keys | ((F.col("text_hash") == h) & (F.col("text_crc32") == crc) & (F.col("size") == size))
    big = nodes.where((F.col("bytes") > mean / BIG) | split_keys).drop("links").collect() if rows else []
    fixed = _place_big(big, set(splits), n_shards, mean)
    # the others start where there is room, equal texts together
    room = [mean] * n_shards
    for r in big:
        room[fixed[r["node"]]] -= r["bytes"]
    room = [max(0.0, x) for x in room]
    share, at = F.lit(n_shards - 1), 0.0
    edges = []
    for x in room:
        at += x / (sum(room) or 1)
        edges.append(at)
    unit = F.pmod(F.xxhash64("node", F.lit(2)), F.lit(1 << 30)) / float(1 << 30)
    for s in reversed(range(n_shards - 1)):
        share = F.when(unit < edges[s], s).otherwise(share)
    place = F.create_map(*[F.lit(x) for kv in sorted(fixed.items()) for x in kv])[F.col("node")] if fixed else F.lit(None).cast("int")
    # pieces of a split group are small enough to move when the sizes are made equal
    start = nodes.select("node", "bytes", (place.isNull() | split_keys).alias("movable"), F.coalesce(place, share).cast("int").alias("shard"))
    if rows:
        state = written = materialize(start.join(_ends(nodes), "node"), "labels")
        every, linked = _loads(start, n_shards), _loads(state, n_shards)
        rest = [a - b for a, b in zip(every, linked, strict=True)]
        for k in range(rounds):
            state, now = _round(state, rest, n_shards, mean, k, slack)
            discard(written)
            written = now
        found = state.select("node", F.col("shard").alias("to"), F.lit(True).alias("linked"))
        state = materialize(start.join(found, "node", "left").select("node", "bytes", "movable", F.coalesce("to", "shard").alias("shard"), F.coalesce("linked", F.lit(False)).alias("linked")), "labels")
        for k in range(passes):
            state = _balanced(state, n_shards, mean, 100 + k)
        start = state
    placed = pieced.drop("links", "piece").join(start.select("node", "shard"), "node")
    cells = max(1, -(-rows // (n_shards * ROWS_A_CELL)))
    placed = placed.withColumn("cell", F.pmod(F.xxhash64("doc_id", F.lit(6)), F.lit(cells)).cast("int"))
    counts = placed.groupBy("shard", "cell").agg(F.count(F.lit(1)).alias("n"))
    before = counts.select("shard", "cell", (F.sum("n").over(Window.partitionBy("shard").orderBy("cell")) - F.col("n")).alias("before"))
    inside = F.row_number().over(Window.partitionBy("shard", "cell").orderBy("doc_id", "text_hash"))
    numbered = placed.withColumn("inside", inside - 1).join(before, ["shard", "cell"])
    return numbered.select("doc_id", "size", "text_crc32", "shard", (F.col("before") + F.col("inside")).cast("long").alias("slot"))
