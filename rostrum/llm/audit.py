"""Which filter removes what, in every order: a first-failure lookup.

Five filters give a document a five-bit mask of the conditions it fails.  Whatever the order, a document is removed at
the first step whose filter it fails, so a table of 32 masks by 120 orders (``FIRST``) holds every audit there is.
Spark works out the masks and counts documents by (part, mask, label): at most 128 rows a part, after a partial
aggregate in every task, so that a part with most of all documents is no task's burden.  Those rows are dealt by part;
``mapInArrow`` looks them up in the table and adds their counts by part, order, step and label with ``np.bincount``,
holding ``PARTS`` parts at once.  The partial arrays are summed by one more aggregate.

All other figures follow from removals: what fails a filter is what it removes when it comes first, what fails it only
is what it removes when it comes last, and its Shapley sum is what it removes over all orders.

The failure conditions: A, under 50 words; B, 100 * distinct words < 65 * words; C, 100 * ``[A-Z]`` characters >
5 * code points; D, holds any ``[#$%&*|]``; E, identical to the text of any smaller doc_id, removed or not.  Words are
maximal runs of other than ``[\\x20\\x09-\\x0D]``, case-sensitive.

Texts are never shuffled: only their SHA-256, by which E goes, with 128 bits of it and the id, which is a key that no
group of copies makes hot.  Defined cases: a null text is the empty text, a null part the empty string; rows without an
id are counted, fail no E, make no other row fail it, and have no label; rows with one id and one text stand equal, so
neither fails E for the other; a document of several label rows is good (toxic) if any says so; extra columns are
dropped; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import ship
from .common import materialize

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
#: Step, from 0, at which each order removes a document of each mask; 5 is never.
FIRST = np.array([[next((s for s, f in enumerate(o) if mask >> FILTERS.index(f) & 1), len(FILTERS)) for o in ORDERS] for mask in range(1 << len(FILTERS))])
STEPS = len(FILTERS) + 1
#: Parts whose arrays a task holds at once.
PARTS = 256


def text_failures(text: Column) -> Column:
    """The bits of the filters that look at one text (A to D)."""
    words = F.array_remove(F.split(text, r"[\x20\x09-\x0D]+"), "")
    bit = lambda condition, k: F.when(condition, F.lit(1 << k)).otherwise(F.lit(0))
    capitals = F.length(F.regexp_replace(text, "[^A-Z]+", ""))
    return (
        bit(F.size(words) < 50, 0)
        + bit(100 * F.size(F.array_distinct(words)).cast("long") < 65 * F.size(words).cast("long"), 1)
        + bit(100 * capitals.cast("long") > 5 * F.length(text).cast("long"), 2)
        + bit(text.rlike(r"[#$%&*|]"), 3)
    )


def masked(docs: DataFrame, part: str = "source") -> DataFrame:
    """doc_id, apart, part, mask of each row of ``docs``."""
    text = F.coalesce(F.col("text"), F.lit(""))
    # rows without an id match nothing in the joins; ``apart`` only deals them out
    apart = F.when(F.col("doc_id").isNull(), (F.monotonically_increasing_id() % 1009).cast("int")).otherwise(F.lit(0))
    rows = docs.select("doc_id", F.coalesce(F.col(part).cast("string"), F.lit("")).alias("part"), text_failures(text).alias("mask"), F.unhex(F.substring(F.sha2(text, 256), 1, 32)).alias("name"), apart.alias("apart"))
    rows = materialize(rows, "audit")
    # the first of each group of copies is found by name and id together: copies spread over all tasks
    firsts = rows.groupBy("name").agg(F.min("doc_id").alias("doc_id")).where("doc_id is not null").withColumns({"apart": F.lit(0), "first": F.lit(True)})
    again = F.col("doc_id").isNotNull() & F.col("first").isNull()
    return rows.join(firsts, ["name", "doc_id", "apart"], "left").select("doc_id", "apart", "part", (F.col("mask") + F.when(again, F.lit(16)).otherwise(F.lit(0))).alias("mask"))


def labelled(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` with label: 1 for a good document, plus 2 for a toxic one."""
    any_one = lambda c: F.coalesce(F.max((F.col(c) == 1).cast("int")), F.lit(0))
    known = labels.where("doc_id is not null").groupBy("doc_id").agg((any_one("quality") + 2 * any_one("toxic")).alias("label"), F.lit(0).alias("apart"))
    return rows.join(known, ["doc_id", "apart"], "left").select("part", "mask", F.coalesce("label", F.lit(0)).alias("label"))


def _summed(held: dict[str, np.ndarray]) -> pa.RecordBatch:
    """The arrays held, a row for each part, order and step."""
    each = len(ORDERS) * STEPS
    sums = np.stack(list(held.values())).reshape(-1, 4)
    order, step = (np.tile(x, len(held)) for x in np.divmod(np.arange(each), STEPS))
    columns = [pa.array([p for p in held for _ in range(each)], pa.string()), pa.array(order, pa.int32()), pa.array(step, pa.int32())]
    columns += [pa.array(x, pa.int64()) for x in (sums.sum(1), sums[:, 1] + sums[:, 3], sums[:, 2] + sums[:, 3])]
    return pa.RecordBatch.from_arrays(columns, ["part", "order", "step", "removed", "good", "toxic"])


def accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removals by part, order and step of rows (part, mask, label, n); a part may come out more than once."""
    held: dict[str, np.ndarray] = {}
    each = len(ORDERS) * STEPS * 4
    for b in batches:
        for at in range(0, b.num_rows, PARTS):  # so many parts at most
            rows = b.slice(at, PARTS)
            names = rows.column("part").dictionary_encode()
            code = names.indices.to_numpy(zero_copy_only=False)[:, None]
            step = FIRST[rows.column("mask").to_numpy()]
            key = ((code * len(ORDERS) + np.arange(len(ORDERS))) * STEPS + step) * 4 + rows.column("label").to_numpy()[:, None]
            n = np.broadcast_to(rows.column("n").to_numpy()[:, None], key.shape)
            found = np.bincount(key.ravel(), n.ravel(), len(names.dictionary) * each).astype(np.int64).reshape(-1, each)
            for part, counts in zip(names.dictionary.to_pylist(), found, strict=True):
                held[part] = held[part] + counts if part in held else counts
            if len(held) >= PARTS:
                yield _summed(held)
                held = {}
    if held:
        yield _summed(held)


def removals(rows: DataFrame) -> DataFrame:
    """part, order, step (from 0; 5 holds what is kept), removed, good, toxic: of rows (part, mask, label)."""
    ship(rows.sparkSession)
    counts = rows.groupBy("part", "mask", "label").agg(F.count(F.lit(1)).alias("n"))
    partial = counts.repartition("part").mapInArrow(accumulate, "part string, order int, step int, removed long, good long, toxic long")
    return partial.groupBy("part", "order", "step").agg(*[F.sum(c).alias(c) for c in ("removed", "good", "toxic")])


def audit(docs: DataFrame, labels: DataFrame, part: str = "source") -> DataFrame:
    """One row for each part, order of the filters and step (1 to 5): kept, removed, redundant, unique_fails,
    good_lost, toxic_lost, shapley."""
    sums = removals(labelled(masked(docs, part), labels))
    name = F.array(*map(F.lit, ORDERS))[F.col("order")]
    later = Window.partitionBy("part", "order").orderBy(F.col("step").desc())
    sums = sums.withColumn("filter_order", name).withColumn("kept", F.sum("removed").over(later) - F.col("removed")).where(F.col("step") < len(FILTERS))
    own = Window.partitionBy("part", F.substring("filter_order", F.col("step") + 1, F.lit(1)))
    at = lambda step: F.max(F.when(F.col("step") == step, F.col("removed"))).over(own)
    return sums.select(
        "part",
        "filter_order",
        (F.col("step") + 1).alias("step"),
        "kept",
        "removed",
        (at(0) - F.col("removed")).alias("redundant"),
        at(len(FILTERS) - 1).alias("unique_fails"),
        F.col("good").alias("good_lost"),
        F.col("toxic").alias("toxic_lost"),
        F.sum("removed").over(own).alias("shapley"),
    )
