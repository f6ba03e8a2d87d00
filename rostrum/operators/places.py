"""Places of rows within their lists, whatever share of all rows one list holds (PRJ-15, AGG-3, SRT-5).

``row_number`` over a list is one task a list.  Here the rows are cut into cells by ranges of the order, each list's rows
are numbered within (list, cell), and the rows of the list's earlier cells, one count a cell, are added.  Rows are
shuffled once, by (list, cell); no task has more than a cell.  The cuts come from a sample of ``SAMPLE`` order keys, those
of the least hashes: they decide how even the cells are, never a place.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.labels import row_key

CELLS = 64
SAMPLE = 4096


def _cuts(keyed: DataFrame, cells: int) -> Column | None:
    """An array of at most ``cells - 1`` order keys, or none where there are no rows to cut."""
    found = [r[0] for r in keyed.orderBy(F.xxhash64("_list", "_at")).limit(SAMPLE).select("_at").sort("_at").collect()]
    kind = keyed.schema["_at"].dataType
    chosen = list(dict.fromkeys(found[k * len(found) // cells] for k in range(1, cells))) if found else []
    lit = lambda row: F.struct(*[F.lit(v).cast(f.dataType).alias(f.name) for f, v in zip(kind.fields, row, strict=True)])
    return F.array(*map(lit, chosen)) if chosen else None


def numbered(rows: DataFrame, lists: Sequence[Column], order: Sequence[Column], name: str = "place", cells: int = CELLS) -> DataFrame:
    """``rows`` with a long ``name``: the place, from 0, among the rows of equal ``lists``, by ``order`` ascending, nulls first.

    Nulls in ``lists`` are equal.  The order has to be total within a list: rows that it leaves equal get a place each, in
    no stated order, and stand in one cell.  Columns of ``order`` are of plain types; those of ``rows`` have any names but
    ``name``.
    """
    if name.lower() in {c.lower() for c in rows.columns}:
        raise ValueError(f"there is a column {name} already")
    keyed = rows.select(F.struct(*[F.col(f"`{c}`") for c in rows.columns]).alias("_row"), F.struct(*[c.alias(f"l{k}") for k, c in enumerate(lists)]).alias("_list"), F.struct(*[c.alias(f"o{k}") for k, c in enumerate(order)]).alias("_at"))
    cuts = _cuts(keyed, cells)
    celled = keyed.withColumn("_cell", F.size(F.filter(cuts, lambda c: c < F.col("_at"))) if cuts is not None else F.lit(0))
    inside = celled.withColumn("_inside", F.row_number().over(Window.partitionBy("_list", "_cell").orderBy("_at")))
    counts = celled.groupBy("_list", "_cell").agg(F.count(F.lit(1)).alias("_n"))
    before = counts.select("_list", "_cell", (F.sum("_n").over(Window.partitionBy("_list").orderBy("_cell")) - F.col("_n")).alias("_before"))
    return inside.join(before, ["_list", "_cell"]).select("_row.*", (F.col("_before") + F.col("_inside") - 1).cast("bigint").alias(name))


def with_index_key(rows: DataFrame, first: Column, lists: Sequence[Column], order: Sequence[Column], name: str = "row_key", cells: int = CELLS) -> DataFrame:
    """PRJ-15 where no other column tells rows apart: ``first``, or the place in the row's list where that is missing."""
    placed = numbered(rows, lists, order, "_index", cells)
    return placed.withColumn(name, row_key(first, F.col("_index"))).drop("_index")
