"""Readers of nested JSON documents, and the rows inside their envelopes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..operators.places import numbered
from . import schemas


def _schema(ddl: str) -> T.StructType:
    return T._parse_datatype_string(ddl)


def read_json(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """JSON documents of a stated schema, never an inferred one; a file may hold one document on many lines."""
    return spark.read.schema(_schema(ddl)).json(path, multiLine=True)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def results(envelope: DataFrame, field: str = "Results") -> DataFrame:
    """The rows of an envelope's array; a missing array has none (PRJ-1)."""
    kind = envelope.schema[field].dataType.simpleString()
    rows = F.coalesce(F.col(field), F.array().cast(kind))
    return envelope.select(F.inline(rows))


def members(envelope: DataFrame) -> DataFrame:
    """Members of a search envelope, out of their ``value`` (PRJ-1)."""
    return results(envelope, "items").select("value.*")


def unwrapped(rows: DataFrame) -> DataFrame:
    """Rows that may or may not stand in a ``value`` (PRJ-2)."""
    fields = rows.schema["value"].dataType.fieldNames()
    plain = [F.coalesce(F.col(f"value.{f}"), F.col(f)).alias(f) if f in rows.columns else F.col(f"value.{f}").alias(f) for f in fields]
    return rows.select(*plain)


def debate_items(debates: DataFrame) -> DataFrame:
    """One row per item of nested debates, in order: debate_id, pos, house and the item's fields (SRT-5)."""
    return debates.select(F.col("Overview.Id").alias("debate_id"), F.col("Overview.House").alias("house"), F.posexplode("Items").alias("pos", "item")).select("debate_id", "house", "pos", "item.*")


def pruned(ddl: str, fields: Sequence[str]) -> T.StructType:
    """The part of a schema that ``fields``, dotted paths through structs and arrays, name; the reader skips the rest of a document."""
    def cut(kind: T.DataType, paths: list[list[str]]) -> T.DataType:
        if [] in paths:
            return kind
        if isinstance(kind, T.ArrayType):
            return T.ArrayType(cut(kind.elementType, paths), kind.containsNull)
        if not isinstance(kind, T.StructType) or {p[0] for p in paths} - set(kind.fieldNames()):
            raise ValueError(f"no such fields: {sorted('.'.join(p) for p in paths)}")
        return T.StructType([T.StructField(f.name, cut(f.dataType, [p[1:] for p in paths if p[0] == f.name]), f.nullable) for f in kind.fields if any(p[0] == f.name for p in paths)])

    return cut(_schema(ddl), [f.split(".") for f in fields])


def read_debates(spark: SparkSession, path: str, item_fields: Sequence[str], lines: bool = True) -> DataFrame:
    """Nested debates with these fields of their items and what ``ordered_items`` needs; one document a line, so that files split,
    or over many lines."""
    fields = dict.fromkeys(["Overview.Id", "Overview.House", "Items.OrderIndex", *[f"Items.{f}" for f in item_fields]])
    return spark.read.schema(pruned(schemas.DEBATE, list(fields))).json(path, multiLine=not lines)


def ordered_items(debates: DataFrame) -> DataFrame:
    """One row per item: debate_id, house, the item's fields and pos, its place (from 0) in the debate by its declared index (SRT-5).

    A debate may come in several documents, and may hold any share of all items.  Items without an index stand last.  Of
    equal indices, and of none, the place in the document counts, then the item's fields.
    """
    items = debate_items(debates)
    told = [F.col(f"`{c}`") for c in items.columns if c not in ("debate_id", "house", "pos", "OrderIndex")]
    order = [F.col("OrderIndex").isNull(), F.col("OrderIndex"), F.col("pos"), *told]
    return numbered(items, [F.col("debate_id")], order, "_ordered").drop("pos").withColumnRenamed("_ordered", "pos")


def sections(days: DataFrame) -> DataFrame:
    """One row per section of day overviews."""
    return days.select("Date", "House", F.inline("Sections"))
