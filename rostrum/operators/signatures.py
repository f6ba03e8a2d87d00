"""Substring search that skips data: q-gram signatures of parts (FIL-4, SRC-3).

``contains`` has to read every text.  ``Signed.build`` writes the rows once in parts, and beside them a signature of each
part: a bit for every run of ``Q`` bytes of its texts in lower case, by hash.  A term can only be in parts whose
signatures have the bits of all its own runs; the others are skipped by partition pruning, and what is left is read and
held against the term itself, so that the rows are those of the scan whatever the hashes do.

Signatures are bitmaps of 4 KB, ``BITS / 32768`` of them a part.  A task passes over the bytes of its rows and holds the
bits of one part, a megabyte however large the part is; what it gives are bitmaps, and those of one part are put together
by an aggregate.  A search meets them by equality with a row for each run of the term.  The driver takes the numbers of
the parts that are left: one a part at most, as for a list of files.  Terms shorter than ``Q`` skip nothing.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import runs
from ..functions.text import found_in
from ..session import bounded_batches

Q = 4
#: Bits of a part's signature.
BITS = 1 << 20
#: Bits of one bitmap, as Spark's aggregates have them.
BITMAP = 1 << 15
PART = "_part"


def _low(text: str | Column) -> Column:
    return F.lower(F.col(f"`{text}`") if isinstance(text, str) else text).cast("binary")


def grams(numbers: np.ndarray) -> np.ndarray:
    """The bits of runs of ``Q`` bytes, given as numbers."""
    return runs.slots(runs.cut(numbers, Q), BITS)


def _signed(n_texts: int, bits: int):
    """Signatures of the parts, whose rows stand together, as rows of their bitmaps; a part may come more than once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = None, np.zeros(max(bits, BITMAP), bool)

        def written() -> pa.RecordBatch:
            maps = np.packbits(seen, bitorder="little").reshape(-1, BITMAP // 8)
            used = np.flatnonzero(maps.any(1))
            return pa.RecordBatch.from_arrays([pa.array([part] * len(used), pa.int32()), pa.array(used), pa.array([maps[k].tobytes() for k in used], pa.binary())], [PART, "bucket", "bits"])

        for b in batches:
            of = b.column(0).to_numpy()
            borders = [0, *(np.flatnonzero(of[1:] != of[:-1]) + 1).tolist(), len(of)]
            for start, end in zip(borders, borders[1:]):
                if start == end:
                    continue
                if of[start] != part:
                    if part is not None:
                        yield written()
                    part, seen[:] = of[start], False
                for k in range(n_texts):
                    data, at = runs.joined(b.column(k + 1).slice(start, end - start))
                    whole = np.ones(len(data), bool)  # places whose run ends within their text
                    for back in range(1, Q):
                        last = at[1:] - back
                        whole[last[last >= at[:-1]]] = False
                    for a, full in runs.steps(data):
                        seen[runs.slots(runs.cut(full[whole[a : a + len(full)]], Q), bits)] = True
        if part is not None:
            yield written()

    return run


class Signed:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._kinds = StructType([*spark.read.parquet(f"{self.path}/columns").schema.fields, StructField(PART, IntegerType())])

    @classmethod
    def build(cls, rows: DataFrame, text: Sequence[str], path: str, parts: int, by: Sequence[str] = ()) -> Signed:
        """Write ``rows`` in ``parts`` parts, signed over the columns ``text``.  ``by``: columns whose ranges make the
        parts, so that rows which are alike stand together; otherwise rows are dealt evenly."""
        if PART in {c.lower() for c in rows.columns}:
            raise ValueError(f"a column named {PART}")
        spark, path = rows.sparkSession, path.rstrip("/")
        dealt = rows.repartitionByRange(parts, *by) if by else rows.repartition(parts)
        dealt.withColumn(PART, F.spark_partition_id()).write.partitionBy(PART).parquet(f"{path}/rows")
        rows.limit(0).write.parquet(f"{path}/columns")
        made = cls(spark, path)
        bounded_batches(spark)
        low = made._rows().select(PART, *[_low(c).alias(f"_{k}") for k, c in enumerate(text)])
        maps = low.mapInArrow(_signed(len(text), BITS), f"{PART} int, bucket long, bits binary")
        signed = maps.groupBy(PART, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        signed.write.parquet(f"{path}/signatures")
        return made

    def _rows(self) -> DataFrame:
        return self.spark.read.schema(self._kinds).parquet(f"{self.path}/rows")

    def parts(self) -> list[int]:
        return sorted(r[0] for r in self._rows().select(PART).distinct().collect())

    def parts_for(self, term: str) -> list[int] | None:
        """The parts that may hold ``term``; None if it is too short to tell."""
        low = bytes(self.spark.range(1).select(_low(F.lit(term)).alias("low")).first()["low"])
        if len(low) < Q:
            return None
        _, numbers = next(runs.steps(np.frombuffer(low, np.uint8)))
        bits = sorted(set(grams(numbers[: len(low) - Q + 1]).tolist()))
        wanted = self.spark.range(1).select(F.explode(F.array(*[F.lit(b).cast("bigint") for b in bits])).alias("bit"))
        wanted = wanted.select(F.floor(F.col("bit") / BITMAP).alias("bucket"), (F.col("bit") % BITMAP).alias("at"), F.lit(len(bits)).alias("n"))
        held = self.spark.read.parquet(f"{self.path}/signatures").join(F.broadcast(wanted), "bucket")  # a row a run of the term
        byte = F.conv(F.hex(F.substring("bits", (F.col("at") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
        hit = F.pmod(F.call_function("shiftright", byte, (F.col("at") % 8).cast("int")), F.lit(2)) == 1
        left = held.where(hit).groupBy(PART).agg(F.count(F.lit(1)).alias("k"), F.first("n").alias("n")).where("k = n")
        return sorted(r[PART] for r in left.select(PART).collect())

    def search(self, term: str, text: Sequence[str]) -> DataFrame:
        """The rows that hold ``term`` in any case in one of ``text`` (columns that are signed): those of a scan."""
        parts = self.parts_for(term)
        rows = self._rows() if parts is None else self._rows().where(F.col(PART).isin(parts)) if parts else self._rows().limit(0)
        return rows.where(found_in(term, *[F.col(f"`{c}`") for c in text])).drop(PART)
