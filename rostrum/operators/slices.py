"""Slices of any depth (WIN-3, LIM-2): rows laid out once by rank, and read by place.

``orderBy(...).offset(n)`` sorts the whole table and throws the prefix away.  Where slices are asked of one order again
and again, ``Ranked.build`` deals the rows by ranges of the order, sorts within each range, and writes them with their
place in the range: one shuffle, no task above its range.  The rows of each range are counted (one number a range), and
prefix sums of the counts say in which range a place lies.  A slice then reads the ranges that it touches, by partition
pruning, and of these the row groups whose places it covers, by a pushed filter; nothing is sorted but the slice.

The order has to be total for slices to be those of a sort; rows that it leaves equal keep one place each, in an order
fixed when they are written, and stand in one range.  Nulls come first in ascending and last in descending order, as in
``orderBy``.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

RANGE, PLACE = "_range", "_place"


class Ranked:
    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        found = {r[RANGE]: r["n"] for r in spark.read.parquet(f"{self.path}/counts").collect()}
        self.ranges = sorted(found)
        self.starts = [0, *accumulate(found[k] for k in self.ranges)]
        self._kinds = StructType([*spark.read.parquet(f"{self.path}/columns").schema.fields, StructField(PLACE, LongType()), StructField(RANGE, IntegerType())])

    @classmethod
    def build(cls, rows: DataFrame, order: Sequence[Column], path: str, ranges: int) -> Ranked:
        """Lay ``rows`` out by ``order`` in up to ``ranges`` ranges under ``path``."""
        if {RANGE, PLACE} & {c.lower() for c in rows.columns}:
            raise ValueError(f"columns named {RANGE} or {PLACE}")
        spark, path = rows.sparkSession, path.rstrip("/")
        dealt = rows.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
        # the number of a row within its task: the low 33 bits of its id
        placed = dealt.withColumn(PLACE, F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))).withColumn(RANGE, F.spark_partition_id())
        placed.write.partitionBy(RANGE).parquet(f"{path}/rows")
        spark.read.schema(placed.schema).parquet(f"{path}/rows").groupBy(RANGE).agg(F.count(F.lit(1)).alias("n")).write.parquet(f"{path}/counts")
        rows.limit(0).write.parquet(f"{path}/columns")
        return cls(spark, path)

    @property
    def count(self) -> int:
        return self.starts[-1]

    def slice(self, first: int, n: int) -> DataFrame:
        """Rows at the places ``first`` to ``first + n - 1`` (from 0), with their place; fewer at the table's end."""
        rows = self.spark.read.schema(self._kinds).parquet(f"{self.path}/rows")
        first, end = max(first, 0), min(first + n, self.count)
        if first >= end:
            return rows.limit(0).withColumn("place", F.col(PLACE)).drop(RANGE, PLACE)
        a, z = bisect_right(self.starts, first) - 1, bisect_left(self.starts, end) - 1
        one = lambda k: rows.where((F.col(RANGE) == self.ranges[k]) & (F.col(PLACE) >= first - self.starts[k]) & (F.col(PLACE) < end - self.starts[k]))
        found = one(a) if a == z else one(a).union(one(z))
        if z - a > 1:  # whole ranges
            found = found.union(rows.where((F.col(RANGE) > self.ranges[a]) & (F.col(RANGE) < self.ranges[z])))
        starts = dict(zip(self.ranges, self.starts, strict=False))
        before = F.split(F.lit(",".join(str(starts.get(k, 0)) for k in range(self.ranges[-1] + 1))), ",").cast("array<bigint>")[F.col(RANGE)]
        return found.withColumn("place", before + F.col(PLACE)).drop(RANGE, PLACE)

    def visible(self, first: int, shown: int, overscan: int = 5) -> DataFrame:
        """What a list shows from place ``first`` on, with some more rows on either side (WIN-3)."""
        start = max(0, first - overscan)
        return self.slice(start, first + shown + overscan - start)
