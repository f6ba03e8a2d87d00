"""First write wins on a stream (SET-2).

``FirstWrites`` keeps, for each key, the row that comes first by a declared order, whenever it arrives: a minimum, which
has a partial step, so that a key with any share of a batch is one row before it is shuffled, and which is the same
however the stream is cut into batches, reordered or replayed.  The state, one row a key, is Spark's own: with the
RocksDB provider (``rostrum.session`` sets it) it lies on disk, checkpointed in the shared folder.  Changed rows go to
Parquet, a folder a batch; a batch that is run again replaces its folder, and the reader takes the minimum once more.

``once_within`` is for streams whose repeats come within a known delay: it forgets keys after that, and passes each key's
first arrival on at once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery


def first_rows(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """A row for each key (null is one): of those with the least ``order``, nulls first, the least by all columns.  For batches and
    streams; columns are of orderable types."""
    at = F.struct(*[F.col(f"`{c}`").alias(f"o{k}") for k, c in enumerate(order)])
    row = F.struct(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.min(F.struct(at.alias("at"), row.alias("row"))).alias("_first")).select("_first.row.*")


class FirstWrites:
    def __init__(self, spark: SparkSession, path: str, key: str, order: Sequence[str]):
        self.spark, self.path, self.key, self.order = spark, path.rstrip("/"), key, order

    def start(self, stream: DataFrame, **trigger) -> StreamingQuery:
        """Fold ``stream`` into the state; started again, it goes on where it stopped."""
        def write(rows: DataFrame, batch: int) -> None:
            rows.write.mode("overwrite").parquet(f"{self.path}/rows/batch={batch}")

        folded = first_rows(stream, self.key, self.order)
        return folded.writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", f"{self.path}/checkpoint").trigger(**(trigger or {"availableNow": True})).start()

    def read(self) -> DataFrame:
        """The state after the batches written so far."""
        return first_rows(self.spark.read.parquet(f"{self.path}/rows").drop("batch"), self.key, self.order)


def once_within(stream: DataFrame, key: str, at: str, delay: str) -> DataFrame:
    """Each key's first arrival; what comes again within ``delay`` of event time is dropped, and the key forgotten after it."""
    return stream.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])
