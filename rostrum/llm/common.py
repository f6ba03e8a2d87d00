"""Shared helpers: durable lineage cuts, bounded Arrow batches, size estimates."""

from __future__ import annotations

import math
import tempfile
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..session import ARROW_ROWS, bounded_batches  # noqa: F401  the operators take them from here

def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder the cluster names.  Where it is unset, a temporary one of this machine if all executors are
    in the driver's own process, as in tests; else an error, since executors would not see each other's files."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.sparkContext._jsc.sc().getCheckpointDir()
        root = root.get() if root.isDefined() else None
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="rostrum-")
        spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


_written: list[str] = []


def materialize(df: DataFrame, label: str = "cut") -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: a lineage cut
    that outlives any executor (unlike a local checkpoint)."""
    spark = df.sparkSession
    path = f"{checkpoint_root(spark)}/rostrum/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._rostrum_path = path
    _file_system(spark, path)[0].deleteOnExit(_file_system(spark, path)[1])  # if nothing deletes it sooner
    _written.append(path)
    return out


def _file_system(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def _delete(spark: SparkSession, path: str) -> None:
    fs, p = _file_system(spark, path)
    fs.delete(p, True)


def discard(df: DataFrame) -> None:
    """Delete the files behind a DataFrame returned by ``materialize``."""
    path = getattr(df, "_rostrum_path", None)
    if path:
        _delete(df.sparkSession, path)


def sweep(spark: SparkSession) -> int:
    """Delete all that this driver has materialized, once the results that rest on it are written."""
    paths, _written[:] = list(_written), []
    for path in paths:
        _delete(spark, path)
    return len(paths)


def gathered(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of small batches in tables of about ``rows``, none of them empty."""
    held, n = [], 0
    for b in batches:
        held.append(b)
        n += b.num_rows
        if n >= rows:
            yield pa.Table.from_batches(held)
            held, n = [], 0
    if n:
        yield pa.Table.from_batches(held)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_crc(col: str = "doc_id") -> Column:
    """CRC-32 of an id written as decimal text."""
    return F.crc32(F.col(col).cast("string").cast("binary"))


def crc32_text(text: str) -> int:
    return zlib.crc32(text.encode("utf-8", "surrogatepass"))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, or one like it that no column of ``df`` has in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def longs(values: list[int]) -> Column:
    """An array of numbers as one expression that the optimizer folds into a literal, however many there are."""
    return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>") if values else F.array().cast("array<bigint>")


def ceil_div(a: int, b: int) -> int:
    return max(1, math.ceil(a / b))


def with_fields(df: DataFrame, **fields: str) -> T.StructType:
    """The schema of ``df`` with more columns at its end."""
    return T.StructType([*df.schema.fields, *T._parse_datatype_string(", ".join(f"{k} {v}" for k, v in fields.items())).fields])
