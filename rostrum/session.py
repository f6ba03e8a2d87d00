"""Sessions with the settings that the library's semantics rest on."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}

#: Rows and bytes a Python worker receives at once; keeps a batch of very long texts bounded.
ARROW_ROWS = 500
ARROW_BYTES = 16 << 20


def session(app: str = "rostrum", **conf: str) -> SparkSession:
    """A session; ``conf`` adds or replaces settings (dots written as two underscores)."""
    settings = SETTINGS | {k.replace("__", "."): v for k, v in conf.items()}
    return SparkSession.builder.appName(app).config(map=settings).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give the executors' Python workers this package, once a context, wherever the driver runs from."""
    context = spark.sparkContext
    if getattr(context, "_rostrum_shipped", False):
        return
    home = Path(__file__).parent
    made = os.path.join(tempfile.mkdtemp(prefix="rostrum-code-"), "rostrum.zip")
    with zipfile.ZipFile(made, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(home.rglob("*.py")):
            z.write(f, f"{home.name}/{f.relative_to(home)}")
    context.addPyFile(made)
    context._rostrum_shipped = True


def bounded_batches(spark: SparkSession) -> None:
    """Get ready for Python workers: they have the package, and the rows and bytes of one Arrow batch are limited, so
    that long texts stay within a worker's memory.  These two settings of the session stay so."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", ARROW_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", ARROW_BYTES)
