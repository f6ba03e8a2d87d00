"""Writers: CSV export, JSON snapshots that replace each other, JSON bodies."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.utils import AnalysisException

EXPORT_HEADER = ["Name", "Party", "Constituency", "Mention Count"]


class NotFound(LookupError):
    """A point lookup without a row."""

    status = 404

    def body(self) -> dict:
        return {"error": str(self)}


def export_columns(ranking: DataFrame) -> DataFrame:
    """Topic ranking under the export's header, all as text, null as empty (SNK-1, PRJ-14)."""
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("name", "party", "constituency", "mentions")]
    return ranking.select(*[c.alias(h) for c, h in zip(text, EXPORT_HEADER, strict=True)])


def export_csv(ranking: DataFrame, path: str) -> bool:
    """Write the ranking as CSV with every cell quoted; nothing at all if there is no row.

    A quote inside a cell is doubled (RFC 4180).  The original leaves it as it is, which breaks the row.
    One file: a ranking has at most a page of rows for each keyword.
    """
    rows = export_columns(ranking)
    if rows.isEmpty():
        return False
    rows.coalesce(1).write.csv(path, header=True, quoteAll=True, escape='"', emptyValue="", mode="overwrite")
    return True


def export_lines(ranking: DataFrame) -> DataFrame:
    """The export's lines, header first: line_no and line (SNK-1, STR-13)."""
    cell = lambda c: F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))
    ranked = ranking.select(F.col("rank").cast("bigint").alias("line_no"), F.concat_ws(",", *[cell(F.coalesce(F.col(c).cast("string"), F.lit(""))) for c in ("name", "party", "constituency", "mentions")]).alias("line"))
    head = ranking.sparkSession.createDataFrame([(0, ",".join(f'"{h}"' for h in EXPORT_HEADER))], "line_no bigint, line string")
    return head.unionByName(ranked)


def export_name(topic: str | None) -> str:
    """File name of an export (SNK-2)."""
    return f"{topic or 'topic'}-analysis.csv"


def export_names(topic: Column) -> Column:
    """SNK-2 for rows."""
    return F.concat(F.coalesce(F.nullif(topic, F.lit("")), F.lit("topic")), F.lit("-analysis.csv"))


def bodies(df: DataFrame) -> DataFrame:
    """Rows as JSON text (SNK-5)."""
    return df.select(F.to_json(F.struct("*")).alias("body"))


class Conflict(RuntimeError):
    """Another writer committed the version that this one was to be."""


class Snapshots:
    """A small keyed table kept as JSON, replaced whole on every change (SNK-3, SNK-4, SRC-13, SRC-14).

    Each version is a folder of data and a commit: a small file, named by the version's number, that names the folder.
    A commit comes into being whole or not at all, and only if there is none of its number: where two writers start from
    one version, one of them gets the next number and the other a ``Conflict``.  ``update`` then reads what was
    committed and applies its change to that, so that both changes are kept.  Readers see committed versions only.  The
    version before stays until the next change.

    Needs a file system that creates a link or renames a file only where there is none of that name, as local ones and
    HDFS do.
    """

    def __init__(self, spark: SparkSession, root: str, ddl: str):
        self.spark, self.root, self.schema = spark, root.rstrip("/"), T._parse_datatype_string(ddl)
        self._jvm = spark._jvm
        self._fs = self._path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _path(self, name: str):
        return self._jvm.org.apache.hadoop.fs.Path(name)

    def _names(self, kind: str) -> list[str]:
        top = self._path(self.root)
        names = [str(s.getPath().getName()) for s in self._fs.listStatus(top)] if self._fs.exists(top) else []
        return sorted(n for n in names if n.startswith(kind))

    def version(self) -> int:
        """The number of the current version; 0 if there is none."""
        commits = self._names("commit-")
        return int(commits[-1].removeprefix("commit-")) if commits else 0

    def _data(self, version: int) -> str:
        stream = self._fs.open(self._path(f"{self.root}/commit-{version:012d}"))
        try:
            return bytes(stream.readAllBytes()).decode()
        finally:
            stream.close()

    def read(self, default: DataFrame | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version (the current one); ``default``, or no row, if there are none or they can't be read."""
        empty = default if default is not None else self.spark.createDataFrame([], self.schema)
        version = self.version() if version is None else version
        if not version:
            return empty
        try:
            rows = self.spark.read.schema(T.StructType([*self.schema.fields, T.StructField("_bad", T.StringType())])).json(f"{self.root}/{self._data(version)}", columnNameOfCorruptRecord="_bad")
            bad = rows.agg(F.max("_bad"), F.count(rows.columns[0])).first()[0] is not None
        except AnalysisException:
            return empty
        return empty if bad else rows.drop("_bad").orderBy("pos").drop("pos") if "pos" in rows.columns else rows.drop("_bad")

    def commit(self, rows: DataFrame, after: int) -> int:
        """Write ``rows`` as the version after ``after``; ``Conflict`` if there is one already."""
        data = f"data-{uuid.uuid4().hex}"
        rows.write.json(f"{self.root}/{data}", ignoreNullFields=False)
        made, wanted = self._path(f"{self.root}/new-{data}"), self._path(f"{self.root}/commit-{after + 1:012d}")
        stream = self._fs.create(made, False)
        stream.write(bytearray(data.encode()))
        stream.close()
        if not self._placed(made, wanted):
            self._fs.delete(made, False)
            self._fs.delete(self._path(f"{self.root}/{data}"), True)
            raise Conflict(f"version {after + 1} is another writer's")
        for old in self._names("commit-"):
            if int(old.removeprefix("commit-")) < after:
                number = int(old.removeprefix("commit-"))
                self._fs.delete(self._path(f"{self.root}/{self._data(number)}"), True)
                self._fs.delete(self._path(f"{self.root}/{old}"), False)
        return after + 1

    def _placed(self, made, wanted) -> bool:
        """Whether ``made`` now stands as ``wanted``, where there was none."""
        if self._fs.getScheme() == "file":  # a rename replaces there, a link doesn't
            paths = self._jvm.java.nio.file.Paths
            local = lambda p: paths.get(self._fs.pathToFile(p).getPath(), self.spark.sparkContext._gateway.new_array(self._jvm.String, 0))
            try:
                self._jvm.java.nio.file.Files.createLink(local(wanted), local(made))
            except Py4JJavaError as e:
                if "FileAlreadyExistsException" in str(e.java_exception):
                    return False
                raise
            self._fs.delete(made, False)
            return True
        return bool(self._fs.rename(made, wanted))

    def update(self, change, tries: int = 20) -> int:
        """Commit ``change(current rows)``; where another writer was faster, apply it to that writer's rows instead."""
        for _ in range(tries):
            base = self.version()
            try:
                return self.commit(change(self.read(version=base)), base)
            except (Conflict, Py4JJavaError, PySparkException):
                if self.version() == base:
                    raise  # no other writer's doing, such as the removal of files that were being read
        raise Conflict(f"no version committed in {tries} tries")

    def write(self, rows: DataFrame) -> int:
        """Replace all rows, whatever they are."""
        return self.update(lambda _: rows)
