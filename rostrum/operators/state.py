"""Keyed state over immutable DataFrames (SET-2 to SET-6).  ``pos`` is a row's place."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions.text import js_trim


def _end(state: DataFrame, pos: str) -> int:
    """The place after the last row."""
    last = state.agg(F.max(pos)).first()[0]
    return 0 if last is None else last + 1


def add_absent(state: DataFrame, new: DataFrame, key: str = "id", pos: str = "pos") -> DataFrame:
    """Rows of ``new`` whose key is not there are appended in order; the first write of a key wins (SET-2)."""
    first = new.withColumn("_n", F.row_number().over(Window.partitionBy(key).orderBy(pos))).where("_n = 1").drop("_n")
    fresh = first.join(state.select(key), key, "left_anti")
    return state.unionByName(fresh.withColumn(pos, (F.col(pos) + _end(state, pos)).cast(state.schema[pos].dataType)).select(*state.columns))


def append(state: DataFrame, new: DataFrame, pos: str = "pos") -> DataFrame:
    """SET-4."""
    moved = new.withColumn(pos, (F.col(pos) + _end(state, pos)).cast(state.schema[pos].dataType))
    return state.unionByName(moved.select(*state.columns))


def remove(state: DataFrame, ids: Sequence, key: str = "id") -> DataFrame:
    """SET-3, SET-6; rows of unknown ids are no error."""
    return state.where(~F.col(key).isin(list(ids))) if len(ids) else state


def remove_all(state: DataFrame, gone: DataFrame, key: str = "id") -> DataFrame:
    """The same in bulk (JOIN-5)."""
    return state.join(gone.select(key), key, "left_anti")


def update(state: DataFrame, changes: DataFrame, key: str = "id") -> DataFrame:
    """Columns that a change names replace the row's; a null leaves it, an unknown id does nothing; of several changes of
    one id the later one counts, column by column (SET-5)."""
    named = [c for c in changes.columns if c != key and c in state.columns]
    placed = changes.withColumn("_at", F.monotonically_increasing_id())
    last = placed.groupBy(key).agg(*[F.max_by(c, F.when(F.col(c).isNotNull(), F.col("_at"))).alias(f"_new_{c}") for c in named])
    met = state.join(last, key, "left")
    return met.select(*[F.coalesce(F.col(f"_new_{c}"), F.col(c)).alias(c) if c in named else F.col(c) for c in state.columns])


def replay(state: DataFrame, log: DataFrame, key: str = "id", seq: str = "seq", op: str = "op") -> DataFrame:
    """``state`` after a log of changes in the order of ``seq`` (SET-2 to SET-6 over tables).

    ``put`` adds a row whose key is absent, else it does nothing; ``set`` replaces the columns that it names in a row that
    is there, a null leaves one; ``remove`` takes the row away.  Of one seq, removals come first, then puts, of which the
    least row counts, then sets, of which the greatest value counts.  Entries without key or seq, and of any other op, do
    nothing; columns that the log lacks stay as they are, or are null in added rows.  Keys of ``state`` are distinct.

    The fold needs no order of rows: a key's last removal decides which entries still count, its first put after that
    whether and from where on there is a row, and each column's last set after that its value.  All three are aggregates
    with partial steps, so a key with any share of the log is reduced before it is shuffled; joins are by key, with one
    row a key on one side.
    """
    ops = ["remove", "put", "set"]
    rest = [c for c in state.columns if c != key]
    kinds = {c: state.schema[c].dataType for c in rest}
    quoted = lambda c: F.col(f"`{c}`")
    value = lambda c: (quoted(c) if c in log.columns else F.lit(None)).cast(kinds[c])
    at = F.struct(quoted(seq).alias("seq"), F.array_position(F.array(*map(F.lit, ops)), quoted(op)).alias("op"))
    row = F.struct(*[value(c).alias(f"c{k}") for k, c in enumerate(rest)])
    entries = log.where(quoted(key).isNotNull() & quoted(seq).isNotNull() & quoted(op).isin(*ops)).select(quoted(key).cast(state.schema[key].dataType).alias("_key"), at.alias("_at"), row.alias("_new"))
    is_op = lambda name: F.col("_at.op") == ops.index(name) + 1

    gone = entries.where(is_op("remove")).groupBy("_key").agg(F.max("_at").alias("_gone"))
    alive = entries.where(~is_op("remove")).join(gone, "_key", "left").where(F.col("_gone").isNull() | (F.col("_at") > F.col("_gone"))).drop("_gone")
    first = alive.where(is_op("put")).groupBy("_key").agg(F.min(F.struct("_at", "_new")).alias("_put"))
    old = state.select(quoted(key).alias("_key"), F.struct(*[quoted(c).alias(f"c{k}") for k, c in enumerate(rest)]).alias("_old"))
    rows = old.join(gone, "_key", "left_anti").join(first, "_key", "full")
    rows = rows.select("_key", F.when(F.col("_old").isNull(), F.col("_put._at")).alias("_from"), F.coalesce("_old", "_put._new").alias("_row"))

    named = [k for k, c in enumerate(rest) if c in log.columns]
    if named:
        sets = alive.where(is_op("set")).join(rows.select("_key", "_from"), "_key").where(F.col("_from").isNull() | (F.col("_at") > F.col("_from")))
        last = sets.groupBy("_key").agg(*[F.max(F.when(F.col(f"_new.c{k}").isNotNull(), F.struct("_at", F.col(f"_new.c{k}").alias("value")))).alias(f"_set{k}") for k in named])
        rows = rows.join(last, "_key", "left")
    shown = {c: F.coalesce(F.col(f"_set{k}.value"), F.col(f"_row.c{k}")) if k in named else F.col(f"_row.c{k}") for k, c in enumerate(rest)} | {key: F.col("_key")}
    return rows.select(*[shown[c].alias(c) for c in state.columns])


def topic(spark, name: str, keywords: Sequence[str], topic_id: str | None = None) -> DataFrame:
    """A new topic's row; the id is the clock in milliseconds unless given (PRJ-19).  Blank keywords go, others stay
    as they are (FIL-7)."""
    made = spark.range(1).select(F.lit(topic_id).alias("id") if topic_id is not None else F.unix_millis(F.current_timestamp()).cast("string").alias("id"), F.lit(name).alias("name"), F.array(*map(F.lit, keywords)).cast("array<string>").alias("keywords"), F.lit(0).alias("pos"))
    return made.withColumn("keywords", F.filter("keywords", lambda k: js_trim(k) != ""))


def savable(name: Column, keywords: Column) -> Column:
    """FIL-8 for rows: a name, and a keyword, that are more than blanks."""
    return F.coalesce((js_trim(name) != "") & F.exists(keywords, lambda k: js_trim(k) != ""), F.lit(False))


def may_save(name: str, keywords: Sequence[str]) -> bool:
    """FIL-8."""
    return bool(name.strip()) and any(k.strip() for k in keywords)
