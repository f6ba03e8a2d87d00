import datetime
import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import places, speakers


def slow(rows):
    """(list, order) -> place"""
    out, seen = {}, {}
    for key, at in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] if r[1] is not None else 0)):
        out[key, at] = seen.get(key, 0)
        seen[key] = seen.get(key, 0) + 1
    return out


@pytest.mark.parametrize("cells", [1, 2, 7, 64])
def test_places_are_those_of_a_sort_in_each_list(spark, cells):
    rng = random.Random(cells)
    rows = [(rng.choice([None, "hot", "hot", "hot", "a", ""]), k) for k in range(400)] + [("b", None)]
    df = spark.createDataFrame(rows, "list string, at long").repartition(5)
    got = places.numbered(df, [F.col("list")], [F.col("at")], cells=cells).collect()
    assert {(r["list"], r["at"]): r["place"] for r in got} == slow(rows) and len(got) == len(rows)


def test_a_hot_list_is_many_tasks(spark):
    df = spark.range(20_000).select(F.when(F.col("id") % 10 == 0, F.col("id")).otherwise(-1).alias("list"), F.col("id").alias("at"), F.lit(1).alias("_cell"), F.lit(2).alias("_inside"))
    placed = places.numbered(df, [F.col("list")], [F.col("at")], cells=32)
    assert placed.columns == ["list", "at", "_cell", "_inside", "place"]
    hot = placed.where("list = -1")
    assert hot.agg(F.max("place"), F.count_distinct("place")).first() == (17_999, 18_000)
    cuts = places._cuts(df.select(F.struct("list").alias("_list"), F.struct("at").alias("_at")), 32)
    sizes = [r[0] for r in df.groupBy(F.size(F.filter(cuts, lambda c: c < F.struct("at")))).count().select("count").collect()]
    assert len(sizes) == 32 and max(sizes) < 3 * 20_000 / 32


def test_kinds_of_order_equal_rows_and_none(spark):
    kinds = [("a", datetime.date(2024, 1, 1 + k % 28), f"n{k:03d}", k % 3 == 0) for k in range(60)]
    df = spark.createDataFrame(kinds, "l string, d date, n string, b boolean")
    got = places.numbered(df, [], [F.col("b"), F.col("d"), F.col("n")], "p", 8).orderBy("p").collect()
    assert [(r["b"], r["d"], r["n"]) for r in got] == sorted((b, d, n) for _, d, n, b in kinds) and [r["p"] for r in got] == list(range(60))
    same = spark.createDataFrame([("a", 1)] * 50, "l string, at long")
    assert sorted(r["place"] for r in places.numbered(same, [F.col("l")], [F.col("at")]).collect()) == list(range(50))
    assert places.numbered(same.limit(0), [F.col("l")], [F.col("at")]).collect() == []
    with pytest.raises(ValueError):
        places.numbered(same.withColumnRenamed("l", "PLACE"), [F.col("PLACE")], [F.col("at")])


def test_index_keys_and_days(spark):
    df = spark.createDataFrame([(1, "x", "k"), (2, "x", None), (3, "x", ""), (4, "y", None)], "id long, list string, key string")
    got = places.with_index_key(df, F.col("key"), [F.col("list")], [F.col("id")]).orderBy("id").collect()
    assert [r["row_key"] for r in got] == ["k", "1", "2", "0"]
    days = speakers.by_day(df.select("id", F.lit("2024-01-15").alias("d"), F.lit(7).alias("_n"), F.lit(8).alias("_before")), "d", "id")
    assert sorted((r["id"], r["place"], r["_n"], r["_before"]) for r in days.collect()) == [(k, k, 7, 8) for k in (1, 2, 3, 4)]
