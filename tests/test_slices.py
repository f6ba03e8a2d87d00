import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators.slices import Ranked


def rows(n, seed=1):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(n // 3 + 1)]), k, f"t{k}") for k in range(n)]


def ranked(spark, tmp_path, data, ranges=8):
    df = spark.createDataFrame(data, "a long, id long, place_ string")
    return Ranked.build(df, [F.col("a").desc(), F.col("id")], f"file://{tmp_path}/ranked", ranges)


def test_every_slice_is_that_of_a_sort(spark, tmp_path):
    data = rows(300)
    whole = sorted(data, key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    r = ranked(spark, tmp_path, data)
    assert r.count == 300 and len(r.ranges) > 4
    again = Ranked(spark, r.path)
    for first, n in [(0, 10), (0, 300), (290, 50), (35, 1), (37, 120), (300, 5), (1000, 5), (10, 0), (-3, 8)]:
        got = sorted((x["place"], x["a"], x["id"]) for x in again.slice(first, n).collect())
        assert got == [(k, *whole[k][:2]) for k in range(max(first, 0), min(max(first + n, 0), 300))]
    assert sorted(x["place"] for x in r.visible(2, 4).collect()) == list(range(11))


def test_a_slice_reads_its_range_only_and_sorts_nothing(spark, tmp_path):
    r = ranked(spark, tmp_path, rows(400))
    plan = r.slice(390, 5)._jdf.queryExecution().executedPlan().toString()
    assert "Sort" not in plan and "Exchange" not in plan and "PartitionFilters: [isnotnull(_range" in plan and "GreaterThanOrEqual(_place" in plan
    assert len(r.slice(390, 5).select(F.input_file_name()).distinct().collect()) == 1


@pytest.mark.parametrize("data", [[], [(1, 1, "x")], [(5, k, "x") for k in range(50)], [(1, 1, "x")] * 30])
def test_few_equal_and_repeated_rows(spark, tmp_path, data):
    r = ranked(spark, tmp_path, data)
    assert r.count == len(data)
    assert sorted(x["place"] for x in r.slice(0, 100).collect()) == list(range(len(data)))
    assert r.slice(5, 3).columns == ["a", "id", "place_", "place"]


def test_reserved_names(spark, tmp_path):
    with pytest.raises(ValueError):
        Ranked.build(spark.range(3).withColumn("_place", F.lit(1)), [F.col("id")], f"file://{tmp_path}/x", 2)
