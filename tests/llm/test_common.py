from types import SimpleNamespace

from pyspark.sql import functions as F

from rostrum.llm import common


def test_cuts_can_be_read_until_swept(spark):
    cut = common.materialize(spark.range(5).select("id", F.lit("x").alias("t")), "test")
    assert cut.count() == 5 and common.checkpoint_root(spark) in cut._rostrum_path
    gone = common.materialize(spark.range(2))
    common.discard(gone)
    assert common.sweep(spark) >= 1
    assert common.sweep(spark) == 0


def test_the_named_folder_is_used(spark):
    assert common.checkpoint_root(spark) == common.checkpoint_root(spark)
    named = SimpleNamespace(conf=SimpleNamespace(get=lambda key, none: {"spark.checkpoint.dir": "hdfs://shared/cut/"}.get(key, none)))
    assert common.checkpoint_root(named) == "hdfs://shared/cut"


def test_ids_are_hashed_as_text(spark):
    import zlib

    ids = [0, 7, 123456, -5]
    got = spark.createDataFrame([(i,) for i in ids], "doc_id long").select("doc_id", common.id_crc().alias("c")).collect()
    assert {r["doc_id"]: r["c"] for r in got} == {i: zlib.crc32(str(i).encode()) for i in ids}
