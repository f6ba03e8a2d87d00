"""Columns of any name, very many partitions, and awkward rows in every stage."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from rostrum.llm import common, fingerprints, mixing, near, packing, quality, secrets
from rostrum.llm.queries import op2_exact_top_k, op4_fingerprints

from . import corpus
from .test_packing import path

NAMES = ["key", "step", "bucket", "place", "_id", "_hash", "_values", "link", "group", "id", "start", "spans", "row", "found", "kept", "class_id", "own_range", "a", "b", "at", "whole", "quality_score", "_score", "document", "copy", "schedule"]


def clashing(spark, pairs):
    return corpus.frame(spark, pairs).drop("score", "id").select("*", *[F.lit(f"of {n}").alias(n) for n in NAMES])


def same(rows, columns):
    assert rows.columns == columns
    for r in rows.select(*NAMES).distinct().collect():
        assert r.asDict() == {n: f"of {n}" for n in NAMES}


def test_operators_keep_columns_of_any_name(spark):
    docs = clashing(spark, corpus.rows(20))
    same(near.keep_one(docs), docs.columns)
    found = secrets.candidates(docs).withColumn("length", F.length("value"))
    same(secrets.redact(docs, found), docs.columns)
    next_rows = fingerprints.with_next(docs, ["text"])
    same(next_rows.drop("next_text"), docs.columns)
    mixed = mixing.mix(docs)
    assert set(docs.columns) <= set(mixed.columns)
    kept = [n for n in NAMES if n not in mixing.OUTPUTS]
    assert mixed.select(*kept).distinct().collect() == [tuple(f"of {n}" for n in kept)]


def test_every_stage_takes_awkward_rows(spark, tmp_path):
    docs = clashing(spark, corpus.rows(30) + [(None, None), (None, ""), (77, "token = \"0c497b5014f705c0be648d68b816f88c209136eb\"")])
    docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("quality"), F.lit(0).alias("toxic")).write.parquet(str(tmp_path / "labels.parquet"))
    for name, stage in corpus_pipeline.STAGES:
        out = common.materialize(stage(spark, docs, str(tmp_path)), name)
        if name != "packing":
            same(out, docs.columns)
            docs = out
    assert out.count() > 0
    empty = clashing(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, empty, str(tmp_path))
        assert out.count() == 0 and (name == "packing" or out.columns == empty.columns)


@pytest.mark.parametrize("ranges", [500, 2000, 10_000])
def test_fingerprints_with_very_many_partitions(spark, tmp_path, ranges):
    pairs = [(i, f"text number {i} of a few words") for i in range(0, 3 * ranges, 3)]
    docs = spark.createDataFrame(pairs, "doc_id long, text string")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(ranges))
    try:
        got = {r["doc_id"]: r["next_text"] for r in fingerprints.with_next(docs, ["text"]).select("doc_id", "next_text").collect()}
        if ranges == 500:
            docs.limit(50).write.parquet(str(tmp_path / "documents.parquet"))
            assert op4_fingerprints(spark, str(tmp_path)).count() == 50
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    texts = dict(pairs)
    ids = sorted(texts, reverse=True)
    assert got == {i: texts[ids[(k + 1) % len(ids)]] for k, i in enumerate(ids)}


def test_ranges_are_those_of_a_plain_search(spark):
    import bisect

    cuts = sorted({k * k % 1009 for k in range(300)})
    got = spark.range(-5, 1100).select("id", fingerprints.range_of(F.col("id"), cuts).alias("r")).collect()
    assert all(r["r"] == bisect.bisect_left(cuts, r["id"]) for r in got)


def test_other_tokenizers_go_through_the_library():
    import struct

    import public_tokenizers
    from tokenizers import Tokenizer

    other = public_tokenizers.path("byte_bpe_50k.json")
    t, e = Tokenizer.from_file(other), packing.Encoder(other)
    for text in ["Hello World again", " leading  blanks\n\tand lines", "Éa <|endoftext|> b", ""]:
        assert e.encode([text]) == [struct.pack(f"<{len(ids)}I", *ids) for ids in [t.encode(text, add_special_tokens=False).ids]]
    assert packing.Encoder(path()).by_words and not e.by_words


def test_a_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Far:
        conf = {"spark.checkpoint.dir": None}

        class sparkContext:
            master = "spark://host:7077"

            class _jsc:
                sc = staticmethod(lambda: type("S", (), {"getCheckpointDir": staticmethod(lambda: type("O", (), {"isDefined": staticmethod(lambda: False), "get": None})())})())

    Far.conf = type("C", (), {"get": staticmethod(lambda *a: None)})
    with pytest.raises(RuntimeError):
        common.checkpoint_root(Far)


def test_vectors_without_components_and_ids_with_several(spark, tmp_path):
    rows = [(0, [1.0, 2.0]), (0, [3.0, -1.0]), (1, []), (2, [5.0, 5.0]), (50, [1.0, 1.0]), (3, None), (4, [1e6, 1e9]), (5, [float("inf"), 0.0])]
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(str(tmp_path / "embeddings.parquet"))
    got = [(r["query_id"], r["rank"], r["vec_id"]) for r in op2_exact_top_k(spark, str(tmp_path)).orderBy("query_id", "rank").collect()]
    assert got[-3:] == [(50, 1, 4), (50, 2, 2), (50, 3, 0)] or [g for g in got if g[0] == 50][:2] == [(50, 1, 4), (50, 2, 2)]


def test_labels_of_repeated_ids_are_bounded(spark):
    docs = spark.createDataFrame([(k % 3, f"word{k} and more words") for k in range(60)], "doc_id long, text string")
    labels = spark.createDataFrame([(0, 1), (1, 0), (2, 1), (None, 1)], "doc_id long, quality int")
    assert 0 <= quality.train(docs, labels, F.lit(True), max_labels=10).score(["word1"])[0] <= 1
