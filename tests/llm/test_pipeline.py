import pandas as pd
from pyspark.sql import functions as F

import corpus_pipeline
from rostrum.llm import packing, quality
from rostrum.llm.common import id_crc

from .test_near import brute
from .test_packing import path


def test_stages_one_by_one(spark, tiny, tmp_path):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tiny)
        out.write.parquet(str(tmp_path / name))
        seen[name] = (docs, docs := spark.read.parquet(str(tmp_path / name)))
        if name != "packing":
            assert docs.columns == columns
    before, after = (x.toPandas() for x in seen["quality"])
    model = quality.train(seen["quality"][0], spark.read.parquet(f"{tiny}/labels.parquet"), id_crc() % 5 != 0)
    want = {i for i, s in zip(before.doc_id, model.score(list(before.text))) if s >= 0.3}
    assert set(after.doc_id) == want and len(after) == len(want) < len(before)
    labels = pd.read_parquet(f"{tiny}/labels.parquet")
    good = set(labels[labels.quality == 1].doc_id)
    assert len(good - set(after.doc_id)) <= 0.02 * len(good)
    before, after = (x.toPandas() for x in seen["near"])
    assert sorted(after.doc_id.astype(str)) == sorted({c for _, c, _ in brute(list(zip(before.doc_id, before.text)))})
    before, after = (x.toPandas() for x in seen["secrets"])
    pattern = r"(?i)(?<=token = \")[0-9a-f]{40}"
    assert dict(zip(after.doc_id, after.text)) == {i: pd.Series([t]).str.replace(pattern, "[SECRET]", regex=True)[0] for i, t in zip(before.doc_id, before.text)}
    before, after = (x.toPandas() for x in seen["mixing"])
    assert set(after.doc_id) == set(before.doc_id)
    tokens, pieces = (x for x in seen["packing"])
    encode = packing.Encoder(path()).encode
    assert pieces.agg(F.sum("length")).first()[0] == sum(len(x) // 4 + 1 for x in encode([r["text"] for r in tokens.collect()]))


def test_run_is_the_stages_in_turn(spark, tiny):
    assert corpus_pipeline.ORACLE_SQL is None
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "near", "secrets", "mixing", "packing"]
    assert corpus_pipeline.run(spark, tiny).agg(F.sum("length")).first()[0] > 0
