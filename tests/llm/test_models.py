import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from rostrum.llm import langid, quality
from rostrum.llm.common import id_crc
from rostrum.llm.queries import op5_language_id, op9_quality_classifier

from . import corpus


def test_languages_of_held_out_documents(spark, small):
    docs = pd.read_parquet(f"{small}/documents.parquet")
    got = op5_language_id(spark, small).toPandas().merge(docs[["doc_id", "lang"]])
    assert len(got) == len(docs) and got.score.between(0, 1).all()
    held = got[got.held_out]
    assert (held.lang == held.lang_pred).mean() > 0.95


def test_backpropagation_through_time_against_differences():
    rng = np.random.default_rng(0)
    h = 3
    d = langid.Direction(rng.normal(0, 0.3, (256, 3 * h)), rng.normal(0, 0.3, (h, 2 * h)), rng.normal(0, 0.3, (h, h)))
    x = rng.integers(97, 101, (6, 4)).astype(np.uint8)
    w = rng.normal(0, 1, (6, 4, h))
    loss = lambda: float((d.run(x) * w).sum())
    grads = d.back(x, d.run(x, keep=True)[1], w)
    for p, g in zip((d.table, d.gates, d.inner), grads):
        for _ in range(12):
            at = tuple(rng.integers(0, s) for s in p.shape) if p is not d.table else (int(rng.integers(97, 101)), int(rng.integers(0, 3 * h)))
            old = p[at]
            p[at] = old + 1e-6
            up = loss()
            p[at] = old - 1e-6
            down = loss()
            p[at] = old
            assert (up - down) / 2e-6 == pytest.approx(g[at], abs=1e-4)


def test_language_edge_cases(spark):
    pairs = corpus.rows(40)
    docs = corpus.frame(spark, pairs).withColumn("lang", F.when(F.col("doc_id") % 2 == 0, "aa").otherwise("bb"))
    model = langid.train(docs, id_crc() % 3 != 1, per_label=20)
    rows = langid.predict(docs.withColumn("text", F.when(F.col("doc_id") == 4, "12 !? 3").otherwise(F.col("text"))), model).collect()
    assert len(rows) == len(pairs)
    for r in rows:
        if not r["text"] or not any(c.isalpha() for c in r["text"]):
            assert (r["lang_pred"], r["score"]) == ("und", 0)
        else:
            assert r["lang_pred"] in ("aa", "bb") and 0 <= r["score"] <= 1
    assert langid.predict(docs.limit(0), model).count() == 0
    none = langid.train(docs.limit(0), F.lit(True))
    assert {r["lang_pred"] for r in langid.predict(docs, none).collect()} == {"und"}


def test_letters():
    assert [langid.has_letter(t) for t in ("", "12 ½ ²", "½a", "é", "_-3")] == [False, False, True, True, False]


def test_every_byte_counts():
    rng = np.random.default_rng(1)
    model = langid.fit([b"aaaa bbbb " * 8, b"cccc dddd " * 8] * 4, ["x", "y"] * 4, steps=60)
    text = "aaaa " * 300 + "cccc " * 3000
    assert model.predict([text])[0] == ["y"]
    long = "".join(rng.choice(list("abcd "), 70_000))
    assert model.predict([long, None, long])[1][0] == model.predict([long])[1][0]


def test_quality_of_held_out_documents(spark, small):
    labels = pd.read_parquet(f"{small}/labels.parquet")
    got = op9_quality_classifier(spark, small).toPandas()
    assert len(got) == 1000 and got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.3)).all()
    held = got[got.held_out].merge(labels, on="doc_id")
    assert (held.predicted == held.quality).mean() > 0.93


def test_the_identity_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    m = quality.FactorizationMachine(0.3, rng.normal(0, 1, quality.FEATURES), rng.normal(0, 0.3, (quality.FEATURES, 4)))
    texts = ["a few words with a few more words", "", "A | B | C\n1234 %%% x x x x"]
    for t, s in zip(texts, m.score(texts)):
        i, v = quality.features(t)
        y = m.bias + m.weights[i] @ v + sum((m.factors[i[a]] @ m.factors[i[b]]) * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert s == pytest.approx(1 / (1 + np.exp(-y)))


def test_quality_edge_cases(spark):
    docs = corpus.frame(spark, corpus.rows(40))
    labels = spark.createDataFrame([(1000 + i, i % 2, 0) for i in range(30)] + [(1001, None, 0), (1002, 0, 1)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, labels, F.lit(True), max_labels=20)
    scored = quality.score(docs, model, out="score")
    assert sorted(scored.columns) == sorted(docs.columns) and scored.count() == docs.count()
    rows = scored.collect()
    assert all(0 <= r["score"] <= 1 for r in rows)
    assert len({r["score"] for r in rows if not r["text"]}) == 1
    assert quality.score(docs.limit(0), model).count() == 0
    one = quality.train(docs, labels.where("quality = 1"), F.lit(True))
    assert all(r["quality_score"] > 0.99 for r in quality.score(docs, one).collect())
    none = quality.train(docs, labels.limit(0), F.lit(True))
    assert all(r["quality_score"] == 0.5 for r in quality.score(docs, none).collect())
