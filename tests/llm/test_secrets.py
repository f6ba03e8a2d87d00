import re

from pyspark.sql import functions as F

from rostrum.llm import secrets

from . import corpus

HEX = "0c497b5014f705c0be648d68b816f88c209136eb"


def scan(spark, pairs):
    docs = corpus.frame(spark, pairs).withColumn("path", F.lit(None).cast("string"))
    return secrets.scan(docs, secrets.train(spark, secrets.statistics(docs)))


def test_findings_are_where_they_say(spark):
    text = f'words before é\U0001f600 token = "{HEX}" and after.\nTOKEN = "{HEX.upper()}"!! card 4785380592391139 mail of.55@mail9.example.com 152.143.123.131'
    pairs = [(1, text), (2, "nothing here at all"), (3, None), (4, ""), (5, "a\x01b\x02 " + text), (6, ("filler " * 9000) + text), (1, text)]
    got = scan(spark, pairs).collect()
    by = {}
    for r in got:
        t = dict(pairs)[r["doc_id"]]
        assert t[r["start"] : r["start"] + r["length"]] == r["value"] and r["value"].lower() == HEX and r["score"] >= 0.5
        by[r["doc_id"]] = by.get(r["doc_id"], 0) + 1
    assert by == {1: 4, 5: 2, 6: 2}


def test_the_forest_keeps_secrets_and_drops_the_rest(spark):
    found = spark.createDataFrame(secrets.labelled_findings(1200, seed=99), "value string, before string, after string, path string, label int")
    scanner = secrets.train(spark, secrets.statistics(corpus.frame(spark, corpus.rows(20))))
    rows = scanner.forest.transform(secrets.assembled(secrets.featured(found, scanner.known))).select("label", "prediction").collect()
    right = sum(r["label"] == r["prediction"] for r in rows) / len(rows)
    assert right > 0.95


def test_held_tables(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    want = sorted((r["doc_id"], m.start(1)) for r in docs.collect() for m in re.finditer(r'(?i)token = "([0-9a-f]{40})"', r["text"]))
    got = secrets.scan(docs.withColumnRenamed("source", "path"), secrets.train(spark, secrets.statistics(docs)))
    assert sorted((r["doc_id"], r["start"]) for r in got.collect()) == want


def test_redaction_changes_nothing_else(spark):
    text = f'a token = "{HEX}" b token = "{HEX}" c'
    pairs = [(1, text), (1, "same id, other text"), (2, None), (None, text), (3, "clean")]
    docs = corpus.frame(spark, pairs)
    clean = secrets.redact(docs, scan(spark, pairs))
    assert clean.columns == docs.columns
    got = sorted((str(r["doc_id"]), str(r["text"])) for r in clean.collect())
    assert got == sorted((str(i), str(t).replace(HEX, "[SECRET]")) for i, t in pairs)


def test_nothing(spark):
    assert scan(spark, []).count() == 0
