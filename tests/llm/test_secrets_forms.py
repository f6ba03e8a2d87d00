import pytest
from pyspark.sql import functions as F

from rostrum.llm import secrets

from . import corpus

KEY = "wJalrXUtnFEMIK7MDENGbPxRfiCYzQ93kLmT02aB"
HEX = "2abc3f9d0c497b5014f705c0be648d68b816f88c"
GHP = "ghp_0aB1cD2eF3gH4iJ5kL6mN7oP8qR9sT0uV1wX"
FORMS = [
    (f"export AWS_SECRET_ACCESS_KEY={KEY}\n", KEY), (f"API_TOKEN={HEX}\nDEBUG=1", HEX), (f"github_token={GHP}", GHP), (f"mode=fast token={HEX}", HEX),
    (f"SECRET_KEY_BASE={HEX}", HEX), (f"region=eu/api_token={HEX}", HEX), (f'"service_token_01": "{HEX}"', HEX), (f'{{"service_token_01":"{HEX}","n":1}}', HEX),
    (f"Authorization: Bearer {HEX} then", HEX), (f'token = "{HEX}"', HEX),
]


@pytest.fixture(scope="module")
def found(spark):
    docs = corpus.frame(spark, [(i, "some words before " + t) for i, (t, _) in enumerate(FORMS)])
    rows = secrets.featured(secrets.candidates(docs), secrets.statistics(docs)).collect()
    kept = secrets.scan(docs, secrets.train(spark, secrets.statistics(docs))).collect()
    return rows, kept


@pytest.mark.parametrize("i", range(len(FORMS)))
def test_the_value_alone_is_found(found, i):
    text, value = "some words before " + FORMS[i][0], FORMS[i][1]
    (r,) = [r for r in found[0] if r["doc_id"] == i and value in r["value"]]
    assert r["value"] == value and text[r["start"] : r["start"] + len(value)] == value and r["named"] == 1
    assert [r["value"] for r in found[1] if r["doc_id"] == i] == [value]


def test_other_names_and_padding(spark):
    padded = "QWxhZGRpbjpvcGVuIHNlc2FtZTEyMw=="
    texts = [f"session={HEX} x", f"blob {padded} x", "author: Christopher wrote it", "deploy_number_01=production x", "api_key_1=api_key_12 x"]
    got = secrets.candidates(corpus.frame(spark, list(enumerate(texts)))).orderBy("doc_id", F.col("start")).collect()
    assert [(r["doc_id"], r["value"]) for r in got] == [(0, HEX), (1, padded), (3, "deploy_number_01=production"), (4, "api_key_12")]
    assert all(texts[r["doc_id"]][r["start"] :].startswith(r["value"]) for r in got)


def test_quoted_values_are_whole_and_redacted_where_they_stand(spark):
    texts = [(1, 'password = "hunter2Xq9!!" and hunter2Xq9!! again'), (2, f"token={HEX}, then"), (3, f"api_key: '{GHP}'.")]
    docs = corpus.frame(spark, texts)
    got = {r["doc_id"]: r["value"] for r in secrets.candidates(docs).collect()}
    assert got == {1: "hunter2Xq9!!", 2: HEX, 3: GHP}
    found = secrets.candidates(docs).withColumn("length", F.length("value"))
    clean = {r["doc_id"]: r["text"] for r in secrets.redact(docs, found).collect()}
    assert clean == {1: 'password = "[SECRET]" and hunter2Xq9!! again', 2: "token=[SECRET], then", 3: "api_key: '[SECRET]'."}


def test_very_many_candidates_and_columns_of_any_name(spark):
    text = " ".join(f"é token_{i}=aB{i:06d}cD{i * 7919:08d}" for i in range(1500))
    docs = corpus.frame(spark, [(1, text)]).withColumn("spans", F.lit(1)).withColumn("_id", F.lit(2)).withColumn("found", F.lit(3)).withColumn("text_hash", F.lit(4))
    rows = secrets.candidates(docs).collect()
    assert len(rows) == 1500 and all(text[r["start"] :].startswith(r["value"]) and r["value"].startswith("aB") for r in rows)
    clean = secrets.redact(docs, secrets.candidates(docs).withColumn("length", F.length("value")))
    assert clean.columns == docs.columns and clean.first()["text"] == " ".join(f"é token_{i}=[SECRET]" for i in range(1500))


def test_shapes_that_the_generator_never_made(spark, small):
    """Held-out shapes of secrets, and of what is none."""
    import random

    rng = random.Random(11)
    of = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    secret = [lambda: "api_key = SG." + of(low + up + num, 22) + "." + of(low + up + num, 43), lambda: "auth_token: '" + of(up + "234567", 32) + "'", lambda: "client_secret=" + "-".join(of(low + num, 5) for _ in range(6)), lambda: 'password = "' + of(low + up + num + "#?", 18) + '"']
    benign = [lambda: f"release v{rng.randint(1, 9)}.{rng.randint(10, 99)}.{rng.randint(100, 999)}-{rng.randint(10, 99)}-rc", lambda: f"form {rng.choice(up)}{of(num, 2)}-20{of(num, 2)}-{of(num, 4)}-NORTH", lambda: f"isbn 978-{rng.randint(0, 9)}-{rng.randint(10, 99)}-{rng.randint(100000, 999999)}-{rng.randint(0, 9)}", lambda: f"see chapter{rng.randint(1, 9)}-of-the-second-part for more"]
    texts = [("some words here " + f() + " and more", 1) for _ in range(30) for f in secret] + [("some words here " + f() + " and more", 0) for _ in range(30) for f in benign]
    known = secrets.statistics(spark.read.parquet(f"{small}/documents.parquet"))
    docs = corpus.frame(spark, [(i, t) for i, (t, _) in enumerate(texts)])
    hit = {r["doc_id"] for r in secrets.scan(docs, secrets.train(spark, known)).collect()}
    right = sum(texts[i][1] for i in hit)
    assert right >= 0.9 * 120 and right >= 0.9 * len(hit)


@pytest.mark.parametrize("text,values", [("token_" * 40_000 + " 1", 0), ("a=" * 60_000 + "1", 1), ("password" * 30_000, 0), ("secret-token." * 20_000 + f"={HEX}", 1)])
def test_long_runs_of_credential_words_take_linear_time(spark, text, values):
    import time

    docs = spark.createDataFrame([(1, text, "")], "doc_id long, text string, path string")
    began = time.perf_counter()
    assert secrets.candidates(docs).count() == values
    assert time.perf_counter() - began < 30  # over 100 s where every word's rest was read to its end
