import random

import numpy as np
import pyarrow as pa
import pytest

from rostrum.functions import runs, text
from rostrum.plans import more_queries, table_queries  # noqa: F401
from rostrum.plans.queries import QUERIES
from pyspark.sql import functions as F


def number(piece: bytes) -> int:
    return int.from_bytes(piece + b"\xff" * (runs.LONGEST - len(piece)), "big", signed=True)


@pytest.mark.parametrize("step", [1, 7, 1 << 17])
@pytest.mark.parametrize("kind", [pa.binary(), pa.large_binary()])
def test_runs_against_brute_force(monkeypatch, step, kind):
    monkeypatch.setattr(runs, "STEP", step)
    rng = random.Random(1)
    texts = [None, b"", *("".join(rng.choice(["a", "b", "é", "😀", " "]) for _ in range(rng.randint(0, 40))).encode() for _ in range(60)), b"ab", None]
    some = pa.array([b"before", *texts, b"after"], kind).slice(1, len(texts))
    lengths = [1, 2, 5, 8]
    pieces = {t[i : i + n] for t in texts if t for n in lengths for i in range(len(t) - n + 1) if i + n <= len(t)}
    asked = {p for p in pieces if rng.random() < 0.3}
    wanted = np.zeros(runs.SLOTS, bool)
    wanted[runs.slots(np.array([number(p) for p in asked]).view(np.uint64))] = True
    got = runs.wanted_runs(some, lengths, wanted).to_pylist()
    assert len(got) == len(texts)
    names = {number(p) for p in asked}
    for t, found in zip(texts, got, strict=True):
        assert len(found) == len(set(found))
        here = {number((t or b"")[i : i + n]) for n in lengths for i in range(len(t or b"") - n + 1)}
        assert set(found) & names == here & names and set(found) <= here


def test_numbers_of_spark_and_of_numpy(spark):
    pieces = ["a", "ab", "é", "😀😀", "abcdefgh", "12345678"]
    rows = spark.createDataFrame([(p,) for p in pieces], "p string").select("p", runs.number(F.col("p").cast("binary")).alias("n")).collect()
    assert {r["p"]: r["n"] for r in rows} == {p: number(p.encode()) for p in pieces}


@pytest.mark.parametrize("name", ["keyword_table_hits", "keyword_table_ranking", "keyword_table_totals"])
def test_texts_are_not_split_into_characters(spark, tiny, name):
    plan = QUERIES[name](spark, tiny)._jdf.queryExecution().optimizedPlan().toString()
    assert "transform(" not in plan and "lambda" not in plan


def test_plain_text_stays_out_of_python(spark, tiny):
    spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    shown = QUERIES["shown_documents"](spark, tiny)
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "500"
    assert "sanitised(CASE WHEN" in shown._jdf.queryExecution().optimizedPlan().toString()
    some = spark.createDataFrame([(1, "plain"), (2, "<p>x"), (3, ""), (4, None)], "id int, t string")
    assert [r[0] for r in some.orderBy("id").select(text.shown(F.col("t"))).collect()] == ["plain", "<p>x</p>", None, None]
