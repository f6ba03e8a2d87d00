"""Logs of changes, first writes on a stream, rankings beyond a page, nested debates, rules for columns and parameters."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rostrum.operators import keywords, state, topics
from rostrum.plans import checks, validate as v
from rostrum.sources import documents, schemas
from rostrum.streaming.writes import FirstWrites, first_rows, once_within

STATE = "id long, name string, note string"


def slow_replay(rows, log):
    at = {"remove": 0, "put": 1, "set": 2}
    least = lambda x: tuple((c is not None, c or "") for c in x[3:])
    held = {r[0]: list(r[1:]) for r in rows}
    for key, seq, op, name, note in sorted((x for x in log if x[0] is not None and x[1] is not None and x[2] in at), key=lambda x: (x[1], at[x[2]], least(x))):
        if op == "remove":
            held.pop(key, None)
        elif op == "put":
            held.setdefault(key, [name, note])
        elif key in held:
            held[key] = [new if new is not None else old for new, old in zip((name, note), held[key], strict=True)]
    return sorted((k, *r) for k, r in held.items())


@pytest.mark.parametrize("seed", range(4))
def test_replay_is_the_fold_of_its_log_in_order(spark, seed):
    rng = random.Random(seed)
    word = lambda: rng.choice([None, "a", "b", "c", "d", ""])
    rows = [(k, word(), word()) for k in range(0, 30, 2)]
    keys = [*range(30), *[7] * 20, None]
    log = [(rng.choice(keys), rng.choice([None, *range(60)]), rng.choice(["put", "set", "set", "remove", "other", None]), word(), word()) for _ in range(300)]
    changes = spark.createDataFrame(log, "id long, seq long, op string, name string, note string").repartition(7)
    got = state.replay(spark.createDataFrame(rows, STATE), changes)
    assert got.columns == ["id", "name", "note"] and sorted(map(tuple, got.collect())) == slow_replay(rows, log)


def test_replay_of_few_columns_and_of_nothing(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], STATE)
    log = spark.createDataFrame([(1, 5, "set", "c"), (3, 6, "put", "d"), (2, 7, "remove", None), (2, 8, "set", "gone")], "id int, seq int, op string, name string")
    assert sorted(state.replay(rows, log).collect()) == [(1, "c", "x"), (3, "d", None)]
    assert sorted(state.replay(rows, log.limit(0)).collect()) == [(1, "a", "x"), (2, "b", "y")]
    assert state.replay(rows.limit(0), log).collect() == [(3, "d", None)]
    assert state.replay(rows.select("id"), log).orderBy("id").collect() == [(1,), (3,)]
    odd = rows.withColumnRenamed("name", "_key").withColumnRenamed("note", "_at")
    assert sorted(state.replay(odd, log.withColumnRenamed("name", "_key")).collect()) == [(1, "c", "x"), (3, "d", None)]


def test_a_replayed_stream_agrees_with_the_batch(spark, tmp_path):
    rng = random.Random(3)
    rows = [(rng.choice([None, *range(40)]), rng.randrange(50), k, rng.choice("ab")) for k in range(600)]
    df = spark.createDataFrame(rows, "key long, t long, n long, what string")
    want = sorted(map(str, first_rows(df, "key", ["t", "n"]).collect()))
    slow = {}
    for r in sorted(rows, key=lambda r: (r[1], r[2])):
        slow.setdefault(r[0], r)
    assert len(want) == len(slow) and {tuple(r) for r in first_rows(df, "key", ["t", "n"]).collect()} == set(slow.values())
    kept = FirstWrites(spark, f"file://{tmp_path}/kept", "key", ["t", "n"])
    for part in range(2):  # the second start goes on where the first one stopped
        df.where(F.col("n") % 2 == part).repartition(4).write.mode("append").parquet(f"{tmp_path}/in")
        kept.start(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 2).parquet(f"{tmp_path}/in")).awaitTermination()
    assert sorted(map(str, kept.read().collect())) == want
    assert len(list((tmp_path / "kept" / "rows").glob("batch=*"))) >= 4


def test_keys_are_forgotten_after_the_delay(spark, tmp_path):
    df = spark.createDataFrame([(k % 10, f"2024-01-01 00:{k:02d}:00") for k in range(30)], "key long, t string").withColumn("t", F.col("t").cast("timestamp"))
    df.repartition(3).write.parquet(f"{tmp_path}/in")
    stream = once_within(spark.readStream.schema(df.schema).parquet(f"{tmp_path}/in"), "key", "t", "2 hours")
    stream.writeStream.format("parquet").option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start(f"{tmp_path}/out").awaitTermination()
    assert sorted(r["key"] for r in spark.read.parquet(f"{tmp_path}/out").collect()) == list(range(10))


def test_a_ranking_of_any_length(spark, tmp_path):
    rng = random.Random(5)
    corpus = [(k, rng.choice(["net zero", "nhs", "nhs and net zero", "none"]), rng.choice([None, 0, *range(1, 40)])) for k in range(300)]
    docs = spark.createDataFrame(corpus, "id long, t string, m long").withColumn("n", F.concat(F.lit("m"), "m"))
    words = spark.createDataFrame([(0, "net zero"), (1, "nhs")], "kw_ord int, keyword string")
    hits = keywords.all_hits(docs, words, "t")
    ranked = topics.full_ranking(hits, "id", "m", "n", "n", f"file://{tmp_path}/r", 6)
    got = [(r["place"] + 1, r["member_id"], r["mentions"]) for r in ranked.slice(0, ranked.count).orderBy("place").collect()]
    found = {}
    for order, word in enumerate(["net zero", "nhs"]):
        for k, t, m in corpus:
            if m and word in t:
                found.setdefault(m, []).append((order, k))
    slow = sorted(found, key=lambda m: (-len(found[m]), min(found[m])))
    assert got == [(k + 1, m, len(found[m])) for k, m in enumerate(slow)]
    page = ranked.slice(5, 3)
    assert sorted(r["member_id"] for r in page.collect()) == sorted(slow[5:8])
    assert "Sort" not in page._jdf.queryExecution().executedPlan().toString()


def test_nested_debates_in_parts_by_declared_index(spark, tmp_path):
    item = lambda k, who: {"Id": str(k), "ItemType": "Contribution", "Value": "<p>x</p>", "AttributedTo": who, **({"OrderIndex": k} if k is not None else {})}
    docs = [{"Overview": {"Id": "d", "House": "Lords"}, "Items": [item(4, "e"), item(None, "z"), item(0, "a")]}, {"Overview": {"Id": "d"}, "Items": [item(3, "d"), item(1, "b")]}, {"Overview": {"Id": "empty"}}, {"Overview": {"Id": "f"}, "Items": [item(2, "x")]}]
    (tmp_path / "d.json").write_text("\n".join(map(json.dumps, docs)))
    read = documents.read_debates(spark, str(tmp_path / "d.json"), ["AttributedTo"])
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "Value" not in plan and "AttributedTo" in plan
    got = documents.ordered_items(read).orderBy("debate_id", "pos").collect()
    assert [(r["debate_id"], r["pos"], r["AttributedTo"]) for r in got] == [("d", 0, "a"), ("d", 1, "b"), ("d", 2, "d"), ("d", 3, "e"), ("d", 4, "z"), ("f", 0, "x")]
    with pytest.raises(ValueError):
        documents.pruned(schemas.DEBATE, ["Items.Nothing"])
    assert documents.pruned("a struct<b: int, c: struct<d: int, e: int>>, f int", ["a.c.e"]).simpleString() == "struct<a:struct<c:struct<e:int>>>"


def test_columns_and_parameters_follow_one_set_of_rules(spark):
    raws = ["99999999999999999999", "-99999999999999999999", "9" * 5000, "+7", "-0", "007", "00000000000000000000000042", "-", " 42", "\u008542", "\x1c5", "x" * 300, "\U0001f600" * 150, "\U0001f600" * 151, "\u0085a\u0085", "﻿a ", "a\n", "\n", "  ", "٣"]
    df = spark.createDataFrame([(r,) for r in raws], "r string")
    columns = {"integer": (checks.integer(F.col("r"), least=-5, most=50), lambda x: v.integer(x, least=-5, most=50)), "text": (checks.text(F.col("r"), longest=300), lambda x: v.text(x, longest=300))}
    for r in df.select("r", *[c.alias(k) for k, (c, _) in columns.items()]).collect():
        for kind, (_, one) in columns.items():
            try:
                want = (one(r["r"]), None)
            except v.Invalid as e:
                want = (None, str(e))
            assert tuple(r[kind]) == want, (kind, r["r"][:30])
