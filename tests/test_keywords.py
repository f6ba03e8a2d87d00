import random

import pytest

from rostrum.operators import keywords, topics
from rostrum.plans import table_queries  # noqa: F401
from rostrum.plans.queries import QUERIES

TEXT = "id long, t string, m string, hash long, chars string"


def corpus():
    rng = random.Random(2)
    bits = ["Net", " zero", "ñÉé", "the", " ", "NHS", "x", "😀", "aaaa", "\n", "cost of living", "."]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 40)))) for i in range(120)]
    rows += [(200, None), (201, ""), (202, "e"), (203, "the " * 30_000 + "needle"), (None, "the nhs"), rows[0], rows[1]]
    return [(i, t, f"m{(i or 0) % 3}", 1, "clash") for i, t in rows]


TABLE = [(1, "net zero"), (2, "NHS"), (3, "x"), (4, "😀"), (5, "zz"), (6, "AAAAA"), (7, " the"), (8, ""), (9, None), (10, "  "), (11, "ñéÉ"), (2, "NHS"), (12, "net zeroñ"), (13, "needle"), (14, "cost of living" * 3), (15, "éé"), (16, "\nnet")]


def brute(rows, table):
    table = [(o, k) for o, k in table if k and k.strip(" ")]
    return sorted((str(i), o, k) for i, t, *_ in rows for o, k in table if t and k.lower() in t.lower())


def hits(spark, rows, table):
    found = keywords.all_hits(spark.createDataFrame(rows, TEXT), keywords.cleaned(spark.createDataFrame(table, "kw_ord int, keyword string")), "t")
    assert found.columns == ["id", "m", "hash", "chars", "kw_ord", "keyword"]
    return sorted((str(r["id"]), r["kw_ord"], r["keyword"]) for r in found.collect())


def test_against_brute_force(spark):
    once = [r for k, r in enumerate(TABLE) if r not in TABLE[:k]]
    assert hits(spark, corpus(), once) == brute(corpus(), once)


def test_a_table_over_the_bound_is_scanned_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(keywords, "BLOCK_BYTES", 1000)
    once = [r for k, r in enumerate(TABLE) if r not in TABLE[:k]]
    assert hits(spark, corpus(), once) == brute(corpus(), once)


def test_empty_tables(spark):
    assert hits(spark, corpus(), []) == hits(spark, [], TABLE) == hits(spark, corpus(), [(1, " ")]) == []


def test_the_same_rows_as_literals(spark):
    rows = [r for r in corpus() if r[0] is not None][:120]
    words = ["net zero", "NHS", "the"]
    df = spark.createDataFrame(rows, TEXT)
    table = spark.createDataFrame(list(enumerate(words)), "kw_ord int, keyword string")
    pick = lambda h: sorted((r["kw_ord"], r["keyword"], r["rn"], r["id"]) for r in h.collect())
    few, many = topics.keyword_hits(df, words, "t", "id", 7), keywords.top_hits(df, table, "t", "id", 7)
    assert pick(few) == pick(many)
    rank = lambda h: sorted(map(tuple, topics.ranking(h, "m", "m", "m").collect()))
    assert rank(few) == rank(many)


@pytest.mark.parametrize("name", ["keyword_table_hits", "keyword_table_totals"])
def test_no_nested_loop(spark, tiny, name):
    plan = QUERIES[name](spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan and "BroadcastHashJoin" in plan


def test_anchors_are_the_rarest_runs(spark):
    table = spark.createDataFrame([(k, f"common{w}") for k, w in enumerate(["abcd", "bcde", "wxyz"])] + [(9, "ab")], "kw_ord int, keyword string")
    listed = keywords.postings(table).collect()
    assert len(listed) == 4 and len({r["hash"] for r in listed}) == 4
    assert {r["keyword"]: r["length"] for r in listed}["ab"] == 2
    assert all(r["at"] > 2 for r in listed if r["length"] == 4)
