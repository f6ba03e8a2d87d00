import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from rostrum.llm import leaks
from rostrum.llm.queries import QUERIES

from . import corpus

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(UPPER))


def grams(items, length):
    out = {}
    for i, t in items:
        w = words(t)
        n = min(len(w), length)
        for k in range(len(w) - n + 1) if n else []:
            out.setdefault(tuple(w[k : k + n]), set()).add(i)
    return out


def brute(docs, items, length=10):
    known, out = grams(items, length), []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(g) for g in known}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in known:
                    hit |= set(range(k, k + n))
                    found |= known[tuple(w[k : k + n])]
        names = ",".join(sorted(str(x) for x in found if x is not None))
        out.append((str(i), len(w), len(hit), len(found - {None}), hashlib.sha256(names.encode()).hexdigest(), bool(hit)))
    return sorted(out)


def cases():
    rng = random.Random(5)
    docs = corpus.rows(30)
    pool = [t for _, t in docs if t and len(t.split()) > 40]
    cut = lambda t, a, n: " ".join(t.split()[a : a + n])
    items = [(k, cut(rng.choice(pool), rng.randint(0, 20), rng.randint(10, 30))) for k in range(12)]
    items += [(20, "Alpha1  BETA2"), (21, "one"), (22, ""), (23, None), (24, "... !!"), (None, cut(pool[0], 3, 12)), (30, items[0][1]), (31, items[0][1].upper()), (2, items[1][1]), (33, "again again again again again again again again again again again")]
    docs += [(3000, "x alpha1, beta2! y"), (3001, "É one É"), (3002, "alpha1_beta2"), (3003, items[0][1].replace(" ", " -- ") + " end"), (3004, items[0][1] + " gap " + items[0][1]), (3005, "ÀÉ " + items[1][1].title() + " ÀÉ"), (3003, "another text of one id, clean"), (3006, items[2][1] + " " + items[3][1])]
    return docs, items


def run(spark, docs, items, length=10):
    found = leaks.scan(corpus.frame(spark, docs).withColumn("words", F.lit(1)).withColumn("hash", F.lit(2)), spark.createDataFrame(items, "item_id long, text string"), length)
    names = F.array_sort(F.col("items").cast("array<string>"))
    rows = found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("None")), "n_words", leaks.n_hit(F.col("spans")), F.size("items"), F.sha2(F.array_join(names, ","), 256), F.size("spans") > 0)
    return sorted(map(tuple, rows.collect()))


@pytest.mark.parametrize("length", [10, 4])
def test_against_brute_force(spark, length):
    docs, items = cases()
    assert run(spark, docs, items, length) == brute(docs, items, length)


def test_a_set_over_the_bound_is_broadcast_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(leaks, "BLOCK_BYTES", 20_000)
    docs, items = cases()
    assert leaks.Grams(spark.createDataFrame(items, "item_id long, text string")).blocks > 2
    assert run(spark, docs, items) == brute(docs, items)


def test_empty_tables(spark):
    docs, items = cases()
    assert run(spark, docs[:5], []) == brute(docs[:5], [])
    assert run(spark, [], items) == []


def test_quick_lower_case_changes_ascii_only(spark):
    every = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and c]
    rows = [("".join(every[k : k + 1]),) for k in range(0x3000)] + [("".join(every[k : k + 64]),) for k in range(0x3000, len(every), 64)]
    df = spark.createDataFrame(rows, "t string").select(F.col("t"), leaks.lowered(F.col("t")).alias("low"))
    assert [t for t, low in df.collect() if low != t.translate(UPPER)] == []


def without_hits(text, items, length=10):
    """``text`` without the words of occurrences, and what stands between words of one."""
    known, w = grams(items, length), words(text)
    at = [m.span() for m in re.finditer(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", text)]
    hit = set()
    for n in {len(g) for g in known}:
        for k in range(len(w) - n + 1):
            if tuple(w[k : k + n]) in known:
                hit |= set(range(k, k + n))
    gone = set()
    for k in hit:
        gone |= set(range(at[k][0], at[k + 1][0] if k + 1 in hit else at[k][1]))
    return "".join(c for k, c in enumerate(text) if k not in gone)


def test_removal(spark):
    docs, items = cases()
    table, bench = corpus.frame(spark, docs), spark.createDataFrame(items, "item_id long, text string")
    cut = leaks.remove(table, bench)
    assert cut.columns == table.columns
    assert sorted((str(r.doc_id), str(r.text)) for r in cut.collect()) == sorted((str(i), str(t if t is None else without_hits(t, items))) for i, t in docs)
    clean = [(i, t) for (i, t) in docs if not brute([(i, t)], items)[0][-1]]
    assert sorted((str(r.doc_id), str(r.text)) for r in leaks.remove(table, bench, whole=True).collect()) == sorted((str(i), str(t)) for i, t in clean)


def test_the_query_finds_planted_passages(spark, tiny):
    docs = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    items = [tuple(r) for r in spark.read.parquet(f"{tiny}/benchmark.parquet").select("item_id", "text").collect()]
    got = QUERIES["op13_benchmark_decontamination"](spark, tiny).collect()
    assert sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in got) == brute(docs, items)
