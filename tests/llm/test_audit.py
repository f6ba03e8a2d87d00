import re
from collections import Counter
from itertools import permutations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from rostrum.llm import audit

from . import corpus

LABELS = "doc_id long, quality int, toxic int"


def failures(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return [len(words) < 50, 100 * len(set(words)) < 65 * len(words), 100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]


def brute(rows, labels):
    """rows: (doc_id, text, part).  One dictionary of figures for each part, order and step."""
    docs = []
    good, toxic = {i for i, q, _ in labels if q == 1}, {i for i, _, t in labels if t == 1}
    for i, text, part in rows:
        smaller = i is not None and any(j is not None and j < i and (u or "") == (text or "") for j, u, _ in rows)
        docs.append((part or "", dict(zip("ABCDE", [*failures(text or ""), smaller])), i is not None and i in good, i is not None and i in toxic))
    out, shapley = {}, Counter()
    for part in {d[0] for d in docs}:
        for order in map("".join, permutations("ABCDE")):
            left = [d for d in docs if d[0] == part]
            every = left
            for step, f in enumerate(order, 1):
                gone = [d for d in left if d[1][f]]
                left = [d for d in left if not d[1][f]]
                shapley[part, f] += len(gone)
                out[part, order, step] = [len(left), len(gone), sum(d[1][f] for d in every) - len(gone), sum(d[1][f] and sum(d[1].values()) == 1 for d in every), sum(d[2] for d in gone), sum(d[3] for d in gone)]
    return sorted((*k, *v, shapley[k[0], k[1][k[2] - 1]]) for k, v in out.items())


def run(spark, rows, labels):
    docs = spark.createDataFrame([(*r, 1, 2, "x") for r in rows], "doc_id long, text string, source string, mask int, first int, name string")
    return sorted(map(tuple, audit.audit(docs, spark.createDataFrame(labels, LABELS)).collect()))


def odd_rows():
    rows = [(i, t, f"s{(i or 0) % 3}" if i != 5 else None) for i, t in corpus.rows()]
    rows += [(2000 + i, t, "s1") for i, t in enumerate(["A" * 6 + "b" * 94, "A" * 5 + "b" * 95, "a # b", "É" * 10, "w " * 65 + "v", "\x0bx\x1fy\xa0z", " ".join(f"w{k % 33}" for k in range(50))])]
    rows += [(2100 + i, rows[0][1], "s2") for i in range(9)] + [(None, rows[0][1], None), (None, None, "s0")]
    return rows


def test_against_brute_force(spark):
    rows = odd_rows()
    labels = [(i, (i or 0) % 2, (i or 0) % 5 == 0) for i, _, _ in rows[:70]]
    labels = [(i, q, int(t)) for i, q, t in labels] + [(1003, 1, None), (1003, None, 1), (None, 1, 1), (99, 1, 1)]
    assert run(spark, rows, labels) == brute(rows, labels)


def test_empty_tables(spark):
    assert run(spark, [], []) == []
    assert len(run(spark, [(1, None, None)], [])) == 600


def test_first_failures():
    assert audit.FIRST.shape == (32, 120)
    for mask in range(32):
        for k, order in enumerate(audit.ORDERS):
            fails = [s for s, f in enumerate(order) if mask & (1 << "ABCDE".index(f))]
            assert audit.FIRST[mask, k] == min(fails, default=5)


def test_parts_are_flushed_and_summed(spark, monkeypatch):
    monkeypatch.setattr(audit, "PARTS", 3)
    rows = [(f"p{k % 7}", k % 32, k % 4, k) for k in range(500)]
    batch = pa.RecordBatch.from_pylist([dict(zip(["part", "mask", "label", "n"], r)) for r in rows])
    sums = Counter()
    for b in audit.accumulate(iter([batch.slice(0, 200), batch.slice(200)])):
        assert b.num_rows <= 2 * 3 * 720
        for r in b.to_pylist():
            sums[r["part"], r["order"], r["step"]] += r["removed"]
    want = Counter()
    for part, mask, _, n in rows:
        for k in range(120):
            want[part, k, int(audit.FIRST[mask, k])] += n
    assert +sums == +want


@pytest.mark.parametrize("text,bits", [("", 1), ("AB", 5), ("$", 9), ("a " * 50, 2), (" ".join(f"w{k}" for k in range(50)), 0)])
def test_masks(spark, text, bits):
    assert spark.range(1).select(audit.text_failures(F.lit(text))).first()[0] == bits
