import random

import pytest
from pyspark.sql import functions as F

from rostrum.functions.text import found_in
from rostrum.operators import signatures
from rostrum.operators.signatures import Signed
from rostrum.sources.documents import read_table


def rows(spark, n=200):
    rng = random.Random(3)
    data = [(k, "".join(rng.choice(["ab", "Éc", "def ", "😀", "x", "\n"]) for _ in range(rng.randint(0, 30))), rng.choice([None, "who", "Net Zero"]), "clash") for k in range(n)]
    data += [(n, None, None, "c"), (n + 1, "", "", "c"), (n + 2, "a needle here", "x", "c"), (n + 2, "a needle here", "x", "c"), (n + 3, "abc", "NEE", "c"), (None, "x" * 50_000 + "needle", None, "c")]
    return spark.createDataFrame(data, "id long, t string, who string, bit string")


@pytest.mark.parametrize("bits", [1 << 20, 64])
def test_the_rows_of_a_scan(spark, tmp_path, monkeypatch, bits):
    monkeypatch.setattr(signatures, "BITS", bits)
    df = rows(spark)
    signed = Signed.build(df, ["t", "who"], f"file://{tmp_path}/s", 12, by=["id"])
    for term in ["NEEDLE", "net zero", "abÉC", "", "not there at all", "def ab", "nee"]:
        want = df.where(found_in(term, F.col("t"), F.col("who")))
        assert sorted(map(str, signed.search(term, ["t", "who"]).collect())) == sorted(map(str, want.collect())), term


def test_parts_without_the_term_are_skipped(spark, tmp_path):
    signed = Signed.build(rows(spark), ["t"], f"file://{tmp_path}/s", 12, by=["id"])
    assert len(signed.parts()) > 8 and 1 <= len(signed.parts_for("needle")) <= 3 and signed.parts_for("quite another") == [] and signed.parts_for("nee") is None
    plan = signed.search("needle", ["t"])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "_part" in plan.split("PartitionFilters: [")[1].split("]")[0]
    assert len(signed.search("needle", ["t"]).select(F.input_file_name()).distinct().collect()) <= 3


def test_share_of_skipped_parts_on_documents(spark, small, tmp_path):
    docs = read_table(spark, small, "documents").select("doc_id", "text")
    signed = Signed.build(docs, ["text"], f"file://{tmp_path}/s", 64, by=["doc_id"])
    every, left = len(signed.parts()), len(signed.parts_for("token ="))
    print("parts", every, "left", left)
    assert left < every / 2


def test_empty_tables_and_reserved_names(spark, tmp_path):
    signed = Signed.build(rows(spark).limit(0), ["t"], f"file://{tmp_path}/s", 4)
    assert signed.search("needle", ["t"]).collect() == [] and signed.search("", ["t"]).collect() == []
    with pytest.raises(ValueError):
        Signed.build(spark.range(2).withColumn("_part", F.lit("a")), ["_part"], f"file://{tmp_path}/x", 2)


def test_a_task_gives_bitmaps_not_a_row_for_each_run():
    import numpy as np
    import pyarrow as pa

    rng = random.Random(5)
    texts = ["".join(chr(rng.randint(97, 122)) for _ in range(20_000)) for _ in range(12)]
    parts = [3] * 5 + [4] * 7
    batches = [pa.RecordBatch.from_arrays([pa.array(parts[k : k + 4], pa.int32()), pa.array([None if x == 2 else texts[x].encode() for x in range(k, k + 4)], pa.binary())], ["_part", "_0"]) for k in range(0, 12, 4)]
    made = [r for b in signatures._signed(1, signatures.BITS)(iter(batches)) for r in b.to_pylist()]
    assert len(made) == len({(r["_part"], r["bucket"]) for r in made}) == 2 * signatures.BITS // signatures.BITMAP
    for part in (3, 4):
        maps = {r["bucket"]: r["bits"] for r in made if r["_part"] == part}
        wanted = set()
        for k, t in enumerate(texts):
            if parts[k] == part and k != 2:
                raw = np.frombuffer(t.encode(), np.uint8)
                for _, full in signatures.runs.steps(raw[:3000]):
                    wanted |= set(signatures.grams(full[: 3000 - signatures.Q + 1]).tolist())
        assert all(maps[b // signatures.BITMAP][b % signatures.BITMAP // 8] >> b % 8 & 1 for b in wanted)
