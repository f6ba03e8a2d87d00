import random
import struct
import zlib
from collections import defaultdict

import pytest

from rostrum.llm import packing

from . import corpus

P = pytest.importorskip("public_tokenizers")


def path():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def check(pairs, rows, window=packing.WINDOW):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(path())
    want = defaultdict(list)
    for i, text in pairs:
        ids = t.encode(text or "", add_special_tokens=False).ids + [1]
        want[i].append(struct.pack(f"<{len(ids)}I", *ids))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"], r["doc_tokens"]].append((r["start"], r["length"], r["ids_crc32"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for i, texts in want.items():
        for ids in set(texts):
            n = len(ids) // 4
            times = texts.count(ids)
            got = sorted(pieces[i, n])
            if times == 1 and len({len(x) for x in texts}) == len(texts):
                at = 0
                for start, length, crc in got:
                    assert start == at and crc == zlib.crc32(ids[4 * at : 4 * (at + length)])
                    at += length
                assert at == n
            else:
                assert sum(x[1] for x in got) == n * sum(len(x) // 4 == n for x in texts)
    padding = total = 0
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    return padding / max(1, total)


def test_round_trip(spark):
    pairs = corpus.rows(150)
    pairs += [(50, "ends <|endoftext|> inside"), (51, "it's they'll İstanbul ΟΔΟΣ é ñ Å 12 ½ ²x y z $$$ a_b"), (52, "WORD!! Word, word.")]
    assert check(pairs, packing.pack(corpus.frame(spark, pairs), path).collect()) < 0.02


def test_tables_pad_little(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet").repartition(4)
    pairs = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert check(pairs, packing.pack(docs, path).collect()) < 0.02


def test_ids_can_stay_and_nothing_gives_nothing(spark):
    rows = packing.pack(corpus.frame(spark, corpus.rows(30)), path, with_ids=True).collect()
    assert all(zlib.crc32(bytes(r["ids"])) == r["ids_crc32"] and len(r["ids"]) == 4 * r["length"] for r in rows)
    assert packing.pack(corpus.frame(spark, []), path).count() == 0


def test_best_fit_keeps_a_bounded_number_of_windows():
    rng = random.Random(2)
    packer, closed = packing.Packer(0, 64, 5, 4), []
    for i in range(500):
        closed += list(packer.add(i, bytes(4 * rng.randint(1, 150))))
        assert len(packer.spaces) <= 5
    full = [sum(len(p[2]) for p in pieces) // 4 for _, pieces in closed]
    assert max(full) == 64 and min(full) >= 60


@pytest.mark.parametrize("n", [0, 1, 5, 63, 64, 65, 200])
def test_leftovers_end_in_powers_of_two(n):
    pieces = [(k, 0, bytes(4), 1) for k in range(n)]
    sizes = [sum(len(p[2]) // 4 for p in s) for _, s in packing.merged(iter(pieces), 0, 64)]
    assert sum(sizes) == n and all(s & (s - 1) == 0 for s in sizes)
