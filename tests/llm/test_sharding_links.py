import random

import pytest
from pyspark.sql import functions as F

from rostrum.llm import sharding

from . import corpus

RNG = random.Random(7)
BODY = " ".join(corpus.words(RNG, 300))


def links(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    return {r["doc_id"]: set(r["links"]) for r in df.select("doc_id", sharding.links(F.col("text")).alias("links")).collect()}


def test_links_come_from_the_whole_text(spark):
    new = lambda k: " ".join(corpus.words(RNG, k))
    passage = " ".join(f"p{i}" for i in range(8 * sharding.EVERY))
    got = links(spark, [
        f"{new(50)} {BODY} {new(50)}", f"{new(50)} {BODY} {new(50)}",  # other headers and footers
        f"{new(200)} {passage} {new(200)}", f"{new(90)} {passage} {new(300)}",  # a passage with some anchors
        "five words of a short text", "Five  words of a short text here",  # short texts
        "two words", "Two words", "", None,
    ])
    assert got[0] & got[1] and got[2] & got[3] and got[4] & got[5] and got[6] == got[7]
    assert not got[0] & got[2] and not got[8] and not got[9]


@pytest.mark.parametrize("words,edge", [(20, 3), (200, 40)])
def test_near_copies_with_other_edges_stay_together(spark, words, edge):
    rng = random.Random(words)
    pairs = []
    for g in range(150):
        body = " ".join(corpus.words(rng, words))
        pairs += [(g * 10 + k, " ".join(corpus.words(rng, edge)) + f" {body} " + " ".join(corpus.words(rng, edge))) for k in range(3)]
    got = {r["doc_id"]: r["shard"] for r in sharding.shards(corpus.frame(spark, pairs), n_shards=4).collect()}
    assert sum(len({got[g * 10 + k] for k in range(3)}) == 1 for g in range(150)) > 90  # by chance 1/16 of 150
