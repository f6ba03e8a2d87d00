"""Small corpora with the awkward cases in them."""

import random

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, shard int, node long, tokens long, id long, fingerprint string"


def words(rng, n):
    return [rng.choice(["alpha", "beta", "gamma", "delta", "epsilon", "zeta", "eta", "theta", "iota", "kappa"]) + str(rng.randint(0, 60)) for _ in range(n)]


def rows(n=60, seed=1):
    """(doc_id, text): prose, exact and near copies, shared passages, repeated words, nulls, empties, one long text."""
    rng = random.Random(seed)
    passage = words(rng, 60)
    base = words(rng, 120)
    out = []
    for i in range(n):
        kind = i % 10
        if kind == 0:
            text = " ".join(base)
        elif kind == 1:
            near = list(base)
            near[rng.randrange(len(near))] = f"edit{i}"
            text = "\t".join(near[:60]) + "\n" + " ".join(near[60:])
        elif kind == 2:
            text = " ".join(words(rng, 30) + passage + words(rng, 20))
        elif kind == 3:
            text = " ".join(["again"] * rng.randint(5, 40) + words(rng, 5) + ["again"] * rng.randint(5, 40))
        elif kind == 4:
            text = " ".join(words(rng, rng.randint(1, 14)))
        else:
            text = " ".join(words(rng, rng.randint(20, 200)))
        out.append((1000 + i, text))
    out += [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "é"), (6, " ".join(words(rng, 20_000))), (7, "x" * 5000), (8, None)]
    out += [(1000, out[0][1])]  # a repeated row
    out += [(None, "a row without an id but with some words in it to be counted here all the same")]
    return out


def frame(spark, pairs):
    full = [(i, t, "en", f"s{(i or 0) % 3}" if i != 4 else None, len(t or ""), 0.5, 3, 9, 1, 7, "clash") for i, t in pairs]
    return spark.createDataFrame(full, SCHEMA)
