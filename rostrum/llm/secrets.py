"""Secret scans: candidates by pattern, false positives removed by a random forest.  DataFrame
operations only: the patterns are SQL regular expressions, the forest is the one of Spark's own
machine-learning library, which scores on the JVM.

A candidate is a value assigned to a name with a credential word in it and at most 128 characters after that word, or
a run of 16 or more token characters with a digit, without the ``name=`` (up to eight of them) in front of it.  A quoted value ends at its quote; another
one loses the full stop, comma, colon or semicolon at its end.  The features are length, character classes
and their transitions, how likely its letters follow each other, variety, coverage by the words of a
dictionary, the words before and after it, and the path of its document.  Letter transitions and dictionary
are statistics over all words of the corpus (``statistics``).  The forest learns from labelled findings;
``labelled_findings`` makes a bounded set of them from the public formats of credentials and of what is
mistaken for them, for corpora that come without.

Defined cases: null and empty texts have no findings; equal values found twice in a text are two
findings; a repeated row has its findings again; a text's own control characters U+0001 and U+0002 are
read as blanks; extra columns are dropped by ``scan`` and kept by ``redact``, whatever their names; an empty table gives
an empty result, and a corpus without words an empty dictionary and even transitions; a null path counts as
the empty one; assigned values of fewer than 8 characters are no candidates.
"""

from __future__ import annotations

import datetime
import math
import random
from dataclasses import dataclass

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from .common import discard, materialize

# Names of credentials, words near what is none, words of placeholders, syllables of made-up words.
NAMES = ["token", "secret", "password", "passwd", "pwd", "api_key", "api-key", "apikey", "access_key", "access-key", "private_key", "auth", "bearer", "credential", "client_secret"]
BENIGN = ["example", "sha", "sha1", "sha256", "md5", "hash", "commit", "checksum", "digest", "uuid", "guid", "card", "phone", "tel", "version", "id", "isbn", "order", "invoice", "file", "path", "ip", "mail", "build"]
PLACEHOLDERS = ["example", "sample", "dummy", "placeholder", "changeme", "change", "your", "test", "fake", "here", "insert", "xxxx", "0000", "1234", "abcd", "mail", "com", "org", "net", "www", "http", "file", "path", "user", "name", "index", "main", "java", "src", "lib", "key", "token", "password", "secret", "version", "build", "date", "page", "item", "none", "null", "true", "false"]
SYLLABLES = ["th", "he", "in", "er", "an", "re", "on", "at", "en", "nd", "sch", "ung", "ment", "cion", "que", "eau", "heit", "com", "pro", "ver", "sta", "lin", "dor", "mak"]

_NAME = "(?i:" + "|".join(NAMES) + ")"
_FIRST = r"(?<![A-Za-z0-9+/=_.~-])"
# the rest of a name after its credential word: API_KEY_PROD, token_01, secret2.  Bounded, as a run may hold many such
# words, and each is tried
_REST = r"(?:[_.-][A-Za-z0-9_.-]{0,127}+|[0-9]{0,128}+)"
_HEAD = r"[A-Za-z0-9+/=_.~-]*?" + _NAME + _REST + r"""["']?[ \t]{0,3}[:=][ \t]{0,3}["']?(?=[^\s"'<>\x01\x02]{8})"""
_ASSIGNED = _HEAD + r"""[^\s"'<>\x01\x02]{8,}"""
_RUN = r"(?=[A-Za-z+/=_.~-]*+[0-9])[A-Za-z0-9+/=_.~-]{16,}+"
# other names in front of a run, eight at most; what is left is a run still
_LEADING = r"(?:[A-Za-z_][A-Za-z0-9_.-]*+=(?!=)(?=" + _RUN + ")){1,8}"
CANDIDATE = f"{_FIRST}({_ASSIGNED}|{_RUN})"
_VALUE = f"^({_HEAD}|{_LEADING})?(.*)$"
_QUOTED = r"""["'][^"']*$"""
BEFORE, AFTER = 48, 24

FEATURES = ["size", "digits", "upper", "lower", "symbols", "hex", "changes", "variety", "vowels", "placeholder", "dictionary", "transitions", "dots", "assigned", "named", "quoted", "benign", "words_after", "path_test"]

LETTERS = "abcdefghijklmnopqrstuvwxyz"
#: Words of the dictionary, the most frequent ones of at least four letters.
DICTIONARY = 1000
#: Parts of which one prefix sum is taken at once.
PARTS = 128


@dataclass
class Statistics:
    """What the corpus says of its words: the dictionary, and the base-2 logarithm of the chance of each letter after
    another.  Bounded: ``DICTIONARY`` words and 26 x 26 numbers."""

    words: list[str]
    steps: dict[str, float]


def statistics(docs: DataFrame, text: str = "text") -> Statistics:
    """Counted over all words of all texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower(F.col(text)), F.lit("[a-z]{2,24}"), F.lit(0))).alias("word")).groupBy("word").agg(F.count(F.lit(1)).alias("n"))
    words = materialize(words, "words")
    top = words.where(F.length("word") >= 4).orderBy(F.col("n").desc(), "word").limit(DICTIONARY).collect()
    pairs = F.transform(F.sequence(F.lit(1), F.length("word") - 1), lambda k: F.substring("word", k, F.lit(2)))
    seen = {r["pair"]: r["n"] for r in words.select(F.explode(pairs).alias("pair"), "n").groupBy("pair").agg(F.sum("n").alias("n")).collect()}
    discard(words)
    after = {a: sum(seen.get(a + b, 0) for b in LETTERS) for a in LETTERS}
    return Statistics([r["word"] for r in top], {a + b: math.log2((seen.get(a + b, 0) + 1) / (after[a] + 26)) for a in LETTERS for b in LETTERS})


@dataclass
class Scanner:
    forest: RandomForestClassificationModel
    known: Statistics


def candidates(docs: DataFrame, text: str = "text", path: str = "path") -> DataFrame:
    """A row per candidate: doc_id, text_hash, path, start (code points from 0), value, before, after."""
    clean = F.translate(F.col(text), "\x01\x02", "  ")
    marked = F.split(F.regexp_replace(clean, CANDIDATE, "\x01$1\x02"), "\x01")
    docs = docs.where(F.col(text).rlike("[0-9=:]")).select("doc_id", F.xxhash64(text).alias("text_hash"), F.coalesce(F.col(path), F.lit("")).alias("path") if path in docs.columns else F.lit("").alias("path"), marked.alias("parts")).where(F.size("parts") > 1)
    # each part after the first is: match, U+0002, the text up to the next match
    sizes = F.transform("parts", lambda p: F.length(p) - F.when(F.contains(p, F.lit("\x02")), 1).otherwise(0))
    docs = docs.withColumn("sizes", sizes)
    # prefix sums in two steps, so that a text of very many candidates does not copy a list for each of them
    total = lambda part: F.aggregate(part, F.lit(0), lambda acc, n: acc + n)
    lots = F.transform(F.sequence(F.lit(0), F.floor((F.size("sizes") - 1) / PARTS).cast("int")), lambda g: total(F.slice("sizes", g * PARTS + 1, PARTS)))
    docs = docs.withColumn("lots", F.aggregate(lots, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n))))
    start = lambda i: F.get("lots", F.floor(i / PARTS).cast("int")) + total(F.slice("sizes", F.floor(i / PARTS).cast("int") * PARTS + 1, F.pmod(i, F.lit(PARTS))))
    # the match before belongs to the context: in "token_1234567890": "..." it is the name
    tail = lambda p: F.substring(F.translate(F.substring(p, -BEFORE - 1, BEFORE + 1), "\x02", ""), -BEFORE, BEFORE)
    found = F.transform(
        F.sequence(F.lit(1), F.size("parts") - 1),
        lambda i: F.struct(
            start(i).alias("at"),
            F.substring_index(F.get("parts", i), "\x02", 1).alias("match"),
            tail(F.get("parts", i - 1)).alias("before"),
            F.substring(F.substring_index(F.get("parts", i), "\x02", -1), 1, AFTER).alias("after"),
        ),
    )
    rows = docs.select("doc_id", "text_hash", "path", F.explode(found).alias("c")).select("doc_id", "text_hash", "path", "c.*")
    rows = rows.withColumn("head", F.regexp_extract("match", _VALUE, 1)).withColumn("value", F.regexp_extract("match", _VALUE, 2))
    rows = rows.withColumn("value", F.when(F.col("head").rlike(_QUOTED), F.col("value")).otherwise(F.regexp_replace("value", "[.,;:]+$", ""))).where(F.length("value") >= 8)
    lead = F.length("head")
    return rows.select("doc_id", "text_hash", "path", (F.col("at") + lead).cast("long").alias("start"), "value", F.concat("before", "head").alias("before"), "after")


def _likely(low: Column, known: Statistics) -> Column:
    """Mean logarithm of the chance of each letter after the one before; 0 without neighbouring letters."""
    chances = F.map_from_arrays(F.split(F.lit(",".join(known.steps)), ","), F.split(F.lit(",".join(map(repr, known.steps.values()))), ",").cast("array<double>"))
    chars = F.split(low, "")
    steps = F.transform(F.sequence(F.lit(1), F.greatest(F.size(chars) - 1, F.lit(1))), lambda k: F.element_at(chances, F.concat(F.get(chars, k - 1), F.get(chars, k))))
    known_steps = F.array_compact(steps)
    return F.aggregate(known_steps, F.lit(0.0), lambda acc, x: acc + x) / F.greatest(F.size(known_steps), F.lit(1))


def featured(found: DataFrame, known: Statistics) -> DataFrame:
    """Columns named in ``FEATURES``, for rows with value, before, after and path."""
    v = F.col("value")
    n = F.greatest(F.length(v), F.lit(1))
    share = lambda pattern: (n - F.length(F.regexp_replace(v, pattern, ""))) / n
    classes = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace(v, "[a-z]", "a"), "[A-Z]", "A"), "[0-9]", "0"), "[^aA0]", ".")
    low = F.lower(v)
    near = F.lower("before")
    name = "(" + "|".join(NAMES) + ")"
    cols = {
        "size": F.least(F.length(v), F.lit(200)),
        "digits": share("[0-9]"),
        "upper": share("[A-Z]"),
        "lower": share("[a-z]"),
        "symbols": share("[^A-Za-z0-9]"),
        "hex": v.rlike("^[0-9a-fA-F]+$"),
        "changes": F.length(F.regexp_replace(classes, r"(.)\1*", "x")) / n,
        "variety": F.size(F.array_distinct(F.split(v, ""))) / F.least(n, F.lit(64)),
        "vowels": share("[aeiouAEIOU]"),
        "placeholder": (n - F.length(F.regexp_replace(low, "(" + "|".join(PLACEHOLDERS) + ")", ""))) / n,
        "dictionary": (n - F.length(F.regexp_replace(low, "(" + "|".join(sorted(known.words, key=lambda w: (-len(w), w))) + ")", ""))) / n if known.words else F.lit(0.0),
        "transitions": _likely(low, known),
        "dots": F.least(F.length(v) - F.length(F.translate(v, ".", "")), F.lit(5)),
        "assigned": near.rlike(r"""[:=]\s*["']?$"""),
        "named": near.rlike(name + r"""(?:[_.-][a-z0-9_.-]*)?[^a-z]{0,8}$"""),
        "quoted": near.rlike(r"""["'`]$"""),
        "benign": near.rlike(r"\b(" + "|".join(BENIGN) + r")\b[^a-z]{0,8}$"),
        "words_after": F.lower("after").rlike(r"^\W{0,3}[a-z]"),
        "path_test": F.lower("path").rlike("test|example|sample|fixture|doc"),
    }
    return found.select("*", *[F.coalesce(c.cast("double"), F.lit(0.0)).alias(k) for k, c in cols.items()])


def labelled_findings(n: int = 3000, seed: int = 5, words: list[str] | None = None) -> list[tuple[str, str, str, str, int]]:
    """(value, before, after, path, label) by the public formats; ``n`` rows, the same every time.  Plain words are those of
    ``words``, if any, or made up."""
    rng = random.Random(seed)
    low, up, num = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
    of = lambda chars, k: "".join(rng.choice(chars) for _ in range(k))
    made_up = lambda: "".join(rng.choice(SYLLABLES) for _ in range(rng.randint(1, 4)))
    word = lambda: rng.choice(words) if words and rng.random() < 0.7 else made_up()
    prose = lambda: " ".join(word() for _ in range(rng.randint(2, 6))) + " "
    day = lambda shape: datetime.datetime.fromtimestamp(rng.randrange(10**8, 2 * 10**9), datetime.UTC).strftime(shape)
    paths = ["", "", "app/config.py", "deploy/.env", "lib/main.go", "settings.yaml"]
    values = [
        lambda: of("0123456789abcdef", rng.choice([32, 40, 40, 64])),
        lambda: of("0123456789ABCDEF", rng.choice([32, 40])),
        lambda: of(low + up + num, rng.randint(20, 44)),
        lambda: of(low + up + num + "+/", rng.choice([40, 64, 88])) + rng.choice(["", "=", "=="]),
        lambda: "AKIA" + of(up + num, 16),
        lambda: rng.choice(["ghp_", "gho_", "glpat-", "npm_"]) + of(low + up + num, 36),
        lambda: rng.choice(["sk_live_", "rk_live_", "sk-"]) + of(low + up + num, rng.choice([24, 32, 48])),
        lambda: "xoxb-" + of(num, 12) + "-" + of(low + up + num, 24),
        lambda: "AIza" + of(low + up + num + "-_", 35),
        lambda: "eyJ" + of(low + up + num, 30) + "." + "eyJ" + of(low + up + num, 40) + "." + of(low + up + num + "-_", 43),
    ]
    strong = values[4:]
    naming = lambda: rng.choice([str.lower, str.upper, str.title])(rng.choice(NAMES)) + rng.choice([" = \"", "=\"", ": \"", "=", ": ", " = '", " := \""])
    password = lambda: word() + of(num + "!@#$%", rng.randint(3, 6)) + of(low + up + num, rng.randint(3, 8))
    not_secret = [
        lambda: (of(num, rng.choice([16, 16, 18, 20])), prose()),
        lambda: (of(num, 16), rng.choice(["card ", "order ", "id: ", "invoice "])),
        lambda: (".".join(word() for _ in range(rng.randint(1, 2))) + of(num, rng.randint(1, 2)) + "." + word() + "." + rng.choice(["com", "org", "net", "io", "de"]), prose()),
        lambda: (word() + "-" + of(num, 2) + "." + word() + "." + rng.choice(["com", "org", "net", "info"]), rng.choice(["http://", "host ", "server: ", prose()])),
        lambda: (".".join(str(rng.randint(100, 255)) for _ in range(4)) + rng.choice(["", "-24"]), prose()),
        lambda: (of("0123456789abcdef", 40), rng.choice(["commit ", "sha1: ", "commit: ", "checksum ", "digest="])),
        lambda: (of("0123456789abcdef", rng.choice([32, 64])), rng.choice(["md5 ", "sha256:", "hash = ", "etag "])),
        lambda: ("-".join(of("0123456789abcdef", k) for k in (8, 4, 4, 4, 12)), rng.choice(["uuid ", "guid=", "id: ", prose()])),
        lambda: ("/".join([rng.choice(["src", "lib", "usr", "main", "test", "docs"]), word(), word() + of(num, 1) + rng.choice([".py", ".java", ".html", ".txt"])]).ljust(16, "0"), prose()),
        lambda: (rng.choice(["YOUR_API_KEY_HERE", "your-token-here-1234", "changeme12345678", "xxxxxxxxxxxxxxxx", "example-password-1", "insert_secret_here", "dummy_token_0000", "00000000000000000000", "1234567890abcdef", "placeholder12345"]), naming()),
        lambda: (rng.choice(["${API_KEY}", "os.environ.get", "{{token}}", "process.env.TOKEN", "<your-token>", "getenv(TOKEN)", "self.token.value", "config.password"]), naming()),
        lambda: (word() + "_" + word() + "_" + word() + str(rng.randint(1, 99)).zfill(3), prose()),
        lambda: (day("%Y-%m-%dT%H.%M.%S") + rng.choice(["", "Z", ".000", "." + of(num, 3)]), prose()),
        lambda: (day(rng.choice(["%Y%m%dT%H%M%SZ", "%Y%m%d-%H%M%S-log", "IMG_%Y%m%d_%H%M%S.JPG", "%d-%b-%Y-%H%M"])), prose()),
        lambda: ("".join(word().title() for _ in range(rng.randint(3, 5))) + of(num, rng.randint(1, 2)) + rng.choice(["", "Test", "Handler", ".java"]), prose()),
        lambda: ("_".join(word().upper() for _ in range(rng.randint(3, 4))) + "_" + of(num, rng.randint(1, 2)), prose()),
        lambda: (word() + word() + word(), rng.choice(["the token: ", "auth: ", "secret: ", "password: "])),
        lambda: ("".join(word() for _ in range(3)) + of(num, 2), prose()),
        lambda: ("v" + of(num, 1) + "." + of(num, 2) + "." + of(num, 3) + "-beta." + of(num, 2) + "-build", rng.choice(["version ", "build "])),
        lambda: ("---------------" + of(num, 3), prose()),
    ]
    rows = []
    for i in range(n):
        before, after = prose(), rng.choice(["\" ", "", "\"\n", "' ", "\"!! ", " "]) + rng.choice([prose(), "", prose()])
        if i % 2:
            kind = rng.random()
            if kind < 0.2:
                rows.append((rng.choice(strong)(), before, after, rng.choice(paths), 1))
            elif kind < 0.35:
                rows.append((password(), before + naming(), after, rng.choice(paths), 1))
            else:
                rows.append((rng.choice(values)(), before + naming(), after, rng.choice(paths), 1))
        else:
            value, near = rng.choice(not_secret)()
            rows.append((value, before + near, after, rng.choice([*paths, "tests/example.md", "docs/sample.txt"]), 0))
    return rows


def train(spark: SparkSession, known: Statistics, findings: DataFrame | None = None, trees: int = 40, depth: int = 8, seed: int = 3) -> Scanner:
    """Fit on labelled findings (value, before, after, path, label); the built-in set, of 3000, if none."""
    if findings is None:
        findings = spark.createDataFrame(labelled_findings(words=known.words), "value string, before string, after string, path string, label int").coalesce(1)
    rows = assembled(featured(findings.withColumn("label", F.col("label").cast("double")), known))
    return Scanner(RandomForestClassifier(featuresCol="features", labelCol="label", numTrees=trees, maxDepth=depth, seed=seed, featureSubsetStrategy="sqrt").fit(rows), known)


def assembled(rows: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(rows)


def scan(docs: DataFrame, scanner: Scanner, text: str = "text", path: str = "path", threshold: float = 0.5) -> DataFrame:
    """A row per confirmed finding: doc_id, text_hash, start, length, value, score."""
    scored = scanner.forest.transform(assembled(featured(candidates(docs, text, path), scanner.known))).withColumn("score", vector_to_array("probability")[1])
    return scored.where(F.col("score") >= threshold).select("doc_id", "text_hash", "start", F.length("value").cast("long").alias("length"), "value", "score")


def redact(docs: DataFrame, findings: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with every confirmed finding replaced where it stands; all else stays as it is."""
    found = findings.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.struct("start", "length"))).alias("spans")).alias("found")
    met = docs.alias("row").join(found, F.col("row.doc_id").eqNullSafe(F.col("found.doc_id")) & (F.xxhash64("row.text") == F.col("found.text_hash")), "left")
    text, spans = F.col("row.text"), F.col("found.spans")
    ends = lambda i: F.coalesce(F.get(spans, i - 1)["start"] + F.get(spans, i - 1)["length"], F.lit(0)).cast("int")
    begins = lambda i: F.coalesce(F.get(spans, i)["start"], F.length(text)).cast("int")
    kept = F.transform(F.sequence(F.lit(0), F.size(spans)), lambda i: F.substring(text, ends(i) + 1, begins(i) - ends(i)))
    clean = F.when(spans.isNotNull(), F.array_join(kept, mark)).otherwise(text)
    return met.select(*[clean.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])
