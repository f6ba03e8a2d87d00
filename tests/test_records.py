"""Operators over debates, members, topics and state: the rules and quirks of missing values, ties and order."""

import json
import random

import pytest
from pyspark.sql import functions as F

from rostrum.functions import dates, labels, parse, text
from rostrum.operators import filters, members, speakers, state, topics
from rostrum.sources import documents, schemas, sinks

ITEMS = "debate_id string, pos int, ItemType string, AttributedTo string, MemberId long, MemberParty string, Value string"


def model(items):
    """Speakers by plain Python."""
    out = {}
    for debate, _, kind, who, member, party, _ in sorted(items, key=lambda r: (r[0], r[1])):
        if kind == "Contribution" and who:
            key = (debate, member or None, None if member else who)
            out.setdefault(key, [debate, member, who, party, 0])[4] += 1
    return out


def test_speakers_against_a_model(spark):
    rng = random.Random(4)
    items = [(rng.choice("AB"), i, rng.choice(["Contribution", "Contribution", "Procedural"]), rng.choice(["x", "y", "", None, "5"]), rng.choice([None, 0, 5, 6]), rng.choice([None, "P", "Q"]), "v") for i in range(200)]
    got = speakers.speakers(spark.createDataFrame(items, ITEMS)).collect()
    want = model(items)
    assert sorted((r["debate_id"], str(r["member_id"]), r["name"], str(r["party"]), r["contributions"]) for r in got) == sorted((d, str(m), w, str(p), n) for d, m, w, p, n in want.values())
    for debate in "AB":
        order = [r for r in sorted(got, key=lambda r: r["rank"]) if r["debate_id"] == debate]
        assert [r["rank"] for r in order] == list(range(1, len(order) + 1))
        assert [(-r["contributions"], r["first_pos"]) for r in order] == sorted((-r["contributions"], r["first_pos"]) for r in order)


def test_first_seen_party_may_be_missing(spark):
    items = [("A", 0, "Contribution", "n", 5, None, ""), ("A", 1, "Contribution", "other", 5, "P", "")]
    assert [(r["name"], r["party"], r["contributions"]) for r in speakers.speakers(spark.createDataFrame(items, ITEMS)).collect()] == [("n", None, 2)]


def test_nested_documents(spark, tmp_path):
    debate = {"Overview": {"Id": "d1", "Title": "T", "Date": "2024-01-15", "House": "Commons"}, "Items": [
        {"Id": "1", "ItemType": "Contribution", "Value": "<p>Hello</p>", "AttributedTo": "Ann", "MemberId": 1, "MemberParty": "P"}, {"Id": "2", "ItemType": "Procedural", "Value": "Noted"}, {"Id": "3", "ItemType": "Time"}]}
    (tmp_path / "debate.json").write_text(json.dumps(debate, indent=1))
    items = documents.debate_items(documents.read_json(spark, str(tmp_path / "debate.json"), schemas.DEBATE))
    assert [(r["pos"], r["ItemType"], r["AttributedTo"]) for r in items.orderBy("pos").collect()] == [(0, "Contribution", "Ann"), (1, "Procedural", None), (2, "Time", None)]
    kinds = items.select(filters.item_kind(F.col("ItemType"), F.col("Value")).alias("k")).collect()
    assert [r["k"] for r in kinds] == ["contribution", "procedural", None]
    assert speakers.speakers(items).first()["name"] == "Ann"
    (tmp_path / "none.json").write_text('{"TotalResults": 0}')
    assert documents.results(documents.read_json(spark, str(tmp_path / "none.json"), schemas.HITS)).count() == 0
    (tmp_path / "m.json").write_text(json.dumps({"items": [{"value": {"id": 172, "nameDisplayAs": "Ms A", "latestParty": {"name": "Labour"}}}]}))
    found = documents.members(documents.read_json(spark, str(tmp_path / "m.json"), schemas.MEMBERS))
    assert found.select("id", "latestParty.name").first() == (172, "Labour")
    mixed = spark.createDataFrame([((1, "in"), None, None), (None, 2, "out")], "value struct<id: long, name: string>, id long, name string")
    assert sorted(map(tuple, documents.unwrapped(mixed).collect())) == [(1, "in"), (2, "out")]


def test_search_predicates(spark):
    rows = spark.createDataFrame([(1, "Net ZERO", 7, "2024-01-01T00:00:00", "Commons"), (2, None, 7, "2024-01-31T12:00:00", "Lords"), (3, "zero", 8, "2024-02-01T00:00:00", "Commons")], "id long, t string, m long, d string, house string").withColumn("d", F.col("d").cast("timestamp_ntz"))
    ids = lambda df: [r["id"] for r in df.collect()]
    assert ids(filters.search(rows, "zero", ["t"], "id")) == [1, 3]
    assert ids(filters.search(rows, "", ["t"], "id", date="d", end="2024-01-31")) == [1, 2]
    assert ids(filters.search(rows, "", ["t"], "id", date="d", start="2024-01-31")) == [2, 3]
    assert ids(filters.search(rows, "", ["t"], "id", member="m", member_id=7, house="Lords")) == [2]
    assert ids(filters.search(rows, "", ["t"], "id", take=0, skip=1)) == [2, 3]
    assert ids(filters.recent(rows, "d", "id", None)) == [3, 2, 1]
    with pytest.raises(sinks.NotFound):
        filters.lookup(rows, "id", 99)
    assert filters.nothing(rows).schema == rows.schema and filters.nothing(rows).count() == 0


def test_sections(spark):
    rows = spark.createDataFrame([("Oral Questions",), (None,), ("Debate",)], "k string")
    keep = lambda s: [r["k"] for r in rows.where(filters.in_section(F.col("k"), s)).collect()]
    assert keep("QUEST") == ["Oral Questions"] and len(keep("  ")) == 3
    day = spark.createDataFrame([([("1", "Debate"), ("2", None)],)], "Sections array<struct<Id: string, Type: string>>")
    assert day.select(F.size(filters.sections_in(F.col("Sections"), "deb"))).first()[0] == 1


def test_days(spark):
    rows = spark.createDataFrame([(1, "2024-01-15T00:00:00"), (2, ""), (3, "2024-01-16"), (4, None), (5, "2024-01-15")], "id int, d string")
    assert [r["day"] for r in speakers.days(rows, "d").collect()] == ["Unknown", "2024-01-16", "2024-01-15"]
    assert {(r["day"], r["place"], r["id"]) for r in speakers.by_day(rows, "d", "id").collect()} == {("2024-01-15", 1, 1), ("2024-01-15", 2, 5), ("2024-01-16", 1, 3), ("Unknown", 1, 2), ("Unknown", 2, 4)}
    assert speakers.holds(rows, "id", 3) and not speakers.holds(rows, "id", 9)


def test_topic_ranking_rules(spark):
    corpus = spark.createDataFrame([(i, t, m, n, p) for i, (t, m, n, p) in enumerate([("Net zero and NHS", 5, "Ann", None), ("the nhs", 5, "Ann B", "P"), ("net ZERO", 6, None, "Q"), ("nhs", 0, "none", "R"), ("nhs", None, "none", "R"), ("other", 5, "x", "y")])], "id long, t string, m long, n string, p string")
    hits = topics.keyword_hits(corpus, ["net zero", "NHS"], "t", "id")
    got = [(r["member_id"], r["name"], r["party"], r["mentions"], r["rank"]) for r in topics.ranking(hits, "m", "n", "p").orderBy("rank").collect()]
    assert got == [(5, "Ann", None, 3, 1), (6, "Unknown", "Q", 1, 2)]
    once = topics.ranking(hits, "m", "n", "p", distinct_on="id").collect()
    assert {r["member_id"]: r["mentions"] for r in once} == {5: 2, 6: 1}
    many = spark.range(200).select("id", F.lit("nhs").alias("t"), (F.col("id") % 2 + 1).alias("m"), F.lit("a").alias("n"), F.lit("b").alias("p"))
    assert topics.ranking(topics.keyword_hits(many, ["nhs"], "t", "id"), "m", "n", "p").agg(F.sum("mentions")).first()[0] == 50
    assert topics.keyword_hits(corpus, [], "t", "id").count() == 0
    assert topics.seed_topics(spark).count() == 3


def test_export(spark, tmp_path):
    rows = spark.createDataFrame([(1, 'A "B"', None, None, 3, 1)], "member_id long, name string, party string, constituency string, mentions long, rank long")
    assert [r["line"] for r in sinks.export_lines(rows).orderBy("line_no").collect()] == ['"Name","Party","Constituency","Mention Count"', '"A ""B""","","","3"']
    assert sinks.export_csv(rows, str(tmp_path / "out")) and not sinks.export_csv(rows.limit(0), str(tmp_path / "none"))
    assert not (tmp_path / "none").exists()
    written = "".join(f.read_text() for f in (tmp_path / "out").glob("part*"))
    assert written == '"Name","Party","Constituency","Mention Count"\n"A ""B""","","","3"\n'
    assert sinks.export_name("Rail") == "Rail-analysis.csv" and sinks.export_name("") == "topic-analysis.csv"
    assert json.loads(sinks.bodies(rows.select("name")).first()["body"]) == {"name": 'A "B"'}


WATCH = "id long, name string, pos int"


def test_watchlist(spark):
    empty = spark.createDataFrame([], WATCH)
    one = state.add_absent(empty, spark.createDataFrame([(1, "a", 0)], WATCH))
    two = state.add_absent(one, spark.createDataFrame([(1, "again", 0), (2, "b", 1), (2, "later", 2)], WATCH))
    assert [(r["id"], r["name"]) for r in two.orderBy("pos").collect()] == [(1, "a"), (2, "b")]
    assert [r["id"] for r in state.remove(two, [1, 50]).collect()] == [2]
    assert state.remove(two, []).count() == 2
    flags = members.with_watch_flag(spark.createDataFrame([(1,), (3,)], "id long"), two, "id")
    assert {r["id"]: r["watched"] for r in flags.collect()} == {1: True, 3: False}


def test_topics_state(spark):
    t = spark.createDataFrame([("1", "a", ["x"], 0), ("2", "b", ["y"], 1)], "id string, name string, keywords array<string>, pos int")
    new = state.topic(spark, "c", ["k", " ", " z "], "9")
    assert [tuple(r) for r in state.append(t, new).orderBy("pos").select("id", "keywords", "pos").collect()][-1] == ("9", ["k", " z "], 2)
    changed = state.update(t, spark.createDataFrame([("2", "B", None), ("7", "n", ["q"])], "id string, name string, keywords array<string>"))
    assert [tuple(r) for r in changed.orderBy("pos").select("id", "name", "keywords").collect()] == [("1", "a", ["x"]), ("2", "B", ["y"])]
    assert state.topic(spark, "c", ["k"]).first()["id"].isdigit()
    assert state.may_save(" n ", ["", "k"]) and not state.may_save(" ", ["k"]) and not state.may_save("n", [" "])


def test_snapshots_replace_each_other(spark, tmp_path):
    shelf = sinks.Snapshots(spark, str(tmp_path / "watch"), WATCH)
    assert shelf.read().count() == 0
    shelf.write(spark.createDataFrame([(1, "a", 0)], WATCH))
    shelf.write(state.add_absent(shelf.read().withColumn("pos", F.lit(0)), spark.createDataFrame([(2, None, 0)], WATCH)))
    shelf.write(shelf.read().withColumn("pos", F.lit(0)).where("id = 2"))
    assert [(r["id"], r["name"]) for r in shelf.read().collect()] == [(2, None)]
    current = tmp_path / "watch" / shelf._data(shelf.version())
    for f in current.glob("part*"):
        f.write_text("{not json\n")
        (current / f".{f.name}.crc").unlink(missing_ok=True)
    assert shelf.read().count() == 0
    seeds = topics.seed_topics(spark)
    assert sinks.Snapshots(spark, str(tmp_path / "none"), schemas.TOPIC).read(seeds).count() == 3


def test_member_detail(spark):
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id long, name string")
    contact, synopsis = spark.createDataFrame([(1, "c")], "id long, contact string"), spark.createDataFrame([], "id long, synopsis string")
    assert [tuple(r) for r in members.detail_of(people, contact, synopsis, 2).collect()] == [(2, "b", None, None)]
    assert members.synopsis_of(people, synopsis).count() == 2
    with pytest.raises(sinks.NotFound):
        members.detail_of(people, contact, synopsis, 3)


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"c {kind}").select(column(F.col("c"))).first()[0]


@pytest.mark.parametrize("value,term,want", [
    ("a motion without a term", None, "a motion without a term"),
    ("", "motion", None),
    (None, "motion", None),
    ("The Motion was carried", "motion", 'The <mark class="highlight-match">Motion</mark> was carried'),
    ("<style>b{}</style><blockquote onmouseover='x()'>quoted</blockquote>", None, "<blockquote>quoted</blockquote>"),
    ("<p>an <em>amended</em> clause</p>", "clause", '<p>an <em>amended</em> <mark class="highlight-match">clause</mark></p>'),
    ("pays 5.50+VAT a head", "5.50+vat", 'pays <mark class="highlight-match">5.50+VAT</mark> a head'),
    ("École", "éCOLE", '<mark class="highlight-match">École</mark>'),
])
def test_shown_text(spark, value, term, want):
    assert one(spark, lambda c: text.shown(c, term), value) == want


def test_days_of_many_rows_are_numbered_in_ranges(spark):
    rows = spark.createDataFrame([(i * 7 % 500, "2024-01-01" if i % 3 else "2024-01-02") for i in range(500)], "k long, d string")
    got = [(r["day"], r["k"], r["place"]) for r in speakers.by_day(rows, "d", "k").collect()]
    by = {}
    for day, k, place in sorted(got):
        by.setdefault(day, []).append(place)
    assert len(got) == 500 and all(p == list(range(1, len(p) + 1)) for p in by.values())


def test_the_later_change_counts(spark):
    rows = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], "id long, name string, note string")
    changes = spark.createDataFrame([(1, "c", None), (1, "d", None), (1, None, "z"), (9, "q", "q")], "id long, name string, note string").coalesce(1)
    assert sorted(tuple(r) for r in state.update(rows, changes).collect()) == [(1, "d", "z"), (2, "b", "y")]


def test_text_functions(spark):
    assert one(spark, lambda c: text.match_count(c, "cat"), "The cat sat on the mat with another CAT") == 2
    pieces = one(spark, lambda c: text.parts(c, "cat"), "a Cat b")
    assert [(p["part"], p["is_match"]) for p in pieces] == [("a ", False), ("Cat", True), (" b", False)]
    assert one(spark, text.js_trim, " \t\n x y " + chr(0xA0)) == "x y"
    assert one(spark, text.capitalised, "cOMMONS house") == "Commons house"
    assert one(spark, text.stripped, "<p>a<br>b</p><style>x{}</style>") == "ab"
    assert text.sanitise('<a href="javascript:alert(1)" target="_b">x</a><a href="/ok?a=1&b=2">y</a>') == '<a target="_b">x</a><a href="/ok?a=1&amp;b=2">y</a>'
    assert text.sanitise("<div><b>open <unknown>kept</unknown> 1 < 2") == "<div><b>open kept 1 &lt; 2</b></div>"
    assert text.sanitise(None) == "" and text.sanitise('<p data-x="1" class="k">a</p>') == '<p class="k">a</p>'


def test_dates_labels_and_links(spark):
    assert one(spark, dates.long_date, "2024-01-15T00:00:00") == "Monday 15 January 2024"
    assert one(spark, dates.short_date, None) == "Unknown date"
    assert one(spark, dates.long_date, "Unknown") == "Unknown Date"
    assert one(spark, dates.short_date, "2024-02-30") == "Invalid Date"
    assert one(spark, dates.month_year, "2019-12-12") == "December 2019"
    assert one(spark, labels.coloured, "Scottish National Party") == "#FDF38E"
    assert one(spark, labels.coloured, "Green Labour") == "#E4003B"
    assert one(spark, labels.coloured, None) == "#808080"
    assert one(spark, labels.house_style, None) == "red"
    assert one(spark, labels.photo_url, 0, "long") is None
    assert one(spark, labels.uri_component, "Ann (O'B) ~!*é") == "Ann%20(O'B)%20~!*%C3%A9"
    assert one(spark, labels.seat_prefix, 2, "int") == ""
    shown, more = labels.shown_keywords(F.col("k"))
    assert tuple(spark.createDataFrame([(list("abcdef"),)], "k array<string>").select(shown, more).first()) == (list("abcd"), "+2 more")


@pytest.mark.parametrize("value,want", [("12abc", 12), (" -3", -3), ("x", None), (None, None), ("99999999999999999999", None)])
def test_leading_int(spark, value, want):
    assert one(spark, parse.leading_int, value) == want


def test_two_writers_from_one_version_are_both_kept(spark, tmp_path):
    shelf, other = (sinks.Snapshots(spark, str(tmp_path / "w"), WATCH) for _ in range(2))
    shelf.write(spark.createDataFrame([(1, "a", 0)], WATCH))
    base = shelf.version()
    mine, theirs = shelf.read(), other.read()
    assert other.commit(theirs.withColumn("pos", F.lit(0)).unionByName(spark.createDataFrame([(2, "b", 1)], WATCH)), base) == base + 1
    with pytest.raises(sinks.Conflict):
        shelf.commit(mine.withColumn("pos", F.lit(0)).unionByName(spark.createDataFrame([(3, "c", 2)], WATCH)), base)
    assert {r["id"] for r in shelf.read().collect()} == {1, 2}
    shelf.update(lambda rows: rows.withColumn("pos", F.col("id").cast("int")).unionByName(spark.createDataFrame([(3, "c", 3)], WATCH)))
    assert [r["id"] for r in other.read().collect()] == [1, 2, 3]
    names = {p.name.split("-")[0] for p in (tmp_path / "w").iterdir() if not p.name.startswith(".")}
    assert names == {"commit", "data"} and len(list((tmp_path / "w").glob("data-*"))) == 2


def test_many_writers_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    root = str(tmp_path / "w")
    sinks.Snapshots(spark, root, WATCH).write(spark.createDataFrame([(0, "a", 0)], WATCH))

    def add(k):
        return sinks.Snapshots(spark, root, WATCH).update(lambda rows: rows.withColumn("pos", F.col("id").cast("int")).unionByName(spark.createDataFrame([(k, "x", k)], WATCH)))

    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(add, range(1, 5)))
    assert sorted(versions) == [2, 3, 4, 5]
    assert [r["id"] for r in sinks.Snapshots(spark, root, WATCH).read().collect()] == [0, 1, 2, 3, 4]
