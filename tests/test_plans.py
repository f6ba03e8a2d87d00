"""Parameters, endpoints, the result cache, plans and the registry."""

import pytest
from pyspark.sql import functions as F

from rostrum.plans import cache, endpoints, more_queries, queries, table_queries, validate as v  # noqa: F401
from rostrum.sources.documents import read_table


@pytest.mark.parametrize("value,want", [(None, 20), ("", 20), ("12abc", 12), (" 7", 7), ("100", 100)])
def test_integers(value, want):
    assert v.integer(value, least=1, most=100, default=20) == want


@pytest.mark.parametrize("f", [
    lambda: v.integer("abc"), lambda: v.integer("101", most=100), lambda: v.integer("-1"), lambda: v.integer(None, required=True),
    lambda: v.text("x" * 201, longest=200), lambda: v.text("", required=True), lambda: v.text(5), lambda: v.text("ab", pattern="^c"),
    lambda: v.date("15-01-2024"), lambda: v.date("2024-02-30"), lambda: v.date(None, required=True), lambda: v.house("commonsx"), lambda: v.house(" commons"), lambda: v.member_id("0"), lambda: v.member_id("100000"),
])
def test_invalid(f):
    with pytest.raises(v.Invalid) as e:
        f()
    assert e.value.status == 400 and e.value.body() == {"error": str(e.value)}


def test_valid():
    assert v.house(None) == "Commons" and v.house("lORDS") == "Lords" and v.house("", "Lords") == "Lords"
    assert v.text("  ") == "" and v.text(None) is None and v.text(" a ") == "a"
    assert v.date("2024-01-15") == "2024-01-15" and v.date("") is None
    assert v.flag(None) and v.flag("0") and not v.flag("false")


def rows(spark):
    data = [(i, f"bill {'abc'[i % 3]}", i % 2 == 0, "Commons" if i % 3 else "Lords", f"2024-01-{i + 1:02d}") for i in range(25)]
    return spark.createDataFrame(data, "id long, t string, sits boolean, house string, d string").withColumn("d", F.col("d").cast("date"))


def test_endpoints(spark):
    r = rows(spark)
    ids = lambda df: [x["id"] for x in df.collect()]
    search = lambda p: ids(endpoints.search(r, p, text=["t"], key="id", date="d", member="id"))
    assert search({"query": "BILL A", "house": "lords", "take": "2", "skip": "1"}) == [3, 6]
    assert search({"q": "bill"})[:3] == [1, 2, 4]
    with pytest.raises(v.Invalid):
        search({"q": "   "})
    with pytest.raises(v.Invalid):
        search({})
    assert ids(endpoints.day(r.withColumn("k", F.col("t")), {"date": "2024-01-03", "section": "LL"}, date="d", house="house", kind="k")) == [2]
    people = lambda p: ids(endpoints.people(r, p, name="t", key="id", house="house", current="sits"))
    assert people({"name": "bill a", "take": "3"}) == [0, 6, 12] and people({"name": "bill a", "current": "false", "take": "1"}) == [3]
    bills = lambda p: ids(endpoints.bills(r, p, title="t", key="id", updated="d", house="house"))
    assert bills({"take": "2"}) == [24, 23] and bills({"sort": "TitleAscending", "take": "2"}) == [0, 3] and bills({"sort": "nope", "search": "b"})[0] == 24
    assert bills({"sort": "DateUpdatedAscending", "house": "Lords", "take": "1", "skip": "1"}) == [3]


def test_cache_lifetimes(spark):
    now, made = [0.0], []

    def make():
        made.append(1)
        return spark.range(3)

    c = cache.ResultCache(lambda: now[0])
    first = c.get("search", ("q", "a"), make)
    assert c.get("search", ("q", "a"), make) is first and len(made) == 1
    now[0] = 121
    assert c.get("search", ("q", "a"), make) is not first and len(made) == 2
    now[0] = 121 + 601
    assert c.evict() == 1 and not c.kept
    assert [cache.retry_delay_ms(n) for n in (0, 1, 5)] == [1000, 2000, 30000]
    assert cache.topic_key("1", ["a"]) != cache.topic_key("1", ["b"])


def test_failures_are_tried_again(spark):
    slept, tries = [], []

    def make():
        tries.append(1)
        if len(tries) < 3:
            raise OSError("not yet")
        return spark.range(2)

    c = cache.ResultCache(lambda: 0.0, slept.append)
    assert c.get("topics", cache.result_key("debate", 3), make).count() == 2 and slept == [1, 2]
    with pytest.raises(OSError):
        cache.retried(lambda: (_ for _ in ()).throw(OSError()), slept.append)
    assert slept == [1, 2, 1, 2, 4]


def test_columns_are_checked_as_parameters_are(spark):
    from rostrum.plans import checks

    raws = [None, "", "12abc", " 42", "-7", "x1", "3.9", "99999999999", "2024-02-29", "2023-02-29", "15-01-2024", "lORDS", "commonsx", "  a  "]
    kinds = {"integer": lambda x: v.integer(x, least=1, most=50, default=20), "date": v.date, "house": v.house, "text": lambda x: v.text(x, longest=3, required=True), "member_id": v.member_id, "flag": v.flag}
    columns = {"integer": checks.integer(F.col("r"), least=1, most=50, default=20), "date": checks.date(F.col("r")), "house": checks.house(F.col("r")), "text": checks.text(F.col("r"), longest=3, required=True), "member_id": checks.member_id(F.col("r"))}
    rows = spark.createDataFrame([(r,) for r in raws], "r string").select("r", *[c.alias(k) for k, c in columns.items()], checks.flag(F.col("r")).alias("flag")).collect()
    for r in rows:
        for kind in columns:
            try:
                want = (kinds[kind](r["r"]), None)
            except v.Invalid as e:
                want = (None, str(e))
            assert (r[kind]["value"], r[kind]["error"]) == want, (kind, r["r"])
        assert r["flag"] == v.flag(r["r"])


def test_filters_reach_the_scan(spark, tiny):
    plan = queries.member_contributions(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_custkey,7)" in plan and "o_totalprice" not in plan.split("ReadSchema")[1]
    plan = queries.topic_ranking(spark, tiny)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "NestedLoop" not in plan and "Cartesian" not in plan


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_every_query_runs(spark, tiny, name):
    df = queries.QUERIES[name](spark, tiny)
    assert df.columns and df.collect() is not None


def test_against_duckdb(spark, tiny):
    duckdb = pytest.importorskip("duckdb")
    from pathlib import Path

    con = duckdb.connect()
    for f in Path(tiny).glob("*.parquet"):
        con.sql(f"create view {f.stem} as select * from '{f}'")
    for name, sql in queries.ORACLES.items():
        got, want = queries.QUERIES[name](spark, tiny), con.sql(sql)
        columns = sorted(got.columns)
        assert columns == sorted(want.columns), name
        at = [want.columns.index(c) for c in columns]
        norm = lambda r: tuple(str(x) for x in r)
        assert sorted(norm(r) for r in got.select(*columns).collect()) == sorted(norm([r[i] for i in at]) for r in want.fetchall()), name


def test_a_plain_table_is_read_once(spark, tiny):
    assert read_table(spark, tiny, "region").count() == 5
