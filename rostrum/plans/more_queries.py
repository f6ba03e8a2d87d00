"""Further registered queries: envelopes and snapshots, parameters checked as rows, result keys and lifetimes, and the
sanitiser against stated outputs."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, SparkSession, functions as F

from ..functions import labels, text
from ..operators import filters, places, speakers, state
from ..session import bounded_batches
from ..sources import documents, sinks
from ..sources.documents import read_table
from . import cache, checks, endpoints
from .queries import _day, _items, _values, query


def _scratch(spark: SparkSession) -> str:
    """A folder of its own below the shared one that the cluster names; one of this machine only in local mode."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        root = "file://" + tempfile.mkdtemp(prefix="rostrum-snapshots-")
    return f"{root.rstrip('/')}/rostrum/snapshots-{uuid.uuid4().hex}"


def _cases(number: str, *values: Column | None) -> Column:
    """One of the values by the remainder of a number, so that every kind of value is met."""
    chosen = F.lit(None).cast("string")
    for k, v in enumerate(values):
        if v is not None:
            chosen = F.when(F.col(number) % len(values) == k, v).otherwise(chosen)
    return chosen


# Envelopes: what a service returns, as JSON text, parsed by a stated schema.

@query("select conv_id, turn, role, text from conversations")
def envelope_results(spark, d):
    """PRJ-1, JSN-1."""
    rows = read_table(spark, d, "conversations").groupBy("conv_id").agg(F.to_json(F.struct(F.collect_list(F.struct("conv_id", "turn", "role", "text")).alias("Results"))).alias("body"))
    return documents.results(rows.select(F.from_json("body", "Results array<struct<conv_id: bigint, turn: bigint, role: string, text: string>>").alias("e")).select("e.*"))


@query("select c_custkey as id, c_name as name from customer")
def envelope_members(spark, d):
    """PRJ-1: members stand in their ``value``."""
    item = F.struct(F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")).alias("value"))
    rows = read_table(spark, d, "customer").groupBy("c_nationkey").agg(F.to_json(F.struct(F.collect_list(item).alias("items"))).alias("body"))
    return documents.members(rows.select(F.from_json("body", "items array<struct<value: struct<id: bigint, name: string>>>").alias("e")).select("e.*"))


@query("select c_custkey as id, c_name as name from customer")
def unwrapped_members(spark, d):
    """PRJ-2: some rows stand in a ``value``, some do not."""
    wrapped = F.col("c_acctbal") < 0
    value = F.when(wrapped, F.struct(F.col("c_custkey").alias("id"), F.col("c_name").alias("name")))
    rows = read_table(spark, d, "customer").select(value.alias("value"), F.when(~wrapped, F.col("c_custkey")).alias("id"), F.when(~wrapped, F.col("c_name")).alias("name"))
    return documents.unwrapped(rows)


@query("select event_id, cast(json_extract_string(props, '$.k') as bigint) as k from events")
def parsed_props(spark, d):
    """JSN-1."""
    return read_table(spark, d, "events").select("event_id", F.from_json("props", "k bigint")["k"].alias("k"))


# Stored state.

@query("select c_custkey as id, c_name as name from customer where c_acctbal < 0")
def watchlist_snapshot(spark, d):
    """SRC-13, SNK-3: written, replaced, and read again."""
    people = read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"), "c_acctbal")
    kept = sinks.Snapshots(spark, _scratch(spark), "id bigint, name string, pos bigint")
    kept.write(people.drop("c_acctbal"))
    kept.write(state.remove_all(kept.read(), people.where("c_acctbal >= 0")).withColumn("pos", F.col("id")))
    return kept.read()


@query("""select cast(r_regionkey as varchar) as id, r_name as name, string_agg(n_name, '|' order by n_name) as keywords
    from region join nation on n_regionkey = r_regionkey group by all""")
def topic_snapshot(spark, d):
    """SRC-14, SNK-4."""
    nation = read_table(spark, d, "nation").groupBy(F.col("n_regionkey").alias("r_regionkey")).agg(F.sort_array(F.collect_list("n_name")).alias("keywords"))
    rows = read_table(spark, d, "region").join(nation, "r_regionkey").select(F.col("r_regionkey").cast("string").alias("id"), F.col("r_name").alias("name"), "keywords", F.col("r_regionkey").cast("bigint").alias("pos"))
    kept = sinks.Snapshots(spark, _scratch(spark), "id string, name string, keywords array<string>, pos bigint")
    kept.write(rows)
    return kept.read().withColumn("keywords", F.array_join("keywords", "|"))


@query("select c_custkey, case when c_acctbal < 0 then 'topic' else c_mktsegment end || '-analysis.csv' as file from customer")
def export_files(spark, d):
    """SNK-2."""
    return read_table(spark, d, "customer").select("c_custkey", sinks.export_names(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment"))).alias("file"))


@query("""select p_partkey, p_name, to_json({'p_partkey': p_partkey, 'p_name': p_name})::varchar as body from part""")
def part_bodies(spark, d):
    """SNK-5, by the sink's own function."""
    rows = read_table(spark, d, "part").select("p_partkey", "p_name")
    return sinks.bodies(rows).withColumn("row", F.from_json("body", "p_partkey bigint, p_name string")).select("row.p_partkey", "row.p_name", "body")


# Parameters as rows.

_RAW_PART = """case p_partkey % 6 when 0 then null when 1 then '' when 2 then p_size || 'abc' when 3 then '  ' || p_size when 4 then p_name else '-' || p_size end"""


def _raw_part():
    size = F.col("p_size").cast("string")
    return _cases("p_partkey", None, F.lit(""), F.concat(size, F.lit("abc")), F.concat(F.lit("  "), size), F.col("p_name"), F.concat(F.lit("-"), size))


@query(f"""with r as (select p_partkey, {_RAW_PART} as raw from part),
    n as (select *, case when coalesce(raw, '') = '' then 20 else try_cast(nullif(regexp_extract(raw, '^\\s*([+-]?\\d+)', 1), '') as bigint) end as n from r),
    e as (select *, case when n is null then 'this is not a whole number' when n not between 1 and 25 then 'the number has to lie between 1 and 25' end as error from n)
    select p_partkey, raw, case when error is null then n end as value, error from e""")
def checked_integers(spark, d):
    """VAL-2."""
    got = read_table(spark, d, "part").select("p_partkey", _raw_part().alias("raw")).withColumn("c", checks.integer(F.col("raw"), least=1, most=25, default=20))
    return got.select("p_partkey", "raw", "c.value", "c.error")


_RAW_TEXT = "case p_partkey % 4 when 0 then null when 1 then '' when 2 then '  ' || p_name || chr(160) else p_name || ' ' || p_type end"


@query(f"""with r as (select p_partkey, {_RAW_TEXT} as raw from part), t as (select *, trim(raw, ' ' || chr(160)) as bare from r),
    e as (select *, case when coalesce(raw, '') = '' then 'a value is needed here' when length(bare) > 20 then 'the text is too long: at most 20 characters'
        when not regexp_matches(bare, '[aeiou]t') then 'the text does not have the form that is asked for' end as error from t)
    select p_partkey, case when error is null then bare end as value, error from e""")
def checked_texts(spark, d):
    """VAL-1, STR-6."""
    raw = _cases("p_partkey", None, F.lit(""), F.concat(F.lit("  "), F.col("p_name"), F.lit(chr(160))), F.concat(F.col("p_name"), F.lit(" "), F.col("p_type")))
    return read_table(spark, d, "part").select("p_partkey", checks.text(raw, longest=20, required=True, pattern="[aeiou]t").alias("c")).select("p_partkey", "c.value", "c.error")


@query("""with r as (select o_orderkey, case o_orderkey % 5 when 0 then null when 1 then strftime(o_orderdate, '%Y-%m-%d') when 2 then strftime(o_orderdate, '%d-%m-%Y')
        when 3 then strftime(o_orderdate, '%Y') || '-02-30' else '' end as raw from orders),
    e as (select *, case when coalesce(raw, '') = '' then null when not regexp_matches(raw, '^\\d{4}-\\d{2}-\\d{2}$') then 'a date is written as year-month-day, such as 2024-01-31'
        when try_cast(raw as date) is null then 'the calendar has no such day' end as error from r)
    select o_orderkey, case when error is null then nullif(raw, '') end as value, error from e""")
def checked_dates(spark, d):
    """VAL-3."""
    when = F.col("o_orderdate")
    raw = _cases("o_orderkey", None, F.date_format(when, "yyyy-MM-dd"), F.date_format(when, "dd-MM-yyyy"), F.concat(F.date_format(when, "yyyy"), F.lit("-02-30")), F.lit(""))
    return read_table(spark, d, "orders").select("o_orderkey", checks.date(raw).alias("c")).select("o_orderkey", "c.value", "c.error")


@query("""with r as (select o_orderkey, case o_orderstatus when 'F' then 'cOMMONS' when 'O' then 'LORDS' when 'P' then 'senate' end as raw from orders),
    e as (select *, coalesce(upper(raw[1]) || lower(raw[2:]), 'Commons') as named from r)
    select o_orderkey, case when named in ('Commons', 'Lords') then named end as value, case when named not in ('Commons', 'Lords') then 'the house is either Commons or Lords' end as error from e""")
def checked_houses(spark, d):
    """VAL-4."""
    s = F.col("o_orderstatus")
    raw = F.when(s == "F", "cOMMONS").when(s == "O", "LORDS").when(s == "P", "senate")
    return read_table(spark, d, "orders").select("o_orderkey", checks.house(raw).alias("c")).select("o_orderkey", "c.value", "c.error")


_MEMBER_ERROR = "case when raw is null then 'a value is needed here' when raw::bigint not between 1 and 99999 then 'the number has to lie between 1 and 99999' end"


@query(f"""with r as (select o_orderkey, case when o_orderstatus <> 'P' then (o_custkey * 1000)::varchar end as raw from orders), e as (select *, {_MEMBER_ERROR} as error from r)
    select o_orderkey, case when error is null then raw::bigint end as value, error, case when error is not null then '{{"error":"' || error || '"}}' end as body from e""")
def checked_members(spark, d):
    """VAL-5, VAL-6, VAL-7, SNK-6."""
    raw = F.when(F.col("o_orderstatus") != "P", (F.col("o_custkey") * 1000).cast("string"))
    return read_table(spark, d, "orders").select("o_orderkey", checks.member_id(raw).alias("c")).select("o_orderkey", "c.value", "c.error", checks.body(F.col("c.error")).alias("body"))


@query("select c_custkey, coalesce(case c_custkey % 4 when 0 then null when 1 then 'false' when 2 then 'FALSE' else '' end <> 'false', true) as sits from customer")
def flags(spark, d):
    """FIL-11."""
    return read_table(spark, d, "customer").select("c_custkey", checks.flag(_cases("c_custkey", None, F.lit("false"), F.lit("FALSE"), F.lit(""))).alias("sits"))


@query("""select c_custkey, case c_custkey % 4 when 0 then false when 1 then false when 2 then c_name <> '' else c_mktsegment <> '' end as savable from customer""")
def savable_topics(spark, d):
    """FIL-8: no name; a blank name; a name and keywords of which one is blank; blank keywords and the segment."""
    n, s = F.col("c_name"), F.col("c_mktsegment")
    name = _cases("c_custkey", None, F.lit(" \t"), n, n)
    words = F.when(F.col("c_custkey") % 4 == 2, F.array(F.lit(" "), n)).otherwise(F.array(F.lit(""), s))
    return read_table(spark, d, "customer").select("c_custkey", state.savable(name, words).alias("savable"))


@query("select conv_id, turn, role from conversations where conv_id = 2")
def lookup_when_known(spark, d):
    """FIL-12: one id is known, the other not yet."""
    rows = read_table(spark, d, "conversations").select("conv_id", "turn", "role")
    return filters.lookup_if(rows, "conv_id", 2).unionByName(filters.lookup_if(rows, "conv_id", None))


@query("select c_custkey, c_custkey in (select o_custkey from orders where o_totalprice > 300000) as held from customer")
def members_held(spark, d):
    """AGG-6."""
    return speakers.held(read_table(spark, d, "customer").select("c_custkey"), read_table(spark, d, "orders").where("o_totalprice > 300000"), "c_custkey", "o_custkey")


# Results kept for a while.

@query("select l_orderkey, l_linenumber, least(1000 * 2 ** l_linenumber, 30000)::bigint as delay_ms, l_linenumber < 3 as again from lineitem")
def retry_delays(spark, d):
    """MTH-1, CCH-3."""
    n = F.col("l_linenumber")
    return read_table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", cache.delay_ms(n).alias("delay_ms"), cache.again(n).alias("again"))


@query("""with k(kind, stale, gone) as (values ('debates', 300, 1800), ('members', 900, 3600), ('search', 120, 600), ('topics', 300, 1800)),
    e as (select event_id, value * 10 as age, case event_id % 4 when 0 then 'debates' when 1 then 'members' when 2 then 'search' else 'topics' end as kind from events)
    select event_id, kind, case when age < stale then 'fresh' when age < gone then 'stale' else 'gone' end as state from e join k using (kind)""")
def result_states(spark, d):
    """CCH-1."""
    kind = _cases("event_id", *map(F.lit, ("debates", "members", "search", "topics")))
    return read_table(spark, d, "events").select("event_id", kind.alias("kind"), cache.freshness(kind, F.col("value") * 10).alias("state"))


@query("""select c_custkey, '["debates","recent","' || c_mktsegment || '"]' as recent, '["debate","' || c_custkey || '"]' as debate, '["topic-search","' || c_custkey || '","' || c_name || '"]' as topic,
    '["members","search","' || c_name || '"]' as member, '["contributions","' || c_custkey || '"]' as contributions from customer""")
def result_keys(spark, d):
    """CCH-2, all five shapes; a topic's has its keywords too."""
    c = F.col
    parts = {"recent": [c("c_mktsegment")], "debate": [c("c_custkey")], "topic": [c("c_custkey"), c("c_name")], "member": [c("c_name")], "contributions": [c("c_custkey")]}
    return read_table(spark, d, "customer").select("c_custkey", *[cache.key_text(k, *p).alias(k) for k, p in parts.items()])


# Markup against stated outputs: inputs of our own, and what the allow-list leaves of them.
_MARKUP = [
    (1, "plain words", "plain words"),
    (2, '<p class="lead" id="x" style="color:red">a <b>bold</b> word</p>', '<p class="lead">a <b>bold</b> word</p>'),
    (3, "<h1>Heading</h1><section>kept <i>inside</i></section>", "Heading" + "kept <i>inside</i>"),
    (4, "one<script>steal()</script><style>p{}</style> two<br/>three", "one two<br>three"),
    (5, '<a href="HTTPS://example.org/a?b=1&amp;c=2" onclick="go()">out</a>', '<a href="HTTPS://example.org/a?b=1&amp;c=2">out</a>'),
    (6, '<a href=" java\tscript:alert(1)">bad</a> <a href="data:text/html,x">worse</a>', "<a>bad</a> <a>worse</a>"),
    (7, '<a href="/in/site:here" rel="next">in</a> <a href="mailto:a@example.org">mail</a>', '<a href="/in/site:here" rel="next">in</a> <a href="mailto:a@example.org">mail</a>'),
    (8, "<ul><li>one<li>two</ul> 1 < 2", "<ul><li>one</li><li>two</li></ul> 1 &lt; 2"),
    (9, "<blockquote>left <em>open", "<blockquote>left <em>open</em></blockquote>"),
    (10, "<iframe src='x'>hidden</iframe><sup>2</sup><!-- note --><sub>n</sub>", "<sup>2</sup><sub>n</sub>"),
    (11, "", ""),
]
_quoted = lambda s: "'" + s.replace("'", "''") + "'"


@query("select * from (values " + ", ".join(f"({i}, {_quoted(clean)})" for i, _, clean in _MARKUP) + ") t(id, clean)")
def sanitize_cases(spark, d):
    """STR-12."""
    bounded_batches(spark)
    return _values(spark, [(i, raw) for i, raw, _ in _MARKUP], "id int, raw string").select("id", text.sanitised(F.col("raw")).alias("clean"))


_SHOWN = [
    (1, "The vote on votes", "vote", f"The {text.MARK}vote</mark> on {text.MARK}vote</mark>s"),
    (2, "<p>Order, <u>ORDER</u>!</p>", "order", f"<p>{text.MARK}Order</mark>, {text.MARK}ORDER</mark>!</p>"),
    (3, "costs (net) of 5.5", "(net)", f"costs {text.MARK}(net)</mark> of 5.5"),
    (4, "nothing to find", "[a-z]+", "nothing to find"),
    (5, "<div>kept</div><script>lost</script>", "lost", "<div>kept</div>"),
    (6, "", "x", None),
]


@query("select * from (values " + ", ".join(f"({i}, {_quoted(w) if w is not None else 'null'})" for i, _, _, w in _SHOWN) + ") t(id, shown)")
def shown_cases(spark, d):
    """STR-7, STR-8, STR-10, STR-11, one plan for each term."""
    bounded_batches(spark)
    out = None
    for i, raw, term, _ in _SHOWN:
        one = _values(spark, [(i, raw)], "id int, raw string").select("id", text.shown(F.col("raw"), term).alias("shown"))
        out = one if out is None else out.unionByName(one)
    return out


@query("""select doc_id, case when coalesce(text, '') <> '' then regexp_replace(text, '(\\.)', '<mark class="highlight-match">\\1</mark>', 'g') end as shown from documents where not contains(coalesce(text, ''), '<')""")
def shown_documents(spark, d):
    """STR-7, STR-8, STR-11 over whole texts: the term is a character that a pattern has to escape."""
    bounded_batches(spark)
    rows = read_table(spark, d, "documents").where(~F.coalesce(text.is_markup(F.col("text")), F.lit(False)))
    return rows.select("doc_id", text.shown(F.col("text"), ".").alias("shown"))


# Parameters that the first queries leave out.

@query("""select event_id, ts from events where contains(lower(event_type), 'c') and user_id = 3 and value > 20
    and ts >= timestamp '2024-01-02' and ts < timestamp '2024-01-28' order by event_id limit 50 offset 1""")
def search_all_parameters(spark, d):
    """SRC-8 with house, dates, member and paging."""
    rows = read_table(spark, d, "events").withColumn("house", F.when(F.col("value") > 20, "Lords").otherwise("Commons"))
    asked = {"query": "C", "house": "lords", "startDate": "2024-01-02", "endDate": "2024-01-27", "member": "3", "skip": "1", "take": "50"}
    return endpoints.search(rows, asked, text=["event_type"], key="event_id", date="ts", member="user_id").select("event_id", "ts")


@query("select c_custkey, c_name from customer where contains(lower(c_name), '1') and c_acctbal >= 0 order by c_custkey limit 20")
def current_member_search(spark, d):
    """SRC-5."""
    rows = read_table(spark, d, "customer").select("c_custkey", "c_name", (F.col("c_acctbal") >= 0).alias("sits"))
    return endpoints.current_members(rows, "1", column="c_name", key="c_custkey", current="sits").select("c_custkey", "c_name")


@query("select c_custkey, c_name from customer where contains(lower(c_name), '2') and c_acctbal < 0 order by c_custkey limit 100 offset 3")
def former_member_search(spark, d):
    """SRC-10 with ``current``."""
    rows = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment", (F.col("c_acctbal") >= 0).alias("sits"))
    return endpoints.people(rows, {"name": "2", "current": "false", "skip": "3", "take": "100"}, name="c_name", key="c_custkey", house="c_mktsegment", current="sits").select("c_custkey", "c_name")


@query("select event_id, user_id from events where user_id = 5 and event_type = 'click' order by event_id limit 20")
def spoken_contributions(spark, d):
    """SRC-4 with a kind."""
    rows = read_table(spark, d, "events").select("event_id", "user_id", F.when(F.col("event_type") == "click", "Spoken").otherwise("Written").alias("kind"))
    return filters.contributions(rows, "user_id", 5, "event_id", kind="kind").select("event_id", "user_id")


@query("select p_partkey, p_name from part where contains(lower(p_name), 'a') order by p_name, p_partkey limit 100")
def bills_by_title(spark, d):
    """SRC-11, SRT-4."""
    return endpoints.bills(read_table(spark, d, "part").select("p_partkey", "p_name"), {"search": "A", "sort": "TitleAscending", "take": "100"}, title="p_name", key="p_partkey", updated="p_retailprice")


@query("select p_partkey, p_retailprice from part order by p_retailprice, p_partkey limit 100 offset 7")
def bills_oldest_first(spark, d):
    """SRT-4."""
    return endpoints.bills(read_table(spark, d, "part").select("p_partkey", "p_name", "p_retailprice"), {"sort": "DateUpdatedAscending", "take": "100", "skip": "7"}, title="p_name", key="p_partkey", updated="p_retailprice").select("p_partkey", "p_retailprice")


@query("""with r as (select conv_id as debate_id, turn as pos, turn % 3 as mid, role as name, case when turn > 1 then 'after ' || turn end as party from conversations where role <> 'system'),
    k as (select *, nullif(mid, 0) as kid, case when mid = 0 then name end as kname from r),
    g as (select debate_id, kid, kname, count(*) as n, min(pos) as p, arg_min(mid, pos) as mid, arg_min(name, pos) as name, arg_min_null(party, pos) as party from k group by debate_id, kid, kname)
    select debate_id, mid as member_id, name, party, n as contributions, p as first_pos, row_number() over (partition by debate_id order by n desc, p) as rank from g""")
def speakers_with_ids(spark, d):
    """AGG-1, WIN-2 with member ids, 0 for none, and parties, missing in the first turns."""
    party = F.when(F.col("pos") > 1, F.concat(F.lit("after "), F.col("pos").cast("string")))
    return speakers.speakers(_items(spark, d).withColumn("MemberId", F.col("pos") % 3).withColumn("MemberParty", party))


@query("select c_custkey, c_mktsegment as segment from customer where c_custkey not in (select o_custkey from orders where o_totalprice > 450000)")
def removed_some(spark, d):
    """JOIN-5: some rows go, some stay."""
    rows = read_table(spark, d, "customer").select("c_custkey", F.col("c_mktsegment").alias("segment"))
    return state.remove_all(rows, read_table(spark, d, "orders").where("o_totalprice > 450000").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("""select o_orderkey, case when o_orderstatus = 'F' then o_orderpriority else cast(row_number() over (partition by strftime(o_orderdate, '%Y-%m-%d') order by o_orderkey) - 1 as varchar) end as row_key from orders""")
def row_keys_by_place(spark, d):
    """PRJ-15: the place in the day's list where there is no id."""
    rows = read_table(spark, d, "orders").withColumn("day", _day("o_orderdate"))
    named = F.when(F.col("o_orderstatus") == "F", F.col("o_orderpriority"))
    return places.with_index_key(rows, named, [F.col("day")], [F.col("o_orderkey")]).select("o_orderkey", "row_key")


@query("select conv_id as debate_id, turn as pos from conversations where role = 'assistant' and contains(lower(text), 'the') order by 1, 2")
def transcript_of_one(spark, d):
    """FIL-3, FIL-4, in order."""
    return filters.transcript(_items(spark, d), "assistant", "The", member="AttributedTo").select("debate_id", "pos").orderBy("debate_id", "pos")
