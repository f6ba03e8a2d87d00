"""The registered queries over the tables at hand, each with the SQL that gives the same rows.

Debates are ``conversations`` (turns in order; ``system`` turns are procedural), search results ``orders``
with their customers, the corpus ``documents``, members ``customer``, bills ``part``, days ``events``,
markup ``pages``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import dates, labels, parse, text
from ..operators import filters, members, speakers, state, topics
from ..session import bounded_batches
from ..sources import sinks
from ..sources.documents import read_table
from . import endpoints

KEYWORDS = ["and", "of the", "the of", "is the"]
TERM = "the"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a function under its name, with its SQL."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _items(spark: SparkSession, d: str) -> DataFrame:
    rows = read_table(spark, d, "conversations")
    return rows.select(
        F.col("conv_id").alias("debate_id"),
        F.col("turn").alias("pos"),
        F.when(F.col("role") == "system", "Procedural").otherwise("Contribution").alias("ItemType"),
        F.col("role").alias("AttributedTo"),
        F.lit(None).cast("bigint").alias("MemberId"),
        F.lit(None).cast("string").alias("MemberParty"),
        F.col("text").alias("Value"),
    )


def _values(spark: SparkSession, rows: list[tuple], ddl: str) -> DataFrame:
    return spark.createDataFrame(rows, ddl)


def _day(c: str) -> Column:
    return F.date_format(F.col(c), "yyyy-MM-dd'T'HH:mm:ss")


@query("select o_orderkey, o_orderstatus, o_orderdate from orders where o_orderstatus = 'F' order by o_orderdate desc, o_orderkey limit 30")
def recent_by_house(spark, d):
    return filters.recent(read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderdate", "o_orderkey", "F", "o_orderstatus")


@query("select o_orderkey, o_orderstatus, o_orderdate from orders order by o_orderdate desc, o_orderkey limit 30")
def recent_any_house(spark, d):
    return filters.recent(read_table(spark, d, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), "o_orderdate", "o_orderkey", None, "o_orderstatus", 0)


@query("select conv_id, turn, role, text from conversations where conv_id = 1 order by turn")
def debate_lookup(spark, d):
    return filters.lookup(read_table(spark, d, "conversations").select("conv_id", "turn", "role", "text"), "conv_id", 1).orderBy("turn")


@query("select conv_id as debate_id, turn as pos, role as who from conversations where contains(lower(text), 'the') or contains(lower(role), 'the')")
def transcript_search(spark, d):
    return filters.transcript(_items(spark, d), term="THE").select("debate_id", "pos", F.col("AttributedTo").alias("who"))


@query("select conv_id as debate_id, turn as pos from conversations where role = 'user' and (contains(lower(text), 'and') or contains(lower(role), 'and'))")
def transcript_by_speaker(spark, d):
    return filters.transcript(_items(spark, d), "user", "and", member="AttributedTo").select("debate_id", "pos")


@query("""select conv_id as debate_id, turn as pos, case when role <> 'system' then 'contribution' when coalesce(text, '') <> '' then 'procedural' end as kind
    from conversations where role <> 'system' or coalesce(text, '') <> ''""")
def item_kind_dispatch(spark, d):
    kind = filters.item_kind(F.col("ItemType"), F.col("Value"))
    return _items(spark, d).select("debate_id", "pos", kind.alias("kind")).where("kind is not null")


@query("""with s as (select conv_id, role, count(*) as n, min(turn) as p from conversations where role <> 'system' group by all)
    select conv_id as debate_id, role as name, n as contributions, p as first_pos,
           row_number() over (partition by conv_id order by n desc, p) as rank from s""")
def speakers_per_debate(spark, d):
    return speakers.speakers(_items(spark, d)).select("debate_id", "name", "contributions", "first_pos", "rank")


_TOPIC_SQL = """
    with kw(kw_ord, kw) as (select * from (values (0, 'and'), (1, 'of the'), (2, 'the of'), (3, 'is the'))),
    hit as (select kw_ord, d.*, row_number() over (partition by kw_ord order by doc_id) as rn
            from documents d join kw on contains(lower(d.text), kw.kw)),
    top as (select *, kw_ord * 4294967296 + rn as pos from hit where rn <= 50 and coalesce(source, '') <> ''),
    g as (select source, count(*) as mentions, min(pos) as pos, arg_min_null(lang, pos) as party from top group by source)
    select source as member_id, source as name, party, mentions, row_number() over (order by mentions desc, pos) as rank from g
"""


def _topic(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    return topics.ranking(topics.keyword_hits(docs, KEYWORDS, "text", "doc_id"), "source", "source", "lang")


@query(_TOPIC_SQL)
def topic_ranking(spark, d):
    return _topic(spark, d).drop("constituency").orderBy("rank")


@query(f"""with t as ({_TOPIC_SQL})
    select 0::bigint as line_no, '"Name","Party","Constituency","Mention Count"' as line
    union all select rank, '"' || replace(name, '"', '""') || '","' || replace(coalesce(party, ''), '"', '""') || '","","' || mentions || '"' from t""")
def topic_export_lines(spark, d):
    return sinks.export_lines(_topic(spark, d))


@query("""with kw(kw_ord, kw) as (select * from (values (0, 'and'), (1, 'of the'), (2, 'the of'), (3, 'is the'))),
    hit as (select kw_ord, doc_id, source, row_number() over (partition by kw_ord order by doc_id) as rn
            from documents d join kw on contains(lower(d.text), kw.kw))
    select source as member_id, count(distinct doc_id) as mentions from hit where rn <= 50 and coalesce(source, '') <> '' group by source""")
def topic_distinct_records(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    hits = topics.keyword_hits(docs, KEYWORDS, "text", "doc_id")
    return topics.ranking(hits, "source", "source", "lang", distinct_on="doc_id").select("member_id", "mentions")


@query("select strftime(ts, '%Y-%m-%d') as day, count(*) as n from events group by 1")
def group_by_day(spark, d):
    return speakers.per_day(read_table(spark, d, "events").select(_day("ts").alias("ts")), "ts")


@query("""select strftime(o_orderdate, '%Y-%m-%d') as day, o_orderkey, row_number() over (partition by strftime(o_orderdate, '%Y-%m-%d') order by o_orderkey) as place from orders""")
def rows_by_day(spark, d):
    rows = read_table(spark, d, "orders").select("o_orderkey", _day("o_orderdate").alias("date"))
    return speakers.by_day(rows, "date", "o_orderkey").select("day", "o_orderkey", "place")


@query("select distinct strftime(ts, '%Y-%m-%d') as day from events order by day desc")
def day_keys_desc(spark, d):
    return speakers.days(read_table(spark, d, "events").select(_day("ts").alias("ts")), "ts")


@query("select event_id, event_type from events where cast(ts as date) = date '2024-01-02' and contains(lower(event_type), 'cl')")
def section_filter(spark, d):
    rows = read_table(spark, d, "events").withColumn("house", F.lit("Commons"))
    return endpoints.day(rows, {"date": "2024-01-02", "section": " CL "}, date="ts", house="house", kind="event_type").select("event_id", "event_type")


@query("""select doc_id, source from documents where contains(lower(text), 'the') order by doc_id limit 25 offset 10""")
def search_paged(spark, d):
    rows = read_table(spark, d, "documents").withColumn("house", F.lit("Commons"))
    return endpoints.search(rows, {"q": " the ", "skip": "10", "take": "25x"}, text=["text"], key="doc_id", date="doc_id", member="doc_id").select("doc_id", "source")


@query("""select o_orderkey, o_custkey, o_orderdate from orders
    where o_orderdate >= timestamp '1997-01-01' and o_orderdate < timestamp '1997-02-01' and contains(lower(o_orderpriority), 'low')
    order by o_orderkey limit 100""")
def date_range_search(spark, d):
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    found = filters.search(rows, "low", ["o_orderpriority"], "o_orderkey", take=100, date="o_orderdate", start="1997-01-01", end="1997-01-31")
    return found.select("o_orderkey", "o_custkey", "o_orderdate")


@query("select c_custkey, c_name from customer where contains(lower(c_name), '00001') and c_mktsegment = 'BUILDING' order by c_custkey limit 20")
def member_search(spark, d):
    rows = read_table(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return endpoints.people(rows, {"name": "00001", "house": "BUILDING"}, name="c_name", key="c_custkey", house="c_mktsegment").select("c_custkey", "c_name")


@query("select o_orderkey, o_orderdate from orders where o_custkey = 7 order by o_orderkey limit 20")
def member_contributions(spark, d):
    return filters.contributions(read_table(spark, d, "orders").select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", 7, "o_orderkey").drop("o_custkey")


@query("""select c_custkey, c_name, n_name as contact, r_name as synopsis from customer
    left join nation on n_nationkey = c_nationkey left join region on r_regionkey = n_regionkey""")
def member_detail_merge_whole(spark, d):
    people = read_table(spark, d, "customer").select("c_custkey", "c_name", F.col("c_nationkey").alias("id"))
    nation = read_table(spark, d, "nation")
    contact = nation.select(F.col("n_nationkey").alias("id"), F.col("n_name").alias("contact"))
    synopsis = nation.join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("id"), F.col("r_name").alias("synopsis"))
    return members.detail(people, contact, synopsis).select("c_custkey", "c_name", "contact", "synopsis")


@query("select p_partkey, p_name from part where contains(lower(p_name), 'ring') order by p_name desc, p_partkey limit 40 offset 5")
def bills_sorted(spark, d):
    rows = read_table(spark, d, "part").select("p_partkey", "p_name")
    return endpoints.bills(rows, {"search": "RING", "sort": "TitleDescending", "take": "40", "skip": "5"}, title="p_name", key="p_partkey", updated="p_partkey")


@query("select p_partkey, p_name from part order by p_partkey desc limit 20")
def bills_unknown_sort(spark, d):
    return endpoints.bills(read_table(spark, d, "part").select("p_partkey", "p_name"), {"sort": "Newest"}, title="p_name", key="p_partkey", updated="p_partkey")


def _watched(spark, d):
    return read_table(spark, d, "customer").where("c_acctbal < 0").select(F.col("c_custkey").alias("id"))


@query("select c_custkey, c_name, c_acctbal < 0 as watched from customer")
def watch_flag(spark, d):
    return members.with_watch_flag(read_table(spark, d, "customer").select("c_custkey", "c_name"), _watched(spark, d), "c_custkey")


@query("select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal < 0)")
def watched_only(spark, d):
    return members.watched_only(read_table(spark, d, "orders").select("o_orderkey", "o_custkey"), _watched(spark, d), "o_custkey")


def _state(spark, d, cond):
    return read_table(spark, d, "customer").where(cond).select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"))


@query("""select c_custkey as id, c_name as name, c_custkey as pos from customer
    union all select p_partkey, p_name, (select max(c_custkey) + 1 from customer) + p_partkey from part where p_partkey not in (select c_custkey from customer)""")
def watchlist_add_whole(spark, d):
    new = read_table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    return state.add_absent(_state(spark, d, "true"), new)


@query("select c_custkey as id, c_name as name, c_custkey as pos from customer where c_custkey not in (3, 7, 1000)")
def watchlist_remove_whole(spark, d):
    return state.remove(_state(spark, d, "true"), [3, 7, 1000])


@query("select c_custkey as id, c_name as name, c_custkey as pos from customer where not exists (select 1 from orders where o_custkey = c_custkey)")
def remove_in_bulk(spark, d):
    return state.remove_all(_state(spark, d, "true"), read_table(spark, d, "orders").select(F.col("o_custkey").alias("id")))


def _topics(spark):
    rows = [(i, n, k, p) for p, (i, n, k) in enumerate(topics.SEED_TOPICS)]
    return _values(spark, rows, "id string, name string, keywords array<string>, pos int")


def _flat(rows):
    return rows.select("id", "name", parse.keyword_text(F.col("keywords")).alias("keywords"), "pos")


_SEED_SQL = """select * from (values ('1', 'Climate & Environment', 'climate change, net zero, carbon emissions, renewable energy, biodiversity', 0),
    ('2', 'Healthcare', 'NHS, healthcare, mental health, hospitals, doctors', 1),
    ('3', 'Economy', 'inflation, interest rates, cost of living, GDP, unemployment', 2)) t(id, name, keywords, pos)"""


@query(f"with t as ({_SEED_SQL}) select id, case when id = '2' then 'Health' else name end as name, case when id = '2' then 'GP, ward' else keywords end as keywords, pos from t")
def topic_update(spark, d):
    changes = _values(spark, [("2", "Health", ["GP", "ward"]), ("9", "None", ["x"])], "id string, name string, keywords array<string>")
    return _flat(state.update(_topics(spark), changes))


@query(f"with t as ({_SEED_SQL}) select * from t where id <> '2'")
def topic_delete(spark, d):
    return _flat(state.remove(_topics(spark), ["2"]))


@query(f"with t as ({_SEED_SQL}) select * from t union all select '77', 'Rail', 'trains,  signals ', 3")
def topic_add(spark, d):
    return _flat(state.append(_topics(spark), state.topic(spark, "Rail", ["trains", " ", " signals "], "77")))


_PARTIES = [("Labour",), ("Labour (Co-op)",), ("Conservative",), ("Liberal Democrat",), ("Green Party",), ("Scottish National Party",), ("SNP",), ("Plaid Cymru",), ("DUP",), ("Sinn Féin",), ("Crossbench",), ("Green Labour",), ("",), (None,)]


@query("""select p as party, case when contains(lower(p), 'labour') then '#E4003B' when contains(lower(p), 'conservative') then '#0087DC'
    when contains(lower(p), 'liberal democrat') then '#FAA61A' when contains(lower(p), 'green') then '#6AB023'
    when contains(lower(p), 'scottish national') then '#FDF38E' when contains(lower(p), 'snp') then '#FDF38E'
    when contains(lower(p), 'plaid') then '#005B54' when contains(lower(p), 'dup') then '#D46A4C'
    when contains(lower(p), 'sinn') then '#326760' else '#808080' end as colour, n
    from (select t.p, c.n from (values ('Labour'), ('Labour (Co-op)'), ('Conservative'), ('Liberal Democrat'), ('Green Party'),
    ('Scottish National Party'), ('SNP'), ('Plaid Cymru'), ('DUP'), ('Sinn Féin'), ('Crossbench'), ('Green Labour'), (''), (null)) t(p),
    (select count(*) as n from documents) c)""")
def party_colour(spark, d):
    n = read_table(spark, d, "documents").count()
    rows = _values(spark, _PARTIES, "party string")
    return rows.select("party", labels.coloured(F.col("party")).alias("colour"), F.lit(n).cast("bigint").alias("n"))


@query("""select o_orderkey, case when o_orderstatus = 'F' then 'green' else 'red' end as style,
    'House of ' || case when o_orderstatus = 'F' then 'Commons' when o_orderstatus = 'O' then 'Lords' else 'X' end as label from orders""")
def house_label(spark, d):
    house = F.when(F.col("o_orderstatus") == "F", "Commons").when(F.col("o_orderstatus") == "O", "Lords").otherwise("X")
    rows = read_table(spark, d, "orders").select("o_orderkey", house.alias("house"))
    return rows.select("o_orderkey", labels.house_style(F.col("house")).alias("style"), labels.house_label(F.col("house")).alias("label"))


@query("""select c_custkey, coalesce(nullif(v, ''), 'Untitled Debate') as title, coalesce(nullif(v, ''), 'Unknown house') as house,
    coalesce(nullif(v, ''), 'Independent') as party, coalesce(nullif(v, ''), 'Unknown constituency') as seat, coalesce(nullif(v, ''), 'Unknown Speaker') as speaker,
    case when c_nationkey = 1 then 'MP for ' else '' end as prefix, case when coalesce(v, '') = '' then c_name else c_name || ' • ' || v end as suffixed
    from (select *, case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then '' else c_mktsegment end as v from customer)""")
def default_labels(spark, d):
    v = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 1, "").otherwise(F.col("c_mktsegment"))
    rows = read_table(spark, d, "customer").withColumn("v", v)
    c = F.col("v")
    return rows.select("c_custkey", labels.title(c).alias("title"), labels.house_name(c).alias("house"), labels.party_name(c).alias("party"), labels.constituency_name(c).alias("seat"), labels.speaker_name(c).alias("speaker"), labels.seat_prefix(F.col("c_nationkey")).alias("prefix"), labels.with_house(F.col("c_name"), c).alias("suffixed"))


@query("""select c_custkey, '/debate/' || c_custkey as debate, case when c_custkey <> 0 then '/tracker?member=' || c_custkey end as member,
    case when c_custkey <> 0 then 'https://members-api.parliament.uk/api/Members/' || c_custkey || '/Thumbnail' end as photo,
    'https://ui-avatars.com/api/?name=' || replace(c_name || ' (x)!', ' ', '%20').replace('#', '%23') || '&background=e2e8f0&color=64748b' as avatar from customer""")
def link_urls(spark, d):
    rows = read_table(spark, d, "customer")
    key = F.col("c_custkey")
    return rows.select("c_custkey", labels.debate_link(key).alias("debate"), labels.member_link(key).alias("member"), labels.photo_url(key).alias("photo"), labels.avatar_url(F.concat("c_name", F.lit(" (x)!"))).alias("avatar"))


@query("""select raw, array_to_string(list_filter(list_transform(string_split(raw, ','), lambda x: trim(x)), lambda x: x <> ''), ', ') as kept
    from (values ('a, b ,,c'), (' , '), (''), ('net zero,  carbon')) t(raw)""")
def keyword_parse(spark, d):
    rows = _values(spark, [("a, b ,,c",), (" , ",), ("",), ("net zero,  carbon",)], "raw string")
    return rows.select("raw", parse.keyword_text(parse.keywords(F.col("raw"))).alias("kept"))


@query("""select * from (values ('1', 'climate change|net zero|carbon emissions|renewable energy', '+1 more'), ('2', 'NHS|healthcare|mental health|hospitals', '+1 more'),
    ('3', 'inflation|interest rates|cost of living|GDP', '+1 more'), ('4', 'one|two', null)) t(id, shown, more)""")
def keyword_chips(spark, d):
    rows = topics.seed_topics(spark).select("id", "keywords").unionByName(_values(spark, [("4", ["one", "two"])], "id string, keywords array<string>"))
    first, more = labels.shown_keywords(F.col("keywords"))
    return rows.select("id", F.array_join(first, "|").alias("shown"), more.alias("more"))


@query("""select doc_id, md5(regexp_replace(text, '(the)', '<mark class="highlight-match">\\1</mark>', 'gi')) as marked from documents where text <> ''""")
def highlight(spark, d):
    docs = read_table(spark, d, "documents").where(F.col("text") != "")
    return docs.select("doc_id", F.md5(text.highlighted(F.col("text"), TERM)).alias("marked"))


@query("select doc_id, cast(len(regexp_extract_all(text, '(?i)the')) as bigint) as n from documents")
def match_count(spark, d):
    return read_table(spark, d, "documents").select("doc_id", text.match_count(F.col("text"), TERM).alias("n"))


@query("""with p as (select doc_id, string_split_regex(text, '(?i)the') as cut from documents where text <> '')
    select doc_id, cast(len(cut) - 1 as bigint) as matches, cast(list_sum(list_transform(cut, lambda x: length(x))) as bigint) as other_chars from p""")
def highlight_parts(spark, d):
    docs = read_table(spark, d, "documents").where(F.col("text") != "").select("doc_id", text.parts(F.col("text"), TERM).alias("parts"))
    hits = F.filter("parts", lambda p: p["is_match"])
    rest = F.aggregate(F.filter("parts", lambda p: ~p["is_match"]), F.lit(0).cast("bigint"), lambda a, p: a + F.length(p["part"]))
    return docs.select("doc_id", F.size(hits).cast("bigint").alias("matches"), rest.alias("other_chars"))


@query("""select page_id, md5(regexp_replace(regexp_replace(html, '<(script|style)\\b[^>]*>.*?</(script|style)\\s*>', '', 'gis'), '<[^>]*>', '', 'gs')) as bare from pages""")
def strip_markup(spark, d):
    return read_table(spark, d, "pages").select("page_id", F.md5(text.stripped(F.col("html"))).alias("bare"))


# The pages' articles open a <b> that nothing closes, so that by HTML's rules it goes on in every paragraph after, and in
# the footer; of equal ones at most three go on.
_CLEAN_SQL = r"""with cut as (
        select page_id, html, regexp_replace(regexp_extract(html, '(?s)<body>(.*?)<article>', 1), '(?s)</?nav>|<!--.*?-->', '', 'g') as head,
               regexp_extract(html, '(?s)<h1>(.*?)</h1>', 1) as title, string_split(regexp_extract(html, '(?s)</h1>(.*?)</article>', 1), '<p>') as parts,
               regexp_extract(html, '(?s)<footer>(.*?)</footer>', 1) as foot
        from pages
    ), deep as (
        select *, list_transform(parts, lambda p, i: len(list_filter(parts[1:i], lambda x: starts_with(x, '<b>')))) as n from cut
    ), body as (
        select *, list_transform(parts[2:], lambda p, i: case
                   when starts_with(p, '<b>') then '<p>' || repeat('<b>', least(n[i + 1] - 1, 3)) || p || repeat('</b>', least(n[i + 1] - 1, 3) + 1) || '</p>'
                   else '<p>' || repeat('<b>', least(n[i + 1], 3)) || replace(p, '</p>', repeat('</b>', least(n[i + 1], 3)) || '</p>') end) as shown from deep
    )
    , text as (
        select page_id, html, head || title || parts[1] || array_to_string(shown, '') || repeat('<b>', least(n[-1], 3)) || foot || repeat('</b>', least(n[-1], 3)) as t from body
    ), plain as (  -- references to characters, the cut-off ones at the end of titles too, as they are read
        select page_id, html, regexp_replace(replace(replace(replace(replace(replace(replace(t, '&lt;', chr(57345)), '&gt;', chr(57346)), '&quot;', '"'), '&#x27;', chr(39)), '&copy;', '©'), '&middot;', '·'), '&amp;?', '&', 'g') as t from text
    )
    select page_id, case when coalesce(html, '') = '' then '' else replace(replace(replace(t, '&', '&amp;'), chr(57345), '&lt;'), chr(57346), '&gt;') end as clean from plain"""


@query(_CLEAN_SQL)
def sanitize_html(spark, d):
    bounded_batches(spark)
    return read_table(spark, d, "pages").select("page_id", text.sanitised(F.col("html")).alias("clean"))


@query(f"""select page_id, case when clean <> '' then regexp_replace(clean, '(?i)(the)', '<mark class="highlight-match">\\1</mark>', 'g') end as shown from ({_CLEAN_SQL})""")
def sanitize_and_highlight(spark, d):
    bounded_batches(spark)
    return read_table(spark, d, "pages").select("page_id", text.shown(F.col("html"), TERM).alias("shown"))


_DATES = [("2024-01-15T00:00:00",), ("2023-09-03",), ("",), ("Unknown",), ("not a date",), (None,)]


@query("select o_orderkey, strftime(o_orderdate, '%A %-d %B %Y') as long_date from orders")
def long_date(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", dates.long_date(_day("o_orderdate")).alias("long_date"))


@query("select o_orderkey, strftime(o_orderdate, '%-d %b %Y') as short_date from orders")
def short_date(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", dates.short_date(_day("o_orderdate")).alias("short_date"))


@query("select o_orderkey, strftime(o_orderdate, '%B %Y') as since from orders")
def month_year(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", dates.month_year(_day("o_orderdate")).alias("since"))


@query("""select * from (values ('2024-01-15T00:00:00', '2024-01-15', 'Monday 15 January 2024', '15 Jan 2024'), ('2023-09-03', '2023-09-03', 'Sunday 3 September 2023', '3 Sep 2023'),
    ('', 'Unknown', 'Unknown Date', 'Unknown date'), ('Unknown', 'Unknown', 'Unknown Date', 'Invalid Date'), ('not a date', 'not a date', 'Invalid Date', 'Invalid Date'),
    (null, 'Unknown', 'Unknown Date', 'Unknown date')) t(raw, day, long_date, short_date)""")
def odd_dates(spark, d):
    c = F.col("raw")
    return _values(spark, _DATES, "raw string").select("raw", dates.day_key(c).alias("day"), dates.long_date(c).alias("long_date"), dates.short_date(c).alias("short_date"))


@query("""select * from (values ('12abc', 12::bigint), (' 42', 42), ('-7', -7), ('x1', null), ('', null), ('3.9', 3), (null, null)) t(raw, n)""")
def parse_int(spark, d):
    rows = _values(spark, [("12abc",), (" 42",), ("-7",), ("x1",), ("",), ("3.9",), (None,)], "raw string")
    return rows.select("raw", parse.leading_int(F.col("raw")).alias("n"))


@query("select role, upper(substr(role, 1, 1)) || lower(substr(role, 2)) as shown, count(*) as n from conversations group by 1, 2")
def normalise_house(spark, d):
    return read_table(spark, d, "conversations").groupBy("role", text.capitalised(F.col("role")).alias("shown")).agg(F.count(F.lit(1)).alias("n"))


@query("""select (select count(distinct role) from conversations where role <> 'system') as speakers,
    (select count(*) from customer where c_acctbal < 0) as watched, 15::bigint as keywords, (select count(*) = 0 from pages) as no_pages""")
def global_counts(spark, d):
    n = F.count(F.lit(1))
    counts = {
        "speakers": speakers.speakers(_items(spark, d)).agg(F.count_distinct("name")),
        "watched": _watched(spark, d).agg(n),
        "keywords": topics.seed_topics(spark).agg(F.sum(F.size("keywords"))),
        "no_pages": read_table(spark, d, "pages").limit(1).agg(n == 0),
    }
    return spark.range(1).select(*[one.scalar().alias(k) for k, one in counts.items()])


@query("""select event_id, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' as body from events""")
def json_bodies(spark, d):
    rows = read_table(spark, d, "events").select("event_id", "event_type")
    return rows.select("event_id", F.to_json(F.struct("event_id", "event_type")).alias("body"))


@query("select o_orderkey, case when coalesce(o_orderpriority, '') <> '' then o_orderpriority else cast(o_orderkey as varchar) end as row_key from orders")
def row_keys(spark, d):
    return read_table(spark, d, "orders").select("o_orderkey", labels.row_key(F.col("o_orderpriority"), F.col("o_orderkey")).alias("row_key"))


@query("select c_custkey, c_name from customer where c_custkey = 11")
def member_lookup(spark, d):
    return filters.lookup(read_table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", 11)


@query("select c_custkey, r_name as synopsis from customer left join (select n_nationkey, r_name from nation join region on n_regionkey = r_regionkey) on c_nationkey = n_nationkey")
def member_synopsis_whole(spark, d):
    synopsis = read_table(spark, d, "nation").join(read_table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey")).select(F.col("n_nationkey").alias("c_nationkey"), F.col("r_name").alias("synopsis"))
    people = read_table(spark, d, "customer").select("c_custkey", "c_nationkey")
    return people.join(members.synopsis_of(people.select("c_nationkey").distinct(), synopsis, "c_nationkey"), "c_nationkey").select("c_custkey", "synopsis")


@query("""select 9::bigint as id, c_name as name, n_name as contact, null::varchar as synopsis from customer join nation on n_nationkey = c_nationkey where c_custkey = 9""")
def member_endpoint(spark, d):
    people = read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), "c_nationkey")
    contact = people.join(read_table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select("id", F.col("n_name").alias("contact"))
    synopsis = people.limit(0).select("id", F.lit("").alias("synopsis"))
    return endpoints.member(people.drop("c_nationkey"), contact, synopsis, "9 ")


@query("select conv_id, turn from conversations order by conv_id, turn limit 30 offset 15")
def visible_slice(spark, d):
    return filters.visible(read_table(spark, d, "conversations").select("conv_id", "turn"), [F.col("conv_id"), F.col("turn")], 20, 20)


@query("select * from (values ('1', 'Climate & Environment', 5::bigint), ('2', 'Healthcare', 5), ('3', 'Economy', 5)) t(id, name, n)")
def seed_topics(spark, d):
    return topics.seed_topics(spark).select("id", "name", F.size("keywords").cast("bigint").alias("n"))


@query("""with kw(kw_ord, keyword) as (select * from (values (0, 'and'), (1, 'of the'), (2, 'the of'), (3, 'is the')))
    select kw_ord, keyword, doc_id, rn from (select kw_ord, keyword, doc_id, row_number() over (partition by kw_ord order by doc_id) as rn
    from documents d join kw on contains(lower(d.text), keyword)) where rn <= 50""")
def keyword_top_hits(spark, d):
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    hits = topics.keyword_hits(docs, KEYWORDS, "text", "doc_id")
    return hits.select("kw_ord", "keyword", "doc_id", F.col("rn").cast("bigint").alias("rn"))


@query("select conv_id as debate_id, turn as pos, conv_id in (select conv_id from conversations) as watched from conversations")
def transcript_with_watch_whole(spark, d):
    rows = read_table(spark, d, "conversations").select(F.col("conv_id").alias("debate_id"), F.col("turn").alias("pos"))
    return members.with_watch_flag(rows, rows.select(F.col("debate_id").alias("id")), "debate_id")


@query("select ts::date::varchar as day, max(event_id) as last_event, count(*) as n, count(*) = 0 as none from events group by 1")
def day_summary(spark, d):
    rows = speakers.with_day(read_table(spark, d, "events").select("event_id", _day("ts").alias("ts")), "ts")
    return rows.groupBy("day").agg(F.max("event_id").alias("last_event"), F.count(F.lit(1)).alias("n"), (F.count(F.lit(1)) == 0).alias("none"))


@query("""select c_custkey, coalesce(nullif(v, ''), 'Debate') as title, coalesce(nullif(v, ''), 'Unknown') as party, coalesce(nullif(v, ''), '-') as seat
    from (select c_custkey, case when c_custkey % 3 = 0 then null when c_custkey % 3 = 1 then '' else c_mktsegment end as v from customer)""")
def topic_table_labels(spark, d):
    v = F.when(F.col("c_custkey") % 3 == 0, F.lit(None)).when(F.col("c_custkey") % 3 == 1, "").otherwise(F.col("c_mktsegment"))
    return read_table(spark, d, "customer").select("c_custkey", labels.debate_title(v).alias("title"), labels.topic_party(v).alias("party"), labels.topic_seat(v).alias("seat"))
