"""Further registered queries over whole tables: keyword tables, writers of one state, logs of changes, streams, slices of
any depth, nested documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..operators import keywords, signatures, slices, state, topics
from ..sources import documents, sinks
from ..sources.documents import read_table
from ..streaming.writes import FirstWrites
from .more_queries import _scratch
from .queries import query


def _words(spark: SparkSession, d: str, table: str, id: str, text: str) -> DataFrame:
    """Every word of a table's texts, in the order of the first row that has it."""
    rows = read_table(spark, d, table)
    words = rows.select(F.col(id).alias("id"), F.explode(F.split(F.lower(F.col(text)), " ")).alias("keyword"))
    return keywords.cleaned(words.groupBy("keyword").agg(F.min("id").alias("kw_ord")))


_PART_HITS = """with kw as (select w as keyword, min(p_partkey) as kw_ord from (select p_partkey, unnest(string_split(lower(p_name), ' ')) as w from part) where trim(w) <> '' group by w),
    hit as (select kw_ord, keyword, doc_id, source, lang, row_number() over (partition by kw_ord, keyword order by doc_id) as rn
            from documents join kw on contains(lower(text), keyword))"""


@query(f"{_PART_HITS} select kw_ord, keyword, doc_id, rn from hit where rn <= 50")
def keyword_table_hits(spark, d):
    """JOIN-2, WIN-1 and SET-1 with the keywords of a table: the first 50 rows of each."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    hits = keywords.top_hits(docs, _words(spark, d, "part", "p_partkey", "p_name"), "text", "doc_id")
    return hits.select("kw_ord", "keyword", "doc_id", F.col("rn").cast("bigint").alias("rn"))


@query(f"""{_PART_HITS}, top as (select *, kw_ord * 4294967296 + rn as pos from hit where rn <= 50 and coalesce(source, '') <> '')
    select source as member_id, count(*) as mentions, arg_min_null(lang, pos) as party from top group by source""")
def keyword_table_ranking(spark, d):
    """AGG-2 over the keywords of a table."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    hits = keywords.top_hits(docs, _words(spark, d, "part", "p_partkey", "p_name"), "text", "doc_id")
    return topics.ranking(hits, "source", "source", "lang").select("member_id", "mentions", "party")


@query("""with kw as (select w as keyword, min(item_id) as kw_ord from (select item_id, unnest(string_split(lower(text), ' ')) as w from benchmark) where trim(w) <> '' group by w)
    select kw_ord, keyword, count(*) as docs, min(doc_id) as first_doc from documents join kw on contains(lower(text), keyword) group by all""")
def keyword_table_totals(spark, d):
    """JOIN-2 with thousands of keywords: in how many texts each stands, and the first of them."""
    docs = read_table(spark, d, "documents").select("doc_id", "text")
    hits = keywords.all_hits(docs, _words(spark, d, "benchmark", "item_id", "text"), "text")
    return hits.groupBy("kw_ord", "keyword").agg(F.count(F.lit(1)).alias("docs"), F.min("doc_id").alias("first_doc"))


@query("""select c_custkey as id, c_name as name from customer where c_acctbal >= 0
    union all select p_partkey, p_name from part where p_partkey not in (select c_custkey from customer where c_acctbal >= 0)""")
def watchlist_two_writers(spark, d):
    """SNK-3, SRC-13: two writers start from one version; the slower one's change is applied to the faster one's rows."""
    people = read_table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_custkey").alias("pos"), "c_acctbal")
    parts = read_table(spark, d, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"), F.col("p_partkey").alias("pos"))
    kept = sinks.Snapshots(spark, _scratch(spark), "id bigint, name string, pos bigint")
    kept.write(people.drop("c_acctbal"))
    faster = []

    def remove(rows: DataFrame) -> DataFrame:
        return state.remove_all(rows, people.where("c_acctbal < 0")).withColumn("pos", F.col("id"))

    def add(rows: DataFrame) -> DataFrame:
        if not faster:  # the other writer commits between this one's reading and writing
            faster.append(sinks.Snapshots(spark, kept.root, "id bigint, name string, pos bigint").update(remove))
        return state.add_absent(rows.withColumn("pos", F.col("id")), parts)

    kept.update(add)
    return kept.read()


@query("""select o_orderkey, o_totalprice, place from (select o_orderkey, o_totalprice, row_number() over (order by o_totalprice desc, o_orderkey) - 1 as place, count(*) over () as n from orders)
    where place >= n - 40 and place < n - 15""")
def deep_slice(spark, d):
    """LIM-2: a page near the end of all orders, by price."""
    rows = read_table(spark, d, "orders").select("o_orderkey", "o_totalprice")
    ranked = slices.Ranked.build(rows, [F.col("o_totalprice").desc(), F.col("o_orderkey")], _scratch(spark), 64)
    return ranked.slice(ranked.count - 40, 25)


@query("""select conv_id, turn, place from (select conv_id, turn, row_number() over (order by conv_id, turn) - 1 as place, count(*) over () as n from conversations)
    where place >= n // 2 - 5 and place < n // 2 + 25""")
def deep_visible_slice(spark, d):
    """WIN-3: what a list shows from the middle of all turns on."""
    rows = read_table(spark, d, "conversations").select("conv_id", "turn")
    ranked = slices.Ranked.build(rows, [F.col("conv_id"), F.col("turn")], _scratch(spark), 64)
    return ranked.visible(ranked.count // 2, 20)


@query("select doc_id, source from documents where contains(lower(coalesce(text, '')), 'token =')")
def signed_search(spark, d):
    """FIL-4, SRC-3: the rows of a scan, from the parts that may hold the term."""
    rows = read_table(spark, d, "documents").select("doc_id", "source", "text")
    signed = signatures.Signed.build(rows, ["text"], _scratch(spark), 64, by=["doc_id"])
    return signed.search("Token =", ["text"]).select("doc_id", "source")


_WORDS = "select w as keyword, min(p_partkey) as kw_ord from (select p_partkey, unnest(string_split(lower(p_name), ' ')) as w from part) where trim(w) <> '' group by w"


@query(f"""with hit as (select doc_id, source, kw_ord from documents join ({_WORDS}) on contains(lower(text), keyword) where doc_id <> 0)
    select doc_id as member_id, case when coalesce(any_value(source), '') = '' then 'Unknown' else any_value(source) end as name, count(*) as mentions, row_number() over (order by count(*) desc, min(kw_ord), doc_id) as rank from hit group by doc_id""")
def keyword_table_full_ranking(spark, d):
    """AGG-2, SRT-2 without a limit by keyword: every document that holds a keyword of a table, ranked by how many it holds."""
    docs = read_table(spark, d, "documents").select("doc_id", "source", "lang", "text")
    hits = keywords.all_hits(docs, _words(spark, d, "part", "p_partkey", "p_name"), "text")
    ranked = topics.full_ranking(hits, "doc_id", "doc_id", "source", "lang", _scratch(spark), 64)
    return ranked.slice(0, ranked.count).select("member_id", "name", "mentions", (F.col("place") + 1).alias("rank"))


@query("""with log as (select o_custkey as id, o_orderkey as seq, o_orderstatus as op, o_orderpriority as name, case when o_totalprice > 200000 then strftime(o_orderdate, '%Y-%m') end as segment from orders),
    gone as (select id, max(seq) as g from log where op = 'P' group by id),
    alive as (select log.* from log left join gone using (id) where g is null or seq > g),
    put as (select id, min(seq) as since, arg_min(name, seq) as name, arg_min_null(segment, seq) as segment from alive where op = 'O' group by id),
    old as (select c_custkey as id, c_name as name, c_mktsegment as segment from customer where c_acctbal >= 0 and c_custkey not in (select id from gone)),
    held as (select id, -1 as since, name, segment from old union all select id, since, name, segment from put where id not in (select id from old)),
    sets as (select id, arg_max(s.name, seq) filter (s.name is not null) as name, arg_max(s.segment, seq) filter (s.segment is not null) as segment from alive s join held using (id) where op = 'F' and seq > since group by id)
    select held.id, coalesce(sets.name, held.name) as name, coalesce(sets.segment, held.segment) as segment from held left join sets using (id)""")
def replayed_customers(spark, d):
    """SET-2 to SET-6: every order is a change to its customer, who is added, changed column by column, or removed."""
    people = read_table(spark, d, "customer").where("c_acctbal >= 0").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_mktsegment").alias("segment"))
    op = F.when(F.col("o_orderstatus") == "P", "remove").when(F.col("o_orderstatus") == "O", "put").when(F.col("o_orderstatus") == "F", "set")
    month = F.date_format(F.when(F.col("o_totalprice") > 200000, F.col("o_orderdate")), "yyyy-MM")
    log = read_table(spark, d, "orders").select(F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("seq"), op.alias("op"), F.col("o_orderpriority").alias("name"), month.alias("segment"))
    return state.replay(people, log)


@query("select user_id, event_id, event_type from (select *, row_number() over (partition by user_id order by ts, event_id) as n from events) where n = 1")
def stream_first_writes(spark, d):
    """SET-2 on a stream: all events, replayed in batches in no order of time."""
    path = _scratch(spark)
    events = read_table(spark, d, "events").select("user_id", "ts", "event_id", "event_type")
    events.repartition(8, "event_id").write.parquet(f"{path}/events")
    kept = FirstWrites(spark, f"{path}/first", "user_id", ["ts", "event_id"])
    kept.start(spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 3).parquet(f"{path}/events")).awaitTermination()
    return kept.read().select("user_id", "event_id", "event_type")


@query("""select cast(conv_id as varchar) as debate_id, role as "AttributedTo", row_number() over (partition by conv_id order by turn) - 1 as pos from conversations""")
def nested_debates(spark, d):
    """SRC-2, SRT-5: debates as nested JSON, in parts of at most 100 items in no order, read with two fields of the items."""
    turns = read_table(spark, d, "conversations")
    item = F.struct(F.xxhash64("conv_id", "turn").alias("mixed"), F.struct(F.concat_ws("-", "conv_id", "turn").alias("Id"), F.lit("Contribution").alias("ItemType"), F.col("text").alias("Value"), F.col("role").alias("AttributedTo"), F.col("turn").cast("int").alias("OrderIndex")).alias("item"))
    parts = turns.groupBy("conv_id", F.floor(F.col("turn") / 100).alias("part")).agg(F.sort_array(F.collect_list(item)).alias("items"))
    path = _scratch(spark)
    parts.select(F.struct(F.col("conv_id").cast("string").alias("Id")).alias("Overview"), F.col("items.item").alias("Items")).write.json(path)
    return documents.ordered_items(documents.read_debates(spark, path, ["AttributedTo"])).select("debate_id", "AttributedTo", "pos")
