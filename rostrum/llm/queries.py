"""The registered queries of this subpackage and their SQL, where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import audit, fingerprints, langid, leaks, mixing, near, negatives, packing, quality, repeats, secrets, sharding, topk
from .common import id_crc, table


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shards(table(spark, sf_dir, "documents"), n_shards=8)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op2_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = topk.quantized(table(spark, sf_dir, "embeddings"))
    return topk.top_k(vectors, F.col("vec_id") % 50 == 0, k=5)


def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near.near_join(table(spark, sf_dir, "documents")).drop("class_hash")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    both = fingerprints.with_next(fingerprints.fingerprints(docs, out="packed"), ["text", "packed"])
    n = F.length("text")
    cut = F.floor(n / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), n - cut), F.substring("next_text", F.lit(1), cut))
    both = fingerprints.fingerprints(both.select("doc_id", n.cast("long").alias("n_chars"), "packed", "next_packed", edited.alias("edited")), "edited", "packed_edited")
    packed, packed_edited = F.col("packed"), F.col("packed_edited")
    return both.select(
        "doc_id",
        "n_chars",
        F.sha2("edited", 256).alias("edited_sha256"),
        F.lower(F.hex(packed)).alias("fingerprint"),
        F.lower(F.hex(packed_edited)).alias("edited_fingerprint"),
        fingerprints.likeness(packed, packed_edited).alias("near_edited"),
        fingerprints.likeness(packed, F.col("next_packed")).alias("near_next"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = langid.train(docs.select("doc_id", "text", "lang"), id_crc() % 3 != 1)
    return langid.predict(docs.select("doc_id", (id_crc() % 3 == 1).alias("held_out"), "text"), model).drop("text")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), packing.public_tokenizer)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents"))


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents").select("doc_id", "source", "text")).drop("text")


def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), id_crc() % 5 != 0)
    scored = quality.score(docs.select("doc_id", (id_crc() % 5 == 0).alias("held_out"), "text"), model, out="score")
    return scored.select("doc_id", "held_out", "score", (F.col("score") >= 0.3).cast("int").alias("predicted"))


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("path"), "text")
    found = secrets.scan(docs, secrets.train(spark, secrets.statistics(docs)))
    return found.select("doc_id", "start", "length", F.sha2("value", 256).alias("value_sha256"), "score")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label").cast("long") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(negatives.quantized(table(spark, sf_dir, "embeddings"), label), F.col("vec_id") % 100 == 0)


def op13_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = leaks.scan(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    names = F.array_sort(F.col("items").cast("array<string>"))
    return found.select(
        "doc_id",
        F.col("n_words").cast("long").alias("n_words"),
        leaks.n_hit(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join(names, ","), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sharding": op1_sharding,
    "op2_exact_top_k": op2_exact_top_k,
    "op3_ngram_jaccard_join": op3_ngram_jaccard_join,
    "op4_fingerprints": op4_fingerprints,
    "op5_language_id": op5_language_id,
    "op6_packing": op6_packing,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_source_mixing": op8_source_mixing,
    "op9_quality_classifier": op9_quality_classifier,
    "op10_secret_scan": op10_secret_scan,
    "op11_filter_audit": op11_filter_audit,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_benchmark_decontamination": op13_benchmark_decontamination,
}
ORACLES: dict[str, str] = {
    "op2_exact_top_k": """
        with v as (
            select vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and vec_id is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select q.vec_id as query_id, c.vec_id,
                   cast(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from v q join v c on q.vec_id % 50 = 0 and q.vec_id <> c.vec_id
        ), ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored
        )
        select query_id, cast(rank as integer) as rank, vec_id, score from ranked where rank <= 5
    """,
    "op3_ngram_jaccard_join": r"""
        with recursive w as (
            select doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '\s+'), lambda x: x <> '') as w from documents
        ), sh as (
            select distinct doc_id, array_to_string(list_slice(w, i, i + 4), ' ') as s
            from w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(i) where len(w) > 0
        ), n as (
            select w.doc_id, count(s) as n from w left join sh on sh.doc_id = w.doc_id group by 1
        ), met as (
            select a.doc_id as a, b.doc_id as b, count(*) as k from sh a join sh b on a.s = b.s and a.doc_id <> b.doc_id group by 1, 2
            union all
            select a.doc_id, b.doc_id, 0 from n a join n b on a.n = 0 and b.n = 0 and a.doc_id <> b.doc_id
        ), links as (
            select a, b, k = x.n and k = y.n as same from met join n x on x.doc_id = a join n y on y.doc_id = b where 5 * k >= 4 * (x.n + y.n - k)
        ), reach(a, b) as (
            select doc_id, doc_id from w
            union
            select reach.a, links.b from reach join links on links.a = reach.b
        ), class as (
            select a, min(b) as class_id from reach group by a
        ), own as (
            select a, count(*) as n_links, min(b) filter (where same) as twin from links group by a
        )
        select doc_id, class_id, least(doc_id, coalesce(twin, doc_id)) as set_id, coalesce(n_links, 0) as n_links
        from w join class on class.a = doc_id left join own on own.a = doc_id
    """,
    "op7_substring_dedup": r"""
        with w as (
            select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
        ), win as (
            select doc_id, i, md5(array_to_string(list_slice(w, i, i + 12), ' ')) as h from w, unnest(range(1, len(w) - 11)) t(i)
        ), first as (
            select h, min(doc_id) as low from win group by h
        ), gone as (
            select distinct doc_id, i + k as pos from win join first using (h), range(13) r(k) where doc_id > low
        ), word as (
            select w.doc_id, i as pos, w.w[i] as word, gone.pos is not null as removed
            from w, unnest(range(1, len(w.w) + 1)) t(i) left join gone on gone.doc_id = w.doc_id and gone.pos = i
        ), kept as (
            select doc_id, count(*) filter (where removed) as n_removed, string_agg(word, ' ' order by pos) filter (where not removed) as kept from word group by 1
        )
        select doc_id, cast(len(w) as bigint) as n_words, coalesce(n_removed, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
        from w left join kept using (doc_id)
    """,
    "op11_filter_audit": r"""
        with t as (
            select doc_id, coalesce(source, '') as part, coalesce(text, '') as text from documents
        ), w as (
            select *, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as words, min(doc_id) over (partition by text) as low from t
        ), mask as (
            select w.doc_id, part,
                   cast(len(words) < 50 as int) + 2 * cast(100 * len(list_distinct(words)) < 65 * len(words) as int)
                   + 4 * cast(100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 5 * length(text) as int)
                   + 8 * cast(regexp_matches(text, '[#$%&*|]') as int) + 16 * cast(coalesce(doc_id > low, false) as int) as mask
            from w
        ), l as (
            select doc_id, max(cast(coalesce(quality = 1, false) as int)) as good, max(cast(coalesce(toxic = 1, false) as int)) as toxic from labels group by 1
        ), n as (
            select part, mask, count(*) as n, sum(coalesce(good, 0)) as good, sum(coalesce(toxic, 0)) as toxic from mask left join l using (doc_id) group by 1, 2
        ), f(i, f) as (
            values (0, 'A'), (1, 'B'), (2, 'C'), (3, 'D'), (4, 'E')
        ), o as (
            select a.f || b.f || c.f || d.f || e.f as filter_order
            from f a join f b on b.i <> a.i join f c on c.i not in (a.i, b.i) join f d on d.i not in (a.i, b.i, c.i) join f e on e.i not in (a.i, b.i, c.i, d.i)
        ), s as (
            select filter_order, step, cast(pow(2, f.i) as int) as bit,
                   coalesce(list_sum(list_transform(range(1, step), lambda k: cast(pow(2, strpos('ABCDE', filter_order[k]) - 1) as int))), 0) as before
            from o, range(1, 6) r(step) join f on f.f = filter_order[step]
        ), x as (
            select part, filter_order, step, bit,
                   sum(n) filter (where mask & bit = 0 and mask & cast(before as int) = 0) as kept,
                   sum(n) filter (where mask & bit > 0 and mask & cast(before as int) = 0) as removed,
                   sum(n) filter (where mask & bit > 0 and mask & cast(before as int) > 0) as redundant,
                   sum(n) filter (where mask = bit) as unique_fails,
                   sum(good) filter (where mask & bit > 0 and mask & cast(before as int) = 0) as good_lost,
                   sum(toxic) filter (where mask & bit > 0 and mask & cast(before as int) = 0) as toxic_lost
            from n, s group by all
        )
        select part, filter_order, cast(step as int) as step, cast(coalesce(kept, 0) as bigint) as kept, cast(coalesce(removed, 0) as bigint) as removed,
               cast(coalesce(redundant, 0) as bigint) as redundant, cast(coalesce(unique_fails, 0) as bigint) as unique_fails,
               cast(coalesce(good_lost, 0) as bigint) as good_lost, cast(coalesce(toxic_lost, 0) as bigint) as toxic_lost,
               cast(coalesce(sum(removed) over (partition by part, bit), 0) as bigint) as shapley
        from x
    """,
    "op12_hard_negatives": """
        with v as (
            select vec_id, case when vec_id % 7 = 0 then (cast(label as bigint) + 1) % 10 else label end as label,
                   list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
            from embeddings
            where embedding is not null and vec_id is not null and label is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        ), scored as (
            select distinct a.vec_id as anchor_id, c.vec_id, a.label = c.label as alike,
                   cast(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) as bigint) as score
            from v a join v c on a.vec_id % 100 = 0 and a.vec_id <> c.vec_id and len(a.v) = len(c.v)
        ), p as (
            select anchor_id, vec_id as positive_id, score as positive_score from scored where alike
            qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5
        ), n as (
            select p.*, s.vec_id as negative_id, s.score as negative_score,
                   row_number() over (partition by anchor_id, positive_id order by s.score desc, s.vec_id) as rank
            from p join scored s using (anchor_id)
            where not alike and 30 * positive_score <= 100 * s.score and 100 * s.score <= 90 * positive_score
        )
        select anchor_id, positive_id, cast(rank as int) as rank, negative_id, positive_score, negative_score from n where rank <= 10
    """,
    "op13_benchmark_decontamination": r"""
        with d as (
            select row_number() over () as row, doc_id,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from documents
        ), b as (
            select item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
            from benchmark
        ), g as (
            select distinct item_id, least(len(w), 10) as n, list_slice(w, i, i + least(len(w), 10) - 1) as gram
            from b, unnest(range(1, len(w) - least(len(w), 10) + 2)) t(i) where len(w) > 0
        ), win as (
            select row, i, n, list_slice(w, i, i + n - 1) as gram from d, (select distinct n from g) l, unnest(range(1, len(w) - n + 2)) t(i)
        ), hit as (
            select row, i, win.n, item_id from win join g on win.n = g.n and win.gram = g.gram
        ), word as (
            select row, count(distinct i + k) as n_hit from (select distinct row, i, n from hit) h, unnest(range(0, n)) t(k) group by 1
        ), named as (
            select row, count(*) as n_items, string_agg(cast(item_id as varchar), ',' order by cast(item_id as varchar)) as names
            from (select distinct row, item_id from hit where item_id is not null) group by 1
        )
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(names, '')) as items_sha256,
               coalesce(n_hit, 0) > 0 as contaminated
        from d left join word using (row) left join named using (row)
    """,
}
