"""The operators over the test tables, as registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from shelfscout.llm import (
    chunk_dedup,
    divergence,
    html_extract,
    language_model,
    lexical_search,
    mixing,
    packing,
    quality,
    secrets,
    sharding,
    simhash,
    token_counts,
    topk,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _crc32(column: str) -> Column:
    return F.crc32(F.col(column).cast("string").cast("binary"))


def op1_context_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.score(table(spark, sf_dir, "documents"), held_out=_crc32("doc_id") % 7 == 2)
    return found.withColumnRenamed("id", "doc_id")


def op2_markov_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = secrets.scan(docs, secrets.train(secrets.samples(docs)))
    base = F.filter("spans", lambda s: s["kind"] != secrets.MODEL_KIND)
    counts = [
        F.size(secrets.of_kind("spans", kind)).cast("long").alias(f"n_{kind}")
        for kind in secrets.BASE_KINDS
    ]
    return found.select(
        F.col("id").alias("doc_id"),
        *counts,
        F.sha2(secrets.listed(base), 256).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, most=2)
    return found.select(
        F.col("id").alias("doc_id"),
        F.lower(F.lpad(F.hex("code"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op4_pivot_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, k=10)


def op5_viterbi_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("piece_bpe_32k.model")
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), path).withColumnRenamed("id", "doc_id")


def op6_chunk_recipe_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = chunk_dedup.chunk_dedup(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")


def op7_entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixing.mix(table(spark, sf_dir, "documents"), share=1.5, weights=(3, 1, 2), most=2.0)
    taken = (F.col("copies") * F.col("size")).alias("taken")
    return found.select(F.col("id").alias("doc_id"), "size", "source_size", "target", taken)


def op8_byte_prefix_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.byte_shards(table(spark, sf_dir, "documents"), shards=40)
    return found.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_power_of_two_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    found = packing.decompose(table(spark, sf_dir, "documents"), path, longest=1024, end_id=0)
    return found.select(
        F.col("id").alias("doc_id"),
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        F.col("sequence").alias("sequence_id"),
        "offset",
    )


def op10_nbsvm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(_crc32("doc_id") % 5 == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents")
    model = quality.train(docs, table(spark, sf_dir, "labels"), usable=~held_out)
    scored = quality.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.3).cast("int").alias("predicted")
    )


def op11_maximum_subsequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return html_extract.extract(pages, html_extract.train(pages)).withColumnRenamed("id", "page_id")


def op12_count_level_bitmaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"), least_docs=3, most_terms=200)


def op13_aho_corasick_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)
    return found.withColumnRenamed("id", "doc_id")


REGISTRY: dict[str, Query] = {
    query.__name__: query
    for query in (
        op1_context_mixing,
        op2_markov_secrets,
        op3_simhash_near_dedup,
        op4_pivot_top_k,
        op5_viterbi_counts,
        op6_chunk_recipe_dedup,
        op7_entropy_mixing,
        op8_byte_prefix_shards,
        op9_power_of_two_packing,
        op10_nbsvm_quality,
        op11_maximum_subsequence,
        op12_count_level_bitmaps,
        op13_aho_corasick_search,
    )
}

# White space as everywhere in this subpackage; a regular expression of DuckDB's.
_STRIPPED = r"regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')"
_TERMS = rf"regexp_extract_all({_LOWER}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op4_pivot_top_k": """
        with vectors as (
            select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v from embeddings
            where vec_id is not null and embedding is not null
                and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
        )
        select q.vec_id as query_id,
            (row_number() over (partition by q.vec_id order by list_inner_product(q.v, c.v) desc, c.vec_id))::int as rank,
            c.vec_id, list_inner_product(q.v, c.v)::bigint as score
        from vectors q join vectors c on q.vec_id != c.vec_id and len(q.v) = len(c.v)
        where q.vec_id % 100 = 0 qualify rank <= 10
    """,
    "op6_chunk_recipe_dedup": f"""
        with texts as (
            select doc_id, length(coalesce(text, '')) as points, {_STRIPPED} as stripped from documents
        ), ranked as (
            select doc_id, stripped,
                row_number() over w as place,
                first_value(doc_id) over w as keep_id,
                count(*) over (partition by stripped) as group_size
            from texts window w as (partition by stripped order by points desc, doc_id nulls last)
        )
        select doc_id, keep_id, group_size, place = 1 as kept, sha256(stripped) as text_sha256 from ranked
    """,
    "op12_count_level_bitmaps": f"""
        with read as (
            select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, text
            from documents
        ), words as (
            select row, lang, source, unnest({_WORDS}) as term from read
        ), kept as (
            select lang, term, count(*) as total from words group by all having count(distinct row) >= 3
        ), langs as (
            select lang, count(*) as terms, (count(*) + sum(total))::bigint as divisor from kept group by lang
        ), groups as (
            select distinct lang, source from read
        ), counts as (
            select lang, source, term, count(*) as count from words group by all
        ), filled as (
            select lang, source, term, total, coalesce(count, 0) as count,
                (sum(coalesce(count, 0)) over (partition by lang, source) + terms)::bigint as own, divisor
            from groups join kept using (lang) join langs using (lang) left join counts using (lang, source, term)
        ), shares as (
            select lang, source, term, count, 1 + (1000000000 * (count + 1)) // own as p,
                1 + (1000000000 * (total + 1)) // divisor as q
            from filled
        ), pairs as (
            select a.lang, a.source, b.source as item, sum(((a.p - b.p) * (a.p - b.p)) // b.p)::bigint as value
            from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source != b.source group by all
            union all
            select lang, a.source, b.source, 0 from groups a join groups b using (lang)
            where a.source != b.source and lang not in (select lang from langs)
        ), valued as (
            select lang, source, 'pair' as part, item, value from pairs
            union all
            select lang, source, 'term', term, ((p - q) * (p - q)) // q from shares where count > 0 and p > q
        )
        select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank
        from valued qualify part = 'pair' or rank <= 200
    """,
    "op13_aho_corasick_search": f"""
        with occurring as (
            select doc_id, term, count(*) as tf
            from (select doc_id, unnest({_TERMS}) as term from documents) group by all
        ), lengths as (
            select doc_id, sum(tf)::bigint as n from occurring group by doc_id
        ), corpus as (
            select count(*) as documents, sum(n)::bigint as terms from lengths
        ), weights as (
            select term, floor(1000 * ln((2 * any_value(documents) + 2)::double / (2 * count(*) + 1)))::bigint as w
            from occurring, corpus group by term
        ), asked as (
            select distinct item_id, unnest({_TERMS}) as term from benchmark
        ), scored as (
            select item_id, doc_id,
                sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * documents) // terms))))::bigint as score
            from asked join occurring using (term) join lengths using (doc_id) join weights using (term), corpus
            group by item_id, doc_id
        )
        select item_id, row_number() over (partition by item_id order by score desc, doc_id)::int as rank, doc_id, score
        from scored where score > 0 qualify rank <= 10
    """,
}
