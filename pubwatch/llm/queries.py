"""The training-data queries: each operator over its whole table, with production parameters."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pubwatch.llm import (
    byte_bpe,
    conversations,
    cover_tree,
    exact_dedup,
    fill_middle,
    html_text,
    mixing,
    near_dup,
    prefix_forest,
    repeats,
    token_counts,
    toxicity,
    warc,
)
from pubwatch.llm.common import materialise, new_path

Query = Callable[[SparkSession, str], DataFrame]

_queries: dict[str, Query] = {}
_oracles: dict[str, str] = {}


def query(fn: Query) -> Query:
    _queries[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_queries)


def all_oracles() -> dict[str, str]:
    return dict(_oracles)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


BPE_RANKS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
BPE_PATTERN = public_tokenizers.PATTERN
PIECES = public_tokenizers.path("piece_bpe_32k.model")
TOKEN_LIMIT = 4096


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), PIECES)
    return counted.withColumn("over_limit", F.col("n_tokens") > TOKEN_LIMIT)


@query
def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


_oracles["op2_top_k"] = """
    with v as (
      select vec_id, list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as q
      from embeddings
      where vec_id is not null and embedding is not null
        and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
    ), s as (
      select a.vec_id as query_id, b.vec_id,
             cast(list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2])) as bigint) as score
      from (select * from v where vec_id % 100 = 0) a join v b on a.vec_id <> b.vec_id
    )
    select query_id, cast(rnk as integer) as rank, vec_id, score
    from (select *, row_number() over (partition by query_id order by score desc, vec_id) as rnk from s)
    where rnk <= 10
"""


@query
def op3_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = new_path(spark, "warc")
    index = materialise(warc.write_archives(table(spark, sf_dir, "pages"), root), "warc-index")
    records = warc.read_records(index, root)
    return records.select(
        F.col("id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


_oracles["op3_warc"] = """
    with p as (
      select page_id, cast(octet_length(encode(coalesce(html, ''))) as bigint) as payload_bytes,
             sha1(coalesce(html, '')) as hex
      from pages
    ), d as (
      select page_id, payload_bytes,
             array_to_string(list_transform(range(0, 32), lambda i: substr(
               'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
               ((cast('0x' || substr(hex, cast(i // 4 * 5 + 1 as bigint), 5) as bigint)
                 >> cast(15 - 5 * (i % 4) as bigint)) & 31) + 1, 1)), '') as payload_digest
      from p
    ), g as (
      select payload_digest, payload_bytes, min(page_id) as first_id from d group by all
    )
    select page_id, payload_bytes, payload_digest,
           case when page_id = first_id then 'response' else 'revisit' end as record_type,
           case when page_id <> first_id then first_id end as refers_to
    from d join g using (payload_digest, payload_bytes)
"""


@query
def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(table(spark, sf_dir, "documents"), keep="largest")


_oracles["op4_exact_dedup"] = """
    with t as (
      select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                               'abcdefghijklmnopqrstuvwxyz') as norm from documents
    ), g as (select norm, max(doc_id) as keep_id, count(*) as group_size from t group by norm)
    select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept,
           sha256(t.norm) as text_sha256
    from t join g on t.norm = g.norm
"""


@query
def op5_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    digest = F.md5(F.coalesce(F.col("text"), F.lit(""))).alias("digest")
    sized = docs.select("doc_id", "source", mixing.word_count(F.col("text")).alias("size"), digest)
    mixed = mixing.mix(sized, size=F.col("size"), salt=F.col("digest"))
    taken = (F.col("size") * F.col("copies")).alias("taken")
    return mixed.select("row.doc_id", "size", "source_size", "target", taken)


_oracles["op5_mix_sources"] = r"""
    with d as (
      select doc_id, source,
             cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
             coalesce(cast(doc_id as varchar), '') || '|' || md5(coalesce(text, '')) as sid,
             (cast(cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), '') || '|'
                || md5(coalesce(text, '')) || '|mix-1'), 1, 13) as bigint) as double) + 0.5)
              / 4503599627370496.0 as u
      from documents
    ), s as (
      select source, cast(sum(size) as bigint) as source_size,
             [5, 2, 1][(row_number() over (order by source nulls last) - 1) % 3 + 1] as w
      from d group by source
    ), o as (
      select *, 1.5::double * sum(source_size) over () as total,
             coalesce(sum(source_size) over (order by source_size / w, source nulls last
               rows between unbounded preceding and 1 preceding), 0) as held,
             coalesce(sum(w) over (order by source_size / w, source nulls last
               rows between unbounded preceding and 1 preceding), 0) as gone,
             sum(w) over () as all_w
      from s
    ), c as (
      select *, (total - 2.0::double * held) * w / (all_w - gone) >= 2 * source_size as capped from o
    ), r as (
      select max(total) - 2.0::double * coalesce(sum(source_size) filter (where capped), 0) as rest,
             cast(sum(w) filter (where not capped) as double) as open_w from c
    ), t as (
      select source, source_size, case when capped then 2.0::double * source_size
             else cast(rest as double) * w / open_w end as target from c, r
    ), e as (
      select d.*, t.source_size, t.target,
             least(case when t.source_size > 0 then t.target / t.source_size else 0 end, 2) as ratio
      from d join t on d.source is not distinct from t.source
    ), q as (
      select *, cast(floor(ratio) as bigint) as whole,
             case when ratio - floor(ratio) > 0
               then (u / (1 - u)) / ((ratio - floor(ratio)) / (1 - (ratio - floor(ratio))))
               else 'inf'::double end as rnk from e
    ), k as (
      select *, coalesce(sum(size) over (partition by source order by rnk, doc_id nulls first, size, sid
               rows between unbounded preceding and 1 preceding), 0) as earlier,
             target - sum(whole * size) over (partition by source) as rest from q
    )
    select doc_id, size, source_size, target,
           cast(size * (whole + case when whole < 2 and ratio > whole and 2 * earlier + size <= 2 * rest
                        then 1 else 0 end) as bigint) as taken
    from k
"""


@query
def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages"))


@query
def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe_digests(table(spark, sf_dir, "documents"))


def byte_bpe_digests(docs: DataFrame) -> DataFrame:
    coded = byte_bpe.encode_decode(docs, BPE_RANKS, BPE_PATTERN)
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query
def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links")


@query
def op9_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = repeats.remove_repeats(table(spark, sf_dir, "documents"))
    return cleaned.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


EMPTY_SHA256 = hashlib.sha256().hexdigest()


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations")
    result = conversations.repair(conversations.damage(rows))
    digests = conversations.digests(result.rows)
    all_ids = rows.select("conv_id").distinct()
    report, sums = result.report.alias("r"), digests.alias("d")
    joined = all_ids.alias("a").join(report, F.col("a.conv_id").eqNullSafe(F.col("r.conv_id")), "left")
    joined = joined.join(sums, F.col("a.conv_id").eqNullSafe(F.col("d.conv_id")), "left")
    numbers = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return joined.select(
        "a.conv_id",
        *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in numbers],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(EMPTY_SHA256)).alias("repaired_sha256"),
    )


@query
def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"))
    return fill_middle.restore(made).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        F.sha2("output", 256).alias("output_sha256"),
        F.sha2("text", 256).alias("restored_sha256"),
    )


_oracles["op12_fill_middle"] = """
    with d as (
      select doc_id, coalesce(text, '') as t, cast(length(coalesce(text, '')) as bigint) as n,
             sha256('1:' || coalesce(cast(doc_id as varchar), '')) as h
      from documents
    ), c as (
      select *, cast('0x' || substr(h, 1, 8) as bigint) % (n + 1) as a,
             cast('0x' || substr(h, 9, 8) as bigint) % (n + 1) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>')
                    or cast('0x' || substr(h, 17, 8) as bigint) % 100 >= 90 then 'plain'
                  when cast('0x' || substr(h, 25, 8) as bigint) % 100 < 20 then 'spm' else 'psm' end as form
      from d
    ), p as (
      select *, substr(t, 1, least(a, b)) as pre, substr(t, least(a, b) + 1, abs(a - b)) as mid,
             substr(t, greatest(a, b) + 1) as suf
      from c
    )
    select doc_id, n, form,
           case when form <> 'plain' then least(a, b) end as prefix_chars,
           case when form <> 'plain' then abs(a - b) end as middle_chars,
           sha256(case form when 'plain' then t
                    when 'psm' then '<P>' || pre || '<S>' || suf || '<M>' || mid
                    else '<S>' || suf || '<P>' || pre || '<M>' || mid end) as output_sha256,
           sha256(t) as restored_sha256
    from p
"""


@query
def op13_nearest_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_forest.search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
