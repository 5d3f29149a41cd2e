"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from railmill.llm import conversations, digest_index, gnat, langid, linededup, mixing, mtree, neardup, quality
from railmill.llm import sentencepieces, sharding, toxicity, url_filter
from railmill.llm.oracles import CONVERSATIONS_SQL, NEGATIVES_SQL, SHARDS_SQL
from railmill.llm.common import Scratch, partitions, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


URL_RULES = [
    url_filter.Rule("org", "/", "allow"),
    url_filter.Rule("example.org", "/es/", "block"),
    url_filter.Rule("example.org", "/en/1", "block"),
    url_filter.Rule("com", "/fr/", "allow"),
    url_filter.Rule("com", "/de/", "block"),
]

URL_SQL = r"""
with rest as (
    select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest
    from pages
), split as (
    select page_id,
           translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
           regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path
    from rest
), fits as (
    select *,
           host = 'org' or ends_with(host, '.org') as in_org,
           host = 'example.org' or ends_with(host, '.example.org') as in_example,
           host = 'com' or ends_with(host, '.com') as in_com
    from split
), decided as (
    select *, case
        when in_example and starts_with(path, '/en/1') then 'example.org/en/1'
        when in_example and starts_with(path, '/es/') then 'example.org/es/'
        when in_org and starts_with(path, '/') then 'org/'
        when in_com and starts_with(path, '/fr/') then 'com/fr/'
        when in_com and starts_with(path, '/de/') then 'com/de/'
    end as rule
    from fits
)
select page_id, host, path, rule,
       case when rule in ('example.org/en/1', 'example.org/es/', 'com/de/') then 'block' else 'allow' end as verdict
from decided
"""


@query("op1_url_filter", URL_SQL)
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


@query("op2_minhash_neardup")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


@query("op3_source_mix")
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.Mixture(table(spark, sf_dir, "documents"), weights=(3, 1, 2), share=1.5, ceiling=2.0).per_document()


@query("op4_toxicity")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = toxicity.score_toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return scored.select("doc_id", "held_out", "score", "predicted", F.size("passages").alias("n_passages"))


@query("op5_quality")
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score_quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), threshold=0.3)


@query(
    "op6_exact_top_k",
    """
with v as (
    select vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
    from embeddings
    where vec_id is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), scored as (
    select q.vec_id as query_id, c.vec_id, list_dot_product(q.v, c.v)::bigint as score
    from v q join v c on q.vec_id <> c.vec_id
    where q.vec_id % 100 = 0
)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score
from scored
qualify rank <= 10
""",
)
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0, k=10)


@query("op7_language_id")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict_language(table(spark, sf_dir, "documents"))


@query("op8_line_dedup")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = linededup.dedup_lines(table(spark, sf_dir, "documents"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256")
    return left.select("doc_id", "n_lines", "n_left", "emptied", digest)


@query(
    "op9_exact_dedup",
    """
with d as (select doc_id, sha256(coalesce(text, '')) as text_sha256 from documents)
select doc_id,
       max(doc_id) over (partition by text_sha256) as keep_id,
       count(*) over (partition by text_sha256) as group_size,
       doc_id = max(doc_id) over (partition by text_sha256) as kept,
       text_sha256
from d
""",
)
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents against an index that is empty before."""
    scratch = Scratch(spark, "digests")
    index = digest_index.DigestIndex(spark, f"{scratch.path}/index", buckets=partitions(spark))
    result = digest_index.dedup_exact(table(spark, sf_dir, "documents"), index, scratch)
    index.close()  # the result reads stored steps, not the index
    return result


@query("op10_sentencepiece")
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = sentencepieces.load_vocabulary(corpus_pipeline.VOCABULARY)
    return sentencepieces.round_trip(table(spark, sf_dir, "documents"), vocabulary)


@query("op11_conversation_repair", CONVERSATIONS_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    whole = table(spark, sf_dir, "conversations")
    return conversations.repair_report(conversations.damaged(whole), every=whole)


@query("op12_hard_negatives", NEGATIVES_SQL)
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return gnat.mine_hard_negatives(rows.withColumn("label", label), F.col("id") % 100 == 0)


@query("op13_sharding", SHARDS_SQL)
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.assign_shards(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), F.col("home").alias("home_shard"),
    )


query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)
