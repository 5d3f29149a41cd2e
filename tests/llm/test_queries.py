"""Registered queries: columns and types of their contracts, and equality with SQL where SQL can say it."""

import pytest

from railmill.llm.queries import ORACLE, QUERIES

COLUMNS = {
    "op1_url_filter": "page_id:bigint host:string path:string rule:string verdict:string",
    "op2_minhash_neardup": "doc_id:bigint n_shingles:bigint component_id:bigint kept:boolean",
    "op3_source_mix": "doc_id:bigint size:bigint source_size:bigint target:double taken:bigint",
    "op4_toxicity": "doc_id:bigint held_out:boolean score:double predicted:int n_passages:int",
    "op5_quality": "doc_id:bigint held_out:boolean score:double predicted:int",
    "op6_exact_top_k": "query_id:bigint rank:int vec_id:bigint score:bigint",
    "op7_language_id": "doc_id:bigint held_out:boolean lang_pred:string score:double rejected:boolean",
    "op8_line_dedup": "doc_id:bigint n_lines:int n_left:int emptied:boolean text_sha256:string",
    "op9_exact_dedup": "doc_id:bigint keep_id:bigint group_size:bigint kept:boolean text_sha256:string",
    "op10_sentencepiece": "doc_id:bigint n_ids:bigint ids_sha256:string restored:boolean",
    "op11_conversation_repair": "conv_id:bigint gaps:bigint blank:bigint duplicate:bigint truncated:bigint illegal:bigint cost:bigint audit:string repaired_sha256:string",
    "op12_hard_negatives": "anchor_id:bigint positive_id:bigint rank:int negative_id:bigint positive_score:bigint negative_score:bigint",
    "op13_sharding": "doc_id:bigint size:bigint text_crc32:bigint law:string shard:int slot:bigint grown_shard:int home_shard:int",
    "pipeline": "doc_id:bigint lang:string source:string n_ids:bigint ids:array<int>",
}


def test_all_are_registered():
    assert sorted(QUERIES) == sorted(COLUMNS)


@pytest.mark.parametrize("name", sorted(COLUMNS))
def test_columns(spark, small, name):
    df = QUERIES[name](spark, small)
    assert " ".join(f"{c}:{t}" for c, t in df.dtypes) == COLUMNS[name]


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_equals_sql(spark, small, twin, name):
    df = QUERIES[name](spark, small)
    expected = twin.sql(ORACLE[name])
    assert sorted(df.columns) == sorted(expected.columns)
    names = sorted(df.columns)
    got = sorted((tuple(r[c] for c in names) for r in df.collect()), key=repr)
    at = [expected.columns.index(c) for c in names]
    assert got == sorted((tuple(r[i] for i in at) for r in expected.fetchall()), key=repr)
    assert got


@pytest.mark.parametrize("name", ["op2_minhash_neardup", "op3_source_mix", "op4_toxicity", "op5_quality", "op7_language_id", "op8_line_dedup", "op10_sentencepiece", "op13_sharding"])
def test_one_row_per_document(spark, small, name):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    got = sorted(r["doc_id"] for r in QUERIES[name](spark, small).select("doc_id").collect())
    assert got == sorted(r["doc_id"] for r in docs.select("doc_id").collect())
