import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from railmill.llm import mixing
from railmill.llm.mixing import Mixture, mix_documents, splitting_tree, targets

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_targets_share_by_weight_below_the_ceiling():
    assert targets([], (1,), 1.5, 2) == []
    assert targets([10, 10], (1, 1), 1.5, 2) == [15, 15]
    # 36 words; the first wants 18 but stops at 4, the rest is shared 1 : 2, where the third stops at 20
    assert targets([2, 12, 10], (3, 1, 2), 1.5, 2) == [4, 12, 20]
    assert targets([0, 10], (3, 1), 1.5, 2) == [0, 15]
    assert targets([1, 1], (1, 1), 3, 2) == [2, 2]


def test_the_tree_deals_every_block_once(spark):
    quotas = [1000, 0, 37, 5]
    rows = splitting_tree(spark, quotas, 100, 7).collect()
    for sid, quota in enumerate(quotas):
        runs = sorted((r["start"], r["quota"]) for r in rows if r["sid"] == sid)
        assert [s for s, _ in runs] == list(np.cumsum([0, *[q for _, q in runs]])[:-1] if runs else [])
        assert sum(q for _, q in runs) == quota
    sizes = Counter()
    for r in rows:
        sizes[r["shard"]] += r["quota"]
    assert set(sizes.values()) <= {10, 11} and len(sizes) == 100
    assert splitting_tree(spark, quotas, 100, 7).exceptAll(spark.createDataFrame(rows)).count() == 0


def test_sources_meet_their_targets(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    rows = Mixture(docs).per_document().collect()
    text = {r["doc_id"]: (r["source"], len(WORD.findall(r["text"] or ""))) for r in docs.collect()}
    taken, size, target = defaultdict(int), defaultdict(int), {}
    for r in rows:
        source, n = text[r["doc_id"]]
        assert r["size"] == n and 0 <= r["taken"] <= 2 * n
        taken[source] += r["taken"]
        size[source] += n
        target[source] = (r["target"], r["source_size"])
    names = sorted(size)
    want = targets([size[s] for s in names], (3, 1, 2), 1.5, 2.0)
    for name, aim in zip(names, want):
        assert target[name] == (pytest.approx(aim), size[name])
        assert abs(taken[name] - aim) <= 0.5 + 1e-6 * aim
    # random order: it is not the first documents that are taken
    partly = [r for r in rows if r["size"] < r["taken"] < 2 * r["size"]]
    assert len(partly) <= len(names)


def test_reruns_agree(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    first = sorted(map(tuple, Mixture(docs).per_document().collect()))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "7")
        assert sorted(map(tuple, Mixture(docs.repartition(5)).per_document().collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_mixed_documents_hold_the_words_the_plan_takes(spark, small, monkeypatch):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    settings = {"block_words": 256, "shard_words": 4096}
    monkeypatch.setattr(mixing, "BUCKET_DOCS", 4)
    plan = {r["doc_id"]: r["taken"] for r in Mixture(docs, **settings).per_document().collect()}
    mixed = mix_documents(docs, **settings)
    assert mixed.columns == [*docs.columns, "mix_shard"]
    words, whole = Counter(), {r["doc_id"]: r["text"] for r in docs.collect()}
    rows = mixed.collect()
    for r in rows:
        assert whole[r["doc_id"]].startswith(r["text"]) and r["n_chars"] == len(r["text"])
        words[r["doc_id"]] += len(WORD.findall(r["text"]))
    assert {i: n for i, n in plan.items() if n} == dict(words)
    shards = Counter(r["mix_shard"] for r in rows)
    assert len(shards) > 5


def test_odd_rows(spark, odd_documents):
    rows = Mixture(odd_documents).per_document().collect()
    assert len(rows) == odd_documents.count()
    assert all(r["taken"] <= 2 * r["size"] for r in rows)
    # repeated rows are rows of their own
    assert sum(r["doc_id"] == 6 for r in rows) == 2
    mixed = mix_documents(odd_documents)
    assert mixed.columns == [*odd_documents.columns, "mix_shard"]
    assert sum(len(WORD.findall(r["text"])) for r in mixed.collect()) == sum(r["taken"] for r in rows)
    assert Mixture(odd_documents.limit(0)).per_document().collect() == []
    assert mix_documents(odd_documents.limit(0)).collect() == []


def test_names_of_other_columns_do_not_matter(spark, documents):
    rows = [(i, f"some words of text {i}") for i in range(60)]
    odd = {c: F.lit(i) for i, c in enumerate(("_id", "_h", "_source", "_n", "_sid", "_row", "_c", "_order", "_own", "a.b"))}
    docs = documents(rows).withColumns(odd)
    got = mix_documents(docs)
    assert got.columns == [*docs.columns, "mix_shard"]
    plain = mix_documents(documents(rows))
    assert sorted((r["doc_id"], r["text"]) for r in got.select("doc_id", "text").collect()) == sorted((r["doc_id"], r["text"]) for r in plain.collect())
    assert {tuple(r) for r in got.select("_id", "_order", "`a.b`").collect()} == {(0, 7, 9)}
