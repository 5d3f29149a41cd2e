import hashlib

import pytest

from railmill.llm.common import Scratch
from railmill.llm.digest_index import DigestIndex, dedup_exact


@pytest.fixture
def index(spark):
    scratch = Scratch(spark, "digests")
    made = DigestIndex(spark, f"{scratch.path}/index", buckets=4)
    yield made, scratch
    made.close()


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def sha(text):
    return hashlib.sha256((text or "").encode()).hexdigest()


def test_batches_against_the_index(spark, documents, index):
    made, scratch = index
    one = rows_of(dedup_exact(documents([(1, "a"), (2, "a"), (3, "b"), (4, "A"), (5, "a ")]), made, scratch))
    assert one == sorted(
        [(1, 2, 2, False, sha("a")), (2, 2, 2, True, sha("a")), (3, 3, 1, True, sha("b")), (4, 4, 1, True, sha("A")), (5, 5, 1, True, sha("a "))],
        key=repr,
    )
    two = rows_of(dedup_exact(documents([(9, "a"), (8, "c"), (7, "c"), (0, "b")]), made, scratch))
    assert two == sorted(
        [(9, 2, 1, False, sha("a")), (8, 8, 2, True, sha("c")), (7, 8, 2, False, sha("c")), (0, 3, 1, False, sha("b"))], key=repr
    )
    assert made.table().count() == 5
    assert rows_of(dedup_exact(documents([]), made, scratch)) == [] and made.table().count() == 5


def test_an_index_is_opened_again(spark, documents, index):
    made, scratch = index
    dedup_exact(documents([(1, "a")]), made, scratch).collect()
    again = DigestIndex(spark, made.path, buckets=4)
    assert rows_of(dedup_exact(documents([(2, "a")]), again, scratch)) == [(2, 1, 1, False, sha("a"))]
    again.close()


def test_the_index_side_is_not_shuffled(spark, documents, index):
    made, scratch = index
    dedup_exact(documents([(i, f"t{i}") for i in range(50)]), made, scratch).collect()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        new = spark.range(10).selectExpr("unhex(sha2(cast(cast(id as string) as binary), 256)) as digest")
        plan = new.join(made.table().hint("merge"), "digest", "left_anti")._jdf.queryExecution().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in plan and plan.split("== Physical Plan ==")[1].count("Exchange hashpartitioning") == 1


def test_odd_rows(spark, odd_documents, index):
    made, scratch = index
    got = rows_of(dedup_exact(odd_documents, made, scratch))
    assert len(got) == odd_documents.count()
    by_text = {}
    for doc_id, keep_id, size, kept, digest in got:
        by_text.setdefault(digest, []).append((doc_id, keep_id, size, kept))
    assert sorted(by_text[sha("")], key=repr) == [(1, 2, 3, False), (2, 2, 3, True), (None, 2, 3, False)]
    assert sorted(by_text[sha("one two three four five six")]) == [(6, 6, 2, False), (6, 6, 2, True)]
    assert by_text[sha("a row without an id")] == [(None, None, 1, True)]
    assert all(sum(k for *_, k in rows) == 1 for rows in by_text.values())
