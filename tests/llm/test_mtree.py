import numpy as np
import pytest
from pyspark.sql import functions as F

from railmill.llm import mtree
from railmill.llm.mtree import top_k


def brute(rows, k, every):
    usable = []
    for i, v in rows:
        if i is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        usable.append((i, [int(np.floor(1024.0 * x)) for x in v]))
    out = []
    queries = {}
    for i, v in usable:
        if i % every == 0:
            queries[i] = min(queries.get(i, v), v)
    for q, v in queries.items():
        scores = sorted((-sum(a * b for a, b in zip(v, w)), i) for i, w in usable if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scores[:k], 1)]
    return sorted(out)


def found(spark, rows, k=10, every=10):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("rank", F.lit("clash"))
    return sorted(map(tuple, top_k(df, F.col("id") % every == 0, k).collect()))


def f32(v):
    return [float(np.float32(x)) for x in v]


@pytest.mark.parametrize("page_rows,node_rows,share", [(2048, 64, 4096), (40, 4, 3)])
def test_equals_brute_force(spark, monkeypatch, page_rows, node_rows, share):
    monkeypatch.setattr(mtree, "PAGE_ROWS", page_rows)
    monkeypatch.setattr(mtree, "NODE_ROWS", node_rows)
    monkeypatch.setattr(mtree, "SHARE_QUERIES", share)
    rng = np.random.default_rng(2)
    centres = rng.normal(size=(7, 12))
    rows = [(i, f32(centres[i % 7] + 0.3 * rng.normal(size=12))) for i in range(600)]
    rows += [(1000 + i, rows[5][1]) for i in range(150)]  # one vector many times: ties
    rows += [(2000 + i, f32(3 * rng.normal(size=12))) for i in range(30)]
    assert found(spark, rows) == brute(rows, 10, 10)


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0]), (10, [1.0, 2.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]),
        (None, [9.0, 9.0]), (5, [0.5]), (6, []), (7, [1.0, 2.0, 3.0]), (8, [-0.0004, 0.0]), (8, [-0.0004, 0.0]), (20, [0.1, -0.1]),
    ]
    assert found(spark, rows, k=3) == brute(rows, 3, 10)
    assert found(spark, rows, k=50) == brute(rows, 50, 10)
    assert found(spark, [(0, [1.0])]) == []
    assert found(spark, []) == []
    assert found(spark, [(1, None)]) == []
    assert found(spark, [(0, [0.0, 0.0]), (1, [0.0, 0.0])]) == [(0, 1, 1, 0)]


def test_bounds_save_distance_computations():
    rng = np.random.default_rng(8)
    vectors = np.floor(1024 * (rng.normal(size=(20, 8))[np.arange(2000) % 20] * 4 + 0.05 * rng.normal(size=(2000, 8))))
    space = mtree.Space(8, float((vectors**2).sum(axis=1).max()))
    page = mtree.Page(space, np.arange(2000), vectors)
    seen = []
    visit = page._visit
    page._visit = lambda at, some, *rest: (seen.append(len(some)), visit(at, some, *rest))
    ids, scores = page.search(np.arange(50), vectors[:50], np.full(50, mtree._LOW), 5)
    assert sum(seen) < 50 * len(page.routing) / 2
    want = vectors[:50] @ vectors.T
    want[np.arange(50), np.arange(50)] = -np.inf
    assert (scores == -np.sort(-want, axis=1)[:, :5]).all()
