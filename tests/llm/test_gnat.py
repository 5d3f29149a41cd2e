"""Hard negatives against all scores, and what the stored ranges save."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railmill.llm import gnat
from railmill.llm.gnat import Page, Ring, mine_hard_negatives
from railmill.llm.mtree import Space


def brute(rows, every=10, positives=5, negatives=10):
    usable = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[i, label, tuple(int(np.floor(256.0 * x)) for x in v)] = None
    anchors = {}
    for i, label, v in usable:
        if i % every == 0:
            anchors[i] = min(anchors.get(i, (v, label)), (v, label))
    out = []
    for a, (v, label) in anchors.items():
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, own == label) for i, own, w in usable if i != a)
        for p, i, _ in [s for s in scored if s[2]][:positives]:
            fits = [s for s in scored if not s[2] and 30 * -p <= 100 * -s[0] <= 90 * -p][:negatives]
            out += [(a, i, n, j, -p, -s) for n, (s, j, _) in enumerate(fits, 1)]
    return sorted(out)


def found(spark, rows, every=10, **more):
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    df = df.withColumns({c: F.lit("clash") for c in ("id", "v", "node", "page", "rank", "score", "lows")})
    return sorted(map(tuple, mine_hard_negatives(df, F.col("id") % every == 0, **more).collect()))


def f32(v):
    return [float(np.float32(x)) for x in v]


def made(seed, n, dim, clusters=9, spread=0.5):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(clusters, dim))
    return [(i, f32(centres[i % clusters] + spread * rng.normal(size=dim)), int(rng.integers(4))) for i in range(n)]


@pytest.mark.parametrize("page_rows,splits,share,levels", [(2048, 32, 8192, 11), (40, 4, 30, 11), (40, 3, 30, 1)])
def test_equals_brute_force(spark, monkeypatch, page_rows, splits, share, levels):
    for name, value in (("PAGE_ROWS", page_rows), ("SPLITS", splits), ("SHARE_ROWS", share), ("MAX_LEVELS", levels)):
        monkeypatch.setattr(gnat, name, value)
    rows = made(2, 500, 10)
    rows += [(1000 + i, rows[5][1], i % 3) for i in range(120)]  # one vector under three labels
    rows += [(2000 + i, f32(3 * np.random.default_rng(i).normal(size=10)), 1) for i in range(30)]
    got = found(spark, rows)
    assert got == brute(rows) and len(got) > 1000


def test_odd_rows(spark):
    rows = [
        (0, [1.0, 2.0], 1), (10, [1.0, 2.0], 1), (1, None, 1), (2, [None, 1.0], 2), (3, [float("nan"), 1.0], 1), (4, [float("inf"), 1.0], 2),
        (None, [9.0, 9.0], 2), (5, [0.5], 2), (6, [], 2), (7, [1.0, 0.5, 3.0], 2), (8, [0.5, 1.0], 2), (8, [0.5, 1.0], 2), (8, [0.5, 1.0], 3),
        (20, [0.1, -0.1], None), (30, [-1.0, -2.0], 3), (31, [1.0, 2.0], 3), (0, [1.0, 2.0], 2), (40, [0.0, 0.0], 2),
    ]
    assert found(spark, rows) == brute(rows) != []
    assert found(spark, []) == found(spark, [(1, None, 1)]) == found(spark, [(0, [1.0], 1)]) == []


def test_stored_ranges_pass_over_leaves_on_both_sides_of_the_ring():
    rng = np.random.default_rng(8)
    vectors = np.floor(256 * (rng.normal(size=(40, 4))[np.arange(2000) % 40] * 4 + 0.02 * rng.normal(size=(2000, 4))))
    space = Space(4, float((vectors**2).sum(axis=1).max()))
    page = Page(space, np.arange(2000), np.arange(2000) % 5, vectors)
    scores = np.rint(vectors[:60] @ vectors.T).astype(np.int64)
    top = scores.max(axis=1)
    windows = [[int(0.3 * t), int(0.35 * t)] for t in top]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(np.arange(60)), pa.array(np.arange(60) % 5), pa.array(list(vectors[:60].astype(np.int64))), pa.array([[a] for a, _ in windows]), pa.array([[b] for _, b in windows])],
        names=["id", "label", "v", "lows", "highs"],
    )
    ring = Ring(space, batch, 10, same=False)
    page.search(ring, np.arange(60))
    leaves = 2000 / 50
    assert page.visits < 60 * leaves / 3
    got = {}
    for r in ring.results().to_pylist():
        got.setdefault(r["id"], []).append((-r["score"], r["found"]))
    for q, (low, high) in enumerate(windows):
        want = sorted((-s, i) for i, s in enumerate(scores[q]) if low <= s <= high and i % 5 != q % 5)[:10]
        assert sorted(got.get(q, [])) == want
