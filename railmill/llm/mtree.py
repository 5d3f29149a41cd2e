"""Exact top-k search by inner product with M-trees.

With every vector x extended by sqrt(M - |x|^2), M the largest squared length, and a query by 0, the
squared distance is |q|^2 + M - 2 q.x: the largest inner products are the nearest neighbours, and a
metric tree can search them. Its top level is a bounded set of pivots; every vector belongs to
its nearest one. A pivot's vectors lie in pages of bounded size, and every page is a tree of
leaf nodes with a routing object, a covering radius, and entries sorted by their distance to it.

A query first searches one page of its nearest pivot, which gives it a lower bound for the k-th
score. Only pivots whose ball can beat the bound are visited then. Inside a page the nodes are
taken best first; by the triangle inequality a node is skipped if its ball is too far, and so are
entries whose stored distance to the routing object differs too much from the query's. Scores are
integers computed without rounding, so bounds only ever save work.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railmill.llm.common import Scratch, partitions

PAGE_ROWS = 2048
NODE_ROWS = 64
# Pivots in the broadcast directory; beyond it, pivots get more pages.
MAX_PIVOTS = 1024
# Queries one task searches in a page before another task takes a copy of the page.
SHARE_QUERIES = 4096
_LOW = np.iinfo(np.int64).min


class Space(NamedTuple):
    """What turns inner products into distances."""

    dim: int
    longest: float  # M

    def rows(self, column: pa.Array) -> np.ndarray:
        """A list column as a matrix; shorter vectors end in zeros."""
        out = np.zeros((len(column), self.dim))
        sizes = np.diff(column.offsets.to_numpy())
        values = column.values.to_numpy()[column.offsets[0].as_py() :] if len(column) else np.zeros(0)
        out[np.arange(self.dim) < sizes[:, None]] = values[: int(sizes.sum())]
        return out

    def extended(self, x: np.ndarray) -> np.ndarray:
        rest = np.sqrt(np.maximum(self.longest - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def distances(self, queries: np.ndarray, points: np.ndarray) -> np.ndarray:
        """Between plain queries and plain points."""
        own = (queries * queries).sum(axis=1)[:, None]
        return np.sqrt(np.maximum(own + self.longest - 2 * queries @ points.T, 0))

    def reach(self, queries: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        """The distance within which an object must lie to score at least ``bounds``, with some slack."""
        own = (queries * queries).sum(axis=1)
        square = own + self.longest - 2.0 * np.maximum(bounds, -(2.0**62))
        return np.sqrt(np.maximum(square, 0) + 1e-9 * (own + self.longest) + 1.0)


class Page:
    """An M-tree of one page: routing objects, radii, and entries with parent distances."""

    def __init__(self, space: Space, ids: np.ndarray, vectors: np.ndarray):
        self.space = space
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        extended = space.extended(vectors)
        number = max(1, len(ids) // NODE_ROWS)
        chosen = [0]
        apart = np.linalg.norm(extended - extended[0], axis=1)
        while len(chosen) < number and apart.max() > 0:  # farthest first
            chosen.append(int(apart.argmax()))
            apart = np.minimum(apart, np.linalg.norm(extended - extended[chosen[-1]], axis=1))
        square = (extended * extended).sum(axis=1)[:, None] + (extended[chosen] ** 2).sum(axis=1)
        gaps = np.sqrt(np.maximum(square - 2 * extended @ extended[chosen].T, 0))
        own = gaps.argmin(axis=1)
        parent = gaps[np.arange(len(ids)), own]
        by_node = np.lexsort((parent, own))
        self.ids, self.vectors, self.parent = ids[by_node], vectors[by_node], parent[by_node]
        self.bounds = np.searchsorted(own[by_node], np.arange(len(chosen) + 1))
        self.routing = vectors[chosen]
        self.radius = np.array([self.parent[b - 1] if b > a else 0.0 for a, b in zip(self.bounds[:-1], self.bounds[1:])])

    def search(self, query_ids: np.ndarray, queries: np.ndarray, floor: np.ndarray, k: int):
        """Per query the best ``k`` ids and scores of this page that reach its floor.

        All queries move together: in every round each one visits its next best node.
        """
        n = len(queries)
        score = np.full((n, k), _LOW, dtype=np.int64)
        found = np.full((n, k), np.iinfo(np.int64).max, dtype=np.int64)
        to_node = self.space.distances(queries, self.routing)
        least = np.maximum(to_node - self.radius, 0)
        order = np.argsort(least, axis=1)
        slack = 1e-6 * (1 + to_node)
        active = np.arange(n)
        for rank in range(order.shape[1]):
            bound = np.maximum(floor[active], score[active, k - 1])
            reach = self.space.reach(queries[active], bound.astype(float))
            node = order[active, rank]
            near = least[active, node] - slack[active, node] <= reach
            active, node, reach = active[near], node[near], reach[near]
            if not len(active):
                break
            for at in np.unique(node):
                some = active[node == at]
                self._visit(at, some, to_node[some, at], reach[node == at], query_ids, queries, score, found, k)
        return found, score

    def _visit(self, at, some, gap, reach, query_ids, queries, score, found, k) -> None:
        a, b = self.bounds[at], self.bounds[at + 1]
        margin = reach + 1e-6 * (1 + gap)
        low = a + np.searchsorted(self.parent[a:b], (gap - margin).min(), side="left")
        high = a + np.searchsorted(self.parent[a:b], (gap + margin).max(), side="right")
        if low >= high:
            return
        ids = self.ids[low:high]
        value = np.rint(queries[some] @ self.vectors[low:high].T).astype(np.int64)
        value[ids[None, :] == query_ids[some][:, None]] = _LOW
        better = value.max(axis=1) >= score[some, k - 1]
        some, value = some[better], value[better]
        if not len(some):
            return
        every = np.concatenate([score[some], value], axis=1)
        names = np.concatenate([found[some], np.broadcast_to(ids, value.shape)], axis=1)
        first = np.lexsort((names, -every.astype(float)), axis=1)[:, :k] if every.size else every
        score[some] = np.take_along_axis(every, first, axis=1)
        found[some] = np.take_along_axis(names, first, axis=1)


def _searched(batches: Iterator[pa.RecordBatch], space: Space, k: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive by (pivot, page, share) with the page's vectors first, then its queries."""
    at, ids, vectors, page = None, [], [], None
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("pivot", "page", "share")])
        role = batch.column("role").to_numpy()
        runs = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1) | (role[1:] != role[:-1]))))
        for start, end in zip(runs, np.append(runs[1:], batch.num_rows)):
            part = batch.slice(start, end - start)
            if at != tuple(keys[start]):
                at, ids, vectors, page = tuple(keys[start]), [], [], None
            own, rows = part.column("id").to_numpy(), space.rows(part.column("v"))
            if role[start] == 0:
                ids.append(own)
                vectors.append(rows)
                continue
            if not ids:
                continue
            if page is None:
                page = Page(space, np.concatenate(ids), np.concatenate(vectors))
            floor = part.column("floor").to_numpy()
            found, score = page.search(own, rows, floor, k)
            good = (score > _LOW) & (score >= floor[:, None])
            query = np.broadcast_to(own[:, None], score.shape)
            yield pa.RecordBatch.from_arrays(
                [pa.array(query[good]), pa.array(found[good]), pa.array(score[good])], names=["query_id", "vec_id", "score"]
            )


def _search(pages: DataFrame, visits: DataFrame, space: Space, k: int, scratch: Scratch) -> DataFrame:
    """Runs visits ``(pivot, page, id, v, floor)`` against the pages ``(pivot, page, id, v)``."""
    visits = visits.withColumn("_part", F.pmod(F.xxhash64("id"), F.lit(1 << 20)))
    counts = visits.groupBy("pivot", "page").agg(F.ceil(F.count("*") / F.lit(SHARE_QUERIES)).alias("shares"))
    counts = scratch.keep(counts, "shares")
    key = ["pivot", "page"]
    dealt = visits.join(counts, key).select(
        *key, F.pmod("_part", "shares").alias("share"), F.lit(1).alias("role"), "id", "v", "floor"
    )
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share")
    data = pages.join(counts, key).select(*key, copies, F.lit(0).alias("role"), "id", "v", F.lit(_LOW).alias("floor"))
    rows = data.unionByName(dealt).repartition(partitions(pages.sparkSession), *key, "share")
    return rows.sortWithinPartitions(*key, "share", "role").mapInArrow(
        lambda batches: _searched(batches, space, k), "query_id bigint, vec_id bigint, score bigint"
    )


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def integer_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """``(id, v)``: floor(scale * x) of every component; rows with null or non-finite parts are left out."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    usable = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(~bad)
    scaled = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("bigint"))
    return usable.select(F.col("vec_id").cast("bigint").alias("id"), scaled.alias("v"))


def top_k(rows: DataFrame, is_query: Column, k: int = 10, scale: float = 1024.0) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the ``k`` rows of largest inner product with each query.

    ``rows`` has vec_id and embedding; ``is_query`` is a condition on ``id``. Every row but those of
    the query's own id is a candidate; ties go to the smaller vec_id, and a query has fewer rows if
    there are fewer candidates. Vectors that are null or hold null or non-finite components, and rows
    without vec_id, take no part. A shorter vector counts as ending in zeros. Repeated candidate rows
    each count; a query id with several vectors searches with the smallest. Scores must stay below
    2**53. Other columns are not read; an empty table gives an empty result.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "mtree")
    vectors = scratch.keep(integer_vectors(rows, scale), "vectors")
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, c: s + c * c)
    shape = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("longest")).first()
    empty = spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score bigint")
    if not shape["n"]:
        return empty
    space = Space(max(shape["dim"], 1), float(shape["longest"]))
    number = min(MAX_PIVOTS, -(-shape["n"] // PAGE_ROWS))
    chosen = vectors.orderBy(F.xxhash64("id"), "id", "v").limit(number).select("v").toArrow()
    pivots = spark.sparkContext.broadcast(space.rows(chosen.column("v").combine_chunks()))

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            points = space.extended(space.rows(batch.column("v")))
            heads = space.extended(pivots.value)
            square = (points * points).sum(axis=1)[:, None] + (heads * heads).sum(axis=1)
            gaps = np.sqrt(np.maximum(square - 2 * points @ heads.T, 0))
            near = gaps.argmin(axis=1)
            gap = gaps[np.arange(len(near)), near]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("v"), pa.array(near), pa.array(gap)], names=["id", "v", "pivot", "gap"]
            )

    placed = vectors.mapInArrow(assigned, "id bigint, v array<bigint>, pivot bigint, gap double")
    placed = scratch.keep(placed, "placed")
    balls = placed.groupBy("pivot").agg(
        F.max("gap").alias("radius"), F.ceil(F.count("*") / F.lit(PAGE_ROWS)).alias("pages")
    ).collect()  # one row per pivot
    radius, page_counts = np.full(number, -1.0), np.zeros(number, dtype=np.int64)
    for ball in balls:
        radius[ball["pivot"]], page_counts[ball["pivot"]] = ball["radius"], ball["pages"]
    directory = spark.createDataFrame([(i, int(n)) for i, n in enumerate(page_counts)], "pivot bigint, pages bigint")
    directory = scratch.keep(directory.coalesce(1), "directory")
    pages = placed.join(directory, "pivot").select(
        "pivot", F.pmod(F.xxhash64("id", "v"), F.col("pages")).alias("page"), "id", "v"
    )
    queries = scratch.keep(vectors.filter(is_query).groupBy("id").agg(F.min("v").alias("v")), "queries")

    def routed(batches: Iterator[pa.RecordBatch], first: bool) -> Iterator[pa.RecordBatch]:
        """The pivots a query must visit, each with all its pages or, at first, one page of the nearest."""
        for batch in batches:
            wanted = space.rows(batch.column("v"))
            gaps = space.distances(wanted, pivots.value)
            least = np.where(radius >= 0, np.maximum(gaps - radius, 0), np.inf)
            if first:
                # the nearest ball that holds anything
                row, pivot = np.arange(len(wanted)), np.where(radius >= 0, gaps, np.inf).argmin(axis=1)
                listed = [[0]] * len(row)
            else:
                reach = space.reach(wanted, batch.column("floor").to_numpy().astype(float))
                row, pivot = np.nonzero(least - 1e-6 * (1 + gaps) <= reach[:, None])
                nearest = np.where(radius >= 0, gaps, np.inf).argmin(axis=1)
                listed = [list(range(int(p == nearest[r]), page_counts[p])) for r, p in zip(row, pivot)]
            columns = [batch.column(c).take(pa.array(row)) for c in ("id", "v", "floor")]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(pivot), pa.array(listed, pa.list_(pa.int64()))], names=["id", "v", "floor", "pivot", "page"]
            )

    route = "id bigint, v array<bigint>, floor bigint, pivot bigint, page array<bigint>"
    start = queries.withColumn("floor", F.lit(_LOW)).mapInArrow(lambda b: routed(b, True), route)
    some = scratch.keep(_search(pages, start.withColumn("page", F.explode("page")), space, k, scratch), "first")
    floors = some.groupBy("query_id").agg(F.count("*").alias("n"), F.min("score").alias("low"))
    floors = floors.filter(F.col("n") >= k).select(F.col("query_id").alias("id"), "low")
    bounded = queries.join(floors, "id", "left").withColumn("floor", F.coalesce("low", F.lit(_LOW))).drop("low")
    others = bounded.mapInArrow(lambda b: routed(b, False), route).withColumn("page", F.explode("page"))
    rest = scratch.keep(_search(pages, others, space, k, scratch), "rest")
    return _best(some.unionByName(rest), k).select("query_id", "rank", "vec_id", "score")
