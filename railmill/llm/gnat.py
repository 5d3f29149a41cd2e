"""Hard-negative mining with a multiway hyperplane tree in the manner of a GNAT.

Vectors lie in the space of ``mtree.Space``, where the inner product with a query fixes the distance. A
node of the tree has several split points; each vector goes to the nearest of them, and for every
pair (i, j) the node stores the least and greatest distance from split point i to the vectors below j. A
query wants scores between a low and a high bound, a ring around it: a sibling is passed over as soon as
one stored range, seen from the query's distance to that split point, misses the ring. Leaves are
searched exactly, by integer scores.

The tree is built level by level. Nodes with more than ``PAGE_ROWS`` vectors are split by all
tasks together: rows and the split points of their node meet in shares of bounded size. Smaller nodes
are pages, in which a task builds the rest of the tree itself. Queries descend the same levels in shares.
Each anchor's nearest page is searched first, which raises the low bounds for all others.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railmill.llm.common import Scratch, partitions
from railmill.llm.mtree import Space

PAGE_ROWS = 2048
# Split points of a node that many tasks build, and of a node inside a page.
SPLITS = 32
PAGE_SPLITS = 8
LEAF_ROWS = 64
# Rows of a node among which its split points are chosen, by hash.
SAMPLE_ROWS = 512
# Rows or queries that meet one copy of a node or page.
SHARE_ROWS = 8192
# Levels that many tasks build; what is larger below them is cut into pages by hash.
MAX_LEVELS = 11
_BLOCK = 512
_LOW, _HIGH = -(1 << 62), 1 << 62
_NONE = np.iinfo(np.int64).min
_FAR = 1e300


def farthest_first(points: np.ndarray, number: int) -> list[int]:
    """Positions of up to ``number`` different points, each the farthest from those before it."""
    chosen = [0]
    apart = np.linalg.norm(points - points[0], axis=1)
    while len(chosen) < number and apart.max() > 0:
        chosen.append(int(apart.argmax()))
        apart = np.minimum(apart, np.linalg.norm(points - points[chosen[-1]], axis=1))
    return chosen


def _gaps(points: np.ndarray, heads: np.ndarray) -> np.ndarray:
    square = (points * points).sum(axis=1)[:, None] + (heads * heads).sum(axis=1)
    return np.sqrt(np.maximum(square - 2 * points @ heads.T, 0))


def _ranges(gaps: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and greatest distance from split point i to the rows of child j."""
    m = gaps.shape[1]
    least, most = np.full((m, m), _FAR), np.full((m, m), -_FAR)
    for j in np.unique(own):
        below = gaps[own == j]
        least[:, j], most[:, j] = below.min(axis=0), below.max(axis=0)
    return least, most


def _possible(gaps: np.ndarray, least: np.ndarray, most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per query and child: lower and upper bound of the distances to the child's rows."""
    nearest = np.maximum(gaps[:, :, None] - most, least - gaps[:, :, None]).max(axis=1)
    farthest = (gaps[:, :, None] + most).min(axis=1)
    slack = 1e-6 * (1 + gaps.max(axis=1))[:, None]
    return np.maximum(nearest - slack, 0), farthest + slack


class Ring:
    """The queries of one batch: windows of scores, and the best ``k`` found for each."""

    def __init__(self, space: Space, batch: pa.RecordBatch, k: int, same: bool):
        self.space, self.k, self.same = space, k, same
        self.ids = batch.column("id").to_numpy()
        self.labels = batch.column("label").to_numpy()
        self.vectors = space.rows(batch.column("v"))
        sizes = np.array([len(x) for x in batch.column("lows")], dtype=np.int64)
        self.starts = np.concatenate(([0], np.cumsum(sizes)))
        self.owner = np.repeat(np.arange(len(self.ids)), sizes)
        self.number = np.arange(len(self.owner)) - self.starts[self.owner]
        self.low = np.concatenate([np.zeros(0, np.int64), *[np.array(x.as_py(), dtype=np.int64) for x in batch.column("lows")]])
        self.high = np.concatenate([np.zeros(0, np.int64), *[np.array(x.as_py(), dtype=np.int64) for x in batch.column("highs")]])
        self.score = np.full((len(self.owner), k), _NONE, dtype=np.int64)
        self.found = np.full((len(self.owner), k), np.iinfo(np.int64).max, dtype=np.int64)
        self.least = np.array([self.low[a:b].min() for a, b in zip(self.starts, self.starts[1:])], dtype=np.int64)
        self.most = np.array([self.high[a:b].max() for a, b in zip(self.starts, self.starts[1:])], dtype=np.int64)

    def radii(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Inner and outer radius of the rings that may still hold something."""
        outer = self.space.reach(self.vectors[some], self.least[some].astype(float))
        own = (self.vectors[some] ** 2).sum(axis=1)
        square = own + self.space.longest - 2.0 * np.minimum(self.most[some], 2.0**62)
        inner = np.sqrt(np.maximum(square - 1e-9 * (own + self.space.longest) - 1.0, 0))
        return inner, outer

    def offer(self, some: np.ndarray, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray) -> None:
        """Scores the rows of a leaf exactly."""
        value = np.rint(self.vectors[some] @ vectors.T).astype(np.int64)
        fits = (labels[None, :] == self.labels[some][:, None]) == self.same
        value[~fits | (ids[None, :] == self.ids[some][:, None])] = _NONE
        at = np.zeros(len(self.ids), dtype=np.int64)
        at[some] = np.arange(len(some))
        windows = np.concatenate([np.arange(self.starts[q], self.starts[q + 1]) for q in some])
        value = value[at[self.owner[windows]]]
        value[(value < self.low[windows][:, None]) | (value > self.high[windows][:, None])] = _NONE
        best = value.max(axis=1)
        better = (best > _NONE) & (best >= self.score[windows, self.k - 1])
        windows, value = windows[better], value[better]
        if not len(windows):
            return
        every = np.concatenate([self.score[windows], value], axis=1)
        names = np.concatenate([self.found[windows], np.broadcast_to(ids, value.shape)], axis=1)
        first = np.lexsort((names, -every.astype(float)), axis=1)[:, : self.k]
        self.score[windows] = np.take_along_axis(every, first, axis=1)
        self.found[windows] = np.take_along_axis(names, first, axis=1)
        self.low[windows] = np.maximum(self.low[windows], self.score[windows, self.k - 1])
        for q in np.unique(self.owner[windows]):
            self.least[q] = self.low[self.starts[q] : self.starts[q + 1]].min()

    def results(self) -> pa.RecordBatch:
        good = self.score > _NONE
        shape = self.score.shape
        columns = [np.broadcast_to(x[:, None], shape)[good] for x in (self.ids[self.owner], self.number)]
        return pa.RecordBatch.from_arrays(
            [*map(pa.array, columns), pa.array(self.found[good]), pa.array(self.score[good])], names=["id", "number", "found", "score"]
        )


class Page:
    """The tree below a node that fits one task."""

    def __init__(self, space: Space, ids: np.ndarray, labels: np.ndarray, vectors: np.ndarray):
        self.space, self.ids, self.labels, self.vectors = space, ids, labels, vectors
        self.visits = 0  # of a leaf by a query
        self.top = self._node(np.arange(len(ids)), space.extended(vectors))

    def _node(self, rows: np.ndarray, points: np.ndarray):
        if len(rows) > LEAF_ROWS:
            chosen = farthest_first(points, PAGE_SPLITS)
            if len(chosen) > 1:
                gaps = _gaps(points, points[chosen])
                own = gaps.argmin(axis=1)
                below = [self._node(rows[own == j], points[own == j]) for j in range(len(chosen))]
                return self.vectors[rows[chosen]], *_ranges(gaps, own), below
        return rows

    def search(self, ring: Ring, some: np.ndarray, node=None) -> None:
        node = self.top if node is None else node
        if isinstance(node, np.ndarray):
            self.visits += len(some)
            if len(some) and len(node):
                ring.offer(some, self.ids[node], self.labels[node], self.vectors[node])
            return
        splits, least, most, below = node
        nearest, farthest = _possible(self.space.distances(ring.vectors[some], splits), least, most)
        for j in np.argsort(nearest.mean(axis=0)):
            inner, outer = ring.radii(some)
            keep = (nearest[:, j] <= outer) & (farthest[:, j] >= inner)
            if keep.any():
                self.search(ring, some[keep], below[j])


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[pa.RecordBatch], pa.RecordBatch, bool]]:
    """``(node, holders, visitors, new)``: rows arrive by (node, page, share), holders first."""
    at, holders, new = None, [], True
    for batch in batches:
        keys = np.column_stack([batch.column(c).to_numpy() for c in ("node", "page", "share", "role")])
        starts = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        for start, end in zip(starts, np.append(starts[1:], batch.num_rows)):
            if at != tuple(keys[start, :3]):
                at, holders, new = tuple(keys[start, :3]), [], True
            part = batch.slice(start, end - start)
            if keys[start, 3] == 0:
                holders.append(part)
            elif holders:
                for block in range(0, part.num_rows, _BLOCK):
                    yield int(at[0]), holders, part.slice(block, _BLOCK), new
                    new = False


def _heads(holders: list[pa.RecordBatch], space: Space) -> np.ndarray:
    return np.array(holders[0].column("splits")[0].as_py(), dtype=float).reshape(-1, space.dim)


def _meet(holders: DataFrame, visitors: DataFrame, fn: Callable, schema: str, scratch: Scratch) -> DataFrame:
    """Brings visitors to the rows of their (node, page), in shares of about ``SHARE_ROWS`` visitors."""
    key = ["node", "page"]
    shares = F.ceil(F.count("*") / F.lit(SHARE_ROWS)).alias("shares")
    counts = scratch.keep(visitors.groupBy(*key).agg(shares), "shares")
    dealt = visitors.join(counts, key).withColumns({"share": F.pmod(F.xxhash64("id"), F.col("shares")), "role": F.lit(1)})
    copies = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1))
    held = holders.join(counts, key).withColumn("share", copies).withColumn("role", F.lit(0))
    rows = held.drop("shares").unionByName(dealt.drop("shares"), allowMissingColumns=True)
    dealt_out = rows.repartition(partitions(holders.sparkSession), *key, "share").sortWithinPartitions(*key, "share", "role")
    return dealt_out.mapInArrow(fn, schema)


class Tree:
    """The stored levels and pages over rows ``(id, label, v)`` that are all different."""

    ROW = "id bigint, label bigint, v array<bigint>"

    def __init__(self, rows: DataFrame, space: Space, scratch: Scratch):
        self.space, self.scratch, self.spark = space, scratch, rows.sparkSession
        self.levels: list[DataFrame] = []
        done: list[DataFrame] = []
        here = rows.withColumns({"node": F.lit(1).cast("bigint"), "page": F.lit(0).cast("bigint")})
        for level in range(MAX_LEVELS + 1):
            sizes = scratch.keep(here.groupBy("node").agg(F.count("*").alias("n")).withColumn("page", F.lit(0).cast("bigint")), "sizes")
            large = sizes.filter(F.col("n") > PAGE_ROWS)
            if level == MAX_LEVELS or large.isEmpty():
                done.append(here.join(sizes.drop("page"), "node"))
                break
            splits = scratch.keep(self._splits(here.join(large.select("node"), "node", "left_semi")), "splits")
            small = sizes.join(splits.select("node"), "node", "left_anti").drop("page")
            done.append(here.join(small, "node"))
            deeper = here.join(splits.select("node"), "node", "left_semi")
            here = self._split(deeper, splits)
        pages = done[0]
        for more in done[1:]:
            pages = pages.unionByName(more)
        page = F.pmod(F.xxhash64("id", "label"), F.ceil(F.col("n") / F.lit(PAGE_ROWS)))
        self.pages = scratch.keep(pages.select("node", page.alias("page"), "id", "label", "v"), "pages")

    def _splits(self, rows: DataFrame) -> DataFrame:
        """``(node, page, splits)`` of the nodes that have different vectors."""
        space = self.space
        order = Window.partitionBy("node").orderBy(F.xxhash64("id", "label"), "id", "label")
        some = rows.withColumn("at", F.row_number().over(order)).filter(F.col("at") <= SAMPLE_ROWS)
        some = some.repartition(partitions(self.spark), "node").sortWithinPartitions("node", "at").select("node", "v")

        def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            node, held = None, []

            def made() -> Iterator[pa.RecordBatch]:
                if held:
                    points = np.concatenate(held)
                    heads = points[farthest_first(space.extended(points), SPLITS)]
                    if len(heads) > 1:
                        flat = heads.astype(np.int64).ravel()
                        yield pa.RecordBatch.from_arrays([pa.array([node]), pa.array([0]), pa.array([flat])], names=["node", "page", "splits"])

            for batch in batches:
                names, rows = batch.column("node").to_numpy(), space.rows(batch.column("v"))
                for own in dict.fromkeys(names.tolist()):
                    if own != node:
                        yield from made()
                        node, held = own, []
                    held.append(rows[names == own])
            yield from made()

        return some.mapInArrow(chosen, "node bigint, page bigint, splits array<bigint>")

    def _split(self, rows: DataFrame, splits: DataFrame) -> DataFrame:
        """Sends rows to their child nodes and stores the level's split points and ranges."""
        space = self.space
        names = ["node", "page", "id", "label", "v", "least", "most"]

        def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for node, holders, part, _ in _meetings(batches):
                heads = _heads(holders, space)
                gaps = _gaps(space.extended(space.rows(part.column("v"))), space.extended(heads))
                own = gaps.argmin(axis=1)
                least, most = _ranges(gaps, own)
                n = part.num_rows
                nothing, zero = pa.nulls(n, pa.list_(pa.float64())), pa.array(np.zeros(n, np.int64))
                columns = [part.column(c) for c in ("id", "label", "v")]
                yield pa.RecordBatch.from_arrays([pa.array(node * SPLITS + own), zero, *columns, nothing, nothing], names=names)
                ranges = [pa.array([node]), pa.array([0]), *[pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.list_(pa.int64()))]]
                yield pa.RecordBatch.from_arrays([*ranges, pa.array([least.ravel()]), pa.array([most.ravel()])], names=names)

        schema = f"node bigint, page bigint, {self.ROW}, least array<double>, most array<double>"
        met = self.scratch.keep(_meet(splits, rows, assigned, schema, self.scratch), "level")
        each = met.filter("least is not null").select("node", F.posexplode(F.arrays_zip("least", "most")).alias("at", "range"))
        merged = each.groupBy("node", "at").agg(F.min("range.least").alias("least"), F.max("range.most").alias("most"))
        table = merged.groupBy("node").agg(F.array_sort(F.collect_list(F.struct("at", "least", "most"))).alias("t"))
        level = splits.join(table, "node").select("node", "page", "splits", F.col("t.least").alias("least"), F.col("t.most").alias("most"))
        self.levels.append(self.scratch.keep(level, "directory"))
        return met.filter("least is null").drop("least", "most")

    QUERY = "id bigint, label bigint, v array<bigint>, lows array<bigint>, highs array<bigint>"

    def _down(self, queries: DataFrame, nearest: bool) -> DataFrame:
        """The (node, page) of the pages each query must visit, or only the one it is nearest to."""
        space = self.space

        def descended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for node, holders, part, _ in _meetings(batches):
                heads = _heads(holders, space)
                m = len(heads)
                ring = Ring(space, part, 1, True)
                gaps = space.distances(ring.vectors, heads)
                least, most = (np.array(holders[0].column(c)[0].as_py()).reshape(m, m) for c in ("least", "most"))
                if nearest:
                    filled = most[0] > -_FAR  # children that have rows
                    row, child = np.arange(len(gaps)), np.where(filled, gaps, np.inf).argmin(axis=1)
                else:
                    near, far = _possible(gaps, least, most)
                    inner, outer = ring.radii(np.arange(len(gaps)))
                    row, child = np.nonzero((near <= outer[:, None]) & (far >= inner[:, None]))
                taken = [part.column(c).take(pa.array(row)) for c in ("id", "label", "v", "lows", "highs")]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(node * SPLITS + child), pa.array(np.zeros(len(row), np.int64)), *taken],
                    names=["node", "page", "id", "label", "v", "lows", "highs"],
                )

        here = queries.withColumns({"node": F.lit(1).cast("bigint"), "page": F.lit(0).cast("bigint")})
        arrived = []
        for level in self.levels:
            arrived.append(here.join(level.select("node"), "node", "left_anti"))
            going = here.join(level.select("node"), "node", "left_semi")
            here = self.scratch.keep(_meet(level, going, descended, f"node bigint, page bigint, {self.QUERY}", self.scratch), "down")
        places = here
        for more in arrived:
            places = places.unionByName(more)
        cut = self.scratch.keep(self.pages.groupBy("node").agg(F.collect_set("page").alias("cut")), "cut")
        own = F.slice(F.array_sort("cut"), 1, 1) if nearest else F.col("cut")
        return places.drop("page").join(cut, "node").withColumn("page", F.explode(own)).drop("cut")

    def _visit(self, visits: DataFrame, k: int, same: bool) -> DataFrame:
        space = self.space

        def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            page = None
            for _, holders, part, new in _meetings(batches):
                if new:
                    columns = [np.concatenate([h.column(c).to_numpy() for h in holders]) for c in ("id", "label")]
                    page = Page(space, *columns, np.concatenate([space.rows(h.column("v")) for h in holders]))
                ring = Ring(space, part, k, same)
                page.search(ring, np.arange(part.num_rows))
                yield ring.results()

        schema = "id bigint, number bigint, found bigint, score bigint"
        return _meet(self.pages, visits, searched, schema, self.scratch)

    def search(self, queries: DataFrame, homes: DataFrame, k: int, same: bool) -> DataFrame:
        """``(id, number, rank, found, score)``: the best ``k`` rows in each window of each query.

        ``queries`` has the columns of ``QUERY``, one window per place of ``lows`` and ``highs``; a row fits if it
        has the query's label (``same``) or another one, and another id.
        """
        order = Window.partitionBy("id", "number").orderBy(F.desc("score"), "found")
        first = self.scratch.keep(self._visit(queries.join(homes, "id"), k, same), "home")
        floors = first.groupBy("id", "number").agg(F.count("*").alias("n"), F.min("score").alias("floor")).filter(F.col("n") >= k)
        floors = floors.groupBy("id").agg(F.map_from_entries(F.collect_list(F.struct("number", "floor"))).alias("floors"))
        raised = F.transform("lows", lambda low, at: F.greatest(low, F.get(F.array(F.element_at("floors", at.cast("bigint"))), F.lit(0))))
        bounded = queries.join(floors, "id", "left").withColumn("lows", F.when(F.col("floors").isNull(), F.col("lows")).otherwise(raised))
        visits = self._down(self.scratch.keep(bounded.drop("floors"), "bounded"), nearest=False)
        others = visits.join(homes, ["id", "node", "page"], "left_anti")
        rest = self.scratch.keep(self._visit(others, k, same), "rest")
        best = first.unionByName(rest).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return best.select("id", "number", "rank", "found", "score")

    def homes(self, queries: DataFrame) -> DataFrame:
        """``(id, node, page)``: the page each query is nearest to."""
        return self.scratch.keep(self._down(queries, nearest=True).select("id", "node", "page"), "homes")


def labelled_vectors(rows: DataFrame, scale: float) -> DataFrame:
    """``(id, label, v)``: floor(scale * x) of every component; unusable rows are left out."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c.cast("double")) == float("inf")))
    usable = rows.filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & x.isNotNull()).filter(~bad)
    scaled = F.transform(x, lambda c: F.floor(F.lit(scale) * c.cast("double")).cast("bigint"))
    return usable.select(F.col("vec_id").cast("bigint").alias("id"), F.col("label").cast("bigint").alias("label"), scaled.alias("v"))


def mine_hard_negatives(
    rows: DataFrame,
    is_anchor: Column,
    positives: int = 5,
    negatives: int = 10,
    low: int = 30,
    high: int = 90,
    scale: float = 256.0,
) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    ``rows`` has vec_id, embedding and label; ``is_anchor`` is a condition on ``id``. An anchor's positives are the
    ``positives`` best other rows of its label; for each, the ``negatives`` best rows of other labels are returned whose
    score is between ``low`` and ``high`` hundredths of the positive's. Scores are integer inner products of
    ``floor(scale * x)``, higher first, ties by smaller vec_id; they must stay below 2**53. Rows whose vec_id, label or
    vector is null, or whose vector holds a null or non-finite component, take no part. A shorter vector counts as
    ending in zeros. Rows that agree in vec_id, label and vector count once; rows of the anchor's vec_id are no
    candidates, and an anchor with several vectors or labels searches with the smallest vector, then label. An
    anchor without positives, or whose windows hold nothing, has no rows. Other columns are not read.

    Of rows that agree in vector and label only the first few by vec_id can be among the best, so a vector
    that a third of all rows share enters the tree a few times. That drops no result.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession, "gnat")
    vectors = scratch.keep(labelled_vectors(rows, scale).distinct(), "vectors")
    square = F.aggregate("v", F.lit(0).cast("bigint"), lambda s, c: s + c * c)
    shape = vectors.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("dim"), F.max(square).alias("longest")).first()
    if not shape["n"]:
        longs = ", ".join(f"{c} bigint" for c in ("negative_id", "positive_score", "negative_score"))
        return spark.createDataFrame([], f"anchor_id bigint, positive_id bigint, rank int, {longs}")
    space = Space(max(shape["dim"], 1), float(shape["longest"]))
    equal = Window.partitionBy("v", "label").orderBy("id")
    leading = vectors.withColumn("at", F.row_number().over(equal)).filter(F.col("at") <= max(positives, negatives) + 1).drop("at")
    tree = Tree(scratch.keep(leading, "leading"), space, scratch)

    anchors = vectors.filter(is_anchor).groupBy("id").agg(F.min(F.struct("v", "label")).alias("own")).select("id", "own.label", "own.v")
    anchors = scratch.keep(anchors, "anchors")
    whole = anchors.withColumns({c: F.array(F.lit(x).cast("bigint")) for c, x in (("lows", _LOW), ("highs", _HIGH))})
    homes = tree.homes(whole)
    pairs = scratch.keep(tree.search(whole, homes, positives, same=True), "pairs")
    # the window in whole scores: low * p <= 100 * n <= high * p
    least = -F.floor(F.lit(-low) * F.col("score") / F.lit(100)).cast("bigint")
    most = F.floor(F.lit(high) * F.col("score") / F.lit(100)).cast("bigint")
    windows = pairs.select("id", "rank", "found", "score", least.alias("least"), most.alias("most")).filter("least <= most")
    listed = windows.groupBy("id").agg(F.array_sort(F.collect_list(F.struct("rank", "found", "score", "least", "most"))).alias("w"))
    listed = scratch.keep(listed, "windows")
    wanted = anchors.join(listed, "id").select(
        "id", "label", "v", F.col("w.least").alias("lows"), F.col("w.most").alias("highs")
    )
    mined = tree.search(scratch.keep(wanted, "wanted"), homes, negatives, same=False)
    numbered = listed.select("id", F.posexplode("w").alias("number", "p"))
    return mined.join(numbered, ["id", "number"]).select(
        F.col("id").alias("anchor_id"),
        F.col("p.found").alias("positive_id"),
        F.col("rank"),
        F.col("found").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
