"""Mixing sources to target weights with a multivariate-hypergeometric splitting tree.

Every source is one stream of documents in a random but fixed order (by hash), cut into blocks of
about ``block_words``. A source's target says how many whole passes and how much of one more pass
the mix takes; the number of blocks that gives is the source's exact quota. A binary tree over the
output shards splits the quotas: at each node a multivariate hypergeometric draw sends a random
number of blocks of every source to the left half, as if all blocks had been shuffled together.
Each leaf then takes the next blocks of a permutation of the source's blocks, so no block is drawn
twice, and a shard orders its documents by hash.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railmill.llm.common import Scratch, partitions, unused
from railmill.llm.tokens import Block, blocks, words

# Sources whose totals may come to the driver: about 100 bytes each.
MAX_SOURCES = 100_000
BUCKET_DOCS = 1024
_TOP_NODES = 64


class Source(NamedTuple):
    name: str | None
    size: int
    docs: int
    target: float


def targets(sizes: list[int], weights: tuple[float, ...], share: float, ceiling: float) -> list[float]:
    """Shares ``share * sum(sizes)`` by repeating weights; no target above ``ceiling * size``.

    What a source cannot take is shared again among the others by weight, until none is above.
    """
    weight = [weights[i % len(weights)] for i in range(len(sizes))]
    out = [0.0] * len(sizes)
    free, left = list(range(len(sizes))), share * sum(sizes)
    while free:
        total = sum(weight[i] for i in free)
        full = [i for i in free if left * weight[i] / total > ceiling * sizes[i]]
        if not full:
            for i in free:
                out[i] = left * weight[i] / total
            break
        for i in full:
            out[i] = ceiling * sizes[i]
        left -= sum(out[i] for i in full)
        free = [i for i in free if i not in set(full)]
    return out


def split(quotas: np.ndarray, offsets: np.ndarray, lo: int, hi: int, shards: int, seed: int):
    """Splits a node over shards [lo, hi) in two halves by one multivariate hypergeometric draw."""
    middle = (lo + hi) // 2
    total = int(quotas.sum())
    taken = total * (middle - lo) // (hi - lo)
    rng = np.random.Generator(np.random.Philox(key=[seed, lo * (shards + 1) + hi]))
    left = rng.multivariate_hypergeometric(quotas, taken, method="marginals") if len(quotas) else quotas
    return (lo, middle, left, offsets), (middle, hi, quotas - left, offsets + left)


def _leaves(nodes: Iterator[pd.DataFrame], shards: int, seed: int) -> Iterator[pd.DataFrame]:
    for frame in nodes:
        for lo, hi, quotas, offsets in frame.itertuples(index=False):
            stack = [(lo, hi, np.array(quotas, dtype=np.int64), np.array(offsets, dtype=np.int64))]
            while stack:
                lo, hi, quotas, offsets = stack.pop()
                if hi - lo > 1:
                    stack.extend(split(quotas, offsets, lo, hi, shards, seed))
                    continue
                some = np.flatnonzero(quotas)
                yield pd.DataFrame({"sid": some, "shard": lo, "start": offsets[some], "quota": quotas[some]})


def splitting_tree(spark: SparkSession, quotas: list[int], shards: int, seed: int) -> DataFrame:
    """``(sid, shard, start, quota)``: which run of each source's permuted blocks a shard takes.

    The driver splits the first levels only; every subtree is a task.
    """
    nodes = [(0, shards, np.array(quotas, dtype=np.int64), np.zeros(len(quotas), dtype=np.int64))]
    while len(nodes) < _TOP_NODES and any(hi - lo > 1 for lo, hi, _, _ in nodes):
        nodes = [half for n in nodes for half in (split(n[2], n[3], n[0], n[1], shards, seed) if n[1] - n[0] > 1 else (n,))]
    rows = [(lo, hi, q.tolist(), o.tolist()) for lo, hi, q, o in nodes]
    frame = spark.createDataFrame(rows, "lo long, hi long, quotas array<long>, offsets array<long>")
    return frame.repartition(len(rows)).mapInPandas(
        lambda batches: _leaves(batches, shards, seed), "sid long, shard long, start long, quota long"
    )


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes = [np.diff(words(b).bounds) for b in blocks(batch.column("text"))]
        size = pa.array(np.concatenate(sizes) if sizes else np.zeros(0, np.int64), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("source"), batch.column("h"), size],
            names=["doc_id", "source", "h", "size"],
        )


class Mixture:
    """The plan of a mix: where every document lies in its source's stream, and which blocks go where.

    ``docs`` has doc_id, text and source. Sizes are counts of words (runs of bytes other than ASCII
    white space); a null or empty text has size 0 and is never taken. A null source is a source of
    its own, after all others. Null and repeated doc_ids are allowed: order and identity come from
    the hash of id and text, and equal rows are interchangeable. An empty table gives an empty mix.
    Every draw is seeded and depends on the data only, so reruns agree.
    """

    def __init__(
        self,
        docs: DataFrame,
        weights: tuple[float, ...] = (3, 1, 2),
        share: float = 1.5,
        ceiling: float = 2.0,
        block_words: int = 1 << 15,
        shard_words: int = 1 << 22,
        seed: int = 20240601,
    ):
        self.spark = spark = docs.sparkSession
        self.scratch = scratch = Scratch(spark, "mixing")
        self.seed, self.block_words = seed, block_words
        rows = docs.select(
            F.col("doc_id").cast("bigint").alias("doc_id"),
            F.col("text").cast("string").alias("text"),
            F.col("source").cast("string").alias("source"),
        ).withColumn("h", self.order_hash())
        sized = scratch.keep(rows.mapInArrow(_counted, "doc_id long, source string, h long, size long"), "sized")
        totals = sized.groupBy("source").agg(F.sum("size").alias("size"), F.count("*").alias("docs"))
        found = totals.limit(MAX_SOURCES + 1).collect()
        if len(found) > MAX_SOURCES:
            raise ValueError(f"more than {MAX_SOURCES} sources")
        found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
        aims = targets([r["size"] for r in found], weights, share, ceiling)
        self.sources = [Source(r["source"], r["size"], r["docs"], t) for r, t in zip(found, aims)]
        self._plan_blocks(shard_words)
        self.placed = self._place(sized)

    def order_hash(self):
        """63 bits that order a source's documents."""
        return F.xxhash64(F.lit(self.seed), F.col("doc_id").cast("bigint"), F.col("text").cast("string")).bitwiseAND(
            F.lit((1 << 63) - 1)
        )

    def _plan_blocks(self, shard_words: int) -> None:
        rows, quotas = [], []
        rng = np.random.Generator(np.random.Philox(key=[self.seed, 0]))
        for sid, s in enumerate(self.sources):
            whole = round(s.target)
            passes, rest = divmod(whole, s.size) if s.size else (0, 0)
            pass_blocks = -(-s.size // self.block_words)
            quota = passes * pass_blocks + -(-rest // self.block_words)
            factor = int(rng.integers(1, max(quota, 2)))
            while math.gcd(factor, max(quota, 1)) != 1:
                factor += 1
            shift = int(rng.integers(0, max(quota, 1)))
            inverse = pow(factor, -1, quota) if quota > 1 else 0
            bits = max(0, math.ceil(math.log2(s.docs / BUCKET_DOCS)))
            rows.append((sid, s.name, s.size, float(s.target), passes, rest, pass_blocks, quota, shift, inverse, bits))
            quotas.append(quota)
        quota_rows = self.spark.createDataFrame(
            rows,
            "sid long, source string, source_size long, target double, passes long, rest long, "
            "pass_blocks long, quota long, shift long, inverse long, bits int",
        )
        # at most MAX_SOURCES rows; stored, so that Spark knows their size
        self.quotas = self.scratch.keep(quota_rows.coalesce(1), "quotas")
        self.shards = max(1, -(-sum(quotas) * self.block_words // shard_words))
        leaves = self.scratch.keep(splitting_tree(self.spark, quotas, self.shards, self.seed), "leaves")
        drawn = leaves.withColumn("p", F.explode(F.expr("sequence(start, start + quota - 1)")))
        rule = self.quotas.select("sid", F.col("quota").alias("q"), "shift", "inverse", "pass_blocks")
        x = F.when(F.col("q") > 1, F.expr("pmod((p - shift) * inverse, q)")).otherwise(F.lit(0))
        self.blocks = (
            drawn.join(rule, "sid")
            .withColumn("x", x)
            .select("sid", "shard", F.expr("x div pass_blocks").alias("copy"), F.expr("x % pass_blocks").alias("block"))
        )

    def _place(self, sized: DataFrame) -> DataFrame:
        """Adds to each document the words before it in its source's stream."""
        rule = self.quotas.withColumnRenamed("source", "_source")
        known = sized.join(rule, F.col("source").eqNullSafe(F.col("_source"))).drop("_source")
        known = known.withColumn("bucket", F.expr("shiftright(h, 63 - bits)"))
        sums = self.scratch.keep(known.groupBy("sid", "bucket").agg(F.sum("size").alias("n")), "buckets")
        before = Window.partitionBy("sid").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
        sums = sums.select("sid", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
        sums = self.scratch.keep(sums, "starts")
        inside = Window.partitionBy("sid", "bucket").orderBy("h", "doc_id", "size")
        earlier = F.coalesce(F.sum("size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        placed = known.join(sums, ["sid", "bucket"])
        return placed.select(
            "doc_id", "sid", "bucket", "h", "size", "source_size", "target", "passes", "rest",
            F.row_number().over(inside).alias("nth"),
            (F.col("base") + earlier).alias("at"),
        )

    def draws(self) -> DataFrame:
        """One row per copy taken: document, copy number, words taken, shard.

        A document is taken whole in each full pass, and in the last pass if it lies before the
        source's remaining words; the one document on that border gives its first words only.
        """
        last = F.least(F.greatest(F.col("rest") - F.col("at"), F.lit(0)), F.col("size"))
        placed = self.scratch.keep(self.placed, "placed")
        copies = placed.withColumn("copy", F.explode(F.expr("sequence(0L, passes)")))
        copies = copies.withColumn("words", F.when(F.col("copy") < F.col("passes"), F.col("size")).otherwise(last))
        copies = copies.filter("words > 0").withColumn("block", F.expr(f"at div {self.block_words}"))
        return copies.join(self.blocks, ["sid", "copy", "block"])

    def per_document(self) -> DataFrame:
        """Per document: doc_id, size, source_size, target, taken (words of all its copies)."""
        key = ["sid", "bucket", "nth"]
        taken = self.draws().groupBy(*key).agg(F.sum("words").alias("taken"))
        rows = self.placed.join(taken, key, "left")
        return rows.select("doc_id", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken"))


def _first_words(texts: pd.Series, counts: pd.Series) -> pd.Series:
    """The text up to the end of its n-th word; null texts stay null."""
    out = []
    for text, count in zip(texts, counts):
        if text is None:
            out.append(None)
            continue
        data = text.encode()
        ends = words(Block(0, np.frombuffer(data, np.uint8), np.array([0, len(data)]))).end
        out.append(data[: ends[int(count) - 1]].decode())
    return pd.Series(out, dtype=object)


def mix_documents(docs: DataFrame, **settings) -> DataFrame:
    """The mixed documents: the columns of ``docs`` and ``mix_shard``, a row per copy.

    Every shard's rows lie together, in random order. The text moves twice: to meet its plan and
    to its shard. ``n_chars``, if there, is counted anew for a text that was cut. Other columns
    are carried along.
    """
    mixture = Mixture(docs, **settings)
    columns = [c for c in docs.columns if c != "mix_shard"]
    copies = mixture.draws().groupBy("h", "doc_id", "sid", "nth").agg(
        F.collect_list(F.struct("shard", "copy", "words", "size")).alias("_copies")
    )
    # rows equal in id, text and source are told apart by their number
    alike = Window.partitionBy("_h", "_id", "_sid").orderBy("nth")
    plan = copies.select(F.col("h").alias("_h"), F.col("doc_id").alias("_id"), F.col("sid").alias("_sid"), "nth", "_copies")
    plan = mixture.scratch.keep(plan.withColumn("_k", F.row_number().over(alike)).drop("nth"), "plan").alias("p")

    sids = mixture.quotas.select(F.col("sid").alias("_sid"), F.col("source").alias("_source"))
    # the caller's row is one column, so its names clash with nothing
    row = F.struct(*[F.col(f"`{c}`").alias(c) for c in docs.columns])
    own = docs.select(
        row.alias("_row"), mixture.order_hash().alias("_h"), F.col("doc_id").cast("bigint").alias("_id"),
        F.col("source").cast("string").alias("_own"),
    ).join(sids, F.col("_own").eqNullSafe(F.col("_source")))
    own = own.withColumn("_n", F.row_number().over(Window.partitionBy("_h", "_id", "_sid").orderBy("_h"))).alias("o")
    same = (
        (F.col("o._h") == F.col("p._h"))
        & F.col("o._id").eqNullSafe(F.col("p._id"))
        & (F.col("o._sid") == F.col("p._sid"))
        & (F.col("o._n") - F.col("p._k") == 0)  # not a key of the shuffle
    )
    taken = own.join(plan, same).select("o._row", "o._h", F.explode("p._copies").alias("_c"))
    field = F.col("_row").getField
    cut = F.col("_c.words") < F.col("_c.size")
    first = F.pandas_udf(_first_words, "string")(F.when(cut, field("text")), F.col("_c.words"))
    replaced = {"text": F.when(cut, first).otherwise(field("text"))}
    if "n_chars" in columns:
        replaced["n_chars"] = F.when(cut, F.length(first).cast(docs.schema["n_chars"].dataType)).otherwise(field("n_chars"))
    place = unused(columns, "order")
    order = F.xxhash64(F.lit(mixture.seed), "_h", "_c.copy").alias(place)
    shard = F.col("_c.shard").alias("mix_shard")
    rows = taken.select(*[replaced.get(c, field(c)).alias(c) for c in columns], shard, order)
    rows = rows.repartition(partitions(mixture.spark), "mix_shard").sortWithinPartitions("mix_shard", place)
    return rows.drop(place)
