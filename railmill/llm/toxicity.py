"""Toxic passages: maximum-scoring segments over token log-odds, with extreme-value statistics.

Learning counts in how many toxic and clean documents a token occurs. A token's rate has a
Dirichlet prior whose mean is the rate of the token's longest known prefix, so an unseen form of
a known stem inherits its odds and a rare word stays near neutral. The score of a token is its
log-odds against the base rate, less a constant drift that makes clean text negative.

A linear scan then finds all maximal scoring segments of a text. For negative drift the score S of
the best segment among n clean tokens follows an extreme-value law: about K*n*exp(-lambda*S)
segments reach S by chance. lambda solves E[exp(lambda*s)] = 1 over clean tokens and K is fitted to
clean documents. A logistic curve over the logarithms of the evidence of the best and of all significant segments
turns it into a score between 0 and 1.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import Scratch, held_out
from railmill.llm.tokens import U64, Block, as_long, blocks, prefix

# A token is a run of ASCII letters, digits, or bytes of other alphabets.
INSIDE = np.zeros(256, dtype=bool)
INSIDE[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
PREFIXES = (4, 5, 6)  # bytes
LEVELS = len(PREFIXES) + 1
BITS = (*[18] * len(PREFIXES), 20)  # of the hash tables: prefixes are fewer than words
PRIOR = 10.0
DRIFT = 0.6
MIN_DOCS = 2
SAMPLE_DOCS = 16_384
LEAST = -5.0  # evidence below counts as this
GUESS = (-2.0, 0.0, 1.0)  # weights before any document is seen


class Tokens(NamedTuple):
    row: np.ndarray
    bounds: np.ndarray
    known: np.ndarray  # levels x tokens, whether the token is longer than the prefix
    bucket: np.ndarray  # levels x tokens; the last level is the whole token


def tokens(block: Block) -> Tokens:
    n = len(block.data)
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = INSIDE[block.data]
    cut = np.zeros(n + 1, dtype=bool)
    cut[block.starts] = True
    previous = np.concatenate(([False], inside[:-1]))
    start = np.flatnonzero(inside & (~previous | cut))
    end = np.flatnonzero(previous & (~inside | cut))
    bounds = np.searchsorted(start, block.starts)
    sums = prefix(block.data)
    known = np.ones((LEVELS, len(start)), dtype=bool)
    bucket = np.empty((LEVELS, len(start)), dtype=np.int64)
    for level, width in enumerate(PREFIXES):
        known[level] = end - start > width
        bucket[level] = as_long(sums.hashes(start, np.minimum(start + width, end)) & U64((1 << BITS[level]) - 1))
    bucket[-1] = as_long(sums.hashes(start, end) & U64((1 << BITS[-1]) - 1))
    row = np.repeat(np.arange(block.rows), np.diff(bounds))
    return Tokens(row, bounds, known, bucket)


class Lexicon(NamedTuple):
    """Document counts by level and bucket, and the share of toxic documents."""

    toxic: list[np.ndarray]  # one table a level
    total: list[np.ndarray]
    rate: float

    def scores(self, t: Tokens) -> np.ndarray:
        """Log-odds of every token against the base rate, less the drift."""
        rate = np.full(t.bucket.shape[1], self.rate)
        for level in range(LEVELS):
            at = t.bucket[level]
            finer = (self.toxic[level][at] + PRIOR * rate) / (self.total[level][at] + PRIOR)
            rate = np.where(t.known[level], finer, rate)
        base = np.log(self.rate / (1 - self.rate))
        return np.log(rate / (1 - rate)) - base - DRIFT


def segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments ``(from, to, score)``, disjoint and in order.

    Only runs of positive tokens are visited; what lies between them enters by prefix sums. The
    candidates form a stack in which a candidate points to the last one with a smaller left sum,
    so every run is pushed and merged once: linear time.
    """
    sums = np.concatenate(([0.0], np.cumsum(scores)))
    positive = scores > 0
    edges = np.flatnonzero(np.diff(np.concatenate(([False], positive, [False])).astype(np.int8)))
    stack: list[tuple[int, int, float, float, int]] = []  # from, to, left sum, right sum, link
    for start, end in zip(edges[::2].tolist(), edges[1::2].tolist()):
        left, right = float(sums[start]), float(sums[end])
        while True:
            link = len(stack) - 1
            while link >= 0 and stack[link][2] >= left:
                link = stack[link][4]
            if link < 0 or stack[link][3] >= right:
                stack.append((start, end, left, right, link))
                break
            start, left = stack[link][0], stack[link][2]
            del stack[link:]
    return [(a, b, r - x) for a, b, x, r, _ in stack]


class Model(NamedTuple):
    lexicon: Lexicon
    decay: float  # lambda
    log_k: float
    weights: np.ndarray  # of 1 and the logarithms of best and total evidence: long texts do not saturate the score

    def evidence(self, scores: np.ndarray) -> tuple[float, float, list[tuple[int, int, float]]]:
        """Evidence of the best segment and the sum over segments expected less than once by chance."""
        if not len(scores):
            return 0.0, 0.0, []
        offset = self.log_k + np.log(len(scores))
        found = [(a, b, self.decay * s - offset) for a, b, s in segments(scores)]
        significant = [f for f in found if f[2] > 0]
        best = max((f[2] for f in found), default=-offset)
        return max(best, LEAST), sum(f[2] for f in significant), significant

    def probability(self, best: float, total: float) -> float:
        x = self.weights @ (1.0, np.log1p(best - LEAST), np.log1p(total))
        return float(1 / (1 + np.exp(-np.clip(x, -50, 50))))


def _tables() -> list[np.ndarray]:
    """Empty counters; no count exceeds the documents of a sample."""
    return [np.zeros(1 << bits, dtype=np.uint32) for bits in BITS]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Partial document counts of one task: level, bucket, toxic, total."""
    toxic, total = _tables(), _tables()
    for batch in batches:
        label = batch.column("label").to_numpy()
        for block in blocks(batch.column("text")):
            t = tokens(block)
            for level in range(LEVELS):
                bits = BITS[level]
                pairs = np.unique((t.row[t.known[level]] << bits) | t.bucket[level][t.known[level]])
                bucket = pairs & ((1 << bits) - 1)
                weight = label[block.first + (pairs >> bits)] == 1
                np.add.at(total[level], bucket, 1)
                np.add.at(toxic[level], bucket[weight], 1)
    for level in range(LEVELS):
        some = np.flatnonzero(total[level])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(some), level, dtype=np.int32)),
                pa.array(some),
                pa.array(toxic[level][some].astype(np.int64)),
                pa.array(total[level][some].astype(np.int64)),
            ],
            names=["level", "bucket", "toxic", "total"],
        )


def _clean_histogram(batches, shared, edges) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(len(edges) + 1, dtype=np.int64)
    for batch in batches:
        label = batch.column("label").to_numpy()
        for block in blocks(batch.column("text")):
            t = tokens(block)
            scores = shared.value.scores(t)[label[block.first + t.row] == 0]
            counts += np.bincount(np.searchsorted(edges, scores), minlength=len(counts))
    some = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bin", "n"])


def _best_scores(batches, shared) -> Iterator[pa.RecordBatch]:
    """Per document: label, tokens, and the scores of its segments."""
    for batch in batches:
        label = batch.column("label").to_numpy()
        for block in blocks(batch.column("text")):
            t = tokens(block)
            scores = shared.value.scores(t)
            found = [[s for _, _, s in segments(scores[a:b])] for a, b in zip(t.bounds[:-1], t.bounds[1:])]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(label[block.first : block.first + block.rows].astype(np.int32)),
                    pa.array(np.diff(t.bounds).astype(np.int64)),
                    pa.array([max(f, default=0.0) for f in found], pa.float64()),
                    pa.array(found, pa.list_(pa.float64())),
                ],
                names=["label", "n", "best", "segments"],
            )


def _solve_decay(edges: np.ndarray, counts: np.ndarray) -> float:
    """The positive root of E[exp(lambda * s)] = 1 over the histogram of clean token scores."""
    centres = np.concatenate(([edges[0]], (edges[:-1] + edges[1:]) / 2, [edges[-1]]))
    share = counts / max(counts.sum(), 1)
    low, high = 1e-3, 20.0
    for _ in range(80):
        middle = (low + high) / 2
        if share @ np.exp(middle * centres) > 1:
            high = middle
        else:
            low = middle
    return low


def fit_logistic(x: np.ndarray, y: np.ndarray, guess: tuple[float, ...] = GUESS, ridge: float = 1.0, steps: int = 100) -> np.ndarray:
    """Weights of a logistic regression with a ridge penalty around ``guess``, by damped Newton steps.

    A full step may overshoot where nearly all points are certain; it is halved until it gains.
    """
    start = np.array(guess)
    w = start

    def loss(w: np.ndarray) -> float:
        z = x @ w
        return np.logaddexp(0, z).sum() - y @ z + ridge * ((w - start) @ (w - start)) / 2

    at = loss(w)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + ridge * (w - start)
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        while np.abs(step).max() > 1e-8 and loss(w - step) > at:
            step = step / 2
        if np.abs(step).max() <= 1e-8:
            break
        w = w - step
        at = loss(w)
    return w


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, sample_docs: int, scratch: Scratch) -> DataFrame:
    """``(doc_id, text, label)`` of at most ``sample_docs`` labelled documents that are not held out.

    The labels are sampled by hash before the texts are touched, and the sampled ids stored: with
    their few bytes known, Spark broadcasts them and filters the documents where they are read. An id with several labels
    takes the smallest; one without a label, or null, is left out.
    """
    usable = labels.filter(F.col("doc_id").isNotNull() & F.col(label).isin(0, 1) & ~held_out(F.col("doc_id")))
    chosen = usable.groupBy("doc_id").agg(F.min(label).cast("int").alias("label"))
    chosen = chosen.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    return docs.select("doc_id", "text").join(scratch.keep(chosen, "chosen"), "doc_id")


def learn(sample: DataFrame, scratch: Scratch) -> Model | None:
    """Counts on three quarters of the sample, calibration on the rest; None without both classes."""
    spark = sample.sparkSession
    sample = scratch.keep(sample.withColumn("part", F.pmod(F.xxhash64(F.lit(7), "doc_id"), F.lit(4))), "sample")
    counting, rest = sample.filter("part <> 0"), sample.filter("part = 0")
    classes = {r["label"]: r["n"] for r in counting.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if not classes.get(0) or not classes.get(1):
        return None
    counts = counting.select("text", "label").mapInArrow(_count, "level int, bucket long, toxic long, total long")
    counts = counts.groupBy("level", "bucket").agg(F.sum("toxic").alias("toxic"), F.sum("total").alias("total"))
    found = counts.filter(F.col("total") >= MIN_DOCS).toArrow()  # at most one row a bucket
    level, bucket, a, n = (found.column(i).to_numpy() for i in range(4))
    toxic, total = _tables(), _tables()
    for i in range(LEVELS):
        here = level == i
        toxic[i][bucket[here]], total[i][bucket[here]] = a[here], n[here]
    lexicon = Lexicon(toxic, total, classes[1] / (classes[0] + classes[1]))
    shared = spark.sparkContext.broadcast(lexicon)

    edges = np.linspace(-8, 8, 641)
    bins = rest.select("text", "label").mapInArrow(lambda b: _clean_histogram(b, shared, edges), "bin long, n long")
    histogram = np.zeros(len(edges) + 1)
    for row in bins.groupBy("bin").agg(F.sum("n").alias("n")).collect():
        histogram[row["bin"]] = row["n"]
    decay = _solve_decay(edges, histogram)
    docs = rest.select("text", "label").mapInArrow(
        lambda b: _best_scores(b, shared), "label int, n long, best double, segments array<double>"
    )
    clean = docs.filter("label = 0 and n > 0 and best > 0").select(F.avg(F.lit(decay) * F.col("best") - F.log("n")))
    log_k = float((clean.first()[0] or 0.0) - np.euler_gamma)  # mean of a Gumbel variable
    draft = Model(lexicon, decay, log_k, np.array(GUESS))
    offset = F.lit(log_k) + F.log(F.greatest("n", F.lit(1)))
    gains = F.transform("segments", lambda s: F.greatest(F.lit(decay) * s - offset, F.lit(0.0)))
    total_gain = F.aggregate(gains, F.lit(0.0), lambda x, y: x + y)
    best = F.when(F.col("n") > 0, F.greatest(F.lit(decay) * F.col("best") - offset, F.lit(LEAST))).otherwise(0.0)
    points = docs.select("label", F.log1p(best - LEAST).alias("best"), F.log1p(total_gain).alias("total")).toArrow()
    y, x1, x2 = (points.column(i).to_numpy().astype(float) for i in range(3))
    shared.destroy()
    if 0 < y.sum() < len(y):
        draft = draft._replace(weights=fit_logistic(np.stack([np.ones_like(x1), x1, x2], axis=1), y))
    return draft


def _scored(batches, shared) -> Iterator[pa.RecordBatch]:
    model: Model = shared.value
    span = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("evidence", pa.float64())])
    for batch in batches:
        for block in blocks(batch.column("text")):
            t = tokens(block)
            scores = model.lexicon.scores(t)
            out, spans = [], []
            for a, b in zip(t.bounds[:-1], t.bounds[1:]):
                best, total, found = model.evidence(scores[a:b])
                out.append(model.probability(best, total))
                spans.append([{"first": x, "last": y - 1, "evidence": e} for x, y, e in found])
            ids = batch.column("doc_id").slice(block.first, block.rows)
            yield pa.RecordBatch.from_arrays([ids, pa.array(out), pa.array(spans, pa.list_(span))], names=["doc_id", "score", "passages"])


def score_toxicity(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, held_out, score, predicted, passages.

    ``passages`` holds the significant segments as first and last token number and evidence.
    The model learns from at most ``sample_docs`` documents whose label ``toxic`` is 0 or 1 and
    which are not held out; texts are the only input of a score. Null and empty texts, and all texts
    if no two classes can be learned, get the score of no evidence. Rows without doc_id are scored
    and not held out; repeated rows get equal scores. Every text is scanned whole, in place.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "toxicity")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    model = learn(labelled_sample(texts, labels, "toxic", sample_docs, scratch), scratch)
    if model is None:
        nothing = Lexicon(_tables(), _tables(), 0.5)
        model = Model(nothing, 1.0, 0.0, np.array(GUESS))
    shared = spark.sparkContext.broadcast(model)
    scored = texts.mapInArrow(
        lambda b: _scored(b, shared),
        "doc_id long, score double, passages array<struct<first:bigint,last:bigint,evidence:double>>",
    )
    predicted: Column = (F.col("score") >= 0.5).cast("int")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted.alias("predicted"), "passages")
