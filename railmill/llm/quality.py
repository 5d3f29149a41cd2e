"""Quality classifier: averaged embeddings of hashed words and character n-grams, softmax, SGD.

A document is the average of the learned vectors of its words and word repeats plus the average
of the vectors of its byte n-grams; a softmax layer turns it into class probabilities. Training
runs mini-batch gradient descent in numpy over a bounded sample. Because averaging and the output
layer are linear, a trained model folds to one number per hash bucket, so scoring a text is a
gather and a mean.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import Scratch, held_out
from railmill.llm.tokens import CODES, U64, Block, blocks, prefix, segment_sums, words
from railmill.llm.toxicity import labelled_sample

BITS = 16
NGRAMS = (3, 5)  # bytes
DIM = 8
SAMPLE_DOCS = 4096
EPOCHS = 12
BATCH = 32
RATE = 0.5
_MASK = U64((1 << BITS) - 1)


class Family(NamedTuple):
    """Feature buckets of one kind and the first feature of each text."""

    bucket: np.ndarray
    bounds: np.ndarray


def features(block: Block) -> list[Family]:
    """Words with their case, a marker for each word equal to the one before, and byte n-grams."""
    sums = prefix(block.data, CODES)
    found = words(block)
    hashed = sums.hashes(found.start, found.end)
    again = np.zeros(len(hashed), dtype=bool)
    again[1:] = (hashed[1:] == hashed[:-1]) & (found.row[1:] == found.row[:-1])
    word = np.repeat((hashed & _MASK).view(np.int64), 1 + again)
    first = np.concatenate(([0], np.cumsum(1 + again)))
    word[first[:-1][again] + 1] = 0  # the bucket of repeats
    out = [Family(word, first[found.bounds])]
    begin, end = block.starts[:-1], block.starts[1:]
    for size in NGRAMS:
        fits = np.ones(len(block.data), dtype=bool)
        for back in range(1, size):
            at = end - back
            fits[at[at >= begin]] = False
        start = np.flatnonzero(fits)
        bucket = ((sums.hashes(start, start + size) ^ U64(size)) & _MASK).view(np.int64)
        number = np.maximum(end - begin - size + 1, 0)
        out.append(Family(bucket, np.concatenate(([0], np.cumsum(number)))))
    return out


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per sampled document its distinct buckets and their weights, which sum to 1."""
    for batch in batches:
        for block in blocks(batch.column("text")):
            families = features(block)
            rows, keys, weights = [], [], []
            for family in families:
                count = np.diff(family.bounds)
                row = np.repeat(np.arange(block.rows), count)
                rows.append(row)
                keys.append((row << BITS) | family.bucket)
                weights.append(1.0 / (len(families) * count[row]))
            key, back = np.unique(np.concatenate(keys), return_inverse=True)
            weight = np.bincount(back, np.concatenate(weights), minlength=len(key))
            offsets = pa.array(np.searchsorted(key >> BITS, np.arange(block.rows + 1)).astype(np.int32))
            bucket = pa.ListArray.from_arrays(offsets, pa.array((key & ((1 << BITS) - 1)).astype(np.int32)))
            value = pa.ListArray.from_arrays(offsets, pa.array(weight.astype(np.float32)))
            label = batch.column("label").slice(block.first, block.rows)
            yield pa.RecordBatch.from_arrays([label, bucket, value], names=["label", "bucket", "weight"])


def train(labels: np.ndarray, bags: list[tuple[np.ndarray, np.ndarray]], seed: int = 1) -> np.ndarray:
    """One score per bucket and, last, the bias: the folded log-odds of label 1."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (1 << BITS, DIM)).astype(np.float32)
    output = rng.uniform(-1 / DIM, 1 / DIM, (DIM, 2)).astype(np.float32)
    rate = np.clip(labels.mean(), 0.01, 0.99)
    bias = np.log(np.array([1 - rate, rate]))
    steps = EPOCHS * (-(-len(bags) // BATCH))
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(len(bags))
        for at in range(0, len(order), BATCH):
            some = order[at : at + BATCH]
            hidden = np.array([bags[i][1] @ vectors[bags[i][0]] for i in some])
            logits = hidden @ output + bias
            p = np.exp(logits - logits.max(axis=1, keepdims=True))
            p /= p.sum(axis=1, keepdims=True)
            p[np.arange(len(some)), labels[some]] -= 1
            step = RATE * (1 - done / steps)
            # each example moves its own features, as if it came alone; a bag names a bucket once
            for i, back in zip(some, (step * DIM * p @ output.T).astype(np.float32)):
                bucket, weight = bags[i]
                vectors[bucket] -= weight[:, None] * back
            output -= (step * hidden.T @ p / len(some) * DIM).astype(np.float32)
            bias -= step * p.mean(axis=0) * 0.1
            done += 1
    folded = vectors @ (output[:, 1] - output[:, 0])
    return np.append(folded, bias[1] - bias[0]).astype(np.float64)


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    labels, bags = [], []
    for batch in batches:
        labels.extend(batch.column("label").to_pylist())
        for bucket, weight in zip(batch.column("bucket"), batch.column("weight")):
            bags.append((bucket.values.to_numpy(), weight.values.to_numpy()))
    if len(set(labels)) == 2:
        folded = train(np.array(labels), bags)
        yield pa.RecordBatch.from_arrays([pa.array([folded], pa.list_(pa.float64()))], names=["folded"])


def learn(sample: DataFrame, scratch: Scratch) -> np.ndarray | None:
    """The folded model, trained by one task on the bags of the bounded sample; None without two classes."""
    bags = sample.mapInArrow(_bags, "label int, bucket array<int>, weight array<float>")
    bags = scratch.keep(bags, "bags")
    order = F.xxhash64("bucket", "label")
    one = bags.repartition(1).sortWithinPartitions(order)
    model = one.mapInArrow(_trained, "folded array<double>").collect()
    return np.array(model[0]["folded"]) if model else None


def scores(column: pa.Array, folded: np.ndarray) -> np.ndarray:
    """The probability of label 1 for every text of a column."""
    out = []
    for block in blocks(column):
        families = features(block)
        logit = np.full(block.rows, folded[-1])
        for family in families:
            count = np.diff(family.bounds)
            logit += segment_sums(folded[family.bucket], family.bounds) / np.maximum(count, 1) / len(families)
        out.append(1 / (1 + np.exp(-np.clip(logit, -50, 50))))
    return np.concatenate(out) if out else np.zeros(0)


def _model(docs: DataFrame, labels: DataFrame, sample_docs: int):
    """The broadcast model; without two classes to learn one that finds every text good."""
    scratch = Scratch(docs.sparkSession, "quality")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    folded = learn(labelled_sample(texts, labels, "quality", sample_docs, scratch), scratch)
    return docs.sparkSession.sparkContext.broadcast(np.append(np.zeros(1 << BITS), 50.0) if folded is None else folded)


def score_quality(
    docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_docs: int = SAMPLE_DOCS
) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, held_out, score (of label 1), predicted.

    The model learns from at most ``sample_docs`` documents whose label ``quality`` is 0 or 1 and
    which are not held out; texts are the only input of a score. Null and empty texts have no
    features and get the score of the bias; without two classes to learn every score is 1.
    Rows without doc_id are scored and not held out; repeated rows get equal scores. Every text is
    scored whole, where it is read.
    """
    shared = _model(docs, labels, sample_docs)
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))

    def scored_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score = pa.array(scores(batch.column("text"), shared.value))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), score], names=["doc_id", "score"])

    scored = texts.mapInArrow(scored_batches, "doc_id long, score double")
    predicted = (F.col("score") >= threshold).cast("int").alias("predicted")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", predicted)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """The rows of ``docs`` whose text scores at least ``threshold``, with all their columns."""
    shared = _model(docs, labels, sample_docs)
    at = docs.columns.index("text")

    def good(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at), shared.value) >= threshold))

    return docs.mapInArrow(good, docs.schema)
