"""Language identification by nearest centroid over TF-IDF vectors of byte n-grams.

Every language has several centroids, found by spherical k-means over a bounded sample, so that
one language may hold different kinds of text. A text goes to the language of the centroid with
the largest cosine. The smallest cosine that a language's own sample reaches bounds how far a
text may lie from it; texts beyond are marked as rejected.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railmill.llm.common import Scratch, held_out
from railmill.llm.tokens import U64, Block, blocks, prefix

BITS = 12
NGRAMS = (1, 2, 3)
CLUSTERS = 3
SAMPLE_PER_LANG = 400
# Languages a model may hold: each costs CLUSTERS * 16 KB in every worker.
MAX_LANGS = 1000
# What a text may fall short of the smallest cosine of its language's sample.
REJECT_MARGIN = 1e-6
ROWS = 256
_SIZE = 1 << BITS
_LETTERS = np.full(256, 0x20, dtype=np.uint8)
_LETTERS[128:] = np.arange(128, 256)
_LETTERS[97:123] = _LETTERS[65:91] = np.arange(97, 123)


def letters(data: np.ndarray) -> np.ndarray:
    """The bytes with all that is no letter as a space; ASCII and Latin-1 letters in lower case."""
    out = _LETTERS[data]
    after = np.zeros(len(data), dtype=bool)
    after[1:] = data[:-1] == 0xC3  # lead byte of the Latin-1 letters
    out[after & (data >= 0x80) & (data <= 0x9E) & (data != 0x97)] += 0x20
    return out


def counts(block: Block) -> np.ndarray:
    """Texts x buckets: how often each hashed n-gram occurs. N-grams hold one space at the most."""
    data = letters(block.data)
    sums = prefix(data)
    spaces = np.concatenate(([0], np.cumsum(data == 0x20)))
    begin, end = block.starts[:-1], block.starts[1:]
    row = np.repeat(np.arange(block.rows) << BITS, end - begin)
    table = np.zeros(block.rows * _SIZE, dtype=np.int64)
    for size in NGRAMS:
        fits = np.ones(len(data), dtype=bool)
        for back in range(1, size):
            at = end - back
            fits[at[at >= begin]] = False
        start = np.flatnonzero(fits)
        start = start[spaces[start + size] - spaces[start] <= min(1, size - 1)]
        bucket = ((sums.hashes(start, start + size) ^ U64(size)) & U64(_SIZE - 1)).view(np.int64)
        table += np.bincount(row[start] | bucket, minlength=len(table))
    return table.reshape(block.rows, _SIZE)


def _parts(block: Block) -> Iterator[tuple[int, Block]]:
    """A block in pieces of few texts, so that the dense counts stay small."""
    for at in range(0, block.rows, ROWS):
        starts = block.starts[at : at + ROWS + 1]
        yield block.first + at, Block(0, block.data[starts[0] : starts[-1]], starts - starts[0])


def vectors(table: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Unit vectors of log-damped counts times inverse document frequency; zero stays zero."""
    x = np.log1p(table).astype(np.float32) * idf
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(norm > 0, norm, 1)


class Model(NamedTuple):
    idf: np.ndarray
    langs: list[str]
    centroids: np.ndarray  # (langs * clusters) x buckets
    owner: np.ndarray  # language of each centroid
    floor: np.ndarray  # per language, the smallest cosine accepted


def k_means(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means with farthest-first seeds; at most ``k`` unit centroids."""
    seeds = [x.mean(axis=0)]
    while len(seeds) < min(k, len(x)):
        unit = np.array([s / max(np.linalg.norm(s), 1e-12) for s in seeds])
        seeds.append(x[np.argmin((x @ unit.T).max(axis=1))])
    centroids = np.array(seeds)
    for _ in range(rounds):
        centroids /= np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)
        own = np.argmax(x @ centroids.T, axis=1)
        centroids = np.array([x[own == c].sum(axis=0) if (own == c).any() else centroids[c] for c in range(len(centroids))])
    return (centroids / np.maximum(np.linalg.norm(centroids, axis=1, keepdims=True), 1e-12)).astype(np.float32)


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for block in blocks(batch.column("text")):
            for first, part in _parts(block):
                table = counts(part)
                row, bucket = np.nonzero(table)
                offsets = pa.array(np.searchsorted(row, np.arange(part.rows + 1)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("lang").slice(first, part.rows),
                        pa.ListArray.from_arrays(offsets, pa.array(bucket.astype(np.int32))),
                        pa.ListArray.from_arrays(offsets, pa.array(table[row, bucket].astype(np.int32))),
                    ],
                    names=["lang", "bucket", "n"],
                )


def learn(docs: DataFrame, scratch: Scratch, per_lang: int = SAMPLE_PER_LANG) -> Model | None:
    """A model from at most ``per_lang`` documents of every language; None if there are none.

    The sample is chosen by hash from ids and languages alone, limited in every task before the
    shuffle. It is bounded by ``MAX_LANGS * per_lang`` rows and filtered where the texts are read.
    """
    spark = docs.sparkSession
    usable = docs.select("doc_id", "lang").filter("doc_id is not null and lang is not null and lang <> 'und'")
    usable = usable.filter(~held_out(F.col("doc_id")))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id"))
    chosen = usable.withColumn("rank", rank).filter(F.col("rank") <= per_lang).select("doc_id", "lang").distinct()
    chosen = scratch.keep(chosen, "chosen")
    langs = sorted(r["lang"] for r in chosen.select("lang").distinct().limit(MAX_LANGS + 1).collect())
    if len(langs) > MAX_LANGS:
        raise ValueError(f"more than {MAX_LANGS} languages")
    texts = docs.select("doc_id", "lang", "text").join(chosen, ["doc_id", "lang"])
    sample = scratch.keep(texts.select("lang", "text").mapInArrow(_sparse, "lang string, bucket array<int>, n array<int>"), "sample")
    sample = sample.filter(F.size("bucket") > 0)
    total = sample.count()
    if not total:
        return None
    idf = np.full(_SIZE, np.log(total + 1), dtype=np.float32)
    for row in sample.select(F.explode("bucket").alias("b")).groupBy("b").agg(F.count("*").alias("n")).collect():
        idf[row["b"]] = np.log((total + 1) / (row["n"] + 1)) + 0.05
    shared = spark.sparkContext.broadcast(idf)

    def centroids(group: pa.Table) -> pa.Table:
        table = np.zeros((group.num_rows, _SIZE), dtype=np.int64)
        for i, (bucket, n) in enumerate(zip(group.column("bucket"), group.column("n"))):
            table[i, bucket.values.to_numpy()] = n.values.to_numpy()
        x = vectors(table, shared.value)
        x = x[np.lexsort(x[:, :64].T)]  # k-means must not depend on the order of rows
        found = k_means(x, CLUSTERS)
        floor = float((x @ found.T).max(axis=1).min()) - REJECT_MARGIN
        rows = len(found)
        return pa.table(
            {
                "lang": [group.column("lang")[0].as_py()] * rows,
                "floor": [floor] * rows,
                "centroid": pa.array(list(found.astype(float)), pa.list_(pa.float64())),
            }
        )

    rows = sample.groupBy("lang").applyInArrow(centroids, "lang string, floor double, centroid array<double>").collect()
    rows.sort(key=lambda r: (r["lang"], r["centroid"]))
    names = sorted({r["lang"] for r in rows})
    floor = {r["lang"]: r["floor"] for r in rows}
    return Model(
        idf,
        names,
        np.array([r["centroid"] for r in rows], dtype=np.float32),
        np.array([names.index(r["lang"]) for r in rows]),
        np.array([floor[n] for n in names]),
    )


def predict_language(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """Per row of ``docs(doc_id, text, lang, ...)``: doc_id, held_out, lang_pred, score, rejected.

    ``score`` is the cosine to the nearest centroid. ``lang_pred`` is a learned value of ``lang``;
    it is ``und``, with score 0 and not rejected, if the text is null or has no letter, or if there
    was nothing to learn. Learning uses text and lang of documents that have both an id and a
    language and are not held out; ``und`` is never learned. Rows without doc_id are predicted and
    not held out; repeated rows get equal results. Every text is read whole, where it lies.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "langid")
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"),
    )
    model = learn(rows, scratch, per_lang)
    shared = spark.sparkContext.broadcast(model)

    def predicted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model: Model | None = shared.value
        for batch in batches:
            for block in blocks(batch.column("text")):
                for first, part in _parts(block):
                    has_letter = batch.column("has_letter").slice(first, part.rows).to_numpy(zero_copy_only=False)
                    usable = has_letter.astype(bool) & (model is not None)
                    lang, score, rejected = np.full(part.rows, "und", dtype=object), np.zeros(part.rows), np.zeros(part.rows, bool)
                    if usable.any():
                        cosine = vectors(counts(part), model.idf) @ model.centroids.T
                        best = cosine.argmax(axis=1)
                        owner = model.owner[best]
                        lang[usable] = np.array(model.langs, dtype=object)[owner[usable]]
                        near = np.clip(cosine[np.arange(part.rows), best], 0, 1).astype(float)
                        score[usable] = near[usable]
                        rejected = usable & (near < model.floor[owner])
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column("doc_id").slice(first, part.rows),
                            pa.array(lang, pa.string()),
                            pa.array(score),
                            pa.array(rejected),
                        ],
                        names=["doc_id", "lang_pred", "score", "rejected"],
                    )

    has_letter = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    found = rows.select("doc_id", "text", has_letter.alias("has_letter")).mapInArrow(
        predicted, "doc_id long, lang_pred string, score double, rejected boolean"
    )
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "rejected")
