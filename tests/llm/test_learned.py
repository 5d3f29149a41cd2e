"""Toxicity, quality and language: held-out accuracy, brute force of the parts, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest

from railmill.llm import langid, quality, toxicity
from railmill.llm.common import is_held_out
from railmill.llm.tokens import blocks


def labelled(scored, spark, folder, label):
    labels = {r["doc_id"]: r[label] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = [r for r in scored.collect() if r["doc_id"] in labels]
    assert all(r["held_out"] == is_held_out(r["doc_id"]) for r in rows)
    assert all(0 <= r["score"] <= 1 for r in rows)
    return [(labels[r["doc_id"]], r) for r in rows]


def test_toxicity_on_held_out_documents(spark, middle):
    docs, labels = (spark.read.parquet(f"{middle}/{t}.parquet") for t in ("documents", "labels"))
    rows = labelled(toxicity.score_toxicity(docs, labels), spark, middle, "toxic")
    held = [(y, r) for y, r in rows if r["held_out"]]
    assert np.mean([y == r["predicted"] for y, r in held]) > 0.9
    assert np.mean([r["predicted"] == 0 for y, r in held if y == 0]) > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.5) for _, r in rows)


def test_toxicity_ranks_held_out_documents(spark, middle):
    """Copies and long texts make evidence large and the classes nearly separable; scores must still tell texts apart."""
    docs, labels = (spark.read.parquet(f"{middle}/{t}.parquet") for t in ("documents", "labels"))
    held = [(y, r["score"]) for y, r in labelled(toxicity.score_toxicity(docs, labels), spark, middle, "toxic") if r["held_out"]]
    ones, zeros = ([s for y, s in held if y == label] for label in (1, 0))
    assert np.mean([(a > b) + (a == b) / 2 for a in ones for b in zeros]) > 0.88


def test_logistic_fit_does_not_overshoot():
    """Evidence with a heavy tail and nearly separable classes: plain Newton steps run away and rank nothing."""
    rng = np.random.default_rng(1148)
    tail = rng.uniform(1, 2.5)
    best = np.concatenate((rng.normal(-3, 0.3, 2400), rng.lognormal(1, tail, 40), rng.lognormal(4.5, tail / 2, 200)))
    y = np.concatenate((np.zeros(2440), np.ones(200)))
    w = toxicity.fit_logistic(np.stack((np.ones_like(best), best, np.log1p(np.maximum(best, 0))), axis=1), y)
    assert np.abs(w).max() < 100


def test_quality_on_held_out_documents(spark, middle):
    docs, labels = (spark.read.parquet(f"{middle}/{t}.parquet") for t in ("documents", "labels"))
    rows = labelled(quality.score_quality(docs, labels), spark, middle, "quality")
    held = [(y, r) for y, r in rows if r["held_out"]]
    assert np.mean([y == r["predicted"] for y, r in held]) > 0.95
    assert all(r["predicted"] == (r["score"] >= 0.3) for _, r in rows)


def test_language_on_held_out_documents(spark, middle):
    docs = spark.read.parquet(f"{middle}/documents.parquet")
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    rows = langid.predict_language(docs).collect()
    assert np.mean([lang[r["doc_id"]] == r["lang_pred"] for r in rows if is_held_out(r["doc_id"])]) > 0.97
    assert all(r["held_out"] == is_held_out(r["doc_id"]) and 0 <= r["score"] <= 1 for r in rows)


def test_scores_do_not_depend_on_other_columns(spark, small):
    """Labels are learned from documents that are not held out only; ids, languages and sources never count."""
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    flipped = labels.selectExpr("doc_id", "1 - quality as quality", "1 - toxic as toxic")
    held = [r["doc_id"] for r in labels.collect() if is_held_out(r["doc_id"])]
    mixed = labels.filter(~labels.doc_id.isin(held)).unionByName(flipped.filter(flipped.doc_id.isin(held)))
    for score in (quality.score_quality, toxicity.score_toxicity):
        want = {r["doc_id"]: r["score"] for r in score(docs, labels).collect()}
        got = {r["doc_id"]: r["score"] for r in score(docs.selectExpr("doc_id", "text", "'?' as lang"), mixed).collect()}
        assert got == want


def test_segments_are_the_maximal_ones():
    """By definition: split off the best segment, then search both sides of it."""

    def brute(scores, at=0):
        best, span = 0.0, None
        for i in range(len(scores)):
            total = 0.0
            for j in range(i, len(scores)):
                total += scores[j]
                if total > best + 1e-12:
                    best, span = total, (i, j + 1)
        if span is None:
            return []
        i, j = span
        return [*brute(scores[:i], at), (at + i, at + j, best), *brute(scores[j:], at + j)]

    rng = random.Random(4)
    for _ in range(300):
        scores = [rng.choice([-3, -2, -1, 1, 2, 3]) + rng.random() / 100 for _ in range(rng.randrange(0, 25))]
        got, want = toxicity.segments(np.array(scores)), brute(scores)
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert [g[2] for g in got] == pytest.approx([w[2] for w in want])


def test_prefixes_lend_their_odds_to_unseen_words():
    def column(*texts):
        return next(blocks(pa.array(texts)))

    toxic, total = toxicity._tables(), toxicity._tables()
    for text, bad in [("grimbleton", 1), ("grimblesque", 1), ("grimblefax", 1), ("harmless words", 0)] * 30:
        t = toxicity.tokens(column(text))
        for level in range(toxicity.LEVELS):
            at = t.bucket[level][t.known[level]]
            np.add.at(total[level], at, 1)
            np.add.at(toxic[level], at, bad)
    lexicon = toxicity.Lexicon(toxic, total, 0.5)
    unseen, seen, other = lexicon.scores(toxicity.tokens(column("grimbleoid harmless stranger")))
    assert unseen > 1 > 0 > seen and other < 0


def test_n_gram_features_by_hand():
    block = next(blocks(pa.array(["ab ab cd", "", None, "xyzzy"])))
    words, threes, fives = quality.features(block)
    assert np.diff(words.bounds).tolist() == [4, 0, 0, 1]  # three words and one repeat
    assert np.diff(threes.bounds).tolist() == [6, 0, 0, 3] and np.diff(fives.bounds).tolist() == [4, 0, 0, 1]
    assert words.bucket[2] == 0 and words.bucket[0] == words.bucket[1]
    again = quality.features(next(blocks(pa.array(["xyzzy"]))))
    assert all((a.bucket[-len(b.bucket) :] == b.bucket).all() for a, b in zip((words, threes, fives), again))


@pytest.mark.parametrize("score", [toxicity.score_toxicity, quality.score_quality])
def test_odd_rows(spark, odd_documents, small, score):
    labels = spark.read.parquet(f"{small}/labels.parquet")
    strange = labels.limit(0).unionByName(
        spark.createDataFrame([(6, 0, 1), (6, 1, 0), (7, None, None), (None, 1, 1), (9, 1, 0), (4, 0, 1)], labels.schema)
    )
    for given in (labels, strange, labels.limit(0)):
        rows = score(odd_documents, given).collect()
        assert len(rows) == odd_documents.count() and all(0 <= r["score"] <= 1 for r in rows)
        assert not any(r["held_out"] for r in rows if r["doc_id"] is None)
    assert score(odd_documents.limit(0), labels).collect() == []


def test_the_filter_keeps_columns_and_good_rows(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    want = {r["doc_id"] for r in quality.score_quality(docs, labels).collect() if r["predicted"]}
    kept = quality.keep_good(docs, labels)
    assert kept.schema == docs.schema and {r["doc_id"] for r in kept.collect()} == want


def test_language_of_odd_rows(spark, odd_documents):
    rows = {r["doc_id"]: r for r in langid.predict_language(odd_documents).collect()}
    assert all(rows[i]["lang_pred"] == "und" and rows[i]["score"] == 0 for i in (1, 2, 3))
    assert {rows[i]["lang_pred"] for i in (4, 5, 6, 7, 8, 9)} <= {"en", "de", "fr"}
    assert langid.predict_language(odd_documents.limit(0)).collect() == []
    nothing = odd_documents.selectExpr("doc_id", "text", "cast(null as string) as lang")
    assert {r["lang_pred"] for r in langid.predict_language(nothing).collect()} == {"und"}


def test_unlike_texts_are_rejected(spark, documents):
    rows = [(i, "the quick brown fox jumps over the lazy dog near the river bank " * 3 + f"number{i}") for i in range(200)]
    docs = documents([*rows, (1000, "qqqq zzzz xxxx vvvv jjjj kkkk " * 5)])
    found = {r["doc_id"]: r for r in langid.predict_language(docs.filter("doc_id < 1000")).collect()}
    assert not any(r["rejected"] for i, r in found.items() if not is_held_out(i))
    learned = docs.filter("doc_id < 1000").unionByName(docs.filter("doc_id = 1000").selectExpr("doc_id", "text", "null as lang", "source", "n_chars"))
    assert {r["doc_id"]: r["rejected"] for r in langid.predict_language(learned).collect()}[1000]
