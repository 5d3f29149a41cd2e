"""Tokens, components and the generic grouping by buckets."""

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from railmill.llm.common import Scratch
from railmill.llm.grouping import components, group
from railmill.llm.tokens import blocks, prefix, shingle_sets, words

WORD = re.compile(rb"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("block_bytes", [1, 7, 1 << 20])
def test_words_of_texts(block_bytes):
    texts = ["", None, " a  bB\tc\n", "ünï \x0bx", "\x00 \x1f", "tail", "x" * 50, " "]
    for column in (pa.array(texts), pa.array(["drop", *texts]).slice(1), pa.chunked_array([texts[:3], texts[3:]])):
        got, rows = [], 0
        for block in blocks(column, block_bytes):
            found = words(block)
            assert block.first == rows
            rows += block.rows
            for a, b in zip(found.bounds[:-1], found.bounds[1:]):
                got.append([bytes(block.data[s:e]) for s, e in zip(found.start[a:b], found.end[a:b])])
        assert got == [WORD.findall((t or "").encode()) for t in texts]


def test_hashes_depend_on_the_bytes_alone():
    block = next(blocks(pa.array(["one two ONE", "two", "onetwo"])))
    found = words(block)
    a, b, c, d, e = prefix(block.data).hashes(found.start, found.end)
    assert a == c and b == d and len({a, b, e}) == 3


def test_shingle_sets_are_sets():
    texts = ["a b c a b c a", "c a b", "", "x", "X", "a b", "b a"]
    block = next(blocks(pa.array(texts)))
    sets, bounds = shingle_sets(block, 3)
    own = [set(sets[a:b].tolist()) for a, b in zip(bounds[:-1], bounds[1:])]
    assert [len(s) for s in own] == [3, 1, 0, 1, 1, 1, 1]
    assert own[1] < own[0] and own[3] == own[4] and own[5] != own[6]


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(45)]
    links += [(100 + i, 101 + i) for i in range(40)] + [(7, 7)] + links[:3]
    parent = list(range(200))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        parent[b] = a
    rng.shuffle(links)
    df = spark.createDataFrame(links, "a long, b long")
    got = dict(map(tuple, components(df, Scratch(spark, "test")).collect()))
    assert got == {x: root(x) for a, b in links if a != b for x in (a, b)}
    assert components(df.limit(0), Scratch(spark, "test")).collect() == []


def test_grouping_finds_links_the_centre_does_not_show(spark):
    """Numbers are linked if they differ by one; all share one bucket, and its centre touches few."""
    nodes = [1, 2, 3, 10, 11, 20, 30, 31, 32, 33]
    buckets = spark.createDataFrame([(5, n) for n in nodes] + [(6, 99)], "key long, node long")
    sketches = spark.createDataFrame([(n, (n,)) for n in [*nodes, 99]], "node long, sketch struct<at: long>")

    def maybe(a, b):
        return F.abs(F.col(a)["at"] - F.col(b)["at"]) <= 4

    def verify(pairs, most):
        return pairs.filter("abs(sketch_a.at - sketch_b.at) = 1").select("a", "b")

    got = group(buckets, sketches, maybe, verify, Scratch(spark, "test"))
    assert dict(map(tuple, got.collect())) == {1: 1, 2: 1, 3: 1, 10: 10, 11: 10, 30: 30, 31: 30, 32: 30, 33: 30}
