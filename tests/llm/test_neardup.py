import random
import re

import numpy as np
import pytest

from railmill.llm import neardup
from railmill.llm.common import Scratch
from railmill.llm.neardup import MISSED, banding, near_duplicates, super_minhash
from railmill.llm.tokens import U64, as_long, mix

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text, size):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return frozenset()
    if len(words) < size:
        return frozenset([tuple(words)])
    return frozenset(tuple(words[i : i + size]) for i in range(len(words) - size + 1))


def brute(rows, size, percent):
    """doc_id -> (set size, component) by comparing all pairs."""
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    parent = {i: i for i, _ in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, (i, a) in enumerate(sets):
        for j, b in sets[:k]:
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                x, y = sorted((root(i), root(j)))
                parent[y] = x
    return {i: (len(s), root(i)) for i, s in sets}


def check(spark, df, rows, size, percent):
    got = near_duplicates(df, size, percent).collect()
    want = brute(rows, size, percent)
    assert len(got) == len(rows)
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in got} == want
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    return want


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_equals_brute_force(spark, middle, size, percent):
    df = spark.read.parquet(f"{middle}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
    want = check(spark, df, rows, size, percent)
    assert len(set(c for _, c in want.values())) < len(want)


@pytest.mark.parametrize("size,percent,seed", [(3, 85, 1), (5, 80, 2)])
def test_a_large_group_around_one_text(spark, documents, size, percent, seed):
    """Variants of one text, many of which are close to the threshold: links beyond the centre's count."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    rows = []
    for i in range(250):
        words = list(base)
        for _ in range(rng.randrange(0, 8)):
            words[rng.randrange(len(words))] = f"x{rng.randrange(40)}"
        rows.append((i, " ".join(words)))
    want = check(spark, documents(rows), rows, size, percent)
    assert 1 < len(set(c for _, c in want.values())) < 250


def test_members_linked_with_each_other_only_meet_few(spark, monkeypatch):
    """Members that differ alike from their centre are all linked: a share of the prefix rows meets, not all pairs."""
    met = []
    keep = Scratch.keep

    def counted(self, df, name="step"):
        kept = keep(self, df, name)
        if name == "meet":
            met.append(kept.count())
        return kept

    monkeypatch.setattr(Scratch, "keep", counted)
    members, alike = 300, list(range(1000, 1036))
    diffs = [[*alike, 2 * i, 2 * i + 1] for i in range(members)]
    odd = as_long(neardup.parities(np.array(sum(diffs, []), dtype=U64), np.arange(members + 1) * len(diffs[0])))
    rows = [(i + 1, 0, 150, False, d, *map(int, o)) for i, (d, o) in enumerate(zip(diffs, odd))]
    columns = ["a bigint, b bigint, n bigint, linked boolean, diff array<bigint>", *[f"{c} bigint" for c in neardup.PARITY]]
    compared = spark.createDataFrame(rows, ", ".join(columns))
    labels = spark.createDataFrame([], "node bigint, label bigint")
    got = neardup._further_links(compared, labels, 85, Scratch(spark, "test")).collect()
    assert {tuple(r) for r in got} == {(i + 1, 1) for i in range(members)}
    assert sum(met) <= members * len(alike) < members * (members - 1) // 2


def test_parities_bound_differences():
    rng = np.random.default_rng(4)
    sets = [np.unique(rng.integers(0, 1 << 40, n).astype(U64)) for n in (0, 1, 30, 60, 400)]
    sets.append(np.concatenate([sets[3][:50], sets[2]]))
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    odd = neardup.parities(np.concatenate(sets), bounds)
    assert odd.shape == (6, len(neardup.PARITY)) and not odd[0].any()
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            assert np.bitwise_count(odd[i] ^ odd[j]).sum() <= len(np.setxor1d(a, b))
    assert np.bitwise_count(odd[3] ^ odd[5]).sum() > 30


def test_chains_join_through_links(spark, documents):
    words = [f"w{i}" for i in range(60)]
    rows = []
    for i in range(25):
        words[(7 * i) % 60] = f"y{i}"
        rows.append((100 - i, " ".join(words)))
    want = check(spark, documents(rows), rows, 3, 80)
    assert len(set(c for _, c in want.values())) == 1


def test_odd_rows(spark, odd_documents):
    got = near_duplicates(odd_documents, 5, 80)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    found = sorted(got.collect(), key=repr)
    by_id = {r["doc_id"]: tuple(r)[1:] for r in found if r["doc_id"] is not None}
    assert by_id[1] == by_id[2][:0] + (0, 1, True) and by_id[2] == (0, 2, True) and by_id[3] == (0, 3, True)
    assert by_id[4][1:] == (4, True) and by_id[5][1:] == (4, False)
    assert by_id[6] == (2, 6, True) and by_id[7] == (2, 6, False) and by_id[9] == (1, 9, True)
    assert [tuple(r)[2:] for r in found if r["doc_id"] is None] == [(None, True)] * 2
    assert len(found) == odd_documents.count()
    assert near_duplicates(odd_documents.limit(0)).collect() == []


def test_one_id_with_two_texts_joins_both(spark, documents):
    rows = [(5, "a b c d e f"), (1, "a b c d e f"), (5, "p q r s t u"), (9, "p q r s t u")]
    got = near_duplicates(documents(rows), 3, 85).collect()
    assert {r["component_id"] for r in got} == {1}


def test_super_minhash_equals_its_definition():
    """Element by element: a lazily shuffled permutation of the slots, rank plus fraction, least wins."""
    rng = np.random.default_rng(5)
    slots, step = 120, 0x9E3779B97F4A7C15
    sizes = [0, 1, 2, 7, 300, 900]
    sets = [np.unique(rng.integers(0, 1 << 63, n).astype(U64)) for n in sizes]
    bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets])))
    got = super_minhash(np.concatenate(sets), bounds, slots)
    for found, elements in zip(got, sets):
        want = np.full(slots, np.iinfo(np.uint64).max, dtype=U64)
        for e in elements:
            order = list(range(slots))
            for rank in range(slots):
                bits = int(mix(np.array([e]) + U64((step * (rank + 1)) & (2**64 - 1)))[0])
                pick = rank + ((bits & 0xFFFFFF) * (slots - rank) >> 24)
                order[rank], order[pick] = order[pick], order[rank]
                want[order[rank]] = min(want[order[rank]], U64(rank << 40 | bits >> 24))
        assert (found == want).all()


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(9)
    shared = rng.integers(0, 1 << 63, 800).astype(U64)
    a = np.concatenate([shared, rng.integers(0, 1 << 63, 100).astype(U64)])
    b = np.concatenate([shared, rng.integers(0, 1 << 63, 100).astype(U64)])
    signature = super_minhash(np.concatenate([a, b]), np.array([0, 900, 1800]), 120)
    assert abs((signature[0] == signature[1]).mean() - 0.8) < 0.13


def test_bands_miss_few_pairs():
    assert banding(85) == (24, 5) and banding(80) == (27, 4)
    for percent in (50, 60, 70, 80, 85, 90, 95, 99, 100):
        bands, rows = banding(percent)
        assert (1 - min(percent / 100, 0.99) ** rows) ** bands <= MISSED and bands * rows <= 256


def test_every_text_of_a_repeated_id_keeps_its_links(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(60)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " q"), (3, b + " q"), (4, "something else entirely here now"), (0, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as t", "2 as node", "3 as doc")
    got = {(r["doc_id"], r["component_id"]) for r in near_duplicates(df, 3, 85).collect()}
    assert got == {(1, 1), (2, 1), (3, 1), (4, 4), (0, 0)}
