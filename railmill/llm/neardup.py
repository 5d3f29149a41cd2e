"""Near-duplicate documents: SuperMinHash signatures, banding, verification, union-find.

SuperMinHash gives every element of a set one random permutation of the signature's slots and
offers each slot the value ``rank + fraction``. Small ranks win, so an element need only be
followed down its permutation until every slot holds a value below the next rank; the slots of
one set are spread without replacement, which lowers the variance against plain MinHash.

Documents that agree on all values of a band share a bucket. Every bucket compares its members
with one centre on the full shingle sets, which costs one comparison a member, and keeps the
difference of each set to the centre's. Two members that the centre does not join can be linked
only if their differences share elements that are early in both; a join on those finds every
further link without listing the pairs of a bucket. So links are exact, and among documents that
share a bucket none is lost. A pair at the threshold misses all buckets with a probability of at most
``MISSED``; the bands follow from that (24 of 5 values at a similarity of 0.85, 27 of 4 at 0.8).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.llm.common import Scratch, partitions
from railmill.llm.grouping import components
from railmill.llm.tokens import U64, as_long, blocks, mix, segment_sums, shingle_sets

MISSED = 1e-6
MAX_BANDS, MAX_SLOTS = 28, 256
# Shingles one salted share of a centre's members may hold before the next share begins.
SHARE_SHINGLES = 1 << 16
_RANK = U64(40)
_STEP = 0x9E3779B97F4A7C15
_ACTIVE = 1 << 17
# Words of the parities of a difference.
PARITY = [f"p{i}" for i in range(8)]


def banding(percent: int) -> tuple[int, int]:
    """Bands and values per band: the longest bands of which few enough suffice."""
    best = (math.ceil(math.log(MISSED) / math.log(1 - min(percent / 100, 0.99))), 1)
    for rows in range(2, MAX_SLOTS):
        share = min(percent / 100, 0.99) ** rows
        bands = math.ceil(math.log(MISSED) / math.log(1 - share))
        if bands > MAX_BANDS or bands * rows > MAX_SLOTS:
            break
        best = (bands, rows)
    if best[0] * best[1] > MAX_SLOTS:
        raise ValueError(f"a similarity of {percent} % is too low for {MAX_SLOTS} slots")
    return best


def super_minhash(elements: np.ndarray, bounds: np.ndarray, slots: int) -> np.ndarray:
    """One signature (uint64 x ``slots``) per set; the elements of set i lie between its bounds.

    All sets move down their permutations together. A set leaves once its largest value is
    below the next rank: later ranks cannot change it.
    """
    n = len(bounds) - 1
    signature = np.full((n, slots), np.iinfo(np.uint64).max, dtype=U64)
    flat = signature.reshape(-1)
    counts = np.diff(bounds)
    row = np.repeat(np.arange(n), counts)
    bits = mix(elements + U64(_STEP))
    slot = ((bits & U64(0xFFFFFF)) * U64(slots)) >> U64(24)
    np.minimum.at(flat, row * slots + slot.astype(np.int64), bits >> U64(24))
    pending = np.flatnonzero((counts > 0) & (signature.max(axis=1, initial=0) >= U64(1) << _RANK))
    while len(pending):
        take = max(1, int(np.searchsorted(np.cumsum(counts[pending]), _ACTIVE, side="right")))
        _descend(elements, bounds, pending[:take], signature, slots)
        pending = pending[take:]
    return signature


def _descend(elements, bounds, sets, signature, slots) -> None:
    flat = signature.reshape(-1)
    counts = bounds[sets + 1] - bounds[sets]
    row = np.repeat(sets, counts)
    own = np.concatenate([elements[bounds[s] : bounds[s + 1]] for s in sets])
    order = np.tile(np.arange(slots, dtype=np.uint8), (len(own), 1))
    for rank in range(slots):
        if rank:
            still = signature.max(axis=1) >= U64(rank) << _RANK
            keep = still[row]
            if not keep.any():
                return
            if not keep.all():
                own, row, order = own[keep], row[keep], order[keep]
        bits = mix(own + U64((_STEP * (rank + 1)) & 0xFFFFFFFFFFFFFFFF))
        pick = rank + (((bits & U64(0xFFFFFF)) * U64(slots - rank)) >> U64(24)).astype(np.int64)
        at = np.arange(len(own))
        chosen = order[at, pick]
        order[at, pick] = order[:, rank]
        order[:, rank] = chosen
        np.minimum.at(flat, row * slots + chosen, (U64(rank) << _RANK) | (bits >> U64(24)))


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key per set and band."""
    keys = np.empty((len(signature), bands), dtype=U64)
    for band in range(bands):
        key = np.full(len(signature), band + 1, dtype=U64)
        for value in signature[:, band * rows : (band + 1) * rows].T:
            key = mix(key * U64(_STEP) + value)
        keys[:, band] = key
    return keys


def _signed(batches: Iterator[pa.RecordBatch], size: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids, whole = batch.column(0), batch.column(1)
        for block in blocks(batch.column(2)):
            sets, bounds = shingle_sets(block, size)
            signature = super_minhash(sets, bounds, bands * rows)
            digests = [as_long(segment_sums(mix(sets ^ U64(salt)), bounds)) for salt in (0x5851F42D4C957F2D, 0x14057B7EF767814F)]
            keys = as_long(band_keys(signature, bands, rows)).reshape(-1)
            offsets = np.arange(block.rows + 1, dtype=np.int32) * bands
            yield pa.RecordBatch.from_arrays(
                [
                    ids.slice(block.first, block.rows),
                    whole.slice(block.first, block.rows),
                    pa.array(np.diff(bounds).astype(np.int64)),
                    *[pa.array(d) for d in digests],
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(keys)),
                ],
                names=["doc_id", "t", "n_shingles", "d1", "d2", "bands"],
            )


def signatures(docs: DataFrame, shingle: int, bands: int, rows: int) -> DataFrame:
    """Per document ``(doc_id, t, text)`` the size of its shingle set, a 128-bit digest of it and band keys."""
    return docs.select("doc_id", "t", "text").mapInArrow(
        lambda batches: _signed(batches, shingle, bands, rows),
        "doc_id bigint, t bigint, n_shingles bigint, d1 bigint, d2 bigint, bands array<bigint>",
    )


def parities(elements: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """``64 * len(PARITY)`` bits (uint64 x ``len(PARITY)``) per set: each element flips one, so bits that differ are elements that differ."""
    n, width = len(bounds) - 1, 64 * len(PARITY)
    row = np.repeat(np.arange(n), np.diff(bounds))
    bit = ((mix(elements) >> U64(40)) % U64(width)).astype(np.int64)
    odd = np.bincount(row * width + bit, minlength=n * width).astype(np.uint8) & 1
    return np.packbits(odd.reshape(n, width), axis=1, bitorder="little").view(U64)


def _compared(batches: Iterator[pa.RecordBatch], size: int, percent: int) -> Iterator[pa.RecordBatch]:
    """Rows arrive by (centre, share) with the centre's text first: only its set is held."""
    group_of, head = None, None
    for batch in batches:
        centre, share, role, node = (batch.column(i).to_numpy() for i in range(4))
        for block in blocks(batch.column(4)):
            sets, bounds = shingle_sets(block, size)
            rows, numbers, linked, diffs = [], [], [], []
            for i in range(block.rows):
                at = block.first + i
                own = sets[bounds[i] : bounds[i + 1]]
                if role[at] == 0:
                    if group_of != (centre[at], share[at]):
                        group_of, head = (centre[at], share[at]), own.copy()
                    continue
                diff = np.setxor1d(own, head, assume_unique=True)
                total = len(own) + len(head)
                rows.append(at)
                numbers.append(len(own))
                # intersection = (total - |diff|) / 2, union = (total + |diff|) / 2
                linked.append(100 * (total - len(diff)) >= percent * (total + len(diff)))
                diffs.append(diff)
            offsets = np.concatenate(([0], np.cumsum([len(d) for d in diffs]))).astype(np.int32)
            elements = np.concatenate([np.zeros(0, dtype=U64), *diffs])
            odd = parities(elements, offsets)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(node[rows], pa.int64()),
                    pa.array(centre[rows], pa.int64()),
                    pa.array(numbers, pa.int64()),
                    pa.array(linked, pa.bool_()),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(as_long(elements))),
                    *[pa.array(as_long(word)) for word in odd.T],
                ],
                names=["a", "b", "n", "linked", "diff", *PARITY],
            )


def _compare(pairs: DataFrame, texts: DataFrame, sets: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """Pairs ``(a, b, n)`` with the size of a's set, whether they are linked, and how they differ.

    The members of a centre are dealt over shares of bounded size, each with a copy of the
    centre's text, so a hot centre is spread over many tasks. Texts no pair needs stop at the
    first join.
    """
    spark = pairs.sparkSession
    weights = pairs.groupBy("b").agg(F.ceil(F.sum("n") / F.lit(SHARE_SHINGLES)).alias("shares"))
    weights = scratch.keep(weights, "shares")
    members = pairs.join(weights, "b").select(
        F.col("b").alias("centre"),
        F.pmod(F.xxhash64("a"), F.col("shares")).alias("share"),
        F.lit(1).alias("role"),
        F.col("a").alias("node"),
    )
    heads = weights.select(
        F.col("b").alias("centre"),
        F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("shares") - 1)).alias("share"),
        F.lit(0).alias("role"),
        F.col("b").alias("node"),
    )
    wanted = members.unionByName(heads).join(sets.select("node", F.col("doc").alias("doc_id"), "t"), "node")
    needed = texts.join(wanted, ["doc_id", "t"])
    return (
        needed.select("centre", "share", "role", "node", "text")
        .repartition(partitions(spark), "centre", "share")
        .sortWithinPartitions("centre", "share", "role")
        .mapInArrow(
            lambda batches: _compared(batches, size, percent),
            "a bigint, b bigint, n bigint, linked boolean, diff array<bigint>" + "".join(f", {c} bigint" for c in PARITY),
        )
    )


def _further_links(compared: DataFrame, labels: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """``(node, label)`` after all links between members of one centre that lie in different groups so far.

    Let D(x) be the difference of x to the centre. Then the difference of x and y is that of D(x)
    and D(y), and they are linked if it has at most ``t = (1 - s) / (1 + s) * (|x| + |y|)``
    elements for similarity s. If D(x) and D(y) share nothing, that makes both linked to the centre.
    Otherwise take any order of elements, and the first one they share: it comes after at most
    ``|D(x) - D(y)| <= (t + |D(x)| - |D(y)|) / 2`` elements of D(x), and likewise of D(y). Rare
    elements first keeps the lists short that such a prefix can meet in. Bits in which the parities of
    D(x) and D(y) differ are elements that do, so pairs with too many of them do not leave the join.

    A list of rows that share an element may hold many links that say the same. So its rows first meet only
    one of them, a linked one if there is any, and all rows of different groups meet when groups have grown by that.
    """
    s = percent / 100
    per_pair, alone = (1 - s) / (1 + s), (1 - s) / s
    label = labels.select(F.col("node").alias("a"), "label")
    placed = compared.join(label, "a", "left").withColumn("label", F.coalesce("label", "a"))
    heads = compared.select("b").distinct().join(labels.select(F.col("node").alias("b"), "label"), "b", "left")
    known = placed.select("b", "label").unionByName(heads.select("b", F.coalesce("label", "b").alias("label")))
    mixed = known.groupBy("b").agg(F.min("label").alias("x"), F.max("label").alias("y")).filter("x <> y")
    mixed = scratch.keep(mixed.select("b"), "mixed")
    members = placed.join(mixed, "b").select("b", "a", "n", "label", F.size("diff").alias("d"), "diff", *PARITY)
    members = scratch.keep(members, "open")
    elements = members.select("b", "a", F.explode("diff").alias("element"))
    often = scratch.keep(elements.groupBy("b", "element").agg(F.count("*").alias("often")), "elements")
    ranked = elements.join(often, ["b", "element"]).groupBy("b", "a").agg(
        F.sort_array(F.collect_list(F.struct("often", "element"))).alias("ranked")
    )
    prefix = F.slice("ranked", 1, F.floor(F.col("n") * alone + 1e-6).cast("int") + 1)
    heads = members.select("b", "a", "n", "label", "d", *PARITY).join(ranked, ["b", "a"])
    heads = heads.select("b", "a", "n", "label", "d", *PARITY, F.posexplode(prefix).alias("at", "item"))
    heads = scratch.keep(heads.filter("item.often > 1").select("*", "item.element").drop("item"), "prefixes")
    limit = (F.col("x.n") + F.col("y.n")) * per_pair + 1e-6
    least = sum((F.bit_count(F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))) for c in PARITY), F.lit(0))
    near = (
        (F.col("x.b") == F.col("y.b"))
        & (F.col("x.element") == F.col("y.element"))
        & (F.col("x.label") != F.col("y.label"))
        & (F.col("x.at") * 2 <= limit + F.col("x.d") - F.col("y.d"))
        & (F.col("y.at") * 2 <= limit + F.col("y.d") - F.col("x.d"))
        & (least <= limit)
    )

    def linked(meet: DataFrame) -> DataFrame:
        # a pair meets at several elements and below several centres, any of which will do
        low, high = F.least("x.a", "y.a").alias("a"), F.greatest("x.a", "y.a").alias("c")
        pairs = scratch.keep(meet.select("x.b", low, high).groupBy("a", "c").agg(F.min("b").alias("b")), "meet")
        left = members.select("b", "a", F.col("n").alias("n_a"), F.col("diff").alias("diff_a"))
        right = members.select("b", F.col("a").alias("c"), F.col("n").alias("n_c"), F.col("diff").alias("diff_c"))
        both = pairs.join(left, ["b", "a"]).join(right, ["b", "c"])
        common = F.size(F.array_intersect("diff_a", "diff_c"))
        apart = F.size("diff_a") + F.size("diff_c") - 2 * common
        total = F.col("n_a") + F.col("n_c")
        both = both.filter((total - apart) * 100 >= (total + apart) * percent)
        return scratch.keep(both.select("a", F.col("c").alias("b")), "more")

    def joined(labels: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            return labels
        known = labels.select(F.col("node").alias("a"), F.col("label").alias("b"))
        return scratch.keep(components(more.unionByName(known), scratch), "labels")

    # a group's label is its smallest node: rows below theirs are linked
    one = F.struct(F.col("label") < F.col("a"), F.xxhash64("a", "element"), "a", "n", "label", "d", "at", *PARITY)
    stars = heads.groupBy("b", "element").agg(F.max(one).alias("one")).select("b", "element", "one.*")
    labels = joined(labels, linked(heads.alias("x").join(stars.alias("y"), near)))
    rows = heads.drop("label").join(labels.select(F.col("node").alias("a"), "label"), "a", "left")
    rows = scratch.keep(rows.withColumn("label", F.coalesce("label", "a")), "rows")
    return joined(labels, linked(rows.alias("x").join(rows.alias("y"), near & (F.col("x.a") < F.col("y.a")))))


def _groups(buckets: DataFrame, texts: DataFrame, sets: DataFrame, known: DataFrame, size: int, percent: int, scratch: Scratch) -> DataFrame:
    """``(node, label)`` of all nodes with links; ``buckets`` has (key, node, n), ``known`` more links."""
    shared = buckets.groupBy("key").agg(F.min("node").alias("b"), F.max("node").alias("last")).filter("b < last")
    shared = scratch.keep(shared.select("key", "b"), "shared")
    members = buckets.join(shared, "key").filter("node <> b")
    pairs = scratch.keep(members.groupBy(F.col("node").alias("a"), "b").agg(F.max("n").alias("n")), "pairs")
    compared = scratch.keep(_compare(pairs, texts, sets, size, percent, scratch), "compared")
    links = scratch.keep(compared.filter("linked").select("a", "b").unionByName(known), "links")
    labels = scratch.keep(components(links, scratch), "labels")
    return _further_links(compared, labels, percent, scratch)


def near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, n_shingles, component_id, kept.

    Words are runs of bytes other than ASCII white space, A-Z count as lower case. A text's set
    holds its distinct ``shingle``-word sequences; with fewer words the whole sequence is the
    only one, without words the set is empty and linked with nothing. Two documents are linked if
    100 * intersection >= ``percent`` * union; ``component_id`` is the smallest doc_id that links
    reach, and the document with that id is kept.

    Null texts count as empty. Rows without doc_id are linked with nothing: component_id null,
    kept true. Rows that share a doc_id are one document with several texts: a link of any of
    them counts, and all such rows get the same answer. Other columns are not read. An empty
    table gives an empty result.

    Copies of one set are represented by their smallest doc_id, so thousands of exact copies cost
    one comparison.
    """
    scratch = Scratch(docs.sparkSession, "neardup")
    text = F.col("text").cast("string")
    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.xxhash64(text).alias("t"), text.alias("text"))
    signed = scratch.keep(signatures(texts, shingle, *banding(percent)), "signed")
    filled = signed.filter("n_shingles > 0 and doc_id is not null")
    # a node is a set; its text is that of its smallest document, told by a digest from other texts of that document
    sets = filled.groupBy("d1", "d2").agg(F.min("doc_id").alias("doc"), F.min_by("t", "doc_id").alias("t"))
    sets = scratch.keep(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    first = signed.join(sets.select("d1", "d2", F.col("doc").alias("doc_id"), "t", "node"), ["d1", "d2", "doc_id", "t"])
    buckets = first.select(F.explode("bands").alias("key"), "node", F.col("n_shingles").alias("n"))
    # a doc_id whose rows hold different texts joins the sets of all of them
    several = filled.groupBy("doc_id").agg(F.min("d1").alias("x"), F.max("d1").alias("y")).filter("x <> y")
    stands_for = filled.join(several.select("doc_id"), "doc_id", "left_semi").join(sets.select("d1", "d2", "node"), ["d1", "d2"])
    stands_for = scratch.keep(stands_for.select("doc_id", "node"), "several")
    least = stands_for.groupBy("doc_id").agg(F.min("node").alias("b"))
    bridges = stands_for.join(least, "doc_id").filter("node <> b").select(F.col("node").alias("a"), "b")
    labels = scratch.keep(_groups(buckets, texts, sets, bridges, shingle, percent, scratch), "groups")
    labelled = sets.select("d1", "d2", "doc", "node").join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    labelled = scratch.keep(labelled.drop("node"), "labelled")
    smallest = labelled.groupBy("label").agg(F.min("doc").alias("component_id"))
    of_set = labelled.join(smallest, "label").select("d1", "d2", "component_id")
    placed = signed.select("doc_id", "n_shingles", "d1", "d2").join(of_set, ["d1", "d2"], "left")
    has_set = F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0)
    component = F.when(has_set, F.col("component_id")).otherwise(F.col("doc_id"))
    return placed.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"),
    )
