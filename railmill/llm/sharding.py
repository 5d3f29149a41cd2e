"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``vnodes`` points of a ring of 2**60 positions. A text's position is a hash of its
bytes, and its home is the shard of the next point clockwise. A shard takes the texts of its own arcs
until its bytes reach the bound, ``(1 + slack)`` times the mean; what does not fit continues clockwise to
the next shard that is not full. So a shard holds at most the bound plus one document, and the shards
that are not full hold all but ``slack * (shards - 1)`` of a mean share or more. Equal texts lie side by
side; only a group at a shard's bound is split, and one larger than a shard fills several.

What depends on the data is one running sum of bytes along the ring. Rows are range-partitioned by
(position, text, doc_id), which cuts hot texts as well, and summed per partition and arc first. The rounds
in which overflow moves on work on intervals of bytes, a table of about ``shards * vnodes`` rows, so no
round reads documents. All steps are DataFrame functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from railmill.llm.common import Scratch, partitions

SHARDS = 8
VNODES = 128
# Bound of a shard over the mean, in thousandths.
SLACK = 2
POSITION_BITS = 60
# Cells by which a position finds its arc.
CELL_BITS = 12
# Copies of one row that move as one.
COPIES = 1000
ROWS_PER_FILE = 1 << 16


def position(digest: Column) -> Column:
    """The place on the ring of a hexadecimal digest: its first 15 digits."""
    return F.conv(F.substring(digest, 1, 15), 16, 10).cast("bigint")


def _cell(place: Column) -> Column:
    return F.shiftright(place, POSITION_BITS - CELL_BITS)


def ring_arcs(spark: SparkSession, shards: int, vnodes: int) -> DataFrame:
    """``(arc, low, high, wanted)``: positions low..high go to the first of ``wanted`` that is not full.

    Arcs are numbered clockwise; the part after the last point wraps round to the first one's shard.
    """
    shard, number = F.pmod("id", F.lit(shards)).cast("int"), F.floor(F.col("id") / F.lit(shards))
    points = spark.range(shards * vnodes).select(shard.alias("shard"), number.alias("number"))
    placed = points.select(position(F.md5(F.concat_ws(":", "shard", "number").cast("binary"))).alias("at"), "shard")
    ring = placed.agg(F.array_sort(F.collect_list(F.struct("at", "shard"))).alias("ring"))
    n = shards * vnodes
    arcs = ring.select("ring", F.explode(F.sequence(F.lit(0), F.lit(n))).alias("arc"))
    owners = F.transform("ring", lambda p: p["shard"])
    onward = F.concat(F.slice(owners, F.col("arc") + 1, F.lit(n)), owners)
    low = F.when(F.col("arc") == 0, F.lit(0)).otherwise(F.get("ring", F.col("arc") - 1)["at"] + 1)
    high = F.coalesce(F.get("ring", F.col("arc"))["at"], F.lit((1 << POSITION_BITS) - 1))
    found = arcs.select("arc", low.alias("low"), high.alias("high"), F.array_distinct(onward).alias("wanted"))
    return found.filter("low <= high")


def bounded_pieces(arcs: DataFrame, shards: int, slack: int) -> DataFrame:
    """Cuts the line of all bytes, ``arcs(arc, wanted, bytes)`` clockwise, into ``(arc, first, last, shard)``.

    In round r every piece that is still without a place asks the r-th shard clockwise of its arc, and
    that shard takes pieces in the order of the ring until it is full. After as many rounds as there
    are shards nothing is left: all shards that refused it would hold more than all bytes.
    """
    everything, ahead = Window.partitionBy(), Window.orderBy("arc")  # of the arcs: a bounded table
    total = F.sum("bytes").over(everything)
    bound = F.ceil(total * F.lit(1000 + slack) / F.lit(1000 * shards)).cast("bigint")
    last = F.sum("bytes").over(ahead)
    pieces = arcs.filter("bytes > 0").select(
        "arc", "wanted", bound.alias("bound"), (last - F.col("bytes")).alias("first"), last.alias("last"),
        F.lit(None).cast("int").alias("shard"),
    )
    size, free = F.col("last") - F.col("first"), F.col("shard").isNull()
    for turn in range(shards):
        asked = pieces.withColumn("asked", F.coalesce("shard", F.get("wanted", F.lit(turn))))
        own = Window.partitionBy("asked")
        before = own.orderBy("arc", "first").rowsBetween(Window.unboundedPreceding, -1)
        held = F.coalesce(F.sum(F.when(~free, size)).over(own), F.lit(0))
        queued = F.coalesce(F.sum(F.when(free, size)).over(before), F.lit(0))
        room = F.greatest(F.lit(0), F.least(size, F.col("bound") - held - queued))
        cut = asked.withColumn("cut", F.col("first") + F.when(free, room).otherwise(size))
        parts = F.array(
            F.struct("first", F.col("cut").alias("last"), F.col("asked").alias("shard")),
            F.struct(F.col("cut").alias("first"), "last", F.lit(None).cast("int").alias("shard")),
        )
        kept = F.filter(parts, lambda p: p["first"] < p["last"])
        pieces = cut.select("arc", "wanted", "bound", F.explode(kept).alias("p")).select("arc", "wanted", "bound", "p.*")
    return pieces.select("arc", "first", "last", "shard")


def _runs(docs: DataFrame) -> DataFrame:
    """Rows without their texts; rows that agree in id and text move together, up to ``COPIES`` of them."""
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), body.alias("body")).select(
        "doc_id",
        F.md5("body").alias("digest"),
        F.crc32("body").alias("text_crc32"),
        (F.octet_length("body") + 1).cast("bigint").alias("size"),
    )
    counted = rows.groupBy("doc_id", "digest", "text_crc32", "size").agg(F.count("*").alias("n"))
    chunk = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(COPIES).cast("bigint"))).alias("chunk")
    runs = counted.select("*", chunk)
    return runs.select(
        "doc_id", "digest", "text_crc32", "size", "chunk", F.least(F.lit(COPIES), F.col("n") - F.col("chunk")).alias("copies")
    )


def assign_shards(docs: DataFrame, shards: int = SHARDS, vnodes: int = VNODES, slack: int = SLACK) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, digest, text_crc32, size, home, shard, slot.

    ``size`` is the text's UTF-8 bytes plus 1, ``digest`` its MD5; a null text counts as empty. ``home`` is
    the shard the ring names, ``shard`` the one that had room. ``slot`` numbers a shard's rows from 0
    without gaps, clockwise along the ring. A null doc_id is smaller than any other and a value like the
    rest. Repeated rows each get a slot of their own. Other columns are not read, so their names cannot clash.
    An empty table gives an empty result. The result depends on the rows and the parameters only.
    """
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession, "ring")
    arcs = scratch.keep(ring_arcs(spark, shards, vnodes), "arcs")
    cells = arcs.select(
        "arc", "low", "high", F.get("wanted", F.lit(0)).alias("home"), F.explode(F.sequence(_cell(F.col("low")), _cell(F.col("high")))).alias("cell")
    )
    runs = scratch.keep(_runs(docs), "runs").withColumn("at", position(F.col("digest"))).withColumn("cell", _cell(F.col("at")))
    cells = scratch.keep(cells.coalesce(1), "cells")  # at most shards * vnodes + 1 + 2**CELL_BITS rows: small enough to be broadcast
    located = runs.join(cells, "cell").filter(F.col("at").between(F.col("low"), F.col("high")))
    order = ["at", "digest", "doc_id", "chunk"]
    dealt = located.repartitionByRange(partitions(spark), *order).sortWithinPartitions(*order)
    ordered = dealt.select(
        F.monotonically_increasing_id().alias("id"), F.spark_partition_id().alias("part"),
        "arc", "home", "doc_id", "digest", "text_crc32", "size", "copies",
    )
    ordered = scratch.keep(ordered, "ordered")

    weight = F.col("size") * F.col("copies")
    sums = scratch.keep(ordered.groupBy("part", "arc").agg(F.sum(weight).alias("bytes")).coalesce(1), "sums")
    by_arc = sums.groupBy("arc").agg(F.sum("bytes").alias("bytes")).join(arcs, "arc")
    pieces = scratch.keep(bounded_pieces(by_arc, shards, slack).coalesce(1), "pieces")
    by_part = sums.groupBy("part").agg(F.sum("bytes").alias("bytes"))
    offsets = by_part.select("part", (F.sum("bytes").over(Window.orderBy("part")) - F.col("bytes")).alias("offset"))

    within = Window.partitionBy("part").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    starts = ordered.withColumn("before", F.coalesce(F.sum(weight).over(within), F.lit(0))).join(offsets, "part")
    starts = starts.withColumn("start", F.col("offset") + F.col("before"))
    meets = (F.col("start") < F.col("last")) & (F.col("start") + weight > F.col("first"))
    # bounded by the ring as well: an arc more for every shard that is cut
    cut = starts.join(pieces, "arc").filter(meets)

    def copies_before(place: Column) -> Column:
        """Copies of the run that start before a place of the line."""
        return F.least(F.col("copies"), F.greatest(F.lit(0), F.ceil((place - F.col("start")) / F.col("size")))).cast("bigint")

    cut = cut.withColumn("n", copies_before(F.col("last")) - copies_before(F.col("first"))).filter("n > 0")
    in_shard = Window.partitionBy("part", "shard").orderBy("id").rowsBetween(Window.unboundedPreceding, -1)
    placed = cut.select(
        "part", "shard", "home", "doc_id", "digest", "text_crc32", "size", "n",
        F.coalesce(F.sum("n").over(in_shard), F.lit(0)).alias("ahead"),
    )
    placed = scratch.keep(placed, "placed")
    counts = placed.groupBy("shard", "part").agg(F.sum("n").alias("rows"))
    first = F.sum("rows").over(Window.partitionBy("shard").orderBy("part")) - F.col("rows")
    numbered = placed.join(counts.select("shard", "part", first.alias("first_slot")), ["shard", "part"])
    copy = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1)).alias("copy")
    return numbered.select("*", copy).select(
        "doc_id", "digest", "text_crc32", "size", "home", "shard", (F.col("first_slot") + F.col("ahead") + F.col("copy")).alias("slot")
    )


def write_shards(docs: DataFrame, path: str, shards: int = SHARDS, vnodes: int = VNODES, slack: int = SLACK) -> None:
    """Writes all columns of ``docs`` as ``path/shard=S`` in files of up to ``ROWS_PER_FILE`` rows by slot.

    A column ``shard`` or ``slot`` of the documents is kept inside the struct column ``document`` like all others.
    """
    body = F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("document"), F.col("doc_id").cast("bigint").alias("key"), F.md5(body).alias("digest"))
    own = Window.partitionBy("key", "digest").orderBy(F.lit(0))
    rows = rows.withColumn("copy", F.row_number().over(own))
    places = assign_shards(docs, shards, vnodes, slack).select(F.col("doc_id").alias("place_key"), F.col("digest").alias("place_digest"), "shard", "slot")
    places = places.withColumn("place_copy", F.row_number().over(Window.partitionBy("place_key", "place_digest").orderBy("shard", "slot")))
    same = F.col("key").eqNullSafe(F.col("place_key")) & (F.col("digest") == F.col("place_digest")) & (F.col("copy") == F.col("place_copy"))
    placed = rows.join(places, same).withColumn("file", F.floor(F.col("slot") / F.lit(ROWS_PER_FILE)))
    dealt = placed.repartition(partitions(docs.sparkSession), "shard", "file").sortWithinPartitions("shard", "slot")
    dealt.select("document", "slot", "shard").write.partitionBy("shard").parquet(path)


def shard_bytes(placed: DataFrame) -> DataFrame:
    """Per shard: rows, bytes, and the bytes that are not at home."""
    away = F.when(F.col("home") != F.col("shard"), F.col("size")).otherwise(F.lit(0))
    return placed.groupBy("shard").agg(F.count("*").alias("rows"), F.sum("size").alias("bytes"), F.sum(away).alias("moved_bytes"))
