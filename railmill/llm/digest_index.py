"""Exact dedup against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest. New documents are reduced to one row
per digest first and then joined against it: a sort-merge anti-join that shuffles only the new
rows, since the index already lies in buckets. What is new is appended in the same buckets.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from railmill.llm.common import Scratch


def text_digest(text: Column) -> Column:
    """SHA-256 of the text in UTF-8, 32 bytes; null counts as empty. The text is not changed."""
    return F.unhex(F.sha2(F.coalesce(text.cast("string"), F.lit("")).cast("binary"), 256))


class DigestIndex:
    """Digest -> id of the document that stays.

    ``path`` must be a folder all executors share. A new session opens an index again by the same
    path and number of buckets. Appending is one write of new files: if it is lost midway, files
    that were not committed are not seen, and the batch can simply be given again.
    """

    SCHEMA = "digest binary, keep_id bigint"

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(
            f"create table {self.name} ({self.SCHEMA}) using parquet "
            f"clustered by (digest) sorted by (digest) into {buckets} buckets location '{path}'"
        )

    def table(self) -> DataFrame:
        return self.spark.table(self.name)

    def add(self, found: DataFrame) -> None:
        """Appends ``found(digest, keep_id)``, digests not in the index yet."""
        (
            found.select("digest", "keep_id")
            .repartition(self.buckets, "digest")
            .write.format("parquet")
            .mode("append")
            .bucketBy(self.buckets, "digest")
            .sortBy("digest")
            .option("path", self.path)
            .saveAsTable(self.name)
        )

    def close(self) -> None:
        """Forgets the table's name; the files stay."""
        self.spark.sql(f"drop table if exists {self.name}")


def dedup_exact(docs: DataFrame, index: DigestIndex, scratch: Scratch) -> DataFrame:
    """Per row of ``docs(doc_id, text, ...)``: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are identical byte for byte; null counts as empty. If the index knows
    the text, its document stays and all rows here go. Otherwise the row with the largest doc_id
    stays and enters the index; a null doc_id is smaller than any other, and of rows that agree
    in doc_id and text exactly one stays. ``group_size`` counts the rows of this call. Other
    columns are not read. An empty table gives an empty result and leaves the index as it is.

    Rows are counted by (digest, doc_id) before they meet, so a text that a third of all rows
    share is spread by doc_id, and its group is summed from partial sums.
    """
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), text_digest(F.col("text")).alias("digest"))
    counted = scratch.keep(rows.groupBy("digest", "doc_id").agg(F.count("*").alias("copies")), "counted")
    groups = counted.groupBy("digest").agg(F.max("doc_id").alias("largest"), F.sum("copies").alias("group_size"))
    groups = scratch.keep(groups, "groups")
    known = groups.join(index.table().hint("merge"), "digest").select("digest", "group_size", "keep_id")
    known = scratch.keep(known.withColumn("new", F.lit(False)), "known")
    new = groups.join(index.table().hint("merge"), "digest", "left_anti").select(
        "digest", "group_size", F.col("largest").alias("keep_id"), F.lit(True).alias("new")
    )
    new = scratch.keep(new, "new")
    index.add(new)
    placed = counted.join(known.unionByName(new), "digest")
    copy = F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("copies"))).alias("copy")
    stays = F.col("new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)
    return placed.select("doc_id", "keep_id", "group_size", "digest", "new", copy).select(
        "doc_id",
        "keep_id",
        "group_size",
        stays.alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
