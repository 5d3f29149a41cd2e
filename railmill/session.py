"""Session settings every job relies on, and the shared working folder."""

from __future__ import annotations

import tempfile
import uuid
from functools import cache

from pyspark.sql import SparkSession

# Runtime settings: safe to apply to a session somebody else created.
RUNTIME_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # a hot key is split even where that costs one more shuffle further up
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # hashed keys as hex text take half the room they do with snappy
    "spark.sql.parquet.compression.codec": "zstd",
    # a write into few folders keeps their files open; without this every task sorts, and spills, all its rows by folder first
    "spark.sql.maxConcurrentOutputFileWriters": "4",
}


def apply_defaults(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_DEFAULTS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", app: str = "railmill", memory: str = "12g") -> SparkSession:
    """A single-machine session for tests and the bench; clusters bring their own."""
    partitions = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", partitions)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return apply_defaults(spark)


def shared_dir(spark: SparkSession, purpose: str) -> str:
    """A fresh folder below ``spark.checkpoint.dir``, which all executors can reach.

    Only a local session may fall back to a temporary folder of its own machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        root = _local_folder()
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="railmill-")
