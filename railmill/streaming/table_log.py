"""Stream output as a table with a log of commits.

A micro-batch is written into a folder of its own and enters the table by one log entry, which names the partitions it
filled. A batch that was committed before is not written again, so a replay neither doubles nor loses rows, and what a lost
attempt left behind is never read. Closed hours are compacted: their partitions are rewritten into few files, and one
entry takes the old ones out and puts the new ones in. Readers go by the log, so they see a table before or after that
entry, never between. Old folders stay until ``vacuum``, for readers that listed them before.
"""

from __future__ import annotations

import uuid
from collections import defaultdict
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railmill.sources.commits import STATE, CommitLog
from railmill.sources.tables import delete, file_system, path_exists

FOLDER = "_folder"
HOUR, HOUR_TEXT, NO_HOUR = "hour", "yyyy-MM-dd-HH", "0000-00-00-00"
# Entries after which the state they lead to is stored.
STATE_EVERY = 50


class Part(NamedTuple):
    """One partition that one commit filled."""

    folder: str
    values: tuple[str, ...]

    def path(self, by: list[str]) -> str:
        return "/".join([f"{FOLDER}={self.folder}", *[f"{c}={v}" for c, v in zip(by, self.values)]])


class ConflictError(RuntimeError):
    """Another compaction has replaced the same partitions."""


class LoggedTable:
    """A table below ``path``; ``by`` are its partition columns, texts, the last of them the hour."""

    def __init__(self, spark: SparkSession, path: str, by: list[str] | None = None):
        self.spark, self.path = spark, path.rstrip("/")
        self.log = CommitLog(spark, f"{self.path}/_log")
        self.by = by or [HOUR]

    # ---- the log ---------------------------------------------------------------------------
    def state(self) -> dict:
        """``parts`` of the table as of now, the last ``batches`` by source, the ``schema``, and the ``number`` of the last entry."""
        state: dict = {"parts": set(), "batches": {}, "schema": None, "number": -1}
        for entry in self.log.entries():
            stored = entry.get(STATE)
            if stored:
                state["parts"] = {Part(f, tuple(v)) for f, v in stored["parts"]}
                state["batches"], state["schema"] = dict(stored["batches"]), stored["schema"]
            else:
                state["parts"] -= {Part(f, tuple(v)) for f, v in entry["removed"]}
                state["parts"] |= {Part(f, tuple(v)) for f, v in entry["added"]}
                if "batch" in entry:
                    state["batches"][entry["source"]] = entry["batch"]
                state["schema"] = entry["schema"]
            state["number"] = entry["number"]
        return state

    def _commit(self, added: set[Part], removed: set[Part], schema: T.StructType, check: Callable[[dict], None], **more) -> None:
        entry = {"added": sorted(added), "removed": sorted(removed), "schema": schema.jsonValue(), **more}
        number = self.log.append(entry, lambda: check(self.state()))
        if number % STATE_EVERY == STATE_EVERY - 1:
            state = self.state()
            if state["number"] == number:
                self.log.store_state(number, {k: sorted(v) if k == "parts" else v for k, v in state.items() if k != "number"})

    # ---- writing ------------------------------------------------------------------------------
    def _write(self, df: DataFrame, rows_per_file: int = 0) -> set[Part]:
        folder = uuid.uuid4().hex
        root = f"{self.path}/data/{FOLDER}={folder}"
        df.write.option("maxRecordsPerFile", rows_per_file).partitionBy(*self.by).parquet(root)
        fs, top = file_system(self.spark, root)
        found: list[tuple] = [()]
        for column in self.by:
            deeper = []
            for values in found:
                under = "/".join([root, *[f"{c}={v}" for c, v in zip(self.by, values)]])
                names = [s.getPath().getName() for s in fs.listStatus(file_system(self.spark, under)[1])]
                deeper += [(*values, n.split("=", 1)[1]) for n in names if n.startswith(f"{column}=")]
            found = deeper
        return {Part(folder, values) for values in found}

    def write(self, df: DataFrame, batch: int, source: str) -> None:
        """Adds one micro-batch of ``source`` (its checkpoint) unless it was added before."""

        def check(state: dict) -> None:
            if state["batches"].get(source, -1) >= batch:
                raise ConflictError(f"batch {batch} of {source} is in the table")

        now = self.state()
        if now["batches"].get(source, -1) >= batch:
            return
        added = self._write(df)
        if added or now["schema"] is None:  # a batch without rows needs no entry, but for the first, which tells the schema
            self._commit(added, set(), df.schema, check, batch=batch, source=source)

    def compact(self, before: str, rows_per_file: int = 1_000_000) -> int:
        """Rewrites every partition of an hour before ``before`` that several commits filled; returns their number.

        An hour counts as closed by its name, so rows that come late make a partition of their own until the next time.
        """
        state = self.state()
        groups: dict[tuple, set[Part]] = defaultdict(set)
        for part in state["parts"]:
            groups[part.values].add(part)
        old = {v: parts for v, parts in groups.items() if v[-1] < before and len(parts) > 1}
        if not old:
            return 0
        removed = set().union(*old.values())
        schema = T.StructType.fromJson(state["schema"])
        rows = self._frame(removed, schema).drop(FOLDER).hint("rebalance", *self.by)
        added = self._write(rows, rows_per_file)

        def check(now: dict) -> None:
            if not removed <= now["parts"]:
                raise ConflictError("the partitions were compacted by somebody else")

        self._commit(added, removed, schema, check)
        return len(old)

    def vacuum(self, older_than_ms: int) -> int:
        """Deletes folders that no entry of the current table names and that were last changed before a moment (epoch ms)."""
        live = {p.folder for p in self.state()["parts"]}
        fs, data = file_system(self.spark, f"{self.path}/data")
        gone = 0
        if fs.exists(data):
            for status in fs.listStatus(data):
                name = status.getPath().getName()
                if name.split("=", 1)[-1] not in live and status.getModificationTime() < older_than_ms:
                    delete(self.spark, f"{self.path}/data/{name}")
                    gone += 1
        return gone

    # ---- reading --------------------------------------------------------------------------------
    def _frame(self, parts: set[Part], schema: T.StructType) -> DataFrame:
        fields = [f for f in schema.fields if f.name not in self.by]
        full = T.StructType([*fields, T.StructField(FOLDER, T.StringType()), *[T.StructField(c, T.StringType()) for c in self.by]])
        if not parts:
            return self.spark.createDataFrame([], full)
        paths = sorted(f"{self.path}/data/{p.path(self.by)}" for p in parts)
        return self.spark.read.schema(full).option("basePath", f"{self.path}/data").parquet(*paths)

    def read(self, keep: Callable[[tuple[str, ...]], bool] = lambda values: True) -> DataFrame:
        """The table as of now; ``keep`` chooses partitions by their values, so others are not even listed."""
        state = self.state()
        if state["schema"] is None:
            raise FileNotFoundError(f"nothing was written to {self.path} yet")
        parts = {p for p in state["parts"] if keep(p.values)}
        return self._frame(parts, T.StructType.fromJson(state["schema"])).drop(FOLDER)

    def exists(self) -> bool:
        return path_exists(self.spark, f"{self.path}/_log")


def hour_of(ts: str) -> F.Column:
    return F.coalesce(F.date_format(F.col(ts).cast("timestamp"), HOUR_TEXT), F.lit(NO_HOUR))
