"""Logged stream tables: replays, compaction, readers meanwhile, lost writers, and states as of a moment."""

import datetime as dt
import os
import time
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from railmill.streaming import live_state, route, sinks, table_log
from railmill.streaming.table_log import HOUR, ConflictError, LoggedTable
from tests.conftest import rows
from tests.test_streaming import FRAME, message


def batch(spark, n, hours=("2024-01-01-05", "2024-01-01-06")):
    return spark.range(100 * n, 100 * n + 40).select("id", F.element_at(F.array(*map(F.lit, hours)), (F.col("id") % len(hours)).cast("int") + 1).alias(HOUR))


def ids(df):
    return sorted(r["id"] for r in df.collect())


def files_of(df):
    return Counter(f.split("hour=")[1].split("/")[0] for f in df.inputFiles())


def test_replays_compaction_and_readers_agree(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(table_log, "STATE_EVERY", 4)
    table = LoggedTable(spark, str(tmp_path / "t"))
    for n in range(9):
        for _ in range(2 if n % 3 else 1):  # some batches are replayed
            table.write(batch(spark, n).repartition(3), n, "query")
    table.write(batch(spark, 20), 0, "another query")
    want = sorted(i for n in [*range(9), 20] for i in range(100 * n, 100 * n + 40))
    before = table.read()
    assert ids(before) == want and files_of(before)["2024-01-01-05"] > 9
    assert table.compact("2024-01-01-06") == 1  # the hour 06 is still open
    after = LoggedTable(spark, str(tmp_path / "t")).read()
    assert ids(after) == want == ids(before)  # a reader that listed its files before goes on with them
    assert files_of(after)["2024-01-01-05"] == 1 and files_of(after)["2024-01-01-06"] > 9
    assert table.compact("2024-01-01-06") == 0
    table.write(batch(spark, 8), 8, "query")  # a replay from before the compaction
    assert ids(table.read()) == want
    table.write(batch(spark, 30), 9, "query")  # a late row of the closed hour
    want = sorted([*want, *range(3000, 3040)])
    assert ids(table.read()) == want
    assert table.compact("2024-01-02") == 2 and files_of(table.read()) == {"2024-01-01-05": 1, "2024-01-01-06": 1}
    assert ids(table.read()) == want
    assert ids(table.read(lambda values: values[-1] == "2024-01-01-05")) == [i for i in want if i % 2 == 0]
    assert table.vacuum(0) == 0
    assert table.vacuum(int(time.time() * 1000) + 10_000) > 9
    assert ids(LoggedTable(spark, str(tmp_path / "t")).read()) == want
    states = [f for f in os.listdir(tmp_path / "t" / "_log") if f.endswith(".state.json")]
    assert len(states) >= 2


def test_lost_writers_leave_nothing_and_two_compactions_do_not_double(spark, tmp_path):
    table = LoggedTable(spark, str(tmp_path / "t"))
    with pytest.raises(FileNotFoundError):
        table.read()
    for n in range(3):
        table.write(batch(spark, n), n, "q")
    table._write(batch(spark, 7))  # written, never committed
    want = sorted(i for n in range(3) for i in range(100 * n, 100 * n + 40))
    assert ids(table.read()) == want
    slow = LoggedTable(spark, str(tmp_path / "t"))
    committed = slow._commit

    def late(*args, **more):
        table.compact("2025")
        committed(*args, **more)

    slow._commit = late
    with pytest.raises(ConflictError):
        slow.compact("2025")
    assert ids(table.read()) == want
    table.write(spark.createDataFrame([], f"id bigint, {HOUR} string"), 3, "q")  # a batch without rows
    assert table.state()["batches"] == {"q": 2} and ids(table.read()) == want
    empty = LoggedTable(spark, str(tmp_path / "empty"))
    empty.write(spark.createDataFrame([], f"id bigint, {HOUR} string"), 0, "q")
    assert empty.read().columns == ["id", HOUR] and ids(empty.read()) == []


def test_routed_topics_and_raw_tables_are_compacted_by_hour(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    for n in range(4):
        lines = [f'{{"value": {__import__("json").dumps(message(10 * n + i))}, "ingest_ts": "2024-01-01T0{n % 2}:10:00Z"}}' for i in range(6)]
        (source / f"{n}.json").write_text("\n".join(lines))
    stream = lambda: spark.readStream.schema(FRAME).option("maxFilesPerTrigger", 1).json(str(source))
    out, raw = str(tmp_path / "routed"), str(tmp_path / "raw")
    sinks.run_to_end(route.route_stream(stream(), out, str(tmp_path / "ck1"), available_now=True), 120)
    sinks.run_to_end(route.table_stream(stream(), raw, str(tmp_path / "ck2"), available_now=True), 120)
    for read, place in ((lambda: route.read_routed(spark, out), out), (lambda: route.read_table(spark, raw, "rail_movement_clean"), raw)):
        before = rows(read())
        assert len(before) == 24 and route.compact(spark, place, "2024-01-01-01") == 1
        assert rows(read()) == before
        assert files_of(read())["2024-01-01-00"] == 1 and files_of(read())["2024-01-01-01"] == 2
    assert route.read_topic_files(spark, out, "rail_movement_clean").count() == 24
    assert Path(raw, "rail_movement_clean", "_log").exists()


def test_states_as_of_a_moment(spark, tmp_path):
    """A train written at 10:00 and 12:00 shows its state of 10:00 at 10:02, and nothing at 11:00."""
    schema = "train_id string, location_name string, last_update timestamp, expired boolean"
    table = LoggedTable(spark, str(tmp_path / "t"))
    at = lambda h, m: dt.datetime(2024, 1, 1, h, m)
    for n, data in enumerate(
        [
            [("a", "early", at(10, 0), False), ("b", "b1", at(9, 58), False)],
            [("b", "b2", at(10, 1), False)],
            [("a", "late", at(12, 0), False), ("c", "c1", at(12, 3), False)],
            [("b", None, at(10, 6), True)],  # silent for five minutes
        ]
    ):
        df = spark.createDataFrame(data, schema).withColumn(live_state.BATCH, F.lit(n).cast("bigint"))
        table.write(df.withColumn(HOUR, table_log.hour_of("last_update")), n, "q")

    def seen(as_of):
        return sorted((r["train_id"], r["location_name"]) for r in live_state.read_live_states(spark, str(tmp_path / "t"), as_of).collect())

    for _ in range(2):
        assert seen(at(10, 2)) == [("a", "early"), ("b", "b2")]
        assert seen(at(10, 0)) == [("a", "early"), ("b", "b1")]
        assert seen(at(11, 0)) == [] == seen(at(9, 0)) == seen(at(13, 0))
        assert seen(at(12, 4)) == [("a", "late"), ("c", "c1")]
        assert seen(None) == [("a", "late"), ("c", "c1")]
        table.compact("2025")
    hours = files_of(live_state.read_live_states(spark, str(tmp_path / "t"), at(10, 2)))
    assert set(hours) == {"2024-01-01-09", "2024-01-01-10"} - ({"2024-01-01-09"} if at(10, 2) - dt.timedelta(minutes=5) >= at(10, 0) else set())
