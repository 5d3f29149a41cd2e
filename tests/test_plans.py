"""Plan shape: push-down, pruning, pre-aggregation, no Python in batch queries."""

import datetime as dt
import re

import pytest

from catalogue import load_all
from catalogue.registry import QUERIES, Tables
from railmill.plans import core, marts, performance, timetable

SF_DIR = "/root/testdata/sf0.001"
load_all()


@pytest.fixture
def stored(spark, tmp_path):
    """The star schema as files, as jobs read it."""
    tables = Tables(spark, SF_DIR)
    out = {}
    for name in ("movement", "stop", "schedule", "location", "geo", "toc", "association"):
        tables.role(name).write.parquet(str(tmp_path / name))
        out[name] = spark.read.parquet(str(tmp_path / name))
    return out


def plan(df) -> str:
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    df.sparkSession.conf.set("spark.sql.debug.maxToStringFields", "1000")
    return df._jdf.queryExecution().executedPlan().toString()


def test_runs_on_reaches_the_scan(stored):
    text = plan(timetable.train_uids_on(stored["schedule"], dt.date(2024, 1, 10)))
    pushed = re.search(r"PushedFilters: \[(.*?)\], ReadSchema", text).group(1)
    assert "LessThanOrEqual(schedule_start_date,2024-01-10)" in pushed
    assert "GreaterThanOrEqual(schedule_end_date,2024-01-10)" in pushed
    assert "EqualTo(wednes_service,true)" in pushed or "wednes_service" in pushed


def test_only_needed_columns_are_read(stored):
    text = plan(performance.station_totals(stored["movement"], stored["location"], stored["toc"]))
    schema = re.search(r"ReadSchema: struct<location_id:string,toc_id[^>]*>", text).group(0)
    assert "train_id" not in schema and "price" not in schema


def test_station_performance_reads_the_fact_once(stored):
    text = plan(performance.station_performance(stored["movement"], stored["location"], stored["toc"]))
    assert text.count("partial_count(1)") >= 1
    # counted per place, operator, day, event and variation before any join
    first_join = text.rindex("Join")
    assert text.rindex("partial_count(1)") > first_join


def test_leaderboards_combine_before_the_shuffle(stored):
    totals = performance.station_totals(stored["movement"], stored["location"], stored["toc"])
    assert "partial_sum" in plan(performance.station_leaderboard(totals))


def test_latest_rows_read_the_table_once_and_limit_each_task(stored):
    text = plan(marts.train_status(stored["movement"]))
    assert text.count("FileScan parquet") == 1 and "Join" not in text
    assert text.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("name", ["p22_fact_movement", "p28_train_delay", "p30_route_meta", "p34_station_performance", "p41_associated_routes"])
def test_no_python_and_no_cross_product(spark, name):
    text = plan(QUERIES[name](spark, SF_DIR))
    for word in ("PythonUDF", "ArrowEval", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text, (name, word)


def test_no_forced_broadcast_in_the_library():
    from pathlib import Path

    import railmill

    for path in Path(railmill.__file__).parent.rglob("*.py"):
        code = path.read_text()
        assert "F.broadcast(" not in code and "localCheckpoint" not in code and ".crossJoin(" not in code, path


def joins(text):
    """Kind and text of every join, the last one first."""
    return re.findall(r"(\w+Join) (\[.*)", text)


@pytest.mark.parametrize(
    "name, key",
    [
        ("p19_bridge_td_to_schedule", "train_signalling_id"),
        ("p21_fact_activation", "train_uid"),
        ("p22_fact_movement", "train_uid"),
        ("p22_fact_movement", "train_id"),
        ("p24_fact_scheduled_location", "train_uid"),
    ],
)
def test_what_grows_with_the_timetable_is_not_sent_through_the_driver(spark, name, key):
    """The files look small when the plan is made, the rows parsed from them are not."""
    kinds = [kind for kind, on in joins(plan(QUERIES[name](spark, SF_DIR))) if on.startswith(f"[{key}#")]
    assert kinds and set(kinds) == {"SortMergeJoin"}


def test_berth_events_multiply_in_the_last_join(spark):
    """Steps meet all schedules of their signalling id there, and no join or shuffle follows."""
    text = plan(QUERIES["p23_fact_berth_events"](spark, SF_DIR))
    kind, on = joins(text)[0]
    assert kind == "SortMergeJoin" and "_range_bin" in on
    assert "Exchange" not in text[: text.index("_range_bin")]


def test_berth_events_make_the_text_of_a_time_once_a_step(spark):
    """After the join that multiplies rows the key takes it from the step."""
    m = Tables(spark, SF_DIR).models
    text = plan(core.fact_berth_events(m.stg_describer, m.dim_area, m.dim_signal_berth, m.bridge_td))
    after, before = text[: text.index("SortMergeJoin")], text[text.index("SortMergeJoin") :]
    assert "md5" in after and "cast(event_ts" not in after and "cast(event_ts" in before


def test_rows_that_multiply_by_berth_step_lie_together(spark):
    text = plan(QUERIES["e09_three_condition_join"](spark, SF_DIR))
    assert "SortMergeJoin" in text and "BroadcastHashJoin" not in text


def test_enrichment_knows_how_few_current_schedules_there_are(spark):
    """The movements are not shuffled for them, however large the timetable they are chosen from."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        kinds = [kind for kind, on in joins(plan(QUERIES["e11_enrich_movements"](spark, SF_DIR))) if "train_signalling_id" in on]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert kinds == ["BroadcastHashJoin"]
