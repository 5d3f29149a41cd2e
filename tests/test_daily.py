"""The daily run: repeating a day, a second day with late messages, and pruned reads."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from catalogue import load_all
from catalogue.registry import Tables
from railmill.operators.filters import on_run_date
from railmill.plans import intermediate, live
from railmill.plans.daily import run_daily
from railmill.sources import tables
from railmill.streaming import enrich

SF_DIR = "/root/testdata/sf0.001"
load_all()


@pytest.fixture(scope="module")
def inputs(spark, tmp_path_factory):
    m = Tables(spark, SF_DIR).models
    from catalogue.products import RUN_TS

    dump = str(tmp_path_factory.mktemp("dump") / "lines")
    m.dump_lines.select("value").write.option("compression", "gzip").text(dump)
    feeds = {
        "activation": m.activation_clean,
        "movement": m.movement_clean,
        "describer": m.describer_clean.withColumn("ingest_ts", F.lit(RUN_TS)),
    }
    seeds = {
        "toc": m.toc_seed, "td_area": m.area_seed, "trust_corpus": m.corpus_seed, "td_smart": m.smart_seed,
        "stops": m.stops_seed, "train_category": m.category_seed,
    }
    return feeds, seeds, dump, RUN_TS


def contents(spark, paths):
    """Every table's rows as text, sorted."""
    out = {}
    for name, path in paths.items():
        df = spark.read.parquet(path)
        out[name] = sorted(r[0] for r in df.select(F.to_json(F.struct(*sorted(df.columns)))).collect())
    return out


def test_a_day_can_be_run_again(spark, inputs, tmp_path):
    feeds, seeds, dump, run_ts = inputs
    warehouse = str(tmp_path / "warehouse")
    first = contents(spark, run_daily(spark, warehouse, feeds, seeds, run_ts, dump))
    again = contents(spark, run_daily(spark, warehouse, feeds, seeds, run_ts, dump))
    assert sorted(first) == sorted(again) and len(first) == 29
    assert {n for n in first if first[n] != again[n]} == set()
    keys = spark.read.parquet(f"{warehouse}/core/fact_train_movement").select("train_movement_id")
    assert keys.count() == keys.distinct().count() > 0


def test_late_messages_of_the_day_before(spark, inputs, tmp_path):
    """Two days, the second with a look back, end like one run over the messages of both."""
    feeds, seeds, dump, run_ts = inputs
    warehouse = str(tmp_path / "warehouse")
    moved = feeds["movement"].filter(F.to_date("ingest_ts") == F.lit(run_ts.date()))
    late = F.pmod(F.xxhash64("train_id"), F.lit(5)) == 0
    run_daily(spark, warehouse, feeds | {"movement": moved.filter(~late)}, seeds, run_ts, dump)
    tomorrow = run_ts + dt.timedelta(days=1)
    paths = run_daily(spark, warehouse, feeds | {"movement": moved}, seeds, tomorrow, dump, lookback_days=1)
    want = moved.select("train_id", "loc_stanox", "actual_timestamp").distinct().count()
    assert spark.read.parquet(paths["stg_movement"]).count() == want


def test_the_live_side_reads_reduced_lookups(spark, inputs, tmp_path):
    feeds, seeds, dump, run_ts = inputs
    paths = run_daily(spark, str(tmp_path / "warehouse"), feeds, seeds, run_ts, dump)
    geo, schedules, operators = enrich.stored_lookups(spark, paths)()
    assert schedules.count() == schedules.select("train_signalling_id").distinct().count() > 0
    assert geo.count() == geo.select("station_id").distinct().count() > 0
    enriched = live.enrich_movements(feeds["movement"], geo, schedules, operators)
    plan = enriched._jdf.queryExecution().executedPlan().toString()
    trains = spark.read.parquet(paths["dim_train_schedule"])
    again = live.enrich_movements(feeds["movement"], geo, trains, operators, run_ts.date())
    assert "Window" not in plan and "Window" in again._jdf.queryExecution().executedPlan().toString()
    assert enriched.exceptAll(again).count() == again.exceptAll(enriched).count() == 0


def scan_filters(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line.split("PartitionFilters: ")[1] for line in plan.splitlines() if "PartitionFilters: [" in line]


def test_days_are_read_by_partition(spark, inputs, tmp_path):
    feeds, seeds, dump, run_ts = inputs
    paths = run_daily(spark, str(tmp_path / "warehouse"), feeds, seeds, run_ts, dump)
    schedules = spark.read.parquet(paths["stg_schedule"])
    for build in (intermediate.schedule_headers, intermediate.schedule_stops):
        assert any("ingest_date" in f and "ubquery" in f for f in scan_filters(build(schedules)))
    moved = on_run_date(spark.read.parquet(paths["stg_movement"]), run_ts.date())
    assert all("ingest_date" in f for f in scan_filters(moved))


def test_merges_read_only_days_that_can_match(spark, tmp_path, monkeypatch):
    def frame(data):
        return spark.createDataFrame(data, "k int, at timestamp, v string, ingest_ts timestamp")

    def day(n):
        return dt.datetime(2024, 1, n, 6)

    path = str(tmp_path / "t")
    tables.merge_days(spark, path, frame([(n, day(n), "a", day(n)) for n in range(1, 9)]), ["k"], event_ts="at")
    updates = frame([(8, day(8), "b", day(9)), (7, day(7), "c", day(9))])
    scratch = str(tmp_path / "scratch")
    monkeypatch.setattr(tables, "shared_dir", lambda spark, purpose: scratch)
    tables.merge_days(spark, path, updates, ["k"], event_ts="at")
    got = {r["k"]: (r["v"], r["ingest_date"].day) for r in spark.read.parquet(path).collect()}
    assert got == {n: ("a", n) for n in range(1, 7)} | {7: ("c", 9), 8: ("b", 9)}
    assert not (tmp_path / "scratch").exists()
    new = tables.with_ingest_date(updates)
    since = tables.earliest_day(new, "at")
    assert since == dt.date(2024, 1, 6)
    hit = tables.matching_days(spark.read.parquet(path), new, ["k"], since)
    assert any("ingest_date" in f and "2024-01-06" in f for f in scan_filters(hit))
    assert tables.earliest_day(frame([(1, None, "a", day(1))]), "at") is None
