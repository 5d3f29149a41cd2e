"""Table writers: idempotence, moved rows, rejects, snapshots."""

import datetime as dt
import json

from pyspark.sql import functions as F

from tests.conftest import rows
from railmill.sources import tables


def day(n):
    return dt.datetime(2024, 1, n, 6)


def frame(spark, data):
    return spark.createDataFrame(data, "k int, v string, ingest_ts timestamp")


def test_merge_days_inserts_updates_and_moves(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.merge_days(spark, path, frame(spark, [(1, "a", day(1)), (2, "b", day(1)), (3, "c", day(2))]), ["k"])
    # 3 was alone on day 2 and moves to day 3: day 2 must vanish
    updates = frame(spark, [(1, "A", day(3)), (3, "C", day(3)), (4, "d", day(4))])
    for _ in range(2):  # twice is the same as once
        tables.merge_days(spark, path, updates, ["k"])
        got = spark.read.parquet(path).select("k", "v", F.col("ingest_date").cast("string"))
        assert rows(got) == [(1, "A", "2024-01-03"), (2, "b", "2024-01-01"), (3, "C", "2024-01-03"), (4, "d", "2024-01-04")]
    assert not (tmp_path / "t" / "ingest_date=2024-01-02").exists()


def test_overwrite_days_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.overwrite_days(frame(spark, [(1, "a", day(1)), (2, "b", day(2))]), path, ["k"])
    for _ in range(2):
        tables.overwrite_days(frame(spark, [(9, "z", day(2))]), path, ["k"])
    assert rows(spark.read.parquet(path).select("k", "v")) == [(1, "a"), (9, "z")]


def test_append_days_rejects_incomplete_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    rejected = tables.append_days(frame(spark, [(1, "a", day(1)), (2, None, day(1)), (3, "c", None)]), path, ["v", "ingest_ts"])
    assert rows(rejected.select("k")) == [(2,), (3,)]
    assert rows(spark.read.parquet(path).select("k")) == [(1,)]


def test_rows_per_file(spark, tmp_path):
    path = tmp_path / "t"
    tables.write_parquet(spark.range(25).coalesce(1), str(path), rows_per_file=10)
    assert len(list(path.glob("*.parquet"))) == 3


def test_partition_filter_reaches_the_scan(spark, tmp_path):
    from railmill.operators.filters import on_run_date

    path = str(tmp_path / "t")
    tables.overwrite_days(frame(spark, [(n, "x", day(n)) for n in range(1, 6)]), path)
    scan = on_run_date(spark.read.parquet(path), dt.date(2024, 1, 3))
    assert rows(scan.select("k")) == [(3,)]
    assert "PartitionFilters: [isnotnull(ingest_date" in scan._jdf.queryExecution().toString()


def test_schedule_snapshot_pages_keep_all(spark):
    flags = {n: True for n in ("mon_service", "tue_service", "wednes_service", "thrus_service", "fri_service", "sat_service")}
    df = spark.range(30).select(
        F.lit("U1").alias("train_uid"),
        F.format_string("s%02d", "id").alias("schedule_id"),
        F.lit("P").alias("stp_indicator"),
        F.lit(dt.date(2024, 1, 1)).alias("schedule_start_date"),
        F.lit(dt.date(2024, 1, 31)).alias("schedule_end_date"),
        *[F.lit(v).alias(k) for k, v in flags.items()],
        F.lit(None).cast("boolean").alias("sun_service"),
    )
    whole = tables.schedule_snapshot(df).collect()
    assert len(whole) == 1 and whole[0].key == "schedule:U1"
    first = json.loads(whole[0].value)[0]
    assert first == {
        "schedule_id": "s00", "stp_indicator": "P", "start_date": "2024-01-01", "end_date": "2024-01-31",
        "mon": True, "tue": True, "wed": True, "thu": True, "fri": True, "sat": True, "sun": False,
    }
    paged = sorted(tables.schedule_snapshot(df, page_rows=4).collect(), key=lambda r: r.page)
    assert [x["schedule_id"] for r in paged for x in json.loads(r.value)] == [f"s{i:02d}" for i in range(30)]


def test_models_become_views_or_tables(spark):
    df = spark.range(3).toDF("k")
    view = tables.materialise(df, "model_as_view", as_table=False)
    stored = tables.materialise(df, "model_as_table", as_table=True)
    try:
        assert rows(view) == rows(stored) == [(0,), (1,), (2,)]
        kinds = {t.name: t.tableType for t in spark.catalog.listTables()}
        assert kinds["model_as_view"] == "TEMPORARY" and kinds["model_as_table"] == "MANAGED"
        # a second run replaces the table
        assert rows(tables.materialise(spark.range(1).toDF("k"), "model_as_table", as_table=True)) == [(0,)]
    finally:
        spark.sql("drop table if exists model_as_table")
        spark.catalog.dropTempView("model_as_view")
