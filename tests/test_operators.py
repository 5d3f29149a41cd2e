"""Operators against brute force, hot keys, and the shape of their plans."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tests.conftest import rows
from railmill.operators import aggregates, arrays, dedup, filters, joins, quality


def plan(df) -> str:
    return df._jdf.queryExecution().toString()


def test_keep_latest_is_repeatable_and_limits_before_the_shuffle(spark):
    data = [(k, ts, f"v{i}") for i, (k, ts) in enumerate([(1, 5), (1, 9), (1, 9), (2, None), (None, 3)])]
    df = spark.createDataFrame(data, "k int, ts int, v string")
    kept = dedup.keep_latest(df, ["k"], by="ts")
    assert rows(kept) == sorted([(1, 9, "v2"), (2, None, "v3"), (None, 3, "v4")], key=repr)
    assert rows(dedup.keep_latest(df.repartition(3), ["k"], by="ts")) == rows(kept)
    text = plan(kept)
    partial, exchange = text.rindex("Partial"), text.rindex("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text and partial > exchange  # below the exchange in the tree


def test_keep_by_priority(spark):
    df = spark.createDataFrame([(1, "schedule", "a"), (1, "trust", "b"), (2, "schedule", "c")], "k int, s string, v string")
    assert rows(dedup.keep_by_priority(df, ["k"], "s", ["trust"])) == [(1, "trust", "b"), (2, "schedule", "c")]


def test_first_and_last_combine_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 0, "a"), (1, 2, "c"), (1, 1, "b"), (2, 0, "x")], "k int, o int, v string")
    ends = dedup.first_and_last(df, ["k"], ["o"], {"v": ("first", "last")})
    assert rows(ends) == [(1, "a", "c"), (2, "x", "x")]
    assert "partial_min_by" in plan(ends)


def test_interval_join_equals_brute_force(spark):
    rng = random.Random(7)
    day0 = dt.date(2024, 1, 1)
    points = [(i, rng.choice([1, 1, 1, 2, None]), day0 + dt.timedelta(days=rng.randrange(120))) for i in range(150)]
    ranges = []
    for j in range(60):
        start = day0 + dt.timedelta(days=rng.randrange(-50, 120))
        ranges.append((j, rng.choice([1, 1, 2]), start, start + dt.timedelta(days=rng.choice([-3, 0, 2, 40, 90_000]))))
    left = spark.createDataFrame(points, "i int, k int, d date")
    right = spark.createDataFrame(ranges, "j int, k int, a date, z date")
    expected = sorted((i, j) for i, k, d in points for j, k2, a, z in ranges if k == k2 and a <= d <= z)
    for width in (1, 7, 28):
        joined = joins.interval_join(left, right, [("k", "k")], F.col("d"), "a", "z", bin_days=width)
        assert sorted((r.i, r.j) for r in joined.select("p.i", "r.j").collect()) == expected


def test_interval_join_without_points(spark):
    left = spark.createDataFrame([], "i int, k int, d date")
    right = spark.createDataFrame([(1, 1, dt.date(2024, 1, 1), dt.date(2024, 2, 1))], "j int, k int, a date, z date")
    assert joins.interval_join(left, right, [("k", "k")], F.col("d"), "a", "z").count() == 0


def test_ordered_pages_keeps_every_row_of_a_hot_group(spark):
    data = [("hot", i // 2, i) for i in range(1000)] + [("cold", 3 - i, i) for i in range(3)] + [(None, 0, 1)]
    df = spark.createDataFrame(data, "k string, o int, v int").repartition(5)
    pages = aggregates.ordered_pages(df, ["k"], ["o"], ["o", "v"], page_rows=100).collect()
    by_key = {}
    for r in sorted(pages, key=lambda r: r.page):
        assert len(r["items"]) <= 100
        by_key.setdefault(r.k, []).append([(x.o, x.v) for x in r["items"]])
    assert [x for page in by_key["hot"] for x in page] == [(i // 2, i) for i in range(1000)]
    assert len(by_key["hot"]) >= 10
    assert by_key["cold"] == [[(1, 2), (2, 1), (3, 0)]] and by_key[None] == [[(0, 1)]]


def test_ordered_pages_without_hot_groups_is_one_page_each(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("o"))
    pages = aggregates.ordered_pages(df, ["k"], ["o"], ["o"])
    assert pages.select("page").distinct().collect()[0].page == 0 and pages.count() == 7


def test_places_do_not_depend_on_partitions(spark):
    data = [("hot" if i % 3 else f"k{i % 50}", (i * 7919) % 1000, i) for i in range(3000)] + [(None, i % 4, i) for i in range(40)]
    df = spark.createDataFrame(data, "k string, o int, v int")
    want = {}
    for k, o, v in sorted(data, key=lambda r: (str(r[0]), r[1], r[2])):
        want.setdefault(k, []).append((o, v))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions, run_rows in ((4, 50), (7, 50), (4, 10**9), (7, 1)):
            spark.conf.set("spark.sql.shuffle.partitions", str(partitions))
            got = aggregates.numbered(df.repartition(partitions), ["k"], ["o", "v"], run_rows=run_rows)
            assert got.columns == ["k", "o", "v", "position"]
            places = {(r.k, r.position): (r.o, r.v) for r in got.collect()}
            assert places == {(k, i): x for k, rows in want.items() for i, x in enumerate(rows)}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_pages_run_no_job_while_they_are_built(spark):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("pages", "building")
    try:
        aggregates.ordered_pages(spark.range(1000).selectExpr("id % 2 as k", "id as o"), ["k"], ["o"], ["o"], page_rows=10)
        assert list(tracker.getJobIdsForGroup("pages")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_interval_join_reaches_points_far_apart(spark):
    days = [dt.date(1999, 12, 31), dt.date(2024, 1, 15), dt.date(2080, 5, 5)]
    left = spark.createDataFrame([(i, 1, d) for i, d in enumerate(days)], "i int, k int, d date")
    right = spark.createDataFrame([(1, 1, dt.date(1990, 1, 1), dt.date(2099, 1, 1))], "j int, k int, a date, z date")
    joined = joins.interval_join(left, right, [("k", "k")], F.col("d"), "a", "z")
    assert rows(joined.select("i")) == [(0,), (1,), (2,)]


def test_latest_rows_keep_ties_and_skip_nulls(spark):
    df = spark.createDataFrame([(1, 5, "a"), (1, 5, "b"), (1, 4, "c"), (2, None, "d")], "k int, ts int, v string")
    assert rows(aggregates.latest_rows(df, "k", "ts").select("k", "ts", "v")) == [(1, 5, "a"), (1, 5, "b")]


def test_metrics_leave_missing_variation_out_of_all_classes(spark):
    df = spark.createDataFrame([(None, "ARRIVAL"), (0, "ARRIVAL"), (11, "DEPARTURE"), (6, "PASS")], "v int, e string")
    r = df.agg(*aggregates.delay_metrics(F.col("v"), F.col("e"))).first()
    assert (r.total_events, r.sum_delay_mins, r.on_time_events, r.slight_delay_events, r.delay_events) == (4, 17, 1, 0, 1)
    assert (r.major_delay_events, r.total_departures, r.total_arrivals) == (1, 1, 2)


def test_weighted_metrics_equal_plain_ones(spark):
    df = spark.range(500).select((F.col("id") % 17 - 3).alias("v"), F.lit("ARRIVAL").alias("e"))
    counted = df.groupBy("v", "e").agg(F.count("*").alias("n"))
    plain = df.agg(*aggregates.delay_metrics(F.col("v"), F.col("e"))).first()
    weighted = counted.agg(*aggregates.delay_metrics(F.col("v"), F.col("e"), F.col("n"))).first()
    assert plain == weighted


def test_append_missing_with_an_empty_side(spark):
    live = spark.createDataFrame([], "id string, a int")
    snap = spark.createDataFrame([("x", 1.5), (None, 2.5)], "id string, b double")
    assert rows(joins.append_missing(live, snap, "id")) == sorted([("x", None, 1.5), (None, None, 2.5)], key=repr)
    some = spark.createDataFrame([("x", 1), (None, 2)], "id string, a int")
    assert len(joins.append_missing(some, snap, "id").collect()) == 3


def test_facets_and_latest_partition(spark):
    df = spark.createDataFrame([("a", "2024-01-01"), ("b", "2024-01-02"), ("a", "2024-01-02")], "f string, d string")
    assert filters.facet_filter(df, {"f": ["a"], "d": []}).count() == 2
    assert rows(filters.latest_partition(df, F.col("d"))) == [("a", "2024-01-02"), ("b", "2024-01-02")]


def test_append_capped(spark):
    df = spark.range(1).select(F.array(*[F.lit(i) for i in range(4)]).alias("a"))
    for cap, expected in ((2, [3, 9]), (10, [0, 1, 2, 3, 9])):
        assert df.select(arrays.append_capped(F.col("a"), F.lit(9), cap)).first()[0] == expected


def test_quality_reports(spark):
    df = spark.createDataFrame([(1, None), (1, "x")], "k int, v string")
    assert rows(quality.null_counts(df, "t", ["k", "v"])) == [("t", "k", 0, "pass"), ("t", "v", 1, "fail")]
    assert rows(quality.duplicate_keys(df, "t", ["k"])) == [("t", 1, 1)]
    noon = dt.datetime(2024, 1, 1, 12)
    stamped = spark.createDataFrame([(noon,)], "ingest_ts timestamp")
    for hours, status in ((8, "pass"), (9, "warn"), (25, "error")):
        report = quality.freshness(stamped, "t", noon + dt.timedelta(hours=hours)).first()
        assert report.status == status
    assert quality.freshness(stamped.limit(0), "t", noon).first().status == "error"


def test_many_marks_in_few_groups_number_rows_without_gathering_a_group(spark):
    rows = spark.sql("select id % 2 as k, (id * 7919) % 5000 as o, id as v from range(5000)")
    placed = aggregates.numbered(rows, ["k"], ["o", "v"], run_rows=20)
    got = sorted((r["k"], r["position"], r["o"], r["v"]) for r in placed.collect())
    ordered = {k: sorted((r["o"], r["v"]) for r in rows.collect() if r["k"] == k) for k in (0, 1)}
    assert got == [(k, i, *p) for k in (0, 1) for i, p in enumerate(ordered[k])]
    # the rows meet the marks where they are, whatever Spark knows of sizes: no shuffle by the group alone
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = aggregates.numbered(rows, ["k"], ["o", "v"], run_rows=20)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" not in plan
