"""Performance queries: stations, routes, delay shares, leaderboards.

Movements are counted per (place, operator, day, event, variation) before any dimension
is joined. That combines inside each map task, so a busy station shrinks to its few
distinct variations first, and both the totals and the worst events read the one result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from railmill.functions import service_date
from railmill.operators.aggregates import category_share, delay_metrics, leaderboard
from railmill.operators.dedup import first_k

METRICS = [
    "sum_delay_mins", "total_events", "total_departures", "total_arrivals", "on_time_events",
    "slight_delay_events", "delay_events", "major_delay_events",
]
STATION = ["station_id", "location_name", "_day"]
WORST_EVENTS = 5
NO_DAY = -(2**31)


PERFORMANCE = ["station_id", "location_name", "service_date", *METRICS, "pct_on_time", "avg_delay_mins"]


def _counted(movements: DataFrame, place: list[str]) -> DataFrame:
    rows = movements.filter(F.col("actual_timestamp").isNotNull()).select(
        *place, service_date(F.col("planned_timestamp")).alias("service_date"), "event_type", "timetable_variation"
    )
    return rows.groupBy(*place, "service_date", "event_type", "timetable_variation").agg(F.count("*").alias("events"))


def _station_counts(movements: DataFrame, locations: DataFrame, tocs: DataFrame) -> DataFrame:
    counted = _counted(movements, ["location_id", "toc_id"])
    # dim_location holds no place without a station; the day as a number: a missing one is a plain key, so totals and worst events, both
    # shuffled by these keys, join without another shuffle
    counted = counted.withColumn("_day", F.coalesce(F.unix_date("service_date"), F.lit(NO_DAY)))
    named = F.col("location_name").isNotNull() & F.col("station_id").isNotNull()
    places = locations.filter(named).select("location_id", "station_id", "location_name")
    return counted.join(places, "location_id").join(tocs.select("toc_id", "toc_name"), "toc_id", "left")


def _station_totals(counted: DataFrame) -> DataFrame:
    metrics = delay_metrics(F.col("timetable_variation"), F.col("event_type"), F.col("events"))
    totals = counted.groupBy(*STATION).agg(*metrics)
    return totals.withColumns(
        {
            "pct_on_time": F.try_divide("on_time_events", "total_events"),
            "avg_delay_mins": F.try_divide("sum_delay_mins", "total_events"),
        }
    )


def _with_date(df: DataFrame) -> DataFrame:
    day = F.when(F.col("_day") != NO_DAY, F.date_from_unix_date("_day"))
    return df.withColumn("service_date", day).select(*PERFORMANCE, *[c for c in df.columns if c in ("toc", "delay")])


def _worst_events(counted: DataFrame) -> DataFrame:
    """The worst events per station and day, one row each.

    A counted row stands for ``events`` equal events, of which at most five can matter.
    """
    order = [F.col("timetable_variation").desc_nulls_last(), F.col("toc_name").asc_nulls_first()]
    slim = counted.select(*STATION, F.col("toc_name"), F.col("timetable_variation"), "events")
    worst_rows = first_k(slim, STATION, order, WORST_EVENTS)
    copies = F.sequence(F.lit(1), F.least(F.col("events"), F.lit(WORST_EVENTS)).cast("int"))
    events = worst_rows.withColumn("_copy", F.explode(copies)).drop("_copy", "events")
    ranked = first_k(events, STATION, order, WORST_EVENTS)
    return ranked.select(*STATION, F.col("toc_name").alias("toc"), F.col("timetable_variation").alias("delay"))


def station_totals(movements: DataFrame, locations: DataFrame, tocs: DataFrame) -> DataFrame:
    """Delay metrics per station and service day, one row each."""
    return _with_date(_station_totals(_station_counts(movements, locations, tocs)))


def station_performance(movements: DataFrame, locations: DataFrame, tocs: DataFrame) -> DataFrame:
    """Delay metrics per station and day, repeated for each of its five worst events."""
    counted = _station_counts(movements, locations, tocs)
    return _with_date(_station_totals(counted).join(_worst_events(counted), STATION))


def route_performance(movements: DataFrame, schedules: DataFrame, routes: DataFrame) -> DataFrame:
    """Delay metrics per route and service day.

    ``routes`` decides which schedules count: with one route per uid the movements of
    its other schedules drop out, with one per schedule all are kept.
    """
    rows = movements.filter(F.col("actual_timestamp").isNotNull()).withColumn(
        "service_date", service_date(F.col("planned_timestamp"))
    )
    totals = rows.groupBy("schedule_id", "service_date").agg(
        *delay_metrics(F.col("timetable_variation"), F.col("event_type"))
    )
    trains = schedules.select("schedule_id", "train_uid")
    known = routes.filter(F.col("route_desc").isNotNull()).select(
        "schedule_id", "train_uid", "origin", "terminating", "route_desc"
    )
    return (
        totals.join(trains, "schedule_id")
        .join(known, ["schedule_id", "train_uid"])
        .select("train_uid", "origin", "terminating", "route_desc", "service_date", *METRICS)
    )


def delay_share_by_operator(delays: DataFrame) -> DataFrame:
    return category_share(delays, "toc_name")


def delay_share_by_route(delays: DataFrame, operator: str) -> DataFrame:
    return category_share(delays.filter(F.col("toc_name") == operator), "route_desc")


def station_leaderboard(totals: DataFrame) -> DataFrame:
    """Stations by total delay, from one row per station and day."""
    board = leaderboard(
        totals,
        ["station_id", "location_name"],
        ["total_events", "sum_delay_mins"],
        {"avg_delay_mins": "avg_delay", "pct_on_time": "pct_on_time"},
    )
    return board.orderBy(F.desc_nulls_last("sum_delay_mins"), "station_id", "location_name")


def route_leaderboard(perf: DataFrame) -> DataFrame:
    board = leaderboard(perf, ["train_uid", "route_desc"], ["total_events", "sum_delay_mins"])
    return board.orderBy(F.desc_nulls_last("sum_delay_mins"), "train_uid", "route_desc")


def headline_figures(perf: DataFrame) -> DataFrame:
    """Events, delay and mean on-time share over a performance frame."""
    share = [F.avg("pct_on_time").alias("pct_on_time")] if "pct_on_time" in perf.columns else []
    return perf.agg(F.sum("total_events").alias("total_events"), F.sum("sum_delay_mins").alias("total_delay"), *share)


def delay_distribution(perf: DataFrame, tie_break: list[str]) -> DataFrame:
    """Delay classes of the newest, most delayed row of a performance frame."""
    order = [F.desc_nulls_last("service_date"), F.desc_nulls_last("sum_delay_mins"), *tie_break]
    top = perf.orderBy(*order).limit(1)
    named = top.select(
        F.col("on_time_events").alias("On Time"),
        F.col("slight_delay_events").alias("1-5 min"),
        F.col("delay_events").alias("6-10 min"),
        F.col("major_delay_events").alias(">10 min"),
    )
    return named.unpivot([], list(named.columns), "category", "count")


def worst_contributors(perf: DataFrame, columns: list[str], by: str) -> DataFrame:
    """Performance rows by a measure, greatest first, with the other columns breaking ties."""
    return perf.select(*columns).orderBy(F.desc_nulls_last(by), *[c for c in columns if c != by])
