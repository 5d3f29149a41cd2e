"""Grouped results: metrics, latest rows, ordered arrays, top-k, shares, leaderboards."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from railmill.functions.labels import DELAY_BUCKETS
from railmill.operators.dedup import first_k

# Largest array one row may carry; bigger groups come in several pages.
PAGE_ROWS = 250_000
# Rows one task numbers at a time, on average; bigger groups are cut at marked rows.
RUN_ROWS = 250_000


def count_when(condition: Column) -> Column:
    """Number of rows the condition holds for (null counts as no)."""
    return F.sum(F.when(condition, 1).otherwise(0))


def delay_metrics(minutes: Column, event_type: Column, weight: Column | None = None) -> list[Column]:
    """Sum of delay, counts by event type and by delay class.

    A missing variation falls into no delay class. ``weight`` is the number of events a
    row stands for, for input that has been counted already.
    """
    one = F.lit(1).cast("bigint") if weight is None else weight

    def events(condition: Column) -> Column:
        return F.sum(F.when(condition, one).otherwise(F.lit(0)))

    return [
        F.sum(minutes * one).alias("sum_delay_mins"),
        F.sum(one).alias("total_events"),
        events(event_type == "DEPARTURE").alias("total_departures"),
        events(event_type == "ARRIVAL").alias("total_arrivals"),
        events(minutes <= 0).alias("on_time_events"),
        events(minutes.between(1, 5)).alias("slight_delay_events"),
        events(minutes.between(6, 10)).alias("delay_events"),
        events(minutes > 10).alias("major_delay_events"),
    ]


def latest_rows(df: DataFrame, key: str, ts: str) -> DataFrame:
    """All rows at the latest timestamp of their key; ties stay, null timestamps never match.

    Spark applies ``rank = 1`` in every task before the shuffle, so a hot key sends its newest
    rows per task and the table is read once.
    """
    rank = F.rank().over(Window.partitionBy(key).orderBy(F.desc(ts)))
    known = df.filter(F.col(key).isNotNull() & F.col(ts).isNotNull())
    return known.withColumn("_rank", rank).filter(F.col("_rank") == 1).drop("_rank")


def numbered(
    df: DataFrame, keys: list[str], order: list[str], name: str = "position", run_rows: int = RUN_ROWS
) -> DataFrame:
    """Adds each row's 0-based place in its group by ``order``; null keys form a group like any other.

    One row in ``run_rows``, chosen by a hash of its values, is a mark. The marks of a group, sorted,
    cut it into runs; a row's place is its number within the run plus the sizes of the runs before.
    All of this follows from the rows' values, so the result does not depend on how the rows are
    partitioned, and no task has to hold or sort more than a run. Rows equal in keys and order
    are interchangeable: give an ``order`` that tells rows apart. Marks and run sizes, one in ``run_rows`` rows each, are
    looked up in a value that every task gets, so rows of few groups are not gathered in as few tasks to meet them.
    """
    place = F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)])
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    slim = df.select(*keys, place.alias("_place"))
    marks = (
        slim.filter(F.pmod(F.xxhash64(*keys, "_place"), F.lit(run_rows)) == 0)
        .groupBy(*keys)
        .agg(F.sort_array(F.collect_set("_place")).alias("marks"))
        .withColumn("step", F.ceil(F.sqrt(F.size("marks"))).cast("int"))
        .withColumn("coarse", F.filter("marks", lambda m, i: (i + 1) % F.col("step") == 0))
    )
    known = _by_group(marks, keys, ["marks", "step", "coarse"])

    def with_run(rows: DataFrame) -> DataFrame:
        found = rows.withColumn("_near", _near(known, keys)).withColumn("_of", _found("_near", group))
        # every step-th mark first, then the marks up to the next of these
        passed = F.size(F.filter("_of.coarse", lambda m: m <= F.col("_place"))) * F.col("_of.step")
        found = found.withColumn("_passed", passed)
        near = F.slice("_of.marks", F.col("_passed") + 1, F.col("_of.step"))
        before = F.col("_passed") + F.size(F.filter(near, lambda m: m <= F.col("_place")))
        return found.withColumn("_run", F.when(F.col("_of").isNull(), 0).otherwise(before))

    # only groups that were cut have a run above 0
    sizes = with_run(slim).filter(F.col("_of").isNotNull()).groupBy(*keys, "_run").agg(F.count("*").alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_run").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(*keys, F.struct("_run", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("start")).alias("_start"))
    starts = starts.groupBy(*keys).agg(F.map_from_entries(F.collect_list("_start")).alias("starts"))
    rows = with_run(df.withColumn("_place", place))
    rows = rows.withColumn("_near", _near(_by_group(starts, keys, ["starts"]), keys))
    start = F.try_element_at(_found("_near", group)["starts"], F.col("_run"))
    number = F.row_number().over(Window.partitionBy(*keys, "_run").orderBy("_place")) - 1
    rows = rows.withColumn("_start", F.coalesce(start, F.lit(0).cast("bigint")))
    return rows.withColumn(name, number + F.col("_start")).select(*df.columns, name)


def _by_group(groups: DataFrame, keys: list[str], values: list[str]) -> Column:
    """One row a group as a single value: an array of as many lists as there are groups, each group listed by its hash."""
    group = F.struct(*[F.col(k).alias(f"k{i}") for i, k in enumerate(keys)])
    listed = groups.select(F.struct(F.xxhash64(*keys).alias("h"), group.alias("group"), *values).alias("g"))
    slot = F.pmod(F.col("g.h"), F.col("n"))
    slots = listed.select("g", F.count("*").over(Window.partitionBy()).alias("n")).groupBy("n", slot.alias("slot"))
    slots = slots.agg(F.collect_list("g").alias("listed")).groupBy("n").agg(F.map_from_entries(F.collect_list(F.struct("slot", "listed"))).alias("m"))
    return slots.select(F.transform(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1), lambda i: F.try_element_at("m", i))).scalar()


def _near(groups: Column, keys: list[str]) -> Column:
    """The groups whose hash falls into the slot of a row's; null where no group is listed."""
    return F.get(groups, F.pmod(F.xxhash64(*keys), F.size(groups)).cast("int"))


def _found(near: str, group: Column) -> Column:
    """The entry of a row's group among those near it, or null."""
    return F.get(F.filter(near, lambda g: g["group"].eqNullSafe(group)), F.lit(0))


def ordered_pages(
    df: DataFrame, keys: list[str], order: list[str], items: list[str], page_rows: int = PAGE_ROWS
) -> DataFrame:
    """Per key and page the rows as one array ``items`` of structs, in ``order``, then by the items.

    A page holds the rows at places ``page * page_rows`` up to the next page's, so pages follow from
    the rows alone and an ordinary group is the single page 0. No row is dropped and no task holds a
    whole hot group.
    """
    position = [*order, *[c for c in items if c not in order]]
    slim = df.select(*dict.fromkeys([*keys, *order, *items]))
    placed = numbered(slim, keys, position, "_position")
    packed = F.struct("_position", F.struct(*items).alias("item"))
    paged = placed.withColumn("page", F.floor(F.col("_position") / F.lit(page_rows)))
    sorted_items = F.transform(F.sort_array(F.collect_list(packed)), lambda x: x["item"])
    return paged.groupBy(*keys, "page").agg(sorted_items.alias("items"))


def top_k_rows(df: DataFrame, keys: list[str], order: list[Column], k: int, rank_as: str | None = None) -> DataFrame:
    return first_k(df, keys, order, k, rank_as)


def top_k_array(df: DataFrame, keys: list[str], order: list[Column], items: list[str], k: int) -> DataFrame:
    """Per key an array of the first ``k`` rows in ``order``: at most k rows are gathered."""
    ranked = first_k(df, keys, order, k, rank_as="_rank")
    packed = F.sort_array(F.collect_list(F.struct("_rank", F.struct(*items).alias("item"))))
    return ranked.groupBy(*keys).agg(F.transform(packed, lambda x: x["item"]).alias("items"))


def last_k_array(df: DataFrame, keys: list[str], order: list[str], items: list[str], k: int) -> DataFrame:
    """Per key the last ``k`` rows in ``order`` as an array, oldest first."""
    ranked = first_k(df, keys, [F.col(c).desc_nulls_last() for c in order], k, rank_as="_rank")
    packed = F.sort_array(F.collect_list(F.struct((-F.col("_rank")).alias("p"), F.struct(*items).alias("item"))))
    return ranked.groupBy(*keys).agg(F.transform(packed, lambda x: x["item"]).alias("items"))


def category_counts(df: DataFrame, index: str, category: str, categories=DELAY_BUCKETS) -> DataFrame:
    """Pivot count: one row per index, one column per category, zero where none.

    The category list is given, so no extra pass has to find it.
    """
    return df.filter(F.col(index).isNotNull()).groupBy(index).agg(
        *[count_when(F.col(category) == c).alias(c) for c in categories]
    )


def row_percentages(counts: DataFrame, index: str, categories=DELAY_BUCKETS) -> DataFrame:
    """Each category as a percentage of its row total."""
    total = sum((F.col(c) for c in categories[1:]), F.col(categories[0]))
    return counts.select(index, *[F.try_divide(F.col(c) * F.lit(100.0), total).alias(c) for c in categories])


def melt(wide: DataFrame, index: str, categories=DELAY_BUCKETS, name="delay_category", value="percent") -> DataFrame:
    return wide.unpivot(index, list(categories), name, value)


def category_share(df: DataFrame, index: str, category: str = "delay_category", categories=DELAY_BUCKETS) -> DataFrame:
    """Long table of category percentages per index."""
    counts = category_counts(df, index, category, categories)
    return melt(row_percentages(counts, index, categories), index, categories)


def leaderboard(df: DataFrame, keys: list[str], totals: list[str], means: dict[str, str] | None = None) -> DataFrame:
    """Sums of ``totals`` and means (column -> output name) per key."""
    sums = [F.sum(c).alias(c) for c in totals]
    averages = [F.avg(c).alias(name) for c, name in (means or {}).items()]
    return df.groupBy(*keys).agg(*sums, *averages)


def centroid(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    return points.agg(F.avg(lat).alias("latitude"), F.avg(lon).alias("longitude"))


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values of one column."""
    return df.select(column).filter(F.col(column).isNotNull()).distinct().orderBy(column)
