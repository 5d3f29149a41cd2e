"""Queries on tables where one key holds a third of all rows, against their SQL twins."""

import shutil
from pathlib import Path

import duckdb
import pytest

from catalogue import load_all
from catalogue.compare import compare, connect
from railmill.operators.aggregates import ordered_pages

SOURCE = Path("/root/testdata/sf0.001")
HOT = {
    "lineitem": "case when nr % 3 = 0 then 7 else l_orderkey end as l_orderkey, case when nr % 3 = 0 then 7 else l_suppkey end as l_suppkey",
    "orders": "case when nr % 3 = 0 then 7 else o_custkey end as o_custkey",
    "events": "case when nr % 3 = 0 then 7 else user_id end as user_id",
}
NAMES = [
    "b12_schedule_snapshot", "e02_four_key_left_join", "e05_interval_join", "e06_two_roles", "f04_latest_rows_with_ties",
    "f05_ordered_array", "f06_top_k_array", "g01_keep_latest", "g04_first_and_last", "i03_last_k_trail", "l03_live_state_batch",
    "l03_live_state_stream", "p25_train_status", "p26_live_train", "p27_route_start_stop", "p28_train_delay", "p30_route_meta",
    "p34_station_performance", "p35_route_performance", "p36_station_search", "p37_delay_share_by_operator",
]
load_all()


@pytest.fixture(scope="module")
def skewed(tmp_path_factory):
    folder = tmp_path_factory.mktemp("skewed")
    con = duckdb.connect()
    for path in SOURCE.glob("*.parquet"):
        name = path.stem
        if name in HOT:
            con.execute(
                f"copy (select * exclude (nr) replace ({HOT[name]}) from (select *, row_number() over () as nr"
                f" from '{path}')) to '{folder / path.name}' (format parquet)"
            )
        else:
            shutil.copy(path, folder / path.name)
    return str(folder)


@pytest.mark.parametrize("name", NAMES)
def test_hot_key(spark, skewed, name):
    problems = compare(spark, connect(skewed), name, skewed)
    assert [p for p in problems if p != "no rows"] == []


def test_hot_group_is_paged_whole(spark, skewed):
    lines = spark.read.parquet(f"{skewed}/lineitem.parquet")
    pages = ordered_pages(lines, ["l_orderkey"], ["l_linenumber"], ["l_linenumber", "l_partkey"], page_rows=200)
    sizes = [(r.l_orderkey, r.page, len(r["items"])) for r in pages.collect()]
    assert sum(n for _, _, n in sizes) == lines.count()
    assert max(n for _, _, n in sizes) <= 200
    assert sum(1 for k, _, _ in sizes if k == 7) >= 10
