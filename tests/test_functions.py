"""Column functions on edge values."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from railmill import functions as fn
from railmill.functions import labels


def values(spark, texts, column):
    df = spark.createDataFrame([(i, x) for i, x in enumerate(texts)], "i int, c string")
    return [r[0] for r in df.orderBy("i").select(column(F.col("c"))).collect()]


def test_parse_millis(spark):
    got = values(spark, ["1704067200123", "", None, "abc", "99999999999999999", "-1"], fn.parse_millis)
    assert got == [
        dt.datetime(2024, 1, 1, 0, 0, 0, 123000), None, None, None, None, dt.datetime(1969, 12, 31, 23, 59, 59, 999000)
    ]


def test_parse_int(spark):
    assert values(spark, ["", " 12 ", "abc", None, "007", "3.7"], fn.parse_int) == [None, 12, None, None, 7, None]
    assert values(spark, ["x", None], lambda c: fn.parse_int(c, 0)) == [0, 0]


def test_parse_bool(spark):
    assert values(spark, ["TRUE", "false", None, "1", "true"], fn.parse_bool) == [True, False, False, False, True]


def test_times_and_allowances(spark):
    times = values(spark, ["0930", "0930H", "", "2460", None, "930", "2359"], fn.hhmm_time)
    assert times == ["09:30:00", "09:30:00", None, None, None, None, "23:59:00"]
    minutes = values(spark, ["H", "1", "1H", "12", "1X", "", None, "HH"], fn.allowance_minutes)
    assert minutes == [0.5, 1.0, 1.5, 12.0, None, None, None, None]


def test_missing_date_is_null_not_text(spark):
    got = values(spark, ["2024-01-10", None, "None"], fn.date_midnight)
    assert got == [dt.datetime(2024, 1, 10), None, None]


def test_strict_cast_fails_on_bad_input(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        values(spark, ["2024-99-99"], lambda c: fn.strict_cast(c, "date"))


def test_delay_bucket_edges(spark):
    df = spark.createDataFrame([(-1,), (0,), (1,), (5,), (6,), (10,), (11,), (None,)], "v int")
    got = [r[0] for r in df.select(fn.delay_bucket(F.col("v"))).collect()]
    assert got == [
        "on_time", "on_time", "slight_delay", "slight_delay", "delay", "delay", "major_delay", "major_delay"
    ]


def test_surrogate_key_tells_null_positions_apart(spark):
    df = spark.createDataFrame([("a", None), (None, "a"), ("a", "")], "x string, y string")
    keys = [r[0] for r in df.select(fn.surrogate_key("x", "y")).collect()]
    assert len(set(keys)) == 3
    assert keys[0] == [r[0] for r in spark.sql(f"select md5('a-{labels.KEY_NULL_TOKEN}')").collect()][0]


def test_slug_and_codes(spark):
    assert values(spark, ["GB Railfreight (Ltd.)"], fn.slug_code) == ["ZZ_gb_railfreight_ltd_"]
    assert values(spark, [" ab ", "  ", None], fn.code_normalise) == ["AB", None, None]
    assert values(spark, ["123456", "12345", None], fn.signalling_id) == ["3456", None, None]


def test_labels_keep_the_leading_blank_and_default(spark):
    assert values(spark, ["LO", "x"], lambda c: fn.code_label(c, labels.LOCATION_TYPE)) == [
        " Originating location - location where the train service starts from", None
    ]
    assert values(spark, ["B", None], lambda c: fn.code_label(c, labels.OPERATING_CHARACTERISTIC, "UNKNOWN")) == [
        "Vacuum Braked", "UNKNOWN"
    ]


def test_runs_on_agrees_for_date_and_column(spark):
    flags = ", ".join(f"(k >> {6 - i}) & 1 = 1 as {name}" for i, name in enumerate(labels.DAY_FLAGS))
    base = spark.sql(f"select id as k, date'2024-01-08' as a, date'2024-01-14' as z, {flags} from range(128)")
    for offset in range(-1, 8):
        day = dt.date(2024, 1, 8) + dt.timedelta(days=offset)
        one = {r.k for r in base.filter(fn.runs_on(day, "a", "z")).collect()}
        flags_ = [F.col(n) for n in labels.DAY_FLAGS]
        other = {r.k for r in base.filter(fn.runs_on_column(F.lit(day), F.col("a"), F.col("z"), flags_)).collect()}
        inside = 0 <= offset < 7
        expected = {k for k in range(128) if inside and (k >> (6 - day.weekday())) & 1}
        assert one == other == expected
