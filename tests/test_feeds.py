"""Frames, routing, dead letters and typed events on golden messages."""

import datetime as dt
import json

from pyspark.sql import functions as F

from railmill.functions.labels import DEAD_LETTER_TOPIC
from railmill.schemas import MESSAGE_TYPES, TYPED_EVENTS
from railmill.sources import feeds, files

TS = dt.datetime(2024, 1, 1, 6, 0)


def frames(spark, *bodies):
    return spark.createDataFrame([(b, TS) for b in bodies], "value string, ingest_ts timestamp")


def message(msg_type, **body):
    return {"header": {"msg_type": msg_type, "user_id": "u"}, "body": body}


def test_split_frames(spark):
    one, two = message("0003", train_id="1"), message("0001", train_id="2")
    got = feeds.split_frames(frames(spark, "", " \n", None, json.dumps(one), "\n" + json.dumps([one, two]), "{bad", "[]"))
    assert sorted(r.value for r in got.collect()) == sorted(
        [json.dumps(one), *[json.dumps(x, separators=(",", ":")) for x in (one, two)], "{bad"]
    )


def test_routing_and_dead_letters(spark):
    bodies = [json.dumps(message(code, train_id=code)) for code in MESSAGE_TYPES]
    bodies += [json.dumps(message("0004")), json.dumps({"body": {}}), '{"header":', '"text"']
    routed = feeds.route_messages(feeds.parse_messages(feeds.split_frames(frames(spark, *bodies)))).collect()
    good = [r for r in routed if r.topic != DEAD_LETTER_TOPIC]
    assert {json.loads(r.value)["train_id"] for r in good} == set(MESSAGE_TYPES)
    letters = [json.loads(r.value) for r in routed if r.topic == DEAD_LETTER_TOPIC]
    assert sorted(x["reason"] for x in letters) == [
        "JSONDecodeError", "JSONDecodeError", "unknown msg_type=0004", "unknown msg_type=None"
    ]
    assert {"header": {"msg_type": "0004", "user_id": "u"}, "body": {}} in [x["raw"] for x in letters]
    assert '{"header":' in [x["raw"] for x in letters]


def test_every_type_has_all_its_fields(spark):
    for code, event in MESSAGE_TYPES.items():
        one = frames(spark, json.dumps(message(code)))
        typed = feeds.typed_events(feeds.parse_messages(one), event)
        names = list(TYPED_EVENTS[event])
        assert typed.columns == ["msg_type", *names, "ingest_ts"]
        assert typed.count() == 1


def test_movement_values(spark):
    body = {
        "train_id": "221A45MF12", "toc_id": "07", "loc_stanox": "00123", "actual_timestamp": "1704067200123",
        "planned_timestamp": "", "correction_ind": "TRUE", "offroute_ind": None, "timetable_variation": " 12 ",
    }
    typed = feeds.typed_events(feeds.parse_messages(frames(spark, json.dumps(message("0003", **body)))), "movement")
    row = typed.first()
    assert (row.toc_id, row.loc_stanox, row.timetable_variation) == (7, 123, 12)
    assert row.actual_timestamp == dt.datetime(2024, 1, 1, 0, 0, 0, 123000) and row.planned_timestamp is None
    assert row.correction_ind is True and row.offroute_ind is False
    assert row.ingest_ts == TS


def test_berth_frames(spark):
    body = json.dumps([{"CA_MSG": {"area_id": "SK", "time": "1704067200000", "from": "1", "to": "2", "descr": "1A23", "msg_type": "CA"}}, {"SF_MSG": {"area_id": "X"}}])
    steps = feeds.typed_berth_steps(feeds.split_berth_frames(frames(spark, body)))
    assert [tuple(r)[:6] for r in steps.collect()] == [("CA", "SK", dt.datetime(2024, 1, 1), "1", "2", "1A23")]


def test_tagged_records(spark):
    lines = ['{"A":{"x":1,"y":{"z":[1,2]}},"B":{}}', "", "  ", "{bad", '{"C":5}', "[1]", "{}", '{"D":null}']
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = files.tagged_records(df, TS).orderBy("record_type").collect()
    assert [(r.record_type, r.payload) for r in got] == [("A", '{"x":1,"y":{"z":[1,2]}}'), ("C", None), ("D", None)]
    assert {r.ingest_ts for r in got} == {TS}


def test_multi_line_extract(spark, tmp_path):
    path = tmp_path / "corpus.json"
    path.write_text(json.dumps({"TIPLOCDATA": [{"NLC": 1, "3ALPHA": "ABC"}, {"NLC": 2}]}, indent=2))
    got = files.read_reference_extract(spark, str(path), "TIPLOCDATA", {"NLC": "nlc", "3ALPHA": "three_alpha"})
    assert [tuple(r) for r in got.collect()] == [("1", "ABC"), ("2", None)]


def test_gzip_dump_is_spread(spark, tmp_path):
    path = str(tmp_path / "dump")
    spark.range(50).select(F.concat(F.lit('{"T":{"id":'), "id", F.lit("}}")).alias("value")).coalesce(1).write.option(
        "compression", "gzip"
    ).text(path)
    df = files.read_tagged_dump(spark, path, TS, partitions=4)
    assert df.rdd.getNumPartitions() == 4 and df.count() == 50


def test_several_types_are_typed_in_one_pass(spark):
    sent = [json.dumps(message(code, train_id=f"t{code}", loc_stanox="7")) for code in ("0002", "0003", "0003", "0001", "9")]
    parsed = feeds.parse_messages(frames(spark, *sent))
    rows = {e: F.struct(F.lit(e).alias("event"), *[feeds.typed_fields(e)[c].alias(c) for c in ("train_id", "loc_stanox")]) for e in ("movement", "cancellation")}
    typed = feeds.typed_together(parsed, rows)
    want = [(e, *r) for e in rows for r in feeds.typed_events(parsed, e).select("train_id", "loc_stanox").collect()]
    assert sorted(map(tuple, typed.collect())) == sorted(want) and len(want) == 3
    plan = typed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") == parsed._jdf.queryExecution().optimizedPlan().toString().count("from_json")
