import datetime as dt

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from purseline.functions.messages import decode_events, encode_events, split_rejects
from purseline.operators.totals import merge_totals, tumbling_totals
from purseline.sources.topics import read_topic, topic_options

BAD = [
    '{"event_id":1,"user_id":2,"transaction_amount":3.5,"timestamp":"x"}',
    "not json",
    '{"event_id":"a"}',
    '{"event_id":9,"transaction_amount":5}',
    None,
    "{}",
]


def messages(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string").select(F.col("value").cast("binary").alias("value"))


def test_bad_messages_are_rejected_one_by_one(spark):
    good = '{"event_id":3000000000,"user_id":2,"transaction_amount":1.25,"timestamp":"2026-01-01T00:00:07"}'
    usable, rejects = split_rejects(decode_events(messages(spark, [*BAD, good])))
    assert [tuple(r) for r in usable.collect()] == [(3000000000, 2, 1.25, dt.datetime(2026, 1, 1, 0, 0, 7))]
    assert sorted(str(r.value) for r in rejects.collect()) == sorted(str(v) for v in BAD)


def test_times_with_and_without_fraction(spark):
    texts = ["2026-01-01T00:00:07", "2026-01-01T00:00:07.123456"]
    values = [f'{{"event_id":{i},"timestamp":"{t}"}}' for i, t in enumerate(texts)]
    got = decode_events(messages(spark, values)).orderBy("event_id").collect()
    assert [r.timestamp for r in got] == [dt.datetime(2026, 1, 1, 0, 0, 7), dt.datetime(2026, 1, 1, 0, 0, 7, 123456)]


def test_encoding_loses_nothing(spark):
    rows = [(1, None, 0.1, dt.datetime(2026, 1, 1, 0, 0, 0, 1)), (2, 7, None, dt.datetime(2026, 1, 1))]
    df = spark.createDataFrame(rows, "event_id bigint, user_id bigint, transaction_amount double, timestamp timestamp")
    back = decode_events(encode_events(df, df.columns, key="event_id")).drop("value")
    assert sorted(map(tuple, back.collect())) == rows


def test_window_is_half_open(spark):
    times = [dt.datetime(2026, 1, 1, 0, 0, 9, 999999), dt.datetime(2026, 1, 1, 0, 0, 10), None]
    df = spark.createDataFrame([(i, 1.0, t) for i, t in enumerate(times)], "event_id bigint, transaction_amount double, timestamp timestamp")
    got = {r.window_start.second: (r.window_end.second, r.event_count) for r in tumbling_totals(df).collect()}
    assert got == {0: (10, 1), 10: (20, 1)}


def test_partials_merge_to_totals(spark):
    start = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame([(i, i / 4, start + dt.timedelta(seconds=i)) for i in range(40)], "event_id bigint, transaction_amount double, timestamp timestamp")
    parts = tumbling_totals(df.where("event_id < 17")).unionByName(tumbling_totals(df.where("event_id >= 17")))
    assert merge_totals(parts).exceptAll(tumbling_totals(df)).count() == 0


def test_topic_options():
    assert topic_options("host:9092", "t", max_per_trigger=5) == {
        "kafka.bootstrap.servers": "host:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "5",
    }


def test_queries_that_start_at_one_time_start_at_one_place():
    options = topic_options("host:9092", "t", now_ms=1_700_000_000_000)
    assert options["startingTimestamp"] == "1700000000000" and "startingOffsets" not in options
    assert options["startingOffsetsByTimestampStrategy"] == "latest"
    assert topic_options("host:9092", "t", "earliest", now_ms=5)["startingOffsets"] == "earliest"


def test_topic_needs_the_connector(spark):
    if any("kafka" in jar for jar in spark.conf.get("spark.jars.packages", "").split(",")):
        pytest.skip("connector present")
    with pytest.raises(AnalysisException, match="kafka"):
        read_topic(spark, topic_options("host:9092", "t"))
