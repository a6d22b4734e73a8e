"""Streams on hand-made deliveries; each delivery is one micro-batch."""

import datetime as dt
import json
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from purseline.functions.messages import decode_events, split_rejects
from purseline.operators.dedup import dedup_events
from purseline.sources.topics import read_message_files, write_message_files
from purseline.streaming import job
from purseline.streaming.dedup import collapse_copies, dedup_stream
from purseline.streaming.sinks import (
    CountLog,
    batch_counts,
    batch_totals_writer,
    start_batches,
    start_table,
    state_partitions,
)
from purseline.streaming.totals import deduplicated_totals, windowed_totals

START = dt.datetime(2026, 1, 1)
EVENT = "event_id bigint, user_id bigint, transaction_amount double, timestamp timestamp"
TOTALS = "window_start timestamp, window_end timestamp, total_volume double, event_count bigint"


def message(event_id, time):
    fields = {"event_id": event_id, "user_id": 1, "transaction_amount": 1.5, "timestamp": time.isoformat()}
    return json.dumps(fields)


class Feed:
    """A folder of messages, and the usable events read from it as a stream."""

    def __init__(self, spark, root):
        self.spark, self.path = spark, str(root / "feed")
        self.output, self.checkpoint = str(root / "output"), str(root / "checkpoint")

    def deliver(self, events):
        values = [
            i if isinstance(i, str) else message(i, START + dt.timedelta(seconds=s)) for i, s in events
        ]
        write_message_files(self.spark.createDataFrame([(v,) for v in values], "value string").coalesce(1), self.path)

    def messages(self):
        return read_message_files(self.spark, self.path)

    def events(self):
        return split_rejects(decode_events(self.messages()))[0]

    def run(self, df):
        query = start_table(df, self.output, self.checkpoint)
        query.awaitTermination()
        return query

    def read(self, schema):
        return self.spark.read.schema(schema).parquet(self.output)


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(spark, tmp_path)


LATE = [[(1, 1), (2, 45)], [(3, 46)], [(4, 5), (5, 38), (2, 45)], [(6, 120)]]


@pytest.mark.parametrize("totals, last", [(windowed_totals, 3), (deduplicated_totals, 2)])
def test_late_events(feed, totals, last):
    """Event 4 is behind its closed window and dropped; 5 is late but its window is open."""
    late = 0
    for delivery in LATE:
        feed.deliver(delivery)
        late += sum(c["late"] for c in batch_counts(feed.run(totals(feed.events()))))
    got = {(r.window_start - START).seconds: r.event_count for r in feed.read(TOTALS).collect()}
    assert got == {0: 1, 30: 1, 40: last}
    assert late == 1


def test_repeats_across_batches_and_restarts(feed):
    first = [(i, i / 100) for i in [*range(500), *range(50)]]
    second = [(i, i / 100) for i in range(490, 1000)]
    repeats = 0
    for delivery in (first, second):
        feed.deliver(delivery)
        query = feed.run(dedup_stream(feed.events(), ["event_id"], "timestamp", "10 seconds"))
        repeats += sum(c["repeats"] for c in batch_counts(query))
    ids = [r.event_id for r in feed.read(EVENT).collect()]
    assert sorted(ids) == list(range(1000))
    assert repeats == 50 + 10


def test_restarted_ids_are_kept_with_a_wider_key(feed):
    feed.deliver([(0, 1), (1, 2), (0, 1)])
    feed.run(dedup_stream(feed.events(), ["event_id", "timestamp"], "timestamp"))
    feed.deliver([(0, 3), (1, 4)])
    feed.run(dedup_stream(feed.events(), ["event_id", "timestamp"], "timestamp"))
    assert feed.read(EVENT).count() == 4


def test_collapse_drops_equal_rows_only(spark):
    rows = [(1, 1, 1.0, START)] * 50 + [(1, 1, 2.0, START), (1, None, 1.0, START), (1, 1, 1.0, None)]
    df = spark.createDataFrame(rows, EVENT).coalesce(1)
    out = collapse_copies(df)
    assert out.schema == df.schema
    assert out.exceptAll(df.distinct()).count() == 0 and out.count() == 4


def test_collapse_leaves_nested_columns_alone(spark):
    df = spark.createDataFrame([(1, [1, 2]), (1, [1, 2])], "event_id bigint, tags array<int>").coalesce(1)
    assert collapse_copies(df).count() == 2


def test_replayed_batch_leaves_the_output_unchanged(feed, spark):
    write = batch_totals_writer(feed.output, width="10 seconds")

    def run():
        start_batches(feed.events(), write, feed.checkpoint).awaitTermination()

    feed.deliver([(i, i) for i in range(40)])
    run()
    feed.deliver([(i, i) for i in range(40, 60)])
    run()
    schema = f"{TOTALS}, processed_at timestamp, batch_id bigint"
    before = feed.read(schema).drop("processed_at").collect()
    assert {r.batch_id for r in before} >= {0, 1} and sum(r.event_count for r in before) == 60

    commits = sorted((p for p in Path(feed.checkpoint, "commits").iterdir() if p.name.isdigit()), key=lambda p: int(p.name))
    commits[-1].unlink()
    Path(commits[-1].parent, f".{commits[-1].name}.crc").unlink(missing_ok=True)
    run()
    assert sorted(feed.read(schema).drop("processed_at").collect()) == sorted(before)


def test_one_run_equals_stop_and_resume(spark, tmp_path):
    deliveries = [[(i, i) for i in range(0, 50)], [(i, i) for i in range(40, 90)], [(i, i) for i in range(85, 130)]]
    results = []
    for name, stop in (("resumed", True), ("once", False)):
        (tmp_path / name).mkdir()
        feed = Feed(spark, tmp_path / name)
        for delivery in deliveries:
            feed.deliver(delivery)
            if stop:
                feed.run(deduplicated_totals(feed.events()))
        if not stop:
            feed.run(deduplicated_totals(feed.events()))
        results.append(sorted(feed.read(TOTALS).collect()))
    assert results[0] == results[1] and len(results[0]) == 11


def test_job_writes_totals_and_rejects(feed, spark):
    feed.deliver([(1, 1), (1, 1), ("not json", 0), (2, 3), (3, 40), ('{"event_id":5}', 0)])
    for query in job.start(feed.messages(), feed.output, feed.checkpoint, every=None):
        query.awaitTermination()
    totals = spark.read.schema(TOTALS).parquet(f"{feed.output}/totals").collect()
    assert [(r.total_volume, r.event_count) for r in totals] == [(3.0, 2)]
    rejects = spark.read.parquet(f"{feed.output}/rejects").collect()
    assert sorted(r.value for r in rejects) == ["not json", '{"event_id":5}']


def test_console(feed):
    feed.deliver([(1, 1), (1, 1), (2, 3)])
    (query,) = job.start(feed.messages(), feed.output, feed.checkpoint, every=None, console=True)
    query.awaitTermination()
    assert query.exception() is None and batch_counts(query)[0]["raw_rows"] == 3


def test_state_width_is_fixed_by_the_first_start(feed, spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    feed.deliver([(1, 1)])
    with state_partitions(spark, 2):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "2"
    with state_partitions(spark, 64):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "64"
    with state_partitions(spark, 2):
        feed.run(windowed_totals(feed.events()))
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    feed.deliver([(2, 100)])
    query = feed.run(windowed_totals(feed.events()))
    assert {o["numShufflePartitions"] for p in query.recentProgress for o in p["stateOperators"]} == {2}


def test_trigger_interval(feed):
    feed.deliver([(1, 1), (2, 100)])
    query = start_table(windowed_totals(feed.events()), feed.output, feed.checkpoint, every="1 second")
    try:
        query.processAllAvailable()
        assert query.isActive
    finally:
        query.stop()
    assert [r.event_count for r in feed.read(TOTALS).collect()] == [1]


def test_batch_dedup_keeps_the_earliest_copy_whatever_the_partitioning(spark):
    rows = [(1, 1, 5.0, START + dt.timedelta(seconds=2)), (1, 1, 7.0, START), (1, 1, 6.0, START), (2, None, 1.0, None)]
    df = spark.createDataFrame(rows, EVENT)
    for partitions in (1, 3):
        out = dedup_events(df.repartition(partitions), ["event_id"], "timestamp").orderBy("event_id").collect()
        assert [tuple(r) for r in out] == [(1, 1, 6.0, START), (2, None, 1.0, None)]
        assert out[0].__fields__ == df.columns


def test_one_key_delivered_very_often(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") < 15_000, 0).otherwise(F.col("id")).alias("event_id"),
        F.lit(1).cast("bigint").alias("user_id"),
        F.lit(1.0).alias("transaction_amount"),
        F.lit(START).cast("timestamp").alias("timestamp"),
    )
    assert dedup_events(df, ["event_id"], "timestamp").count() == 15_001


def test_counts_of_every_batch_are_kept(feed, spark):
    """More micro-batches than Spark keeps reports of."""
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates", "100")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "1")
    log = CountLog(spark, f"{feed.output}-counts", "counted")
    spark.streams.addListener(log)
    try:
        for k in range(3):
            feed.deliver([(i, 10 * k) for i in (k, k, 10 + k)])
            once = dedup_stream(feed.events(), ["event_id"], "timestamp", "10 seconds")
            start_table(once, feed.output, feed.checkpoint, name="counted").awaitTermination()
        for _ in range(100):
            done = len(list(Path(f"{feed.output}-counts").glob("batch_id=*/_SUCCESS")))
            if done == 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(log)
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    rows = spark.read.parquet(f"{feed.output}-counts").orderBy("batch_id").collect()
    assert [(r.raw_rows, r.repeats, r.late) for r in rows] == [(3, 1, 0)] * 3
