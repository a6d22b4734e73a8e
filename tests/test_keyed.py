"""Streams with state of their own: online features, matches, sessions, sliding windows."""

import datetime as dt
import random
from collections import defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from purseline.operators.sessions import sessions
from purseline.operators.sliding import sliding_totals
from purseline.plans.user_features import user_statistics
from purseline.schema import Events, Transactions
from purseline.streaming.features import UPDATES, Tenure, current_features, feature_updates, merged, summaries
from purseline.streaming.matching import match_earlier
from purseline.streaming.sessions import MERGE_EARLY, session_totals
from purseline.streaming.sinks import start_batches, start_table, state_partitions
from purseline.streaming.sliding import sliding_window_totals

START = dt.datetime(2026, 1, 1)
FEED = "event_id bigint, user_id string, transaction_amount double, timestamp timestamp, event_type string"
COLS = Transactions("user_id", "transaction_amount", "timestamp", "event_type", ("event_id",), scale=2)
LABELS = ("view", "click")


def event(i, user, seconds, amount=1.5, kind="view"):
    return (i, user, amount, None if seconds is None else START + dt.timedelta(seconds=seconds), kind)


class Feed:
    """A folder of events; every delivery is a micro-batch, and every run but the first a restart."""

    def __init__(self, spark, root):
        self.spark, self.path = spark, str(root / "feed")
        self.output, self.checkpoint = str(root / "output"), str(root / "checkpoint")
        self.query = None

    def deliver(self, rows, start, files=2):
        self.spark.createDataFrame(rows, FEED).repartition(files).write.mode("append").parquet(self.path)
        with state_partitions(self.spark, 3):
            self.query = start(self.spark.readStream.schema(FEED).parquet(self.path))
            self.query.awaitTermination()

    def to_table(self, transform):
        return lambda rows: start_table(transform(rows), self.output, self.checkpoint)

    def to_updates(self, **options):
        def write(batch, batch_id):
            batch.write.mode("overwrite").parquet(f"{self.output}/batch_id={batch_id}")

        return lambda rows: start_batches(
            feature_updates(rows, COLS, LABELS, **options), write, self.checkpoint, mode="update"
        )

    def updates(self):
        return self.spark.read.schema(f"{UPDATES}, batch_id bigint").parquet(self.output)

    def features(self):
        return current_features(self.updates(), COLS, LABELS)


# Online features.


def test_features_of_one_tenure_are_those_of_the_table(spark, tmp_path):
    draw = random.Random(2)
    rows = [
        event(i, draw.choice(["hot", "hot", "a", "b", None]), draw.randint(0, 5_000), draw.randint(1, 9_999) / 100, draw.choice(["view", "click", "other", None]))
        for i in range(300)
    ]
    feed = Feed(spark, tmp_path)
    draw.shuffle(rows)  # within the delay, any order of arrival gives the same
    for k in range(3):
        feed.deliver(rows[k::3], feed.to_updates(expiry="30 days", delay="2 hours"))
    found = {r.user: r for r in feed.features().collect()}
    whole = user_statistics(spark.createDataFrame(rows, FEED), COLS, LABELS).drop("avg_category_index").collect()
    assert len(found) == len(whole) == 4
    for row in whole:
        for name, value in row.asDict().items():
            if name != "user_id":
                assert found[row.user_id][name] == pytest.approx(value), name


def test_tenures_expire_and_leave_the_state(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    run = feed.to_updates(expiry="100 seconds", delay="10 seconds")
    feed.deliver([event(i, f"u{i}", i) for i in range(40)], run)
    held = feed.query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert held == 40
    feed.deliver([event(100, "u1", 101), event(101, "late", 5_000)], run)  # u1 comes back in time
    state = feed.query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"]
    assert state == 1  # all but the last user
    feed.deliver([event(200, "u2", 5_100)], run)
    found = feed.features().collect()
    by_user = defaultdict(list)
    for r in found:
        by_user[r.user].append((r.tenure_start - START, r.transaction_count, r.closed))
    assert by_user["u1"] == [(dt.timedelta(seconds=1), 2, True)]
    assert sorted(by_user["u2"]) == [(dt.timedelta(seconds=2), 1, True), (dt.timedelta(seconds=5_100), 1, False)]
    assert by_user["late"] == [(dt.timedelta(seconds=5_000), 1, False)]


def test_a_late_event_joins_tenures_and_takes_rows_back(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    run = feed.to_updates(expiry="60 seconds", delay="1 hour")
    feed.deliver([event(1, "a", 100), event(2, "a", 200)], run)
    assert feed.features().count() == 2
    feed.deliver([event(3, "a", 150)], run)
    feed.deliver([event(4, "a", 60)], run)
    rows = feed.features().collect()
    assert [(r.tenure_start - START, r.last_seen - START, r.transaction_count, r.closed) for r in rows] == [
        (dt.timedelta(seconds=60), dt.timedelta(seconds=200), 4, False)
    ]
    assert feed.updates().where("_rows = 0").count() == 2  # the tenures from 200 and from 100 on


def test_gap_of_just_the_expiry_is_one_tenure(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.deliver([event(1, "a", 0), event(2, "a", 60), event(3, "a", 121)], feed.to_updates(expiry="60 seconds", delay="1 second"))
    assert sorted(r.transaction_count for r in feed.features().collect()) == [1, 2]


def test_unusable_events_are_left_out(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    odd = [event(1, "a", 0, x) for x in (None, 0.0, -1.0, float("nan"), float("inf"))] + [event(2, "a", None), event(3, "a", 5, 2.0)]
    feed.deliver(odd, feed.to_updates())
    assert [r.total_spent for r in feed.features().collect()] == [2.0]


def batch_of(rows):
    frame = pd.DataFrame(rows, columns=["user", "micros", "tie", "amount", "units"])
    return frame.assign(log=0.0, hour=1, day=2, weekend=0, month=4, labels=[np.array([1, 0])] * len(frame))


def test_a_batch_reaches_the_state_as_a_row_per_tenure():
    rows = [("hot", i, i, 1.0, 100) for i in range(5_000)] + [("hot", 10_000_000, 1, 2.0, 200), (None, 5, 1, 1.0, 100), (None, 6, 2, 3.0, 300)]
    random.Random(1).shuffle(rows)
    out = summaries(batch_of(rows), 1_000)
    found = {(x["user"], x["first"]): (x["rows"], x["units"], x["last_units"], list(x["labels"])) for _, x in out.iterrows()}
    assert found == {
        ("hot", 0): (5_000, 500_000, 100, [5_000, 0]),
        ("hot", 10_000_000): (1, 200, 200, [1, 0]),
        (None, 5): (2, 400, 300, [2, 0]),
    }


def test_merging_does_not_depend_on_order():
    draw = random.Random(9)
    rows = [("a", draw.randint(0, 3_000), i, draw.randint(1, 99) / 10, 10 * i) for i in range(60)]
    whole = summaries(batch_of(rows), 40)
    for seed in range(5):
        random.Random(seed).shuffle(rows)
        parts = [summaries(batch_of(rows[a : a + 7]), 40) for a in range(0, 60, 7)]
        tenures = [Tenure(**{k: v for k, v in x.items() if k != "user"}) for p in parts for x in p.to_dict("records")]
        out = merged(tenures, 40)
        assert [x.first for x in out] == whole["first"].tolist()
        assert [(x.last, x.last_units, x.rows, x.units) for x in out] == list(
            whole[["last", "last_units", "rows", "units"]].itertuples(index=False, name=None)
        )
        assert np.allclose([x.apart for x in out], whole["apart"])


# Matches.

MATCH = "later_id bigint, user_id string, later timestamp, earlier_id bigint, earlier timestamp"


def sides(rows):
    later = rows.where("event_type = 'later'").select(F.col("event_id").alias("later_id"), "user_id", F.col("timestamp").alias("later"))
    earlier = rows.where("event_type = 'earlier'").select(F.col("event_id").alias("earlier_id"), "user_id", F.col("timestamp").alias("earlier"))
    return later, earlier


@pytest.mark.parametrize("how", ["inner", "leftOuter"])
@pytest.mark.parametrize("hot", [(), ("hot",)])
def test_matches(spark, tmp_path, how, hot):
    draw = random.Random(4)
    rows = [event(i, draw.choice(["hot", "hot", "a", None]), draw.randint(0, 900), kind=draw.choice(["later", "earlier"])) for i in range(150)]
    rows += [event(500, "edge", 100, kind="earlier"), event(501, "edge", 160, kind="later"), event(502, "edge", 161, kind="later")]
    ends = [event(900, "end", 10_000, kind="later"), event(901, "end2", 10_000, kind="earlier")]
    feed = Feed(spark, tmp_path)

    def matched(df):
        return match_earlier(*sides(df), "user_id", "later", "earlier", "60 seconds", how, "1 hour", hot, 5)

    for k in range(3):
        feed.deliver(rows[k::3], feed.to_table(matched))
    feed.deliver(ends, feed.to_table(matched))
    times = {r[0]: r[3] for r in rows}
    expected = []
    for i, user, _, time, kind in rows:
        if kind == "later":
            fits = [j for j, u, _, t, k in rows if k == "earlier" and u == user and user and dt.timedelta(0) <= time - t <= dt.timedelta(seconds=60)]
            expected += [(i, j, times[j]) for j in fits] or ([(i, None, None)] if how == "leftOuter" else [])
    out = spark.read.schema(MATCH).parquet(feed.output).select("later_id", "earlier_id", "earlier").collect()
    assert sorted(map(tuple, out), key=repr) == sorted(expected, key=repr)
    # The watermark has passed all but the last delivery, so only that is kept.
    assert sum(o["numRowsTotal"] for o in feed.query.recentProgress[-1]["stateOperators"]) <= 2 * max(1, 5 * len(hot))


# Sessions and sliding windows: the stream against the static table.


@pytest.mark.parametrize("early", ["true", "false"])
def test_sessions_are_those_of_the_table(spark, tmp_path, early):
    draw = random.Random(5)
    rows = [event(i, draw.choice(["hot", "hot", "a", None]), draw.randint(0, 6_000), i / 4) for i in range(240)]
    rows += [event(500, "edge", 0), event(501, "edge", 60), event(502, "edge", 121)]
    draw.shuffle(rows)
    feed = Feed(spark, tmp_path)
    spark.conf.set(MERGE_EARLY, early)
    try:
        run = feed.to_table(lambda df: session_totals(df, Events(), "60 seconds", "3 hours", scale=2))
        for k in range(3):
            feed.deliver(rows[k::3], run)
        feed.deliver([event(900, "end", 10**6)], run)
    finally:
        spark.conf.unset(MERGE_EARLY)
    static = sessions(spark.createDataFrame(rows, FEED), "60 seconds", Events(), 2, heavy_rows=50, slices=4)
    out = spark.read.schema(static.schema).parquet(feed.output)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, static.collect()))
    assert feed.query.recentProgress[-1]["stateOperators"][0]["numRowsTotal"] == 1


def test_sliding_windows_are_those_of_the_table(spark, tmp_path):
    draw = random.Random(6)
    rows = [event(i, "a", draw.randint(0, 3_000), i / 4) for i in range(150)]
    feed = Feed(spark, tmp_path)
    run = feed.to_table(lambda df: sliding_window_totals(df, Events(), "90 seconds", "1 minute", "2 hours", scale=2))
    for k in range(3):
        feed.deliver(rows[k::3], run)
    feed.deliver([event(900, "end", 10**6)], run)
    static = sliding_totals(spark.createDataFrame(rows, FEED), Events(), "90 seconds", "1 minute", 2)
    out = spark.read.schema(static.schema).parquet(feed.output)
    assert sorted(map(repr, out.collect())) == sorted(map(repr, static.collect()))
