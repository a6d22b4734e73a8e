import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from purseline.operators.latency import latency_by_load, latency_summary, throughput
from purseline.operators.dedup import dedup_events, dedup_metrics
from purseline.operators.quality import table_diff, table_fingerprint


def fingerprint(df):
    return tuple(table_fingerprint(df, df.columns).first())


def test_fingerprint_ignores_order_and_sees_changes(spark):
    df = spark.range(500).select("id", F.concat(F.lit("v"), "id").alias("v"))
    whole = fingerprint(df)
    assert whole == fingerprint(df.repartition(7).orderBy(F.desc("id")))
    assert len(whole[0]) == 16 and whole[1] == 500
    assert whole != fingerprint(df.withColumn("v", F.when(F.col("id") == 3, "x").otherwise(F.col("v"))))
    assert whole != fingerprint(df.unionByName(df.where("id = 3")))


def test_fingerprint_tells_null_from_empty(spark):
    prints = {fingerprint(spark.createDataFrame([(v, "x")], "a string, b string")) for v in (None, "")}
    assert len(prints) == 2


def test_fingerprint_of_nothing(spark):
    assert fingerprint(spark.range(0))[1] == 0


def test_diff_counts_copies(spark):
    left = spark.createDataFrame([(1, "a"), (1, "a"), (2, None)], "k int, v string")
    right = spark.createDataFrame([(1, "a"), (2, None), (2, None), (3, "c")], "k int, v string")
    assert {r.side: r.differing_rows for r in table_diff(left, right).collect()} == {"left_only": 1, "right_only": 2}
    assert {r.differing_rows for r in table_diff(left, left.repartition(3)).collect()} == {0}


@pytest.mark.parametrize("slices", [None, 1, 9])
def test_percentiles_are_exact(spark, slices):
    rng = np.random.default_rng(1)
    values = {"low": rng.integers(0, 50, 400) / 4, "high": rng.exponential(30, 300).round(3), "one": np.array([7.0])}
    rows = [(level, float(v)) for level, vs in values.items() for v in vs] + [("low", None)]
    df = spark.createDataFrame(rows, "level string, latency_ms double")
    for row in latency_summary(df, "level", slices=slices).collect():
        expected = np.quantile(values[row.level], [0.5, 0.95, 0.99])
        assert np.allclose([row.p50, row.p95, row.p99], expected, rtol=0, atol=1e-9)
        assert row.n == len(values[row.level])
    assert statistics.median(values["one"]) == 7.0


def test_throughput_of_one_instant_is_null(spark):
    df = spark.createDataFrame([("a", 0), ("a", 4), ("b", 1)], "level string, s int")
    rates = throughput(df.withColumn("t", F.timestamp_seconds("s")), "level", "t").collect()
    assert {r.level: r.events_per_second for r in rates} == {"a": 0.5, "b": None}


def test_fingerprint_keeps_fields_apart(spark):
    rows = [("x,y", "z"), ("x", "y,z"), (None, "z"), ("\\N", "z"), ("-", "z"), ("1:x", "")]
    prints = {fingerprint(spark.createDataFrame([row], "a string, b string")) for row in rows}
    assert len(prints) == len(rows)


def test_null_keys_are_events_of_their_own(spark):
    df = spark.createDataFrame([(None, 1), (None, 1), (None, 2), (7, 1), (7, 2)], "k int, t int")
    assert dedup_events(df, ["k"], "t").count() == 4
    (counts,) = dedup_metrics(df, "k", F.lit(1)).collect()
    assert (counts.raw_rows, counts.distinct_rows, counts.dropped_rows) == (5, 4, 1)


def test_no_level_is_one_window(spark):
    """Latencies of one level lie in several slices, each of which is a window."""
    df = spark.range(2_000).select(F.lit("a").alias("level"), (F.col("id") / 7).alias("latency_ms"))
    text = latency_summary(df, "level", slices=6)._jdf.queryExecution().executedPlan().toString()
    windows = [line for line in text.split("\n") if " Window [" in line and "_running" in line]
    assert windows and all("_slice" in line for line in windows)


def test_dedup_reads_once_and_sorts_no_aggregate(spark, tmp_path):
    path = str(tmp_path / "events")
    spark.range(100).selectExpr("id % 7 as k", "id as t", "cast(id as string) as v").write.parquet(path)
    text = dedup_events(spark.read.parquet(path), ["k"], "t")._jdf.queryExecution().executedPlan().toString()
    assert text.count("FileScan") == 1 and "Aggregate" not in text and text.count("Exchange") == 1
    assert "Partial" in text  # one row per key and task before the exchange


def test_nested_columns_are_told_apart(spark):
    rows = [(["a, b"],), (["a", "b"],), (None,), ([],), ([None],)]
    prints = {fingerprint(spark.createDataFrame([row], "a array<string>")) for row in rows}
    assert len(prints) == len(rows)


def test_latency_by_load(spark):
    """3 events in one second, 1 in another, 5 in a third; one latency is unknown."""
    rows = [(0, 1.0), (0, 2.0), (0, None), (1, 7.0), *[(2, float(i)) for i in range(5)], (None, 9.0)]
    df = spark.createDataFrame(rows, "s int, latency_ms double").withColumn("t", F.timestamp_seconds("s"))
    out = latency_by_load(df, "t", bounds=(1, 3)).collect()
    assert {r.load: (r.n, r.p50) for r in out} == {1: (1, 7.0), 3: (2, 1.5), None: (5, 2.0)}
