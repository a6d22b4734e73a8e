"""Grouped statistics: the merged form equals the window form it stands for."""

import datetime as dt
import math
import random
import struct

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from purseline.functions.numeric import double_order
from purseline.operators.filters import amount_above
from purseline.operators.labels import fit_label_index
from purseline.operators.normalise import population_stats, with_zscores
from purseline.operators.profile import user_amount_stats, user_sequence_stats, user_temporal_stats
from purseline.operators.sequence import with_sequence_features
from purseline.plans.user_features import user_features
from purseline.registry.bindings import EVENT_LABELS, EVENTS, ORDERS, events, orders
from purseline.schema import Transactions

SCHEMA = "user_id string, amount double, timestamp timestamp_ntz, category string"
START = dt.datetime(2026, 1, 1)

# The feature names and their order are fixed.
FEATURES = """total_spent avg_transaction transaction_count max_transaction min_transaction stddev_transaction
avg_log_amount avg_hour avg_day_of_week weekend_ratio active_months electronics_count groceries_count clothing_count
entertainment_count avg_category_index avg_amount_delta total_transactions_ranked final_running_total
total_spent_zscore avg_transaction_zscore txn_count_zscore""".split()


def transactions(spark, rows):
    return spark.createDataFrame([(u, a, START + dt.timedelta(seconds=s), c) for u, a, s, c in rows], SCHEMA)


@pytest.mark.parametrize("binding, source", [(ORDERS, orders), (EVENTS, events)])
@pytest.mark.parametrize("exact", [True, False])
def test_sequence_stats_equal_window_form(spark, sf_dir, binding, source, exact):
    cols = binding if exact else Transactions(*(getattr(binding, n) for n in ("user", "amount", "time", "category")))
    rows = amount_above(source(spark, sf_dir), cols.amount)
    merged = user_sequence_stats(rows, cols)
    history = with_sequence_features(rows, cols).groupBy(cols.user).agg(
        F.avg("amount_delta").alias("d"), F.max("txn_rank").alias("r"), F.max_by("running_total", "txn_rank").alias("t")
    )
    both = merged.join(history, cols.user)
    assert both.count() == merged.count() == rows.select(cols.user).distinct().count()
    far = (F.abs(F.col("avg_amount_delta") - F.col("d")) > 1e-6) | (F.abs(F.col("final_running_total") - F.col("t")) > 1e-6)
    assert both.where(far | (F.col("total_transactions_ranked") != F.col("r"))).count() == 0


@pytest.mark.parametrize(
    "amounts",
    [
        [1.0, math.nan, 2.0],
        [1.0, 2.0, math.nan],
        [1.0, math.inf],
        [math.inf, 1.0],
        [math.inf, math.inf],
        [math.inf, math.nan],
        [5.0],
    ],
)
def test_mean_delta_of_odd_amounts(spark, amounts):
    df = transactions(spark, [("u", a, i, "x") for i, a in enumerate(amounts)])
    window = Window.partitionBy("user_id").orderBy("timestamp")
    delta = F.col("amount") - F.coalesce(F.lag("amount").over(window), F.lit(0.0))
    want = df.select(delta.alias("d")).agg(F.avg("d").alias("m")).first().m
    got = user_sequence_stats(df).first().avg_amount_delta
    assert got == want or (math.isnan(got) and math.isnan(want))


def test_tied_times_take_the_tiebreak(spark):
    rows = [("u", 3.0, 0, "x", 5), ("u", 9.0, 0, "x", -7), ("u", 4.0, 0, "x", 2)]
    df = spark.createDataFrame([(u, a, START, c, i) for u, a, _, c, i in rows], SCHEMA + ", id bigint")
    for partitions in (1, 4):
        spread = df.repartition(partitions)
        assert user_sequence_stats(spread, Transactions(tiebreak=("id",))).first().avg_amount_delta == 1.0
        assert user_sequence_stats(spread, Transactions()).first().avg_amount_delta == 3.0


def test_order_of_wall_clock_times_in_a_zone_with_clock_changes(spark):
    """02:30 does not exist on that night and would be read as 03:30, after 03:10."""
    rows = [("u", 1.0, "2026-03-08 02:30:00", "x", 1), ("u", 2.0, "2026-03-08 03:10:00", "x", 2)]
    df = spark.createDataFrame(rows, SCHEMA.replace("timestamp_ntz", "string") + ", id bigint")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        wall = df.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))
        assert user_sequence_stats(wall, Transactions(tiebreak=("id",))).first().avg_amount_delta == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_unknown_time_orders_first(spark):
    df = spark.createDataFrame(
        [("u", 1.0, None, "x", 9), ("u", 2.0, dt.datetime(1900, 1, 1), "x", 1), ("v", 5.0, None, "x", 1), ("v", 6.0, None, "x", None)],
        SCHEMA + ", id bigint",
    )
    out = {r.user_id: r.avg_amount_delta for r in user_sequence_stats(df, Transactions(tiebreak=("id",))).collect()}
    assert out == {"u": 1.0, "v": 2.5}


def test_single_row_user(spark):
    row = user_amount_stats(transactions(spark, [("u", 4.0, 0, "x")])).first()
    assert row.stddev_transaction is None
    assert (row.total_spent, row.avg_transaction, row.transaction_count) == (4.0, 4.0, 1)


def test_months_of_different_years_count_once(spark):
    days = [dt.datetime(2025, 1, 1), dt.datetime(2026, 1, 5), dt.datetime(2026, 12, 31)]
    df = spark.createDataFrame([("u", 1.0, d, "x") for d in days] + [("v", 1.0, None, "x")], SCHEMA)
    out = {r.user_id: r for r in user_temporal_stats(df).collect()}
    assert out["u"].active_months == 2
    assert (out["v"].active_months, out["v"].avg_hour, out["v"].weekend_ratio) == (0, None, None)


def test_zero_spread_gives_null_zscores(spark):
    df = transactions(spark, [("a", 2.0, 0, "x"), ("b", 2.0, 1, "x")])
    for row in with_zscores(user_amount_stats(df)).collect():
        assert row.total_spent_zscore is None and row.txn_count_zscore is None
    assert population_stats(user_amount_stats(df)).first().sigma_total == 0.0


def test_feature_table_shape_and_order(spark):
    rows = [(str(u), float(u + i), u * 100 + i, ["Electronics", "Groceries", "Toys"][i]) for u in (10, 9, 2) for i in range(3)]
    out = user_features(transactions(spark, rows))
    assert out.columns == ["user_id", *FEATURES] and len(FEATURES) == 22
    got = out.collect()
    assert [r.user_id for r in got] == ["10", "2", "9"]
    assert all(r.electronics_count == 1 and r.clothing_count == 0 and r.avg_category_index == 1.0 for r in got)


def test_empty_input(spark):
    assert user_features(transactions(spark, []), sort_output=False).collect() == []


def test_invariants(spark, sf_dir):
    out = user_features(events(spark, sf_dir), EVENTS, EVENT_LABELS).toPandas()
    assert (out.final_running_total == out.total_spent).all()
    assert (out.total_transactions_ranked == out.transaction_count).all()
    listed = out[[f"{label}_count" for label in EVENT_LABELS]].sum(axis=1)
    assert (listed <= out.transaction_count).all()
    for name in ("total_spent_zscore", "avg_transaction_zscore", "txn_count_zscore"):
        assert abs(out[name].mean()) < 1e-9 and abs(out[name].std() - 1) < 1e-9


def test_a_saved_index_can_be_used_again(spark, sf_dir):
    rows = events(spark, sf_dir)
    index = fit_label_index(rows, "event_type")
    again = user_features(rows, EVENTS, EVENT_LABELS, index=index).select("user_id", "avg_category_index")
    assert again.exceptAll(user_features(rows, EVENTS, EVENT_LABELS).select(*again.columns)).count() == 0


@pytest.mark.parametrize("tiebreak", [(), ("txn_id",)])
def test_nan_and_infinity_with_and_without_scale(spark, tiebreak):
    nan, inf = float("nan"), float("inf")
    amounts = {"a": [1.0, 2.0], "b": [1.0, nan], "c": [inf, 2.0], "d": [inf, inf], "e": [nan], "f": [2.0, inf]}
    rows = [(u, x, f"2026-01-0{i + 1} 00:00:00", "x", i) for u, values in amounts.items() for i, x in enumerate(values)]
    df = spark.createDataFrame(rows, "user_id string, amount double, timestamp string, category string, txn_id long")
    out = []
    for scale in (None, 2):
        cols = Transactions(tiebreak=tiebreak, scale=scale)
        both = user_amount_stats(df, cols).join(user_sequence_stats(df, cols), "user_id").orderBy("user_id")
        out.append([[str(value) for value in row] for row in both.collect()])
    assert out[0] == out[1]


def test_doubles_order_by_their_bits(spark):
    """Powers of two and their neighbours, subnormals, both zeros, both infinities, NaN."""
    draw = random.Random(6)
    sizes = [0.0, 5e-324, 2.2250738585072014e-308, 1.7976931348623157e308, math.inf, 0.1, 100.0]
    for exponent in range(-1074, 1024, 13):
        power = math.ldexp(1.0, exponent)
        sizes += [power, math.nextafter(power, 0), math.nextafter(power, math.inf)]
    sizes += [math.ldexp(draw.random(), draw.randrange(-1070, 1020)) for _ in range(2_000)]
    values = sizes + [-x for x in sizes] + [math.nan]
    found = spark.createDataFrame([(x,) for x in values], "x double").select("x", double_order(F.col("x")).alias("n")).collect()
    for row in found:
        bits = struct.unpack("<q", struct.pack("<d", abs(row.x)))[0]
        want = 2047 * 2**52 + 1 if math.isnan(row.x) else -bits if row.x < 0 else bits
        assert row.n == want, row.x
    assert spark.createDataFrame([(None,)], "x double").select(double_order(F.col("x"))).first()[0] is None
