"""Ordered features: plain windows, sliced heavy users, ties."""

import datetime as dt
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from purseline.operators.heavy import heavy_keys
from purseline.operators.sequence import with_sequence_features
from purseline.schema import Transactions

SCHEMA = "user_id string, amount double, timestamp timestamp_ntz, category string, id bigint"
COLS = Transactions(tiebreak=("id",), scale=2)
START = dt.datetime(2026, 1, 1)


def rows_of(users, amounts, seconds):
    return [
        (u, a, START + dt.timedelta(seconds=s), "x", i)
        for i, (u, a, s) in enumerate(zip(users, amounts, seconds, strict=True))
    ]


def expected(rows):
    """Brute force: id -> (previous, delta, rank, running total) in cents."""
    histories = defaultdict(list)
    for row in rows:
        histories[row[0]].append(row)
    out = {}
    for history in histories.values():
        previous, total = None, 0
        for rank, row in enumerate(sorted(history, key=lambda r: (r[2], r[4])), 1):
            cents = round(row[1] * 100)
            total += cents
            out[row[4]] = (previous, cents - (previous or 0), rank, total)
            previous = cents
    return out


def computed(df):
    def cents(x):
        return None if x is None else round(x * 100)

    return {
        r.id: (cents(r.prev_amount), cents(r.amount_delta), r.txn_rank, cents(r.running_total)) for r in df.collect()
    }


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(
        st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(1, 9999), st.integers(0, 20)), min_size=1, max_size=60
    ),
    heavy_rows=st.sampled_from([3, 10, 1000]),
    partitions=st.sampled_from([1, 5]),
)
def test_matches_brute_force(spark, data, heavy_rows, partitions):
    rows = rows_of([d[0] for d in data], [d[1] / 100 for d in data], [d[2] for d in data])
    df = spark.createDataFrame(rows, SCHEMA).repartition(partitions)
    assert computed(with_sequence_features(df, COLS, heavy_rows, slices=4)) == expected(rows)


def test_one_user_with_most_rows(spark):
    n = 3000
    users = ["whale" if i % 3 else f"u{i % 50}" for i in range(n)]
    rows = rows_of(users, [(i * 37 % 1000 + 1) / 100 for i in range(n)], [i * 7919 % 500 for i in range(n)])
    df = spark.createDataFrame(rows, SCHEMA).repartition(6)
    assert [key for key, _ in heavy_keys(df, "user_id", 500)] == ["whale"]
    assert computed(with_sequence_features(df, COLS, heavy_rows=500, slices=7)) == expected(rows)


def test_null_user_can_be_heavy(spark):
    df = spark.createDataFrame(rows_of([None] * 80 + ["a"] * 5, [1.0] * 85, range(85)), SCHEMA)
    assert [key for key, _ in heavy_keys(df, "user_id", 50)] == [None]


@pytest.mark.parametrize("heavy_rows", [1000, 10])
def test_copies_without_tiebreak(spark, heavy_rows):
    """Rows equal in user, time and amount: only the multiset of results is defined, and it is stable."""
    rows = rows_of(["a"] * 40 + ["b"] * 5, [2.5] * 45, [0] * 45)
    df = spark.createDataFrame(rows, SCHEMA)
    results = []
    for partitions in (1, 7):
        out = with_sequence_features(df.repartition(partitions), Transactions(scale=2), heavy_rows, slices=3)
        picked = out.select("user_id", "prev_amount", "amount_delta", "txn_rank", "running_total").collect()
        results.append(sorted(map(tuple, picked), key=repr))
    assert results[0] == results[1]
    assert [r[3] for r in sorted(results[0], key=lambda r: (r[0], r[3])) if r[0] == "a"] == list(range(1, 41))
    assert max(r[4] for r in results[0] if r[0] == "a") == 100.0


def test_null_amounts_in_unfiltered_rows(spark):
    rows = rows_of(["a"] * 6, [None, 1.0, None, 2.0, None, 3.0], range(6))
    df = spark.createDataFrame(rows, SCHEMA)
    plain = with_sequence_features(df, COLS)
    sliced = with_sequence_features(df, COLS, heavy_rows=2, slices=4)
    for out in (plain, sliced):
        got = out.orderBy("id").select("prev_amount", "amount_delta", "txn_rank", "running_total").collect()
        assert [r.prev_amount for r in got] == [None, None, 1.0, None, 2.0, None]
        assert [r.amount_delta for r in got] == [None, 1.0, None, 2.0, None, 3.0]
        assert [r.running_total for r in got] == [None, 1.0, 1.0, 3.0, 3.0, 6.0]


def test_first_transaction(spark):
    row = with_sequence_features(spark.createDataFrame(rows_of(["a"], [7.25], [0]), SCHEMA), COLS).first()
    assert (row.prev_amount, row.amount_delta, row.txn_rank, row.running_total) == (None, 7.25, 1, 7.25)


def test_text_times_order_as_times(spark):
    df = spark.createDataFrame(
        [("a", 1.0, "2026-01-01T00:00:10", "x", 1), ("a", 2.0, "2026-01-01 00:00:09.5", "x", 2)],
        "user_id string, amount double, timestamp string, category string, id bigint",
    )
    out = with_sequence_features(df, COLS).orderBy("txn_rank").select(F.col("id")).collect()
    assert [r.id for r in out] == [2, 1]


@pytest.mark.parametrize("heavy_rows", [1000, 2])
@pytest.mark.parametrize("scale", [2, None])
def test_nan_and_infinity_are_as_doubles_have_them(spark, heavy_rows, scale):
    amounts = [1.0, float("inf"), 2.0, float("nan"), 3.0, None, 4.0]
    df = spark.createDataFrame(rows_of(["a"] * 7 + ["b"], [*amounts, 5.0], range(8)), SCHEMA)
    cols = Transactions(tiebreak=("id",), scale=scale)
    out = with_sequence_features(df, cols, heavy_rows, slices=3).orderBy("id")
    got = out.select("prev_amount", "amount_delta", "running_total").collect()
    inf, nan = float("inf"), float("nan")
    expected = [
        (None, 1.0, 1.0), (1.0, inf, inf), (inf, -inf, inf), (2.0, nan, nan), (nan, nan, nan), (3.0, None, nan), (None, 4.0, nan), (None, 5.0, 5.0),
    ]
    assert [tuple(map(str, r)) for r in got] == [tuple(map(str, r)) for r in expected]
