"""Sessions, as-of joins and frames: hand-made rows, heavy users, ties, NULLs."""

import datetime as dt
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from purseline.operators import prefix
from purseline.operators.asof import asof_join
from purseline.operators.frames import with_recent_spend
from purseline.operators.prefix import with_ordered_state
from purseline.operators.sequence import with_sequence_features
from purseline.operators.sessions import sessions
from purseline.operators.slices import split_heavy
from purseline.schema import Events, Transactions

START = dt.datetime(2026, 1, 1)
EVENT = "event_id bigint, user_id string, transaction_amount double, timestamp timestamp_ntz"
COLS = Transactions(tiebreak=("id",), scale=2)
TXN = "user_id string, amount double, timestamp timestamp_ntz, category string, id bigint"


def at(seconds):
    return None if seconds is None else START + dt.timedelta(seconds=seconds)


def whale_rows(n, seed=3):
    draw = random.Random(seed)
    return [
        ("whale" if i % 3 == 0 else f"u{i % 20}", draw.randint(1, 99_999) / 100, at(draw.randint(0, 40 * 86_400)), "x", i)
        for i in range(n)
    ]


# Running totals of doubles.


@pytest.mark.parametrize("block", [4, 16, 1 << 16])
def test_doubles_add_up_alike_whichever_users_are_heavy(spark, monkeypatch, block):
    monkeypatch.setattr(prefix, "BLOCK", block)
    draw = random.Random(block)
    rows = [("whale" if i % 3 else f"u{i % 7}", draw.choice([1e15, 0.1, 1 / 3, 1e-9]) * draw.random(), i) for i in range(900)]
    df = spark.createDataFrame([*rows, ("whale", None, 901), (None, 0.1, 902)], "k string, v double, i bigint")

    def totals(heavy_rows, slices):
        out = with_ordered_state(df.repartition(5), "k", ("i",), "v", heavy_rows, slices, unique=True)
        return sorted((r.i, r._prev, r._rank, r._running) for r in out.collect())

    plain = totals(10_000, None)
    assert totals(100, 3) == plain and totals(100, 11) == plain and totals(2, 7) == plain


def test_totals_by_blocks_are_the_sums(spark, monkeypatch):
    monkeypatch.setattr(prefix, "BLOCK", 3)
    df = spark.createDataFrame([("a", float(i), i) for i in range(1, 41)] + [("b", None, 0), ("b", 2.0, 1)], "k string, v double, i bigint")
    out = with_ordered_state(df, "k", ("i",), "v", unique=True).collect()
    assert {r.i: r._running for r in out if r.k == "a"} == {i: i * (i + 1) / 2 for i in range(1, 41)}
    assert {r.i: r._running for r in out if r.k == "b"} == {0: None, 1: 2.0}


def test_heavy_rows_are_read_twice_at_most(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.createDataFrame(whale_rows(300), TXN).repartition(4).write.parquet(path)
    count = spark.sparkContext.accumulator(0)

    def seen(batches):
        for batch in batches:
            count.add(batch.num_rows)
            yield batch

    df = spark.read.parquet(path)
    passed = df.mapInArrow(seen, df.schema)
    with_sequence_features(passed, COLS, heavy_rows=50, slices=6).write.format("noop").mode("overwrite").save()
    assert count.value == 600


def test_split_keeps_all_rows(spark):
    df = spark.createDataFrame([(None, 1)] * 5 + [("a", 2)] * 4 + [("b", 3)], "k string, v int")
    light, heavy, rows, largest = split_heavy(df, "k", 3)
    assert (rows, largest) == (9, 5)
    assert sorted(map(tuple, light.collect())) == [("b", 3)]
    assert sorted(map(repr, heavy.collect())) == sorted(map(repr, df.where("k is null or k = 'a'").collect()))


# Sessions.


def plain_sessions(rows, gap):
    by_user = defaultdict(list)
    for _, user, amount, time in rows:
        if time is not None:
            by_user[user].append((time, amount))
    out = []
    for user, found in by_user.items():
        runs = []
        for time, amount in sorted(found):
            if runs and (time - runs[-1][-1][0]).total_seconds() <= gap:
                runs[-1].append((time, amount))
            else:
                runs.append([(time, amount)])
        for run in runs:
            end = run[-1][0] + dt.timedelta(seconds=gap)
            out.append((user, run[0][0], end, len(run), round(sum(round(a * 100) for _, a in run) / 100, 2)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("heavy_rows, slices", [(10_000, None), (40, 5), (1, 9)])
def test_sessions(spark, heavy_rows, slices):
    draw = random.Random(1)
    rows = [(i, "whale" if i % 2 else f"u{i % 9}", i / 100, at(draw.randint(0, 20_000))) for i in range(400)]
    rows += [(900, "edge", 1.0, at(0)), (901, "edge", 1.0, at(60)), (902, "edge", 1.0, at(121)), (903, None, 1.0, at(5))]
    rows += [(904, "whale", 1.0, None), rows[3], rows[3]]
    out = sessions(spark.createDataFrame(rows, EVENT).repartition(5), "60 seconds", Events(), 2, heavy_rows, slices)
    found = [tuple(r) for r in out.select("user_id", "session_start", "session_end", "event_count", "total_volume").collect()]
    assert sorted(found, key=repr) == plain_sessions(rows, 60)
    assert [f[3] for f in sorted(found, key=repr) if f[0] == "edge"] == [2, 1]  # the gap itself still belongs


def test_one_session_over_many_slices(spark):
    rows = [(i, "whale", 1.0, at(i)) for i in range(300)]
    out = sessions(spark.createDataFrame(rows, EVENT).repartition(7), "2 seconds", Events(), 2, 10, 8).collect()
    assert [(r.event_count, r.total_volume) for r in out] == [(300, 300.0)]


# As-of joins.


@pytest.mark.parametrize("heavy_rows, slices", [(10_000, None), (50, 6), (1, 5)])
def test_asof_join(spark, heavy_rows, slices):
    draw = random.Random(2)

    def some(n, first):
        return [(first + i, draw.choice(["whale", "whale", "a", "b", None]), draw.choice([None, *range(60)])) for i in range(n)]

    asked, given = some(150, 0), some(120, 1_000)
    asked += [asked[0], (500, "lone", 3)]
    left = spark.createDataFrame([(i, k, at(t)) for i, k, t in asked], "i bigint, k string, t timestamp_ntz")
    right = spark.createDataFrame([(i, k, at(t), i * 2) for i, k, t in given], "r bigint, k string, u timestamp_ntz, v bigint")
    left = left.withColumns({name: F.lit(1) for name in ("_row", "_key.x", "_match")})
    out = asof_join(left, right, "k", "t", "u", ("r", "v"), ("r",), "20 seconds", heavy_rows, slices)
    expected = []
    for i, k, t in asked:
        fits = [(u, r) for r, key, u in given if None not in (k, t, u) and key == k and u <= t]
        u, r = max(fits, default=(None, None))
        hit = r is not None and t - u <= 20
        expected.append((i, k, at(t), r if hit else None, 2 * r if hit else None))
    assert sorted(map(tuple, out.select("i", "k", "t", "r", "v").collect()), key=repr) == sorted(expected, key=repr)


def test_asof_join_has_no_join_of_rows(spark):
    left = spark.createDataFrame([(1, "a", at(1))], "i bigint, k string, t timestamp_ntz")
    right = spark.createDataFrame([(2, "a", at(0))], "r bigint, k string, u timestamp_ntz")
    plan = asof_join(left, right, "k", "t", "u", ("r",))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 1
    with pytest.raises(ValueError, match="left table already"):
        asof_join(left, right, "k", "t", "u", ("k",))


def test_asof_join_of_empty_tables(spark):
    left = spark.createDataFrame([(1, "a", at(1))], "i bigint, k string, t timestamp_ntz")
    right = spark.createDataFrame([], "r bigint, k string, u timestamp_ntz")
    assert [r.r for r in asof_join(left, right, "k", "t", "u", ("r",)).collect()] == [None]
    assert asof_join(left.limit(0), right, "k", "t", "u", ("r",)).count() == 0


# Frames.


@pytest.mark.parametrize("heavy_rows, slices", [(10_000, None), (60, 5), (1, 4)])
def test_recent_spend(spark, heavy_rows, slices):
    rows = whale_rows(300)
    rows += [rows[0], ("whale", None, rows[0][2], "x", 900), ("whale", 5.0, None, "x", 901), (None, 2.0, at(9), "x", 902)]
    rows += [("edge", 1.0, at(0), "x", 903), ("edge", 2.0, at(7 * 86_400), "x", 904), ("edge", 4.0, at(7 * 86_400 + 1), "x", 905)]
    out = with_recent_spend(spark.createDataFrame(rows, TXN).repartition(5), COLS, (7, 30), heavy_rows, slices)

    def spent(row, days):
        if row[2] is None:
            return None, None
        low = row[2] - dt.timedelta(days=days)
        cents = [round(r[1] * 100) for r in rows if r[0] == row[0] and r[1] is not None and r[2] is not None and low <= r[2] <= row[2]]
        return (sum(cents) / 100 if cents else None), len(cents)

    expected = sorted(((r[4], *spent(r, 7), *spent(r, 30)) for r in rows), key=repr)
    found = out.select("id", "spend_7d", "count_7d", "spend_30d", "count_30d").collect()
    assert sorted(map(tuple, found), key=repr) == expected


def test_frames_need_whole_units(spark):
    df = spark.createDataFrame(whale_rows(3), TXN)
    with pytest.raises(ValueError, match="scale"):
        with_recent_spend(df, Transactions())
    with pytest.raises(ValueError, match="at least one day"):
        with_recent_spend(df, COLS, (0,))
