"""Groupings, interval joins, top rows, set operations, sliding windows and sketches on hand-made rows."""

import datetime as dt
import math
import random
from collections import Counter, defaultdict
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from purseline.operators import sets, topk
from purseline.operators.cube import cube_sets, grouped_totals, rollup_sets
from purseline.operators.intervals import BASE, interval_join
from purseline.operators.sets import except_all, intersect_all
from purseline.operators.sketches import (
    DEVIATION,
    ERROR,
    bucket_of,
    bucket_percentiles,
    distinct_sketches,
    percentile_buckets,
    sketch_distinct,
    value_of,
)
from purseline.operators.sliding import pane, seconds, sliding_totals
from purseline.operators.topk import top_rows
from purseline.schema import Events

START = dt.datetime(2026, 1, 1)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# Groupings.

SALES = "a string, b int, c string, amount double"


def sales(n=200):
    draw = random.Random(4)
    rows = [(draw.choice(["x", "y", None]), draw.choice([1, 2, None]), draw.choice("pq"), draw.randint(1, 999) / 100) for _ in range(n)]
    return [*rows, ("x", 1, "p", None), ("only", 7, "q", None)]


def plain_groups(rows, dims, wanted):
    out = []
    for kept in wanted:
        groups = defaultdict(list)
        for row in rows:
            groups[tuple(row[i] if name in kept else None for i, name in enumerate(dims))].append(row[3])
        identity = sum(1 << (len(dims) - 1 - i) for i, name in enumerate(dims) if name not in kept)
        if not kept and not groups:
            groups[(None,) * len(dims)] = []
        for key, amounts in groups.items():
            known = [x for x in amounts if x is not None]
            total = round(sum(known), 2) if known else None
            mean = round(total / len(known), 6) if known else None
            out.append((*key, identity, len(amounts), len(known), total, mean, min(known, default=None), max(known, default=None)))
    return sorted(out, key=repr)


def found_groups(df):
    rows = df.withColumns({"total": F.round("total", 2), "mean": F.round("mean", 6)}).collect()
    return sorted(map(tuple, rows), key=repr)


@pytest.mark.parametrize("name", ["cube", "rollup", "sets", "none"])
def test_grouped_totals(spark, name):
    dims = ("a", "b", "c")
    wanted = {"cube": cube_sets(dims), "rollup": rollup_sets(dims), "sets": [("c",), ("b", "a"), ("a", "b")], "none": [()]}[name]
    rows = sales()
    out = grouped_totals(spark.createDataFrame(rows, SALES).repartition(4), dims, "amount", wanted, scale=2)
    distinct = list(dict.fromkeys(tuple(d for d in dims if d in kept) for kept in wanted))
    assert found_groups(out) == plain_groups(rows, dims, distinct)


def test_all_sets_of_a_cube():
    assert {frozenset(s) for s in cube_sets("abc")} == {frozenset(c) for n in range(4) for c in combinations("abc", n)}
    assert rollup_sets(("a", "b")) == [("a", "b"), ("a",), ()]


def test_empty_table_has_the_total_only(spark):
    out = grouped_totals(spark.createDataFrame([], SALES), ("a", "b"), "amount", cube_sets(("a", "b")), scale=2)
    assert [(r.grouping_id, r.row_count, r.total) for r in out.collect()] == [(3, 0, None)]


def test_rows_are_not_multiplied_by_sets(spark):
    df = spark.createDataFrame(sales(), SALES)
    plan = plan_of(grouped_totals(df, ("a", "b"), "amount", [("a", "b"), ("a",)], scale=2))
    assert plan.count("Generate explode") == 1
    above, below = plan.split("Generate explode")
    assert "Exchange" in below and "HashAggregate" in below and "SortAggregate" not in plan


def test_unknown_columns_of_sets(spark):
    with pytest.raises(ValueError, match="z"):
        grouped_totals(spark.createDataFrame([], SALES), ("a",), "amount", [("z",)])


# Interval join.


def moment(us):
    return None if us is None else START + dt.timedelta(microseconds=us)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_interval_join(spark, how):
    draw = random.Random(8)
    lengths = [0, 1, 2, 15, 16, 17, 255, 256, 257, 4_096, 70_000, 10**9]
    spans = []
    for i in range(150):
        begin = draw.randint(-(10**6), 10**6)
        spans.append((i, draw.choice("ab"), begin, begin + draw.choice(lengths)))
    spans += [(900, "a", 5, 1), (901, None, 0, 9), (902, "a", None, 9), (903, "a", 0, None), spans[0]]
    dots = [(i, draw.choice(["a", "b", "c"]), draw.randint(-(10**6), 10**6)) for i in range(200)]
    dots += [(500 + i, spans[i][1], spans[i][2]) for i in range(40)]  # at the start: inside
    dots += [(600 + i, spans[i][1], spans[i][3]) for i in range(40)]  # at the end: outside
    dots += [(700, "a", None), (701, None, 5), dots[0]]
    points = spark.createDataFrame([(i, k, moment(t)) for i, k, t in dots], "p bigint, k string, t timestamp_ntz")
    intervals = spark.createDataFrame(
        [(i, k, moment(a), moment(b)) for i, k, a, b in spans], "s bigint, k string, a timestamp_ntz, b timestamp_ntz"
    )
    out = interval_join(points.repartition(3), intervals, "k", "t", "a", "b", how)
    expected = []
    for p, k, t in dots:
        inside = [s for s, key, a, b in spans if None not in (key, a, b, k, t) and key == k and a <= t < b]
        expected += [(p, s) for s in inside] or ([(p, None)] if how == "left" else [])
    assert sorted(map(tuple, out.select("p", "s").collect()), key=repr) == sorted(expected, key=repr)


def test_interval_join_moves_a_bounded_multiple(spark):
    """Long and short intervals together: two rows per interval and one per point and level at most."""
    points = spark.createDataFrame([("a", moment(i * 1_000)) for i in range(300)], "k string, t timestamp_ntz")
    spans = [("a", moment(i), moment(i + BASE ** (i % 6))) for i in range(60)]
    intervals = spark.createDataFrame(spans, "k string, a timestamp_ntz, b timestamp_ntz")
    out = interval_join(points, intervals, "k", "t", "a", "b")
    plan = plan_of(out)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert plan.count("Generate explode") == 2  # cells of intervals, levels of points


# Top rows.


def scores(n=400):
    draw = random.Random(6)
    return [("hot" if i % 3 else draw.choice(["a", None]), draw.randint(0, 30), i) for i in range(n)]


def test_top_rows(spark):
    rows = scores()
    df = spark.createDataFrame(rows, "g string, v int, i int").repartition(6)
    out = top_rows(df, "g", [F.desc("v"), F.asc("i")], 7)
    expected = []
    for g in {r[0] for r in rows}:
        order = sorted((r for r in rows if r[0] == g), key=lambda r: (-r[1], r[2]))
        expected += [(*r, n) for n, r in enumerate(order[:7], 1)]
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_top_rows_with_ties(spark):
    rows = scores()
    out = top_rows(spark.createDataFrame(rows, "g string, v int, i int"), "g", [F.desc("v")], 5, ties=True)
    expected = []
    for g in {r[0] for r in rows}:
        for r in rows:
            ahead = sum(1 for s in rows if s[0] == g and s[1] > r[1])
            if r[0] == g and ahead < 5:
                expected.append((*r, ahead + 1))
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(expected, key=repr)


def test_top_rows_are_cut_down_before_each_shuffle(spark):
    df = spark.createDataFrame(scores(), "g string, v int, i int")
    plan = plan_of(top_rows(df, "g", [F.desc("v"), F.asc("i")], 7))
    # Partial ones below both exchanges.
    assert plan.count("Partial") >= 2 and plan.count("WindowGroupLimit") >= 4
    assert topk.PARTS > 1
    with pytest.raises(ValueError):
        top_rows(df, "g", [F.desc("v")], 0)


# Set operations.

ROW = "a string, b bigint, `c.d` array<int>"


@pytest.mark.parametrize("chunk", [1, 3, 100_000])
def test_set_operations_keep_copies(spark, monkeypatch, chunk):
    monkeypatch.setattr(sets, "CHUNK", chunk)
    draw = random.Random(chunk)
    pool = [("x", 1, [1, 2]), ("x", None, None), (None, None, []), ("1", 11, [1]), ("11", 1, [1]), ("hot", 0, None)]

    def some(n):
        return [*(draw.choice(pool) for _ in range(n)), *[pool[5]] * n]

    left, right = some(20), some(9)

    def counted(rows):
        return Counter((a, b, None if c is None else tuple(c)) for a, b, c in rows)

    one, two = (spark.createDataFrame(rows, ROW).repartition(3) for rows in (left, right))
    assert counted(except_all(one, two).collect()) == counted(left) - counted(right)
    assert counted(intersect_all(one, two).collect()) == counted(left) & counted(right)
    assert except_all(one, one).count() == 0 and intersect_all(one, two.limit(0)).count() == 0


def test_set_operations_shuffle_hashes_first(spark):
    one = spark.createDataFrame([("x", 1, [1])], ROW)
    with pytest.raises(ValueError, match="columns differ"):
        except_all(one, one.drop("b"))
    assert "BroadcastNestedLoop" not in plan_of(except_all(one, one))


# Sliding windows.


@pytest.mark.parametrize("width, slide", [("60 seconds", "20 seconds"), ("90 seconds", "60 seconds"), ("1 minute", "1 minute")])
def test_sliding_totals(spark, width, slide):
    draw = random.Random(3)
    rows = [(i, 1, draw.randint(1, 999) / 100, START + dt.timedelta(milliseconds=draw.randint(0, 400_000))) for i in range(200)]
    rows += [(900, 1, 1.0, None), (901, 1, 2.0, START), (902, 1, None, START)]
    df = spark.createDataFrame(rows, "event_id int, user_id int, transaction_amount double, timestamp timestamp")
    out = {r.window_start: (r.window_end, r.event_count, r.total_volume) for r in sliding_totals(df, Events(), width, slide, 2).collect()}
    w, s = seconds(width), seconds(slide)
    expected = {}
    for k in range(-w // s - 1, 400 // s + 2):
        begin = START + dt.timedelta(seconds=k * s)
        end = begin + dt.timedelta(seconds=w)
        inside = [r for r in rows if r[3] is not None and begin <= r[3] < end]
        if inside:
            cents = [round(r[2] * 100) for r in inside if r[2] is not None]
            expected[begin] = (end, len(inside), sum(cents) / 100)
    assert out == expected


def test_panes():
    assert pane("90 minutes", "1 hour") == "1800 seconds" and pane("2 days", "12 hours") == "43200 seconds"
    for width, slide in (("1 hour", "2 hours"), ("0 seconds", "1 second"), ("1 month", "1 day"), ("1.5 hours", "1 hour")):
        with pytest.raises(ValueError):
            pane(width, slide)


def test_windows_copy_panes_not_rows(spark):
    df = spark.createDataFrame([(1, 1, 1.0, START)], "event_id int, user_id int, transaction_amount double, timestamp timestamp")
    plan = plan_of(sliding_totals(df, Events(), "1 hour", "10 minutes", 2))
    assert "Exchange" in plan.split("Expand" if "Expand" in plan else "Generate")[-1]


# Sketches.


def test_percentiles_are_within_the_error(spark):
    draw = random.Random(7)
    values = {
        "wide": [draw.lognormvariate(0, 6) for _ in range(3_000)],
        "signed": [draw.gauss(0, 100) for _ in range(2_000)] + [0.0] * 50,
        "one": [3.25],
        "same": [1e-300] * 100,
        "large": [1.7e308, 1e308, 5e-324],
    }
    rows = [(k, x, i % 7) for k, found in values.items() for i, x in enumerate(found)]
    rows += [("wide", None, 0), ("wide", math.nan, 0), ("wide", math.inf, 1), ("nothing", None, 0)]
    df = spark.createDataFrame(rows, "k string, v double, batch int").repartition(4)
    shares = {"p0": 0.0, "p25": 0.25, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    stored = percentile_buckets(df, ["batch", "k"], "v")
    out = {r.k: r for r in bucket_percentiles(stored, ["k"], shares).collect()}
    whole = {r.k: r for r in bucket_percentiles(percentile_buckets(df, ["k"], "v"), ["k"], shares).collect()}
    assert out == whole and set(out) == set(values)  # batches do not matter
    for k, found in values.items():
        order = sorted(found)
        assert out[k].n == len(order)
        for name, p in shares.items():
            exact = order[math.floor(p * (len(order) - 1))]
            assert out[k][name] == pytest.approx(exact, rel=ERROR * 1.0001, abs=0), (k, name)


def test_buckets_rise_with_values(spark):
    df = spark.createDataFrame([(x,) for x in (-1e9, -2.0, -1e-9, 0.0, 1e-9, 0.5, 1.0, 1e9)], "v double")
    rows = df.select("v", bucket_of(F.col("v")).alias("b")).select("v", "b", value_of(F.col("b")).alias("m")).collect()
    assert [r.b for r in rows] == sorted(r.b for r in rows)
    assert all(r.m == pytest.approx(r.v, rel=ERROR * 1.0001) for r in rows)


def test_distinct_counts_are_about_right(spark):
    df = spark.range(60_000).select((F.col("id") % 3).alias("k"), (F.col("id") % 20_000).alias("v"), (F.col("id") % 11).alias("batch"))
    df = df.unionByName(df).unionByName(spark.createDataFrame([(0, None, 0)], "k long, v long, batch long"))
    out = sketch_distinct(distinct_sketches(df, ["batch", "k"], "v"), ["k"]).collect()
    exact = {r.k: r.n for r in df.groupBy("k").agg(F.count_distinct("v").alias("n")).collect()}
    assert all(abs(r.distinct_values / exact[r.k] - 1) <= 4 * DEVIATION for r in out) and len(out) == 3
