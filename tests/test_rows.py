"""Single-row operators on hand-made edge rows."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.functions.categories import with_category_flags
from purseline.functions.numeric import from_units, to_units
from purseline.functions.temporal import with_time_parts
from purseline.operators.filters import amount_above
from purseline.operators.totals import merge_totals, tumbling_totals
from purseline.schema import Events, Transactions


def test_filter_keeps_positive_and_nan(spark):
    df = spark.createDataFrame([(None,), (0.0,), (-1.0,), (2.0,), (float("nan"),)], "amount double")
    kept = [row.amount for row in amount_above(df, "amount").collect()]
    assert len(kept) == 2 and 2.0 in kept and any(math.isnan(x) for x in kept)


@pytest.mark.parametrize("type_name", ["timestamp", "timestamp_ntz", "string"])
def test_weekend_is_saturday_and_sunday(spark, type_name):
    times = ["2026-01-03 05:06:07", "2026-01-04 23:59:59", "2026-01-05 00:00:00"]
    df = spark.createDataFrame([(t,) for t in times], "t string").withColumn("t", F.col("t").cast(type_name))
    rows = with_time_parts(df, "t").collect()
    assert [r.day_of_week for r in rows] == [7, 1, 2]
    assert [r.is_weekend for r in rows] == [1, 1, 0]
    assert [r.hour_of_day for r in rows] == [5, 23, 0]
    assert {r.month for r in rows} == {1}


def test_unreadable_time_gives_null_parts(spark):
    df = spark.createDataFrame([("bad",), (None,)], "t string")
    for row in with_time_parts(df, "t").collect():
        assert (row.t, row.hour_of_day, row.day_of_week, row.month, row.is_weekend) == (None,) * 5


def test_flag_of_null_category_is_null(spark):
    df = spark.createDataFrame([("x",), ("y",), (None,)], "c string")
    assert [r.is_x for r in with_category_flags(df, "c", ["x"]).collect()] == [1, 0, None]


def test_money_units_are_exact(spark):
    df = spark.createDataFrame([(0.1,), (0.2,), (1e12 + 0.01,)], "a double")
    total = df.agg(from_units(F.sum(to_units(F.col("a"), 2)), 2).alias("t")).first().t
    assert total == 1000000000000.31


def test_table_check_names_what_is_missing(spark):
    df = spark.createDataFrame([("1", 1.0)], "user_id string, amount double")
    with pytest.raises(ValueError, match="timestamp"):
        Transactions().check(df)


def test_table_check_rejects_text_amounts(spark):
    row = ("1", "1.0", dt.datetime(2026, 1, 1), "x")
    schema = T.StructType.fromDDL("user_id string, amount string, timestamp timestamp_ntz, category string")
    with pytest.raises(TypeError, match="numeric"):
        Transactions().check(spark.createDataFrame([row], schema))


@pytest.mark.parametrize("scale", [2, None])
def test_window_totals_take_nan_and_infinity_as_doubles_do(spark, scale):
    inf, nan = float("inf"), float("nan")
    rows = [(i, 1, x, dt.datetime(2026, 1, 1, 0, i)) for i, xs in enumerate([(1.5, 2.25), (1.0, inf), (inf, nan), (None,)]) for x in xs]
    df = spark.createDataFrame(rows, "event_id int, user_id int, transaction_amount double, timestamp timestamp")
    totals = tumbling_totals(df, Events(), "1 minute", scale)
    for out in (totals, merge_totals(totals.unionByName(totals.limit(0)), scale)):
        assert [str(r.total_volume) for r in out.orderBy("window_start").collect()] == ["3.75", "inf", "nan", "None"]
