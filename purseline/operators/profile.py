"""Per-user statistics in one grouped pass.

Everything here can be merged from partial results, the ordered features included:

* deltas between consecutive amounts add up to the last amount, so their mean is
  last amount / number of rows;
* the last rank is the number of rows, the last running total is the sum;
* the number of different months is the number of bits set in an OR of month bits.

So a user's rows are combined map side, a user who owns a third of the table costs one row
per map task, and there is no window, no sort of the rows and no second exchange.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.functions.categories import category_flags
from purseline.functions.numeric import double_order, finite_units, from_units, non_finite, ratio, to_units
from purseline.functions.temporal import time_parts, with_event_time
from purseline.schema import CATEGORIES, Transactions

# Names of zones whose clocks never change.
UNCHANGING_ZONES = ("UTC", "Etc/UTC", "GMT", "Z", "+00:00")


@dataclass(frozen=True)
class Measures:
    """Partial ``state`` kept per user and the ``outputs`` computed from it."""

    state: dict[str, Column] = field(default_factory=dict)
    outputs: dict[str, Column] = field(default_factory=dict)

    def __add__(self, other: Measures) -> Measures:
        return Measures({**self.state, **other.state}, {**self.outputs, **other.outputs})


def _shared(cols: Transactions) -> dict[str, Column]:
    amount = F.col(cols.amount)
    return {
        "_rows": F.count(F.lit(1)),
        "_n": F.count(amount),
        "_sum": F.sum(finite_units(amount, cols.scale)),
        **({} if cols.scale is None else {"_special": F.sum(F.when(non_finite(amount), amount))}),
    }


def _total(cols: Transactions) -> Column:
    """The sum of amounts; with units, NaN and infinities are summed beside and decide."""
    total = from_units(F.col("_sum"), cols.scale)
    return total if cols.scale is None else F.coalesce("_special", total)


def amount_measures(cols: Transactions = Transactions()) -> Measures:
    amount = F.col(cols.amount)
    total = _total(cols)
    state = {
        **_shared(cols),
        "_max": F.max(amount),
        "_min": F.min(amount),
        "_stddev": F.stddev_samp(amount),
        "_log": F.sum(F.log1p(amount)),
    }
    return Measures(
        state,
        {
            "total_spent": total,
            "avg_transaction": ratio(total, F.col("_n")),
            "transaction_count": F.col("_n"),
            "max_transaction": F.col("_max"),
            "min_transaction": F.col("_min"),
            "stddev_transaction": F.col("_stddev"),
            "avg_log_amount": ratio(F.col("_log"), F.col("_n")),
        },
    )


def temporal_measures(cols: Transactions = Transactions()) -> Measures:
    """Means of the time parts share one count: all parts of a NULL time are NULL."""
    time = F.col(cols.time)
    parts = time_parts(time)
    timed = F.col("_timed")
    state = {
        "_timed": F.count(time),
        "_hours": F.sum(parts["hour_of_day"]),
        "_days": F.sum(parts["day_of_week"]),
        "_weekend": F.sum(parts["is_weekend"]),
        "_months": F.bit_or(F.call_function("shiftleft", F.lit(1), parts["month"])),
    }
    return Measures(
        state,
        {
            "avg_hour": ratio(F.col("_hours"), timed),
            "avg_day_of_week": ratio(F.col("_days"), timed),
            "weekend_ratio": ratio(F.col("_weekend"), timed),
            "active_months": F.coalesce(F.bit_count("_months"), F.lit(0)).cast("bigint"),
        },
    )


def category_measures(
    cols: Transactions = Transactions(), labels: Sequence[str] = CATEGORIES, index: str | None = "category_index"
) -> Measures:
    """Count of each listed category, and the mean of an index column where there is one."""
    flags = category_flags(F.col(cols.category), labels)
    names = [f"{label.lower()}_count" for label in labels]
    state = {f"_{name}": F.sum(flag) for name, flag in zip(names, flags.values(), strict=True)}
    outputs = {name: F.col(f"_{name}") for name in names}
    if index:
        state |= {"_index": F.sum(index), "_indexed": F.count(index)}
        outputs["avg_category_index"] = ratio(F.col("_index"), F.col("_indexed"))
    return Measures(state, outputs)


def _position(df: DataFrame, cols: Transactions) -> Column:
    """A value that orders a user's rows as ``cols.order`` does.

    A time and one number (a tie-break, money in units, or a double by its bits) are packed
    into a DECIMAL(38): unlike a struct that is of fixed width, so the aggregate stays a hash
    aggregate instead of one that sorts. Zone-less times are packed only where the session zone has no clock
    changes, which would reorder them.
    """
    zone = df.sparkSession.conf.get("spark.sql.session.timeZone")
    time_type = df.schema[cols.time].dataType
    timed = isinstance(time_type, T.TimestampType) or (
        isinstance(time_type, T.TimestampNTZType) and zone in UNCHANGING_ZONES
    )
    last = F.col(cols.order[-1])
    last_type = df.schema[cols.order[-1]].dataType
    integer = isinstance(last_type, T.IntegralType)
    if not cols.tiebreak and cols.scale is not None:
        last, integer = F.when(non_finite(last), F.lit(2**63 - 1)).otherwise(to_units(last, cols.scale)), True
    elif isinstance(last_type, T.FractionalType) and not isinstance(last_type, T.DecimalType):
        last, integer = double_order(last), True
    if len(cols.order) == 2 and timed and integer:
        micros = F.unix_micros(F.col(cols.time).cast("timestamp")).cast("decimal(18,0)")
        tie = last.cast("decimal(20,0)")
        nulls_first = F.coalesce(micros, F.lit(Decimal(-(10**18) + 1)).cast("decimal(18,0)"))
        return nulls_first * F.lit(Decimal(2**64)) + F.coalesce(tie, F.lit(Decimal(-(2**63))).cast("decimal(20,0)"))
    return F.struct(*cols.order)


def sequence_measures(df: DataFrame, cols: Transactions = Transactions()) -> Measures:
    amount = F.col(cols.amount)
    # inf - inf is NaN: a mean of deltas is finite or infinite only if nothing but the last
    # amount is out of the ordinary.
    position = _position(df, cols)
    state = {
        **_shared(cols),
        "_last": F.max_by(finite_units(amount, cols.scale), position),
        "_odd": F.count_if(non_finite(amount)),
    }
    last = from_units(F.col("_last"), cols.scale)
    if cols.scale is not None:
        state["_last_special"] = F.max_by(F.when(non_finite(amount), amount), position)
        last = F.coalesce("_last_special", last)
    ordinary = (F.col("_odd") == 0) | ((F.col("_odd") == 1) & non_finite(last))
    mean_delta = F.when(ordinary, ratio(last, F.col("_n"))).otherwise(F.lit(float("nan")))
    return Measures(
        state,
        {
            "avg_amount_delta": mean_delta,
            "total_transactions_ranked": F.col("_rows"),
            "final_running_total": _total(cols),
        },
    )


def user_profile(df: DataFrame, cols: Transactions, measures: Measures) -> DataFrame:
    """One row per user: the state by one hash aggregate, the outputs by one projection."""
    grouped = df.groupBy(cols.user).agg(*[state.alias(name) for name, state in measures.state.items()])
    return grouped.select(cols.user, *[output.alias(name) for name, output in measures.outputs.items()])


def user_amount_stats(df: DataFrame, cols: Transactions = Transactions()) -> DataFrame:
    return user_profile(df, cols, amount_measures(cols))


def user_temporal_stats(df: DataFrame, cols: Transactions = Transactions()) -> DataFrame:
    return user_profile(with_event_time(df, cols.time), cols, temporal_measures(cols))


def user_category_stats(
    df: DataFrame,
    cols: Transactions = Transactions(),
    labels: Sequence[str] = CATEGORIES,
    index: str | None = "category_index",
) -> DataFrame:
    return user_profile(df, cols, category_measures(cols, labels, index))


def user_sequence_stats(df: DataFrame, cols: Transactions = Transactions()) -> DataFrame:
    """Needs amounts without NULL, as ``amount_above`` leaves them."""
    ready = with_event_time(df, cols.time)
    return user_profile(ready, cols, sequence_measures(ready, cols))
