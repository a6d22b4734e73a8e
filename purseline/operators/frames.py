"""Sums over the last days of a user, up to each of the user's rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from purseline.functions.numeric import from_units, to_units
from purseline.functions.temporal import with_event_time
from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.slices import AT, SLICE, in_slices, slice_count, slice_window, split_heavy, with_starts
from purseline.schema import Transactions

DAY = 86_400_000_000


def _framed(rows: DataFrame, user: str, days: Sequence[int]) -> DataFrame:
    """Light users: Spark's own RANGE frames, all in one sort."""
    out = rows
    for n in days:
        frame = Window.partitionBy(user).orderBy("_micros").rangeBetween(-n * DAY, Window.currentRow)
        out = out.withColumns({f"_sum{n}": F.sum("_units").over(frame), f"_count{n}": F.count("_units").over(frame)})
    return out


def _differences(rows: DataFrame, user: str, days: Sequence[int], slices: int) -> DataFrame:
    """Heavy users: what was spent up to a row less what was spent before its frame.

    A frame may hold more rows than a task can take, so none is put together. Rows are summed
    by time first; each time then leaves one mark in the order per frame, where the frame
    begins, and a running sum over all gives both ends. For k frames that is at most k + 1 rows
    for each time, whatever the length of the frames.
    """
    times = rows.groupBy(user, "_micros").agg(F.sum("_units").alias("_u"), F.count("_units").alias("_n"))
    none = F.lit(0).cast("long")
    marks = times.select(user, F.col("_micros").alias("_place"), none.alias("_frame"), "_micros", "_u", "_n")
    for n in days:
        # Before the rows of its own time, as the frame includes these: -n sorts before 0.
        place = (F.col("_micros") - n * DAY).alias("_place")
        begin = times.select(user, place, (none - n).alias("_frame"), "_micros", none.alias("_u"), none.alias("_n"))
        marks = marks.unionByName(begin)
    sliced = in_slices(marks, user, ("_place", "_frame"), slices, unique=True)
    names = ("_u", "_n")
    carried = with_starts(
        sliced,
        user,
        {f"{x}s": F.sum(x) for x in names},
        lambda before: {f"{x}0": F.coalesce(F.sum(f"{x}s").over(before), none) for x in names},
    )
    up_to = slice_window(user).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    running = carried.select(
        F.col(user).alias("_user"),
        F.col("_micros").alias("_of"),
        "_frame",
        *[(F.col(f"{x}0") + F.coalesce(F.sum(x).over(up_to), none)).alias(f"{x}r") for x in names],
    )

    def at(name: str, frame: int) -> Column:
        return F.max(F.when(F.col("_frame") == frame, F.col(name)))

    ends = running.groupBy("_user", "_of").agg(
        *[(at(f"{x}r", 0) - at(f"{x}r", -n)).alias(f"{x}{n}") for x in names for n in days]
    )
    same = F.col(user).eqNullSafe(F.col("_user")) & (F.col("_micros") == F.col("_of"))
    joined = rows.join(ends, same, "left")
    return joined.withColumns(
        {f"_sum{n}": F.when(F.col(f"_n{n}") > 0, F.col(f"_u{n}")) for n in days}
        | {f"_count{n}": F.col(f"_n{n}") for n in days}
    ).select(*rows.columns, *[f"_{kind}{n}" for n in days for kind in ("sum", "count")])


def with_recent_spend(
    df: DataFrame,
    cols: Transactions = Transactions(),
    days: Sequence[int] = (7, 30),
    heavy_rows: int = HEAVY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``spend_<n>d`` and ``count_<n>d``: the user's amounts from n days before the row up to its time.

    Both ends belong to the frame, so rows of equal time have equal results; NULL amounts are
    not counted. Rows without a time get NULL and are in no frame. ``scale`` is needed: sums
    of whole units are exact on both ways; without, the difference of two sums of doubles
    would not be what the frame adds up to.
    """
    if cols.scale is None:
        raise ValueError("frames of doubles are not exact; give the scale of the amounts")
    if any(n < 1 for n in days):
        raise ValueError("a frame has at least one day")
    days = list(dict.fromkeys(days))
    ready = with_event_time(df, cols.time)
    ready = ready.withColumns(
        {
            "_units": to_units(F.col(cols.amount), cols.scale),
            "_micros": F.unix_micros(F.col(cols.time).cast("timestamp")),
        }
    )
    timed = ready.where(F.col("_micros").isNotNull())
    light, heavy, rows, _ = split_heavy(timed, cols.user, heavy_rows)
    out = _framed(light, cols.user, days)
    if heavy is not None:
        number = slices or slice_count(df, rows, heavy_rows)
        out = out.unionByName(_differences(heavy, cols.user, days, number))
    out = out.unionByName(ready.where(F.col("_micros").isNull()), allowMissingColumns=True)
    spend = {f"spend_{n}d": from_units(F.col(f"_sum{n}"), cols.scale) for n in days}
    counts = {f"count_{n}d": F.col(f"_count{n}") for n in days}
    return out.withColumns(spend | counts).drop("_units", "_micros", *[f"_{kind}{n}" for n in days for kind in ("sum", "count")])
