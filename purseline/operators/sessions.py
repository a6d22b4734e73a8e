"""Sessions: runs of a key's events that follow each other within a gap."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from purseline.functions.numeric import sum_of_states, sum_states
from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.slices import AT, SLICE, in_slices, slice_count, slice_window, split_heavy, with_starts
from purseline.schema import Events

BEGIN = "session_start"


def _micros(gap: str) -> str:
    """An interval in microseconds, as SQL."""
    return f"unix_micros(timestamp_seconds(0) + interval {gap})"


def with_session_start(
    df: DataFrame, key: str, time: str, gap: str, heavy_rows: int = HEAVY_ROWS, slices: int | None = None
) -> list[DataFrame]:
    """Rows with the start of their session, as light and heavy keys' parts, which share no session.

    An event up to ``gap`` after the one before, that included, belongs to its session. Rows without a time belong to none and are left out.
    """
    timed = df.where(F.col(time).isNotNull())
    light, heavy, rows, _ = split_heavy(timed, key, heavy_rows)

    def begins(previous):
        apart = F.unix_micros(F.col(time).cast("timestamp")) - F.unix_micros(previous.cast("timestamp"))
        return F.when(previous.isNull() | (apart > F.expr(_micros(gap))), F.col(time))

    def latest(window):
        return F.last("_begin", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    order = Window.partitionBy(key).orderBy(time)
    marked = light.withColumn("_begin", begins(F.lag(time).over(order)))
    parts = [marked.withColumn(BEGIN, latest(order)).drop("_begin")]
    if heavy is not None:
        sliced = in_slices(heavy, key, (time,), slices or slice_count(df, rows, heavy_rows))
        # First the last time before each slice, then the last begin.
        near = with_starts(sliced, key, {"_end": F.max(time)}, lambda before: {"_end0": F.last("_end").over(before)})
        rows_of = slice_window(key)
        previous = F.coalesce(F.lag(time).over(rows_of), F.col("_end0"))
        marked = near.withColumn("_begin", begins(previous)).drop("_end0")
        known = with_starts(
            marked,
            key,
            {"_open": F.max("_begin")},
            lambda before: {"_open0": F.last("_open", ignorenulls=True).over(before)},
        )
        known = known.withColumn(BEGIN, F.coalesce(latest(rows_of), F.col("_open0")))
        parts.append(known.drop("_begin", "_open0", SLICE, AT))
    return parts


def sessions(
    df: DataFrame,
    gap: str,
    events: Events = Events(),
    scale: int | None = None,
    heavy_rows: int = HEAVY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Per user and session: begin, end (``gap`` after the last event), events and their amount.

    A session of a heavy user is one row per task before it is shuffled, and may span slices.
    Rows of a NULL user are sessions of a user of their own.
    """
    out = None
    slim = df.select(events.user, events.time, events.amount)
    for part in with_session_start(slim, events.user, events.time, gap, heavy_rows, slices):
        summed = part.groupBy(events.user, BEGIN).agg(
            F.max(events.time).alias("_last"),
            F.count(F.lit(1)).alias("event_count"),
            *[state.alias(name) for name, state in sum_states(F.col(events.amount), scale).items()],
        )
        found = summed.select(
            events.user,
            BEGIN,
            (F.col("_last") + F.expr(f"interval {gap}")).alias("session_end"),
            "event_count",
            sum_of_states(scale).alias("total_volume"),
        )
        out = found if out is None else out.unionByName(found)
    return out
