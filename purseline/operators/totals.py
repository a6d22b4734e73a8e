"""Tumbling-window totals; the same grouping serves static and streaming frames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import sum_of_states, sum_states
from purseline.schema import Events


def tumbling_totals(
    df: DataFrame, events: Events = Events(), width: str = "10 seconds", scale: int | None = None
) -> DataFrame:
    """Per half-open, epoch-aligned window: sum of amounts and number of events.

    Events without a time belong to no window.
    """
    states = sum_states(F.col(events.amount), scale)
    grouped = df.groupBy(F.window(events.time, width).alias("window")).agg(
        *[state.alias(name) for name, state in states.items()], F.count(events.key).alias("event_count")
    )
    return grouped.select(
        F.col("window.start").alias("window_start"),
        F.col("window.end").alias("window_end"),
        sum_of_states(scale).alias("total_volume"),
        "event_count",
    )


def merge_totals(partials: DataFrame, scale: int | None = None) -> DataFrame:
    """Totals per window from partial totals of several batches."""
    states = sum_states(F.col("total_volume"), scale)
    merged = partials.groupBy("window_start", "window_end").agg(
        *[state.alias(name) for name, state in states.items()], F.sum("event_count").alias("event_count")
    )
    return merged.select("window_start", "window_end", sum_of_states(scale).alias("total_volume"), "event_count")
