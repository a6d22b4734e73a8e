"""Sliding-window totals from panes that windows share."""

from __future__ import annotations

import re
from math import gcd

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import sum_of_states, sum_states
from purseline.operators.totals import tumbling_totals
from purseline.schema import Events

# Units of an interval in seconds.
_UNITS = {"second": 1, "minute": 60, "hour": 3_600, "day": 86_400, "week": 604_800}


def seconds(interval: str) -> int:
    """The length of an interval such as "90 minutes"; parts of a second have none."""
    found = re.fullmatch(r"\s*(\d+)\s+([a-z]+?)s?\s*", interval.lower())
    if not found or found[2] not in _UNITS or not int(found[1]):
        raise ValueError(f"not a whole number of seconds, minutes, hours, days or weeks: {interval!r}")
    return int(found[1]) * _UNITS[found[2]]


def pane(width: str, slide: str) -> str:
    """The longest interval of which both the width and the slide are multiples."""
    if seconds(slide) > seconds(width):
        raise ValueError(f"windows of {width} every {slide} leave out rows")
    return f"{gcd(seconds(width), seconds(slide))} seconds"


def merged_panes(panes: DataFrame, width: str, slide: str, scale: int | None = None) -> DataFrame:
    """Windows of ``width`` every ``slide`` from the totals of panes; of a stream as well.

    A pane, not a row, is copied for each window that holds it.
    """
    # Units again, so that merging is as exact as the panes.
    states = sum_states(F.col("total_volume"), scale)
    moment = F.col("window") if "window" in panes.columns else F.col("window_start")
    grouped = panes.groupBy(F.window(moment, width, slide).alias("_window")).agg(
        *[state.alias(name) for name, state in states.items()], F.sum("event_count").alias("event_count")
    )
    return grouped.select(
        F.col("_window.start").alias("window_start"),
        F.col("_window.end").alias("window_end"),
        sum_of_states(scale).alias("total_volume"),
        "event_count",
    )


def sliding_totals(
    df: DataFrame, events: Events = Events(), width: str = "1 hour", slide: str = "10 minutes", scale: int | None = None
) -> DataFrame:
    """Per window [start, start + width), one every ``slide`` from the epoch: amount and events.

    Rows are summed once, by pane; windows without rows have none. Events without a time
    belong to no window.
    """
    return merged_panes(tumbling_totals(df, events, pane(width, slide), scale), width, slide, scale)
