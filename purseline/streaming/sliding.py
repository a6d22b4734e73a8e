"""Sliding-window totals as a stream: panes first, then windows of panes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import sum_of_states, sum_states
from purseline.operators.sliding import merged_panes, pane
from purseline.schema import Events
from purseline.streaming.dedup import DELAY


def sliding_window_totals(
    events: DataFrame,
    names: Events = Events(),
    width: str = "1 hour",
    slide: str = "10 minutes",
    delay: str = DELAY,
    scale: int | None = None,
) -> DataFrame:
    """Totals of closed windows; each event is in the state of one pane only.

    A pane goes on to its windows when the watermark has passed its end, and a window comes
    out when it has passed the window's. Both steps keep state only so long. Late events are
    dropped where their pane is closed.
    """
    states = sum_states(F.col(names.amount), scale)
    panes = (
        events.withWatermark(names.time, delay)
        .groupBy(F.window(names.time, pane(width, slide)).alias("window"))
        .agg(*[state.alias(name) for name, state in states.items()], F.count(names.key).alias("event_count"))
        .select("window", sum_of_states(scale).alias("total_volume"), "event_count")
    )
    return merged_panes(panes, width, slide, scale)
