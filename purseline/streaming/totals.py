"""Event-time window totals as streams."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from purseline.operators.totals import tumbling_totals
from purseline.schema import Events
from purseline.streaming.dedup import DELAY, dedup_stream


def windowed_totals(
    events: DataFrame,
    names: Events = Events(),
    width: str = "10 seconds",
    delay: str = DELAY,
    scale: int | None = None,
) -> DataFrame:
    """Sum and count per window, kept in state until the watermark passes the window's end.

    Rows of a window combine map side before they reach its state, so a busy window is no
    hot spot. Events of windows already closed are dropped.
    """
    return tumbling_totals(events.withWatermark(names.time, delay), names, width, scale)


def deduplicated_totals(
    events: DataFrame,
    names: Events = Events(),
    width: str = "10 seconds",
    delay: str = DELAY,
    scale: int | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Window totals in which every event counts once, under one shared watermark.

    ``keys`` names an event, its id by default; ids that can start again need more columns.
    """
    return tumbling_totals(dedup_stream(events, list(keys) or [names.key], names.time, delay), names, width, scale)
