"""Sessions as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import sum_of_states, sum_states
from purseline.schema import Events
from purseline.streaming.dedup import DELAY

#: Sessions of a user within one task become one row before they are shuffled; set it for
#: the session of a job whose topic has users with a large share of the events.
MERGE_EARLY = "spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition"


def session_totals(
    events: DataFrame, names: Events = Events(), gap: str = "30 minutes", delay: str = DELAY, scale: int | None = None
) -> DataFrame:
    """Closed sessions: user, begin, end (``gap`` after the last event), events and their amount.

    An event at most ``gap`` after or before one of a session belongs to it, whatever the order
    of arrival; events that close the space between two sessions make them one. A
    session comes out when the watermark passes its end, and is gone from the state then.
    """
    window = F.session_window(names.time, gap).alias("window")
    grouped = events.withWatermark(names.time, delay).groupBy(names.user, window).agg(
        F.count(names.key).alias("event_count"), *[s.alias(n) for n, s in sum_states(F.col(names.amount), scale).items()]
    )
    return grouped.select(
        names.user,
        F.col("window.start").alias("session_start"),
        F.col("window.end").alias("session_end"),
        "event_count",
        sum_of_states(scale).alias("total_volume"),
    )
