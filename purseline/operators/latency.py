"""Latency percentiles and throughput per load level."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.operators.prefix import with_ordered_state
from purseline.staging import stage

# The percentiles reported.
PERCENTILES = {"p50": 0.50, "p95": 0.95, "p99": 0.99}
# The load levels reported, in events per second.
LOADS = (100, 1_000, 10_000)


def with_processing_time(df: DataFrame, name: str = "processed_at") -> DataFrame:
    """Add the time of the run; of a stream, that of each row's micro-batch."""
    return df.withColumn(name, F.current_timestamp())


def latency_ms(df: DataFrame, event_time: str, processed_at: str) -> DataFrame:
    """Add ``latency_ms`` = processing time - event time."""
    micros = F.unix_micros(F.col(processed_at)) - F.unix_micros(F.col(event_time))
    return df.withColumn("latency_ms", micros / F.lit(1000.0))


def latency_summary(
    df: DataFrame,
    level: str,
    latency: str = "latency_ms",
    percentiles: Mapping[str, float] = PERCENTILES,
    slices: int | None = None,
) -> DataFrame:
    """Exact interpolated percentiles and the number of events per level.

    Events are first counted per level and latency, map side. The percentiles are then read
    off the cumulative counts, which are added up in slices of levels and latencies at any
    size, so no task holds a whole level.
    """
    known = df.where(F.col(latency).isNotNull())
    return _percentiles(known.groupBy(level, latency).agg(F.count(F.lit(1)).alias("events")), level, latency, percentiles, slices)


def latency_by_load(
    df: DataFrame,
    time: str,
    width: str = "1 second",
    bounds: Sequence[int] = LOADS,
    latency: str = "latency_ms",
    percentiles: Mapping[str, float] = PERCENTILES,
    slices: int | None = None,
) -> DataFrame:
    """Percentiles and events by ``load``: the first of ``bounds`` that the events per ``width`` do not exceed.

    It is NULL above all bounds. All events with a time count as load, those without a latency
    too. Events are counted by window and latency before windows meet their load, so a window
    with a third of all events is as many rows as it has different latencies.
    """
    by_window = df.where(F.col(time).isNotNull()).groupBy(F.window(time, width).getField("start").alias("_window"), latency)
    counts = stage(by_window.agg(F.count(F.lit(1)).alias("_events")), "load-counts")
    loads = counts.groupBy(F.col("_window").alias("_of")).agg(F.sum("_events").alias("_load"))
    load = F.lit(None).cast("long")
    for bound in sorted(bounds, reverse=True):
        load = F.when(F.col("_load") <= bound, F.lit(bound).cast("long")).otherwise(load)
    joined = counts.where(F.col(latency).isNotNull()).join(loads, F.col("_window") == F.col("_of"))
    grouped = joined.groupBy(load.alias("load"), latency).agg(F.sum("_events").alias("events"))
    return _percentiles(grouped, "load", latency, percentiles, slices)


def _percentiles(
    counted: DataFrame, level: str, latency: str, percentiles: Mapping[str, float], slices: int | None
) -> DataFrame:
    """From the events by level and latency."""
    counts = stage(counted, "latency-counts")
    cumulative = with_ordered_state(counts, level, (latency,), "events", 0, slices, unique=True)
    sizes = counts.groupBy(F.col(level).alias("_level")).agg(F.sum("events").alias("_n"))
    ranked = cumulative.join(sizes, F.col(level).eqNullSafe(F.col("_level")))

    state, outputs = [], []
    for name, p in percentiles.items():
        place = F.lit(p) * (F.col("_n") - 1)
        for end, rank in (("low", F.floor(place)), ("high", F.ceil(place))):
            state.append(F.min(F.when(F.col("_running") > rank, F.col(latency))).alias(f"_{name}_{end}"))
        share = F.lit(p) * (F.col("n") - 1) - F.floor(F.lit(p) * (F.col("n") - 1))
        outputs.append((F.col(f"_{name}_low") + share * (F.col(f"_{name}_high") - F.col(f"_{name}_low"))).alias(name))
    return ranked.groupBy(level).agg(F.max("_n").alias("n"), *state).select(level, *outputs, "n")


def throughput(df: DataFrame, level: str, processed_at: str) -> DataFrame:
    """Events per second of processing time, per level."""
    seconds = (F.max(F.unix_micros(processed_at)) - F.min(F.unix_micros(processed_at))) / F.lit(1e6)
    grouped = df.groupBy(level).agg(F.count(F.lit(1)).alias("n"), seconds.alias("seconds"))
    return grouped.withColumn("events_per_second", F.try_divide("n", "seconds"))
