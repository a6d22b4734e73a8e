"""Event time and the parts of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Day numbers 1 = Sunday ... 7 = Saturday.
WEEKEND = (1, 7)


def with_event_time(df: DataFrame, time: str) -> DataFrame:
    """Text becomes a timestamp (NULL when it is not one); real times stay as they are.

    Zone-less timestamps are left zone-less: their parts are those of the wall clock, which
    is what a conversion through the session zone would give back.
    """
    if isinstance(df.schema[time].dataType, T.StringType):
        return df.withColumn(time, F.try_to_timestamp(F.col(time)))
    return df


def time_parts(time: Column) -> dict[str, Column]:
    """The four time parts by output name."""
    day = F.dayofweek(time)
    return {
        "hour_of_day": F.hour(time),
        "day_of_week": day,
        "month": F.month(time),
        "is_weekend": day.isin(*WEEKEND).cast("int"),
    }


def with_time_parts(df: DataFrame, time: str) -> DataFrame:
    """Add ``hour_of_day``, ``day_of_week``, ``month`` and ``is_weekend``."""
    df = with_event_time(df, time)
    return df.withColumns(time_parts(F.col(time)))
