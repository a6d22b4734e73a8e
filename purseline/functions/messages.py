"""JSON messages: encoding rows, decoding values, telling good from bad."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.schema import EVENT_SCHEMA, Events

# Fixed value: ISO-8601 without zone, microseconds always written.
ISO_MICROS = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def json_value(df: DataFrame, columns: list[str]) -> Column:
    """The named columns as one JSON object; times keep their microseconds."""
    fields = []
    for name in columns:
        is_time = isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType))
        fields.append(F.date_format(name, ISO_MICROS).alias(name) if is_time else F.col(name))
    return F.to_json(F.struct(*fields))


def encode_events(df: DataFrame, columns: list[str], key: str | None = None) -> DataFrame:
    """Rows as ``(key, value)`` messages; ``key`` decides the topic partition."""
    value = json_value(df, columns).alias("value")
    return df.select(F.col(key).cast("string").alias("key"), value) if key else df.select(value)


def decode_events(messages: DataFrame, schema: T.StructType = EVENT_SCHEMA, time: str = "timestamp") -> DataFrame:
    """Message bytes → text → declared columns → event time, plus the raw text as ``value``.

    Works on static and streaming frames. Fields that are missing, mistyped or unreadable
    become NULL; nothing raises and nothing is dropped here (see ``split_rejects``).

    The parsed struct is expanded by ``inline``: a later filter on its fields then stays
    above it, where a projection would be copied into the filter and parse the text again.
    """
    text = messages.select(F.col("value").cast("string").alias("value"))
    parsed = text.select(F.inline(F.array(F.from_json("value", schema))), "value")
    return parsed.withColumn(time, F.try_to_timestamp(F.col(time)))


def is_usable(events: Events = Events()) -> Column:
    """Has the key and the event time that dedup and windows need."""
    return F.col(events.key).isNotNull() & F.col(events.time).isNotNull()


def split_rejects(decoded: DataFrame, events: Events = Events()) -> tuple[DataFrame, DataFrame]:
    """(usable events, rejected messages with their raw text).

    Rejects never reach dedup, where all their NULL keys would count as one event.
    """
    good = is_usable(events)
    return decoded.where(good).drop("value"), decoded.where(~good)
