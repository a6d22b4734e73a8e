"""Removing repeated deliveries across micro-batches and restarts."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

# Fixed value: the default delay, for late events and for repeats.
DELAY = "10 seconds"


def _distinct_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        table = pa.Table.from_batches([batch])
        yield from table.group_by(table.column_names).aggregate([]).select(table.column_names).to_batches()


def collapse_copies(events: DataFrame) -> DataFrame:
    """Drop rows equal in every column within each Arrow batch, before any shuffle.

    Streaming dedup sends every row of a key to one task. An event delivered over and over
    is cut down here, where it is read; Spark has no stateless distinct for streams. Rows
    that differ anywhere are kept, so the result after dedup is the same. Nested columns
    cannot be compared in Arrow; with any, all rows go on.
    """
    if any(isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)) for field in events.schema):
        return events
    return events.mapInArrow(_distinct_rows, events.schema)


def dedup_stream(
    events: DataFrame, keys: Sequence[str], time: str, delay: str = DELAY, collapse: bool = False
) -> DataFrame:
    """Keep the first delivery of each key; repeats within ``delay`` of event time are dropped.

    State covers ``delay`` only, and survives restarts with the checkpoint. A repeat with
    the same time is always removed: by state while its key is kept, as late data afterwards.
    The same key with a new time further off than ``delay`` counts as a new event, and an
    event that first arrives behind the watermark is dropped.

    Ids that can start again need more columns in ``keys``. ``collapse`` is for topics with
    storms of exact copies: it passes every row through Python, and copies that it removes
    are in no count of repeats.
    """
    rows = collapse_copies(events) if collapse else events
    return rows.withWatermark(time, delay).dropDuplicatesWithinWatermark(list(keys))
