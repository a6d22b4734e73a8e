"""Starting streams on sinks that a replayed micro-batch leaves unchanged."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from purseline.operators.totals import tumbling_totals
from purseline.schema import Events

WIDTH = "spark.sql.shuffle.partitions"


@contextmanager
def state_partitions(spark: SparkSession, number: int | None = None) -> Iterator[None]:
    """Queries started inside keep their state in exactly ``number`` partitions.

    Each state partition costs files in every micro-batch, so a number near the cores meant
    for the job does best. A query keeps the width of its first start for as long as its
    checkpoint lives; without ``number`` it is the session's setting, whatever cores there
    happen to be at that moment.
    """
    width = spark.conf.get(WIDTH)
    spark.conf.set(WIDTH, number or int(width))
    try:
        yield
    finally:
        spark.conf.set(WIDTH, width)


def _with_trigger(
    writer: DataStreamWriter, checkpoint: str, every: str | None, name: str | None = None
) -> DataStreamWriter:
    writer = writer.option("checkpointLocation", checkpoint)
    writer = writer.queryName(name) if name else writer
    return writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)


def start_table(
    df: DataFrame, path: str, checkpoint: str, every: str | None = None, name: str | None = None
) -> StreamingQuery:
    """Append to a Parquet folder whose log admits each micro-batch once.

    ``every`` sets the trigger interval; without it the query takes what is there and ends.
    """
    writer = df.writeStream.format("parquet").outputMode("append").option("path", path)
    return _with_trigger(writer, checkpoint, every, name).start()


def start_messages(
    messages: DataFrame, servers: str, topic: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Send ``(key, value)`` messages to a topic; needs the Kafka connector."""
    writer = messages.writeStream.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic)
    return _with_trigger(writer, checkpoint, every).start()


def start_console(df: DataFrame, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Print each micro-batch; for development."""
    writer = df.writeStream.format("console").outputMode("update").option("truncate", "false")
    return _with_trigger(writer, checkpoint, every).start()


def start_batches(
    df: DataFrame,
    write: Callable[[DataFrame, int], None],
    checkpoint: str,
    every: str | None = None,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call ``write(batch, batch_id)`` for each micro-batch; ``mode`` "update" for rows that replace earlier ones."""
    return _with_trigger(df.writeStream.outputMode(mode).foreachBatch(write), checkpoint, every, name).start()


def batch_totals_writer(
    path: str, names: Events = Events(), width: str = "10 seconds", scale: int | None = None
) -> Callable[[DataFrame, int], None]:
    """Writes each micro-batch's window totals to ``path/batch_id=N``, with ``processed_at``.

    A replayed batch overwrites its own folder. The totals are partial: a window may go on
    in the next batch (see ``merge_totals``).
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        totals = tumbling_totals(batch, names, width, scale).withColumn("processed_at", F.current_timestamp())
        totals.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def _counts(progress) -> dict[str, int]:
    operators = progress["stateOperators"]
    return {
        "batch_id": progress["batchId"],
        "raw_rows": progress["numInputRows"],
        "repeats": sum(int(o["customMetrics"].get("numDroppedDuplicateRows", 0)) for o in operators),
        "late": sum(int(o["numRowsDroppedByWatermark"]) for o in operators),
    }


def batch_counts(query: StreamingQuery) -> list[dict[str, int]]:
    """Of the latest micro-batches: rows read, repeats dropped by state, rows dropped as late.

    Taken from the query's own progress reports, so counting costs no job. ``late`` counts
    what reaches the state: events where dedup comes first, and one row per window and task
    where rows are combined before it. Spark keeps the last reports only (see ``CountLog``).
    """
    return [_counts(progress) for progress in query.recentProgress]


class CountLog(StreamingQueryListener):
    """Writes the counts of every micro-batch of one query to ``path/batch_id=N``.

    Add it to ``spark.streams`` before the query starts. A replayed batch overwrites its own
    file; a trigger without data reports nothing new and is left out.
    """

    def __init__(self, spark: SparkSession, path: str, name: str):
        self.spark, self.path, self.name = spark, path, name

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        progress = event.progress
        if progress.name != self.name or not progress.numInputRows:
            return
        counts = _counts(json.loads(progress.json))
        batch = counts.pop("batch_id")
        row = self.spark.range(1).select(*[F.lit(n).cast("long").alias(k) for k, n in counts.items()])
        row.coalesce(1).write.mode("overwrite").parquet(f"{self.path}/batch_id={batch}")
