"""Message topics: the Kafka connector, and folders of messages with the same shape."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from purseline.schema import ENVELOPE_SCHEMA

MESSAGE_SCHEMA = T.StructType([ENVELOPE_SCHEMA["value"]])


def topic_options(
    servers: str, topic: str, starting: str = "latest", max_per_trigger: int | None = None, now_ms: int | None = None
) -> dict[str, str]:
    """Source options. ``starting`` counts only while the checkpoint is empty.

    Two queries that both start at "latest" each look for it themselves, and a message that
    comes between is in one only. With ``now_ms`` "latest" is the first message from that time
    on, or the next one to come, which is the same place for every query. ``max_per_trigger``
    bounds a micro-batch, so a backlog is worked off in even steps.
    """
    options = {"kafka.bootstrap.servers": servers, "subscribe": topic, "startingOffsets": starting}
    if starting == "latest" and now_ms is not None:
        del options["startingOffsets"]
        options |= {"startingTimestamp": str(now_ms), "startingOffsetsByTimestampStrategy": "latest"}
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def read_topic(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    """Stream of messages from a topic; needs the Kafka connector on the class path."""
    return spark.readStream.format("kafka").options(**options).load()


def read_message_files(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """Stream of messages from Parquet files that appear under ``path``."""
    reader = spark.readStream.schema(MESSAGE_SCHEMA)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path)


def write_topic(messages: DataFrame, servers: str, topic: str) -> None:
    """Send a static frame of ``(key, value)`` messages; each task sends its own rows."""
    messages.write.format("kafka").option("kafka.bootstrap.servers", servers).option("topic", topic).save()


def write_message_files(messages: DataFrame, path: str) -> None:
    """Append messages as Parquet files, values as bytes like those of a topic."""
    messages.selectExpr("CAST(value AS BINARY) AS value").write.mode("append").parquet(path)
