"""Session settings of the two jobs. Library functions always take an existing session."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Wall-clock times without a zone are read as UTC, files carry microsecond timestamps.
# AQE stays on: it merges small shuffle partitions, so the width below is an upper bound.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
}

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def build_session(
    app: str,
    master: str | None = None,
    shuffle_partitions: int | None = None,
    log_level: str = "WARN",
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session for a command line job; unset values are left to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", shuffle_partitions)
    for name, value in {**SETTINGS, **(extra or {})}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel(log_level)
    return spark
