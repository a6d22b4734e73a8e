"""Parquet tables in and out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from purseline.schema import Transactions

TIMESTAMP_TYPE = "spark.sql.parquet.outputTimestampType"


def read_transactions(
    spark: SparkSession, path: str, cols: Transactions = Transactions(), schema: T.StructType | None = None
) -> DataFrame:
    """All Parquet files under ``path``, the bound columns only, checked before use.

    With a ``schema`` no footer is read to plan the query.
    """
    reader = spark.read.schema(schema) if schema else spark.read
    return cols.check(reader.parquet(path)).select(*cols.required)


def write_table(df: DataFrame, path: str, rows_per_file: int | None = None, mode: str = "overwrite") -> None:
    """Write Parquet, by default in place of what was there.

    ``rows_per_file`` splits large tasks' output; it moves no rows. Timestamps get
    microseconds, which Spark sets per session, so the setting is put back after the write.
    """
    conf = df.sparkSession.conf
    writer = df.write.mode(mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    before = conf.get(TIMESTAMP_TYPE)
    conf.set(TIMESTAMP_TYPE, "TIMESTAMP_MICROS")
    try:
        writer.parquet(path)
    finally:
        conf.set(TIMESTAMP_TYPE, before)
