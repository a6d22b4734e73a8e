"""Removing repeated deliveries in a static table, and counting them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def dedup_events(df: DataFrame, keys: Sequence[str], time: str) -> DataFrame:
    """One row per key: the earliest, and among equally early ones the smallest.

    Rows with a NULL in their key are events of their own and all stay. Which copy survives
    does not depend on partitioning. The table is read once; of each key every task keeps one
    row before the exchange (a window with a limit), so a key delivered a billion times, or
    a NULL on a third of the rows, meets no task of its own.
    """
    rest = [name for name in df.columns if name not in (*keys, time)]
    unnamed = F.lit(False)
    for name in keys:
        unnamed |= F.col(f"`{name}`").isNull()
    # A row without a key is alone in its window.
    alone = F.when(unnamed, F.monotonically_increasing_id()).otherwise(F.lit(-1))
    order = [F.col(f"`{name}`") for name in (time, *rest)]
    first = Window.partitionBy("_alone", *[F.col(f"`{name}`") for name in keys]).orderBy(*order)
    placed = df.withColumn("_alone", alone).withColumn("_place", F.row_number().over(first))
    return placed.where(F.col("_place") == 1).drop("_alone", "_place")


def dedup_metrics(df: DataFrame, key: str, batch: Column) -> DataFrame:
    """Per batch: delivered rows, different keys and the difference; each NULL key is different."""
    counted = df.groupBy(batch.alias("batch")).agg(
        F.count(F.lit(1)).alias("raw_rows"), (F.count_distinct(key) + F.count_if(F.col(key).isNull())).alias("distinct_rows")
    )
    return counted.withColumn("dropped_rows", F.col("raw_rows") - F.col("distinct_rows"))
