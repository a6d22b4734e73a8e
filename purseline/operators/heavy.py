"""Finding the few keys that hold too many rows for one task."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Rows of one key that a single task sorts comfortably.
HEAVY_ROWS = 20_000_000


def key_sizes(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> tuple[list[tuple], int]:
    """``(key, rows)`` of all keys with more than ``heavy_rows`` rows, and the rows of the largest key.

    There are fewer than rows / ``heavy_rows`` heavy keys: 50,000 in 10^12 rows. One may be None.

    Reads the key column only and counts map side: a heavy key is one row per map task.
    """
    counts = df.groupBy(F.col(key).alias("item")).agg(F.count(F.lit(1)).alias("rows"))
    found = counts.agg(
        F.max("rows").alias("largest"),
        F.collect_list(F.when(F.col("rows") > heavy_rows, F.struct("rows", "item"))).alias("heavy"),
    ).first()
    heavy = sorted(found["heavy"], key=lambda row: (-row["rows"], str(row["item"])))
    return [(row["item"], row["rows"]) for row in heavy], found["largest"] or 0


def heavy_keys(df: DataFrame, key: str, heavy_rows: int = HEAVY_ROWS) -> list[tuple]:
    """``(key, rows)`` of all keys with more than ``heavy_rows`` rows, largest first."""
    return key_sizes(df, key, heavy_rows)[0]
