"""Reproducibility checks: a fingerprint of a table, and how two tables differ."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def row_text(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """The columns as text that no other values give: each with its length before it, NULL as -.

    Arrays, maps and structs are written as JSON, as their plain texts are ambiguous.
    """

    def field(name: str) -> Column:
        value = F.col(f"`{name}`")
        nested = isinstance(df.schema[name].dataType, (T.ArrayType, T.MapType, T.StructType))
        text = F.when(value.isNotNull(), F.to_json(F.struct(value))) if nested else value.cast("string")
        return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("-"))

    names = df.columns if columns is None else columns
    return F.concat(*map(field, names)) if names else F.lit("")


def table_fingerprint(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: 16 hex digits that identify the rows, whatever their order, and their number.

    Each row is hashed by MD5, whose four 32-bit parts are added up each for itself, as
    decimals that no table overflows; the fingerprint is a SHA-256 of the sums and the count.
    """
    row = F.md5(row_text(df, columns))
    parts = [F.conv(F.substring(row, 1 + 8 * i, 8), 16, 10).cast("decimal(10,0)").alias(f"p{i}") for i in range(4)]
    halves = df.select(*parts).agg(
        *[F.coalesce(F.sum(f"p{i}"), F.lit(0)).cast("string").alias(f"p{i}") for i in range(4)],
        F.count(F.lit(1)).alias("row_count"),
    )
    digest = F.sha2(F.concat_ws(":", "p0", "p1", "p2", "p3", F.col("row_count").cast("string")), 256)
    return halves.select(F.substring(digest, 1, 16).alias("fingerprint"), "row_count")


def table_diff(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows found only left or only right, counted with their copies; two rows of counts.

    One grouping over both tables instead of two set differences. Rows are shuffled as their
    MD5 and a weight, so the width of the tables does not count; copies combine map side.
    """
    row = F.unhex(F.md5(row_text(left))).alias("_row")
    sides = left.select(row, F.lit(1).alias("_weight")).unionByName(right.select(row, F.lit(-1).alias("_weight")))
    balance = sides.groupBy("_row").agg(F.sum("_weight").alias("balance")).where(F.col("balance") != 0)
    totals = balance.agg(
        F.coalesce(F.sum(F.when(F.col("balance") > 0, F.col("balance"))), F.lit(0)).alias("left_only"),
        F.coalesce(F.sum(F.when(F.col("balance") < 0, -F.col("balance"))), F.lit(0)).alias("right_only"),
    )
    return totals.unpivot([], ["left_only", "right_only"], "side", "differing_rows")
