"""Set operations that count copies and give the rows back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.operators.quality import row_text

#: Copies of one row that one task gives back.
CHUNK = 100_000


def _counted(left: DataFrame, right: DataFrame) -> DataFrame:
    """``(_row, _left, _right)``: the MD5 of each different row and its copies on both sides."""
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    row = F.unhex(F.md5(row_text(left))).alias("_row")
    one, none = F.lit(1).cast("long"), F.lit(0).cast("long")
    sides = left.select(row, one.alias("_l"), none.alias("_r")).unionByName(
        right.select(row, none.alias("_l"), one.alias("_r"))
    )
    return sides.groupBy("_row").agg(F.sum("_l").alias("_left"), F.sum("_r").alias("_right"))


def _given_back(left: DataFrame, right: DataFrame, copies: Column) -> DataFrame:
    """Each row of ``left`` in as many copies as its counts ask for.

    Hashes and counts decide which rows are needed; these come from ``left``, one copy per
    hash. Copies are made in chunks dealt over tasks, so the row that is a third of a table
    is written by many.
    """
    wanted = _counted(left, right).select("_row", copies.alias("_copies")).where(F.col("_copies") > 0)
    row = F.unhex(F.md5(row_text(left))).alias("_of")
    whole = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    # Copies combine map side, on their 16 bytes.
    once = left.select(row, whole.alias("_whole")).groupBy("_of").agg(F.first("_whole").alias("_whole"))
    kept = once.join(wanted, F.col("_of") == F.col("_row"))
    chunks = F.sequence(F.lit(0).cast("long"), F.expr(f"(_copies - 1) div {CHUNK}"))
    dealt = kept.select("_whole", "_copies", F.explode(chunks).alias("_chunk")).hint("rebalance")
    here = F.least(F.lit(CHUNK).cast("long"), F.col("_copies") - F.col("_chunk") * CHUNK)
    return dealt.select("_whole", F.explode(F.sequence(F.lit(1).cast("long"), here))).select("_whole.*")


def except_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of ``left``, each as often as it is there more often than in ``right``.

    NULLs are equal to each other. Both tables need the same columns in the same order, of
    types that have a text; rows are told apart by the MD5 of their texts.
    """
    return _given_back(left, right, F.col("_left") - F.col("_right"))


def intersect_all(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows in both tables, each as often as in the one that has fewer copies of it."""
    return _given_back(left, right, F.least("_left", "_right"))
