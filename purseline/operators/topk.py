"""The first rows of each group in an order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Parts of a group that are cut down before they meet.
PARTS = 64


def top_rows(
    df: DataFrame, group: str, order: Sequence[Column], k: int, ties: bool = False, position: str = "position"
) -> DataFrame:
    """The first ``k`` rows of each group, with their position from 1.

    Without ``ties`` exactly k rows stay; to be the same in every run, ``order`` must end in
    columns that tell the rows of a group apart. With ``ties`` all rows stay that have fewer
    than k before them, equal ones with equal positions; there may be more than k.

    Spark keeps the first k rows of each key in each task before it shuffles (a window with a
    limit). Groups are cut into ``PARTS`` by row hash first, so what the tasks of a hot group
    send meets in as many tasks, and at most k x PARTS rows of it in the last one.
    """
    if k < 1:
        raise ValueError("k is at least 1")
    number = F.rank if ties else F.row_number
    part = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in df.columns]), F.lit(PARTS))
    few = df.withColumn("_part", part)
    few = few.withColumn("_position", number().over(Window.partitionBy(group, "_part").orderBy(*order)))
    few = few.where(F.col("_position") <= k).drop("_position", "_part")
    out = few.withColumn(position, number().over(Window.partitionBy(group).orderBy(*order)))
    return out.where(F.col(position) <= k)
