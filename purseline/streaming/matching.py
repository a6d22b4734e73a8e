"""Joining two streams within a span of time."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.streaming.dedup import DELAY


def _salt(rows: DataFrame, key: str, hot: Sequence, salt: Column) -> DataFrame:
    """``_salt``: of rows of hot keys as given, of all others 0."""
    named = F.col(key).isin(list(hot)) if len(hot) else F.lit(False)
    return rows.withColumn("_salt", F.when(named, salt).otherwise(F.lit(0)))


def match_earlier(
    later: DataFrame,
    earlier: DataFrame,
    key: str,
    later_time: str,
    earlier_time: str,
    within: str,
    how: str = "inner",
    delay: str = DELAY,
    hot: Sequence = (),
    salts: int = 16,
) -> DataFrame:
    """Pairs of a row of ``later`` and one of ``earlier`` with its key, at most ``within`` before it.

    Rows of equal time are pairs. Names must differ but for ``key``, which is given once. Both
    sides are kept in state: a row of ``earlier`` until the watermark, the lesser one of the two
    streams, is past its time by ``within``, a row of ``later`` until it is past its time. With
    ``how`` "leftOuter" a row of ``later`` without a match comes out with NULLs then. NULL
    keys match nothing. Rows that arrive behind the watermark are dropped.

    One task keeps all rows of a key. For keys in ``hot``, rows of ``later`` are dealt over
    ``salts`` tasks and rows of ``earlier`` given to each, so a busy key costs that many copies
    of one side instead of a task for the whole; results are the same.
    """
    if how not in ("inner", "leftOuter"):
        raise ValueError("how is inner or leftOuter")
    spread = F.pmod(F.xxhash64(*[F.col(f"`{name}`") for name in later.columns]), F.lit(salts)).cast("int")
    first = _salt(later.withWatermark(later_time, delay), key, hot, spread)
    second = earlier.withWatermark(earlier_time, delay).withColumnRenamed(key, "_key")
    all_salts = F.sequence(F.lit(0), F.lit(salts - 1))
    many = F.when(F.col("_key").isin(list(hot)), all_salts).otherwise(F.array(F.lit(0))) if len(hot) else F.array(F.lit(0))
    second = second.withColumn("_part", F.explode(many))
    near = (F.col(earlier_time) <= F.col(later_time)) & (
        F.col(earlier_time) >= F.col(later_time) - F.expr(f"interval {within}")
    )
    same = (F.col(key) == F.col("_key")) & (F.col("_salt") == F.col("_part"))
    return first.join(second, same & near, how).drop("_key", "_salt", "_part")
