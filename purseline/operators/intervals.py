"""Joining points in time with the intervals that hold them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells of a level are so many times as long as those of the level below; level 0 has microseconds.
BASE = 16
LEVELS = 15


def _length(level: str) -> str:
    """Microseconds in a cell of the level, as SQL."""
    return f"shiftleft(cast(1 as bigint), 4 * {level})"


def _cell(place: str, level: str) -> Column:
    """Number of the cell; whole numbers throughout, floored below 0 as well."""
    return F.expr(f"({place} - pmod({place}, {_length(level)})) div {_length(level)}")


def _level(length: Column) -> Column:
    """The first level whose cells are as long as the interval, so that it meets two of them at most."""
    level = F.lit(LEVELS)
    for i in reversed(range(LEVELS)):
        level = F.when(length <= F.lit(BASE**i), i).otherwise(level)
    return level


def interval_join(
    points: DataFrame, intervals: DataFrame, key: str, at: str, start: str, end: str, how: str = "inner"
) -> DataFrame:
    """Pairs of a point and an interval [start, end) of the same ``key`` that holds it.

    Names must differ between the two tables but for ``key``, which is given once. Intervals
    without a length or a bound, NULL keys and points without a time match nothing; with
    ``how`` "left" such points, like all without an interval, come once with NULLs.

    Each interval lies in the one or two cells that it meets on the level of its length, each
    point in one cell of every level in use. So the join is by equality, each pair meets once,
    and at most 2 rows per interval and 16 per point are moved; a cell holds intervals that
    are longer than a sixteenth of it only, so most of what meets there belongs together.
    """
    if how not in ("inner", "left"):
        raise ValueError("how is inner or left")
    lengths = intervals.where(F.col(key).isNotNull()).withColumns(
        {"_from": F.unix_micros(F.col(start).cast("timestamp")), "_to": F.unix_micros(F.col(end).cast("timestamp"))}
    )
    lengths = lengths.where(F.col("_from") < F.col("_to")).withColumn("_level", _level(F.col("_to") - F.col("_from")))
    used = [row["_level"] for row in lengths.select("_level").distinct().collect()]  # 16 numbers at most
    first, last = _cell("_from", "_level"), _cell("(_to - 1)", "_level")
    # Two cells at most; where both are the same one, the interval is there once.
    cells = F.array_distinct(F.array(first, last))
    stored = lengths.withColumn("_cell", F.explode(cells)).withColumnRenamed(key, "_key")
    placed = points.withColumn("_at", F.unix_micros(F.col(at).cast("timestamp")))
    levels = F.array(*[F.lit(i) for i in sorted(used)]).cast("array<int>")
    probes = placed.where(F.col(key).isNotNull() & F.col("_at").isNotNull()).withColumn("_on", F.explode(levels))
    probes = probes.withColumn("_in", _cell("_at", "_on"))
    same = (F.col(key) == F.col("_key")) & (F.col("_on") == F.col("_level")) & (F.col("_in") == F.col("_cell"))
    holds = (F.col("_from") <= F.col("_at")) & (F.col("_at") < F.col("_to"))
    pairs = probes.join(stored, same & holds)
    helpers = ("_key", "_on", "_in", "_at", "_from", "_to", "_level", "_cell")
    if how == "inner":
        return pairs.drop(*helpers)
    # Points of equal key and time have a match together or not at all.
    matched = pairs.select(F.col(key).alias("_with"), F.col("_at").alias("_when")).distinct()
    alone = placed.join(matched, (F.col(key) == F.col("_with")) & (F.col("_at") == F.col("_when")), "left_anti")
    return pairs.drop(*helpers).unionByName(alone.drop("_at"), allowMissingColumns=True)
