"""As-of join: to each row the latest one of another table, not later than itself."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.slices import AT, SLICE, in_slices, slice_count, slice_window, split_heavy, with_starts


def asof_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    left_time: str,
    right_time: str,
    carry: Sequence[str],
    tiebreak: Sequence[str] = (),
    within: str | None = None,
    heavy_rows: int = HEAVY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """All rows of ``left`` with the ``carry`` columns of their match in ``right``, NULL without one.

    The match has the same ``key`` and the latest time up to the row's own; of several with
    that time it is the last by ``tiebreak``, then by the carried values. ``within`` bounds its
    age. NULL keys and NULL times match nothing. Names in ``carry`` must be new to ``left``.

    Both tables are put in one order and the last row of ``right`` is carried on: one exchange
    and one sort, no join. Heavy keys are cut into slices, to which one row each is carried.
    """
    taken = sorted(set(carry) & set(left.columns))
    if taken:
        raise ValueError(f"columns {taken} are in the left table already")
    tie = [F.col(name) for name in dict.fromkeys((*tiebreak, *carry))]
    row = F.struct(*[F.col(f"`{name}`") for name in left.columns])
    found = F.struct(F.col(right_time).alias("_found"), *[F.col(name) for name in carry])
    usable = F.col(key).isNotNull() & F.col(right_time).isNotNull()
    given = right.where(usable).select(
        F.col(key).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_side"), F.struct(*tie).alias("_tie"), found.alias("_match")
    )
    asked = left.select(F.col(key).alias("_key"), F.col(left_time).alias("_time"), F.lit(1).alias("_side"), row.alias("_asked"))
    both = given.unionByName(asked, allowMissingColumns=True)
    light, heavy, rows, _ = split_heavy(both, "_key", heavy_rows)
    order = ("_time", "_side", "_tie")

    def latest(window):
        return F.last("_match", ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, Window.currentRow))

    out = light.withColumn("_last", latest(Window.partitionBy("_key").orderBy(*order)))
    if heavy is not None:
        sliced = in_slices(heavy, "_key", order, slices or slice_count(both, rows, heavy_rows))
        carried = with_starts(
            sliced,
            "_key",
            {"_open": F.max_by("_match", F.when(F.col("_match").isNotNull(), F.col(AT)))},
            lambda before: {"_open0": F.last("_open", ignorenulls=True).over(before)},
        )
        carried = carried.withColumn("_last", F.coalesce(latest(slice_window("_key")), F.col("_open0")))
        out = out.unionByName(carried.drop("_open0", SLICE, AT))
    out = out.where(F.col("_side") == 1)
    fits = F.col("_key").isNotNull() & F.col("_time").isNotNull()
    if within:
        fits &= F.col("_last._found") + F.expr(f"interval {within}") >= F.col("_time")
    return out.select("_asked.*", *[F.when(fits, F.col(f"_last.{name}")).alias(name) for name in carry])
