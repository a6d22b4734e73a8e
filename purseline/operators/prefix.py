"""Ordered state per key - previous value, position, running sum - without a heaviest task.

Light keys are windows, heavy ones slices (see ``slices``). Whole numbers and decimals add up
alike in any order. Doubles do not, so they are added in one fixed order on both ways: within
blocks of consecutive row numbers, then over blocks, then over blocks of blocks.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.slices import AT, SLICE, in_slices, slice_count, slice_window, split_heavy, with_starts
from purseline.staging import stage

STATE = ("_prev", "_rank", "_running", "_prev_1", "_running_1")

#: Rows whose doubles are added one after another, and such blocks; longer keys take several.
BLOCK = 1 << 16


def _after(start: Column, value: Column) -> Column:
    """Their sum, where a missing part counts as nothing."""
    return F.when(start.isNull(), value).when(value.isNull(), start).otherwise(start + value)


def _names(values: Sequence[str]) -> list[tuple[str, str]]:
    """Each value column and what its state's names end in; the first has the plain names."""
    return [(value, "" if i == 0 else f"_{i}") for i, value in enumerate(values)]


def _window_state(rows: WindowSpec, values: Sequence[str]) -> dict[str, Column]:
    up_to = rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = {"_rank": F.row_number().over(rows).cast("bigint")}
    for value, end in _names(values):
        state |= {f"_prev{end}": F.lag(value).over(rows), f"_running{end}": F.sum(value).over(up_to)}
    return state


def _sliced_state(sliced: DataFrame, key: str, values: Sequence[str]) -> DataFrame:
    """The same state, from within the slices and from those before."""
    ends = {"_n": F.count(F.lit(1))}
    for value, end in _names(values):
        ends |= {f"_s{end}": F.sum(value), f"_last{end}": F.max_by(value, AT)}

    def starts(before: WindowSpec) -> dict[str, Column]:
        out = {"_n0": F.sum("_n").over(before)}
        for _, end in _names(values):
            out |= {f"_s0{end}": F.sum(f"_s{end}").over(before), f"_last0{end}": F.last(f"_last{end}").over(before)}
        return out

    carried = with_starts(sliced, key, ends, starts)
    local = carried.withColumns(_window_state(slice_window(key), values))
    whole = {"_rank": F.col("_rank") + F.coalesce("_n0", F.lit(0))}
    for _, end in _names(values):
        first = F.col("_rank") == 1
        whole[f"_prev{end}"] = F.when(first, F.col(f"_last0{end}")).otherwise(F.col(f"_prev{end}"))
        whole[f"_running{end}"] = _after(F.col(f"_s0{end}"), F.col(f"_running{end}"))
    return local.withColumns(whole).drop(SLICE, AT)


def _blocked_running(ranked: DataFrame, key: str, value: str) -> DataFrame:
    """``_running`` added up by blocks of row numbers, whatever way the rows were ranked.

    A block is one task's window; so are the blocks of a block of blocks, of which even
    10^12 rows of one key make a few hundred.
    """
    number = F.expr(f"cast((_rank - 1) div {BLOCK} as bigint)")
    within = Window.partitionBy(key, "_block").orderBy("_rank").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = stage(
        ranked.withColumn("_block", number).withColumn("_running", F.sum(value).over(within)), "running-blocks"
    )
    blocks = rows.where(F.col("_rank") % BLOCK == 0).select(
        F.col(key).alias("_key"), F.col("_block").alias("_of"), F.col("_running").alias("_total")
    )
    blocks = blocks.withColumn("_group", F.expr(f"_of div {BLOCK}"))
    up_to = (Window.unboundedPreceding, Window.currentRow)
    blocks = blocks.withColumn(
        "_in_group", F.sum("_total").over(Window.partitionBy("_key", "_group").orderBy("_of").rowsBetween(*up_to))
    )
    groups = blocks.where(F.col("_of") % BLOCK == BLOCK - 1).select(
        F.col("_key").alias("_key2"),
        (F.col("_group") + 1).alias("_after"),
        F.sum("_in_group").over(Window.partitionBy("_key").orderBy("_group").rowsBetween(*up_to)).alias("_groups"),
    )
    # What lies before a block: the groups before its own, then the blocks of its group.
    before = blocks.select("_key", (F.col("_of") + 1).alias("_of"), "_in_group").withColumn(
        "_group", F.expr(f"_of div {BLOCK}")
    )
    before = before.withColumn("_in_group", F.when(F.col("_of") % BLOCK != 0, F.col("_in_group")))
    same = F.col("_key").eqNullSafe(F.col("_key2")) & (F.col("_group") == F.col("_after"))
    before = before.join(groups, same, "left").select("_key", "_of", _after(F.col("_groups"), F.col("_in_group")).alias("_base"))
    joined = rows.join(before, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_block") == F.col("_of")), "left")
    return joined.withColumn("_running", _after(F.col("_base"), F.col("_running"))).drop("_key", "_of", "_block", "_base")


def with_ordered_state(
    df: DataFrame,
    key: str,
    order: Sequence[str],
    value: str,
    heavy_rows: int = HEAVY_ROWS,
    slices: int | None = None,
    unique: bool = False,
    also: str | None = None,
) -> DataFrame:
    """Add ``_prev``, ``_rank`` and ``_running`` of ``value`` over each key's rows in ``order``.

    ``also`` names a second column, which gets ``_prev_1`` and ``_running_1``; its sums must not
    depend on the order.

    ``unique`` says that no two rows of a key are equal in ``order``. Running sums are the same
    to the last bit whichever keys count as heavy, and however many slices they have.

    Runs one small job at once, to learn which keys are heavy. Without any (the usual case)
    the plan is a single window: one hash exchange, one sort. Where doubles are added, keys
    of more than ``BLOCK`` rows cost a second exchange, by block.
    """
    values = [value] if also is None else [value, also]
    light, heavy, rows, largest = split_heavy(df, key, heavy_rows)
    inexact = isinstance(df.schema[value].dataType, (T.DoubleType, T.FloatType))
    out = light.withColumns(_window_state(Window.partitionBy(key).orderBy(*order), values))
    if heavy is not None:
        sliced = in_slices(heavy, key, order, slices or slice_count(df, rows, heavy_rows), unique)
        out = out.unionByName(_sliced_state(sliced, key, values).select(*out.columns))
    # A window adds up one block in order; slices, or keys of several blocks, need the blocks.
    blocked = inexact and (heavy is not None or largest > BLOCK)
    return _blocked_running(out, key, value).select(*out.columns) if blocked else out
