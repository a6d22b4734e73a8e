"""Row features that depend on a user's earlier transactions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import finite_units, from_units, non_finite
from purseline.functions.temporal import with_event_time
from purseline.operators.heavy import HEAVY_ROWS
from purseline.operators.prefix import STATE, with_ordered_state
from purseline.schema import Transactions


def with_sequence_features(
    df: DataFrame,
    cols: Transactions = Transactions(),
    heavy_rows: int = HEAVY_ROWS,
    slices: int | None = None,
) -> DataFrame:
    """Add ``prev_amount``, ``amount_delta``, ``txn_rank`` and ``running_total``.

    The first transaction of a user has no previous amount and its whole amount as delta.
    The running total counts rows, not times, so tied rows have different totals. NaN and
    infinite amounts have no units; with a scale they are carried beside, as doubles, and give
    what doubles give.
    """
    ready = with_event_time(df, cols.time).withColumn("_amount", finite_units(F.col(cols.amount), cols.scale))
    odd = None
    if cols.scale is not None:
        odd = "_odd"
        ready = ready.withColumn(odd, F.when(non_finite(F.col(cols.amount)), F.col(cols.amount)))
    state = with_ordered_state(
        ready, cols.user, cols.order, "_amount", heavy_rows, slices, bool(cols.tiebreak), odd
    )
    previous, total = from_units(F.col("_prev"), cols.scale), from_units(F.col("_running"), cols.scale)
    delta = from_units(F.col("_amount") - F.coalesce("_prev", F.lit(0)), cols.scale)
    if odd:
        previous, total = F.coalesce("_prev_1", previous), F.coalesce("_running_1", total)
        either = F.col(odd).isNotNull() | F.col("_prev_1").isNotNull()
        own = F.coalesce(odd, from_units(F.col("_amount"), cols.scale))
        delta = F.when(either, own - F.coalesce("_prev_1", from_units(F.col("_prev"), cols.scale), F.lit(0.0))).otherwise(delta)
    return state.withColumns(
        {"prev_amount": previous, "amount_delta": delta, "txn_rank": F.col("_rank"), "running_total": total}
    ).drop("_amount", "_odd", *STATE)
