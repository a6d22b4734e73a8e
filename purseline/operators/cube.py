"""Totals over several groupings at once: cube, rollup and chosen sets."""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.functions.numeric import ratio, sum_of_states, sum_states

#: How each partial state of a group is made from rows, and from the states of finer groups.
_MERGED = {"_rows": F.sum, "_n": F.sum, "_sum": F.sum, "_special": F.sum, "_min": F.min, "_max": F.max}


def cube_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [kept for n in range(len(dims), -1, -1) for kept in combinations(dims, n)]


def rollup_sets(dims: Sequence[str]) -> list[tuple[str, ...]]:
    return [tuple(dims[:n]) for n in range(len(dims), -1, -1)]


def grouped_totals(
    df: DataFrame, dims: Sequence[str], amount: str, sets: Sequence[Sequence[str]], scale: int | None = None
) -> DataFrame:
    """Per group of each set: ``row_count``, ``amount_count``, ``total``, ``mean``, ``least``, ``most``.

    Columns that a set does not group by are NULL, and ``grouping_id`` tells these from NULLs
    in the data: the bits of ``dims``, first highest, that are not grouped by. A set given
    twice comes once. The set without columns has one row, on an empty table as well.

    Rows are read and summed once, by the finest grouping that the sets need. Only its states,
    map side combined, are then multiplied by the sets and merged, so neither the rows nor a
    hot group are ever repeated.
    """
    wanted = list(dict.fromkeys(tuple(name for name in dims if name in kept) for kept in sets))
    unknown = {name for kept in sets for name in kept} - set(dims)
    if unknown or not wanted:
        raise ValueError(f"sets must name some of {list(dims)}; not {sorted(unknown)}")
    finest = [name for name in dims if any(name in kept for kept in wanted)]
    states = {
        "_rows": F.count(F.lit(1)),
        "_n": F.count(amount),
        **sum_states(F.col(amount), scale),
        "_min": F.min(amount),
        "_max": F.max(amount),
    }
    fine = df.groupBy(*finest).agg(*[state.alias(name) for name, state in states.items()])

    def identity(kept: Sequence[str]) -> int:
        return sum(1 << (len(dims) - 1 - i) for i, name in enumerate(dims) if name not in kept)

    # Each state once per set, with the columns of the set; what is left out is NULL.
    groups = [
        F.struct(
            *[(F.col(name) if name in kept else F.lit(None).cast(df.schema[name].dataType)).alias(name) for name in dims],
            F.lit(identity(kept)).cast("long").alias("grouping_id"),
        )
        for kept in wanted
        if kept or not finest
    ]
    keys = [*dims, "grouping_id"]
    out = None
    if groups and finest:
        spread = fine.select(F.explode(F.array(*groups)).alias("_group"), *states).select("_group.*", *states)
        out = spread.groupBy(*keys).agg(*[_MERGED[name](name).alias(name) for name in states])
    if () in wanted:  # grouped by nothing, so that there is a row even without rows
        total = fine.agg(*[_MERGED[name](name).alias(name) for name in states]) if finest else fine
        nulls = [F.lit(None).cast(df.schema[name].dataType).alias(name) for name in dims]
        total = total.select(*nulls, F.lit(identity(())).cast("long").alias("grouping_id"), *states)
        out = total if out is None else out.unionByName(total)
    count = {name: F.coalesce(F.col(name), F.lit(0)) for name in ("_rows", "_n")}
    total = sum_of_states(scale)
    return out.select(
        *keys,
        count["_rows"].alias("row_count"),
        count["_n"].alias("amount_count"),
        total.alias("total"),
        ratio(total, F.col("_n")).alias("mean"),
        F.col("_min").alias("least"),
        F.col("_max").alias("most"),
    )
