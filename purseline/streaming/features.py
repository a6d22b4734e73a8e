"""Per-user features kept up to date by a stream, in state that expires.

A user's history is cut into tenures: a tenure ends when nothing has come for the expiry
time. All that a tenure needs is one summary of fixed size, and two summaries can be merged
in any order. So events are summed up by user within each Arrow batch before they are
shuffled, and a user who sends a third of all events reaches the state as a few rows per task.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from purseline.functions.categories import category_flags
from purseline.functions.numeric import non_finite, to_units
from purseline.functions.temporal import time_parts
from purseline.operators.profile import Measures, amount_measures, category_measures, sequence_measures, temporal_measures
from purseline.operators.sliding import seconds
from purseline.schema import CATEGORIES, Transactions
from purseline.streaming.dedup import DELAY


#: What ``feature_updates`` gives, for reading stored updates back.
UPDATES = (
    "user string, tenure_start timestamp, last_seen timestamp, closed boolean, _rows bigint, _n bigint, _sum bigint, "
    "_max double, _min double, _stddev double, _log double, _timed bigint, _hours bigint, _days bigint, _weekend bigint, "
    "_months bigint, _last bigint, _labels array<bigint>"
)


@dataclass
class Tenure:
    """What is known of one tenure. Times are microseconds, amounts units of the last decimal."""

    first: int
    last: int
    last_tie: int
    last_units: int
    rows: int
    units: int
    least: float
    most: float
    logs: float
    mean: float
    apart: float  # sum of squared distances from the mean
    hours: int
    days: int
    weekend: int
    months: int
    labels: list[int]

    def merge(self, other: Tenure) -> Tenure:
        rows = self.rows + other.rows
        step = other.mean - self.mean
        late = max(self, other, key=lambda x: (x.last, x.last_tie, x.last_units))
        return Tenure(
            min(self.first, other.first),
            late.last,
            late.last_tie,
            late.last_units,
            rows,
            self.units + other.units,
            min(self.least, other.least),
            max(self.most, other.most),
            self.logs + other.logs,
            self.mean + step * other.rows / rows,
            self.apart + other.apart + step * step * self.rows * other.rows / rows,
            self.hours + other.hours,
            self.days + other.days,
            self.weekend + other.weekend,
            self.months | other.months,
            [a + b for a, b in zip(self.labels, other.labels, strict=True)],
        )


_NAMES = [x.name for x in fields(Tenure)]
_TYPES = {"least": "double", "most": "double", "logs": "double", "mean": "double", "apart": "double", "labels": "array<bigint>"}
_SUMMARY = ", ".join(f"{name} {_TYPES.get(name, 'bigint')}" for name in _NAMES)
_STATE = ", ".join(f"{name} array<{_TYPES.get(name, 'bigint')}>" for name in _NAMES)
# As the processor gives them, times are numbers, which have no zone.
_OUTPUT = UPDATES.replace("timestamp,", "bigint,")


def merged(tenures: Iterator[Tenure] | list[Tenure], expiry: int) -> list[Tenure]:
    """The tenures by time, put together where less than ``expiry`` or just that lies between."""
    out: list[Tenure] = []
    for tenure in sorted(tenures, key=lambda x: (x.first, x.last, x.last_tie)):
        if out and tenure.first - out[-1].last <= expiry:
            out[-1] = out[-1].merge(tenure)
        else:
            out.append(tenure)
    return out


def summaries(events: pd.DataFrame, expiry: int) -> pd.DataFrame:
    """One row per user and tenure of a batch of events."""
    rows = events.sort_values(["user", "micros", "tie", "units"], kind="stable", na_position="first")
    user = rows["user"].fillna("").to_numpy(), rows["user"].isna().to_numpy()
    micros = rows["micros"].to_numpy()
    new = np.ones(len(rows), bool)
    if len(rows) > 1:
        new[1:] = (user[0][1:] != user[0][:-1]) | (user[1][1:] != user[1][:-1]) | (np.diff(micros) > expiry)
    rows = rows.assign(tenure=np.cumsum(new))
    rows["apart"] = (rows["amount"] - rows.groupby("tenure")["amount"].transform("mean")) ** 2
    rows["labels"] = rows["labels"].map(np.asarray)
    grouped = rows.groupby("tenure", sort=False)
    end = grouped.tail(1)
    out = pd.DataFrame(
        {
            "user": end["user"].to_numpy(),
            "first": grouped["micros"].first().to_numpy(),
            "last": end["micros"].to_numpy(),
            "last_tie": end["tie"].to_numpy(),
            "last_units": end["units"].to_numpy(),
            "rows": grouped.size().to_numpy(),
            "units": grouped["units"].sum().to_numpy(),
            "least": grouped["amount"].min().to_numpy(),
            "most": grouped["amount"].max().to_numpy(),
            "logs": grouped["log"].sum().to_numpy(),
            "mean": grouped["amount"].mean().to_numpy(),
            "apart": grouped["apart"].sum().to_numpy(),
            "hours": grouped["hour"].sum().to_numpy(),
            "days": grouped["day"].sum().to_numpy(),
            "weekend": grouped["weekend"].sum().to_numpy(),
            "months": [int(np.bitwise_or.reduce(x.to_numpy())) for _, x in grouped["month"]],
        }
    )
    starts = np.flatnonzero(new)
    flags = np.stack(rows["labels"].to_list()).reshape(len(rows), -1)
    out["labels"] = list(np.add.reduceat(flags, starts, axis=0)) if len(rows) else []
    return out


def _output(user: str, tenure: Tenure, closed: bool) -> tuple:
    deviation = math.sqrt(tenure.apart / (tenure.rows - 1)) if tenure.rows > 1 else None
    return (
        (user, tenure.first, tenure.last, closed, tenure.rows, tenure.rows, tenure.units, tenure.most, tenure.least, deviation, tenure.logs)
        + (tenure.rows, tenure.hours, tenure.days, tenure.weekend, tenure.months, tenure.last_units, tenure.labels)
    )


def _gone(user: str, start: int, labels: int) -> tuple:
    """A row that takes back what was said of a tenure that now is part of another."""
    return (user, start, start, True, 0, 0, 0, None, None, None, None, 0, 0, 0, 0, 0, None, [0] * labels)


def _keeper(expiry: int, labels: int):
    """The state processor: merges what came, tells the tenures that changed, drops those that expired."""
    columns = [x.split()[0] for x in _OUTPUT.split(", ")]

    def keep(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = [Tenure(*x) for x in zip(*state.get, strict=True)] if state.exists else []
        before = {x.first for x in held}
        touched: list[tuple[int, int]] = []
        come: list[Tenure] = []
        for batch in batches:
            for row in batch[_NAMES].itertuples(index=False):
                values = row._asdict()
                numbers = {k: v if isinstance(v, float) else int(v) for k, v in values.items() if k != "labels"}
                come.append(Tenure(**numbers, labels=[int(x) for x in values["labels"]]))
        touched = [(x.first, x.last) for x in come]
        tenures = merged([*held, *come], expiry)
        # Past the last event by more than the expiry, nothing can come any more that belongs to it.
        mark = state.getCurrentWatermarkMs() * 1_000
        open_ones = [x for x in tenures if x.last + expiry >= mark]
        out = [_output(key[0], x, False) for x in open_ones if any(x.first <= a and b <= x.last for a, b in touched)]
        out += [_output(key[0], x, True) for x in tenures if x.last + expiry < mark]
        out += [_gone(key[0], start, labels) for start in sorted(before - {x.first for x in tenures})]
        if open_ones:
            state.update(tuple([getattr(x, name) for x in open_ones] for name in _NAMES))
            state.setTimeoutTimestamp(max((min(x.last for x in open_ones) + expiry) // 1_000, mark // 1_000) + 1)
        else:
            state.remove()
        yield pd.DataFrame(out, columns=columns)

    return keep


def feature_updates(
    events: DataFrame,
    cols: Transactions,
    labels: Sequence[str] = CATEGORIES,
    expiry: str = "30 days",
    delay: str = DELAY,
) -> DataFrame:
    """A stream of feature rows: after each micro-batch those of all users that it met.

    A row has the user, ``tenure_start``, ``last_seen``, ``closed`` and the statistics that the
    feature table has, except the category index, which needs the whole table. It replaces
    earlier rows of its user and tenure start; ``transaction_count`` 0 takes them back, where
    an event that came late has moved the start or joined two tenures. A tenure is closed, and
    its state dropped, when the watermark has passed its last event by more than ``expiry``.

    Results do not depend on the order of arrival within ``delay``. Amounts must be above 0
    and finite and the time known, as in the table's own filter; other events are left out. A
    NULL user is a user. ``cols`` needs a ``scale``, and a whole number as its only tie-break.
    """
    if cols.scale is None or len(cols.tiebreak) != 1:
        raise ValueError("online features need the scale of amounts and one tie-break")
    gap, amount, time = seconds(expiry) * 1_000_000, F.col(cols.amount), F.col(cols.time)
    usable = events.where((amount > 0) & ~non_finite(amount) & time.isNotNull())
    parts = time_parts(time)
    flags = [F.coalesce(flag.cast("long"), F.lit(0)) for flag in category_flags(F.col(cols.category), labels).values()]
    rows = usable.select(
        F.col(cols.user).cast("string").alias("user"),
        F.unix_micros(time.cast("timestamp")).alias("micros"),
        F.coalesce(F.col(cols.tiebreak[0]).cast("long"), F.lit(-(2**63))).alias("tie"),
        amount.cast("double").alias("amount"),
        to_units(amount, cols.scale).alias("units"),
        F.log1p(amount).alias("log"),
        *[parts[name].cast("long").alias(short) for name, short in _PARTS.items()],
        F.call_function("shiftleft", F.lit(1).cast("long"), parts["month"]).alias("month"),
        (F.array(*flags) if flags else F.array().cast("array<bigint>")).alias("labels"),
    )

    def sum_up(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield summaries(batch, gap)

    summed = rows.mapInPandas(sum_up, f"user string, {_SUMMARY}")
    summed = summed.withColumn("seen", F.timestamp_micros("last")).withWatermark("seen", delay)
    told = summed.groupBy("user").applyInPandasWithState(
        _keeper(gap, len(labels)), _OUTPUT, _STATE, "update", GroupStateTimeout.EventTimeTimeout
    )
    return told.withColumns({name: F.timestamp_micros(name) for name in ("tenure_start", "last_seen")})


_PARTS = {"hour_of_day": "hour", "day_of_week": "day", "is_weekend": "weekend"}


def _measures(df: DataFrame, cols: Transactions, labels: Sequence[str]) -> Measures:
    return amount_measures(cols) + temporal_measures(cols) + category_measures(cols, labels, None) + sequence_measures(df, cols)


def current_features(updates: DataFrame, cols: Transactions, labels: Sequence[str] = CATEGORIES) -> DataFrame:
    """Of stored updates with their ``batch_id``, the latest row of each tenure, as features.

    The features are computed from the state by the expressions of the feature table.
    """
    newest = [name for name in updates.columns if name not in ("user", "tenure_start")]
    kept = updates.groupBy("user", "tenure_start").agg(F.max(F.struct("batch_id", *[n for n in newest if n != "batch_id"])).alias("_new"))
    kept = kept.select("user", "tenure_start", "_new.*").where(F.col("_rows") > 0)
    nothing = {"_special": F.lit(None).cast("double"), "_odd": F.lit(0), "_last_special": F.lit(None).cast("double")}
    counts: dict[str, Column] = {f"_{label.lower()}_count": F.get("_labels", F.lit(i)) for i, label in enumerate(labels)}
    ready = kept.withColumns(nothing | counts)
    template = updates.sparkSession.createDataFrame([], f"`{cols.user}` string, `{cols.amount}` double, `{cols.time}` timestamp, `{cols.tiebreak[0]}` bigint")
    outputs = _measures(template, cols, labels).outputs
    return ready.select("user", "tenure_start", "last_seen", "closed", *[value.alias(name) for name, value in outputs.items()])
