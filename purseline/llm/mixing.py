"""Mixing sources to target weights by cube-method balanced sampling.

A source's target over its size is how often each of its documents should be taken. Whole
times are taken outright; the fraction is the inclusion probability of one more copy. The
flight phase moves these probabilities along vectors that change neither the expected number
of documents nor the expected words, until each is 0 or 1. It runs in blocks of bounded size;
what stays fractional in a block, two documents at most, goes on to blocks of the next round.
When a source is one block, the last two, which are among its smallest, land by dropping one
constraint after the other, the number of documents before their words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import column_of, fresh, words
from purseline.staging import stage

# Fixed values of the contract: weights by place of the source, most times a source is taken.
WEIGHTS = (5, 2, 1)
MOST_TIMES = 3

#: Documents in a block of the flight phase.
BLOCK = 8_192
#: Rows of one document from which on they are dealt to blocks one by one.
CROWD = 64
SEED = 20_240_229
TINY = 1e-9
#: Documents so many times the mean of their block are settled before the others.
LARGE = 2


def text_size(text: Column) -> Column:
    """Words of a text; 0 for NULL."""

    @F.pandas_udf("long")
    def count(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([len(words(x)) for x in texts], dtype="int64")

    return count.asNondeterministic()(text)


def source_targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, most: float = MOST_TIMES) -> DataFrame:
    """``(source, source_size, target)`` from documents' ``source`` and ``size``.

    Sources weigh ``weights`` in turn, in code point order with NULL last. Their shares of all
    words stop at ``most`` times their own; the excess goes to the others by weight, again
    until none is above. Numbering sorts the sources over all tasks, not in one.
    """
    spark = sizes.sparkSession
    own = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = own.orderBy(F.asc_nulls_last("source"))
    kind = dict(own.dtypes)["source"]
    numbered = order.rdd.zipWithIndex().map(lambda x: (x[0][0], x[0][1], x[1]))
    ranked = spark.createDataFrame(numbered, f"source {kind}, source_size long, place long")
    weight = F.element_at(F.array(*map(F.lit, weights)), (F.col("place") % len(weights) + 1).cast("int"))
    ranked = stage(ranked.select("source", "source_size", weight.cast("double").alias("weight")), "mix-sources")
    total = float(ranked.agg(F.sum("source_size")).first()[0] or 0)
    limit = F.col("source_size") * float(most)
    level, full = 0.0, -1
    while True:
        # Sources that the last level lifted to their limit are full; the rest share what is left.
        is_full = (F.col("weight") * level >= limit) if full >= 0 else F.lit(False)
        now, filled, left = ranked.agg(
            F.count(F.when(is_full, 1)), F.sum(F.when(is_full, limit)), F.sum(F.when(~is_full, F.col("weight")))
        ).first()
        if now == full or not left:
            break
        full, level = now, (total - (filled or 0.0)) / left
    return ranked.select("source", "source_size", F.least(F.col("weight") * level, limit).alias("target"))


def _direction(sizes: np.ndarray, at: int) -> np.ndarray:
    """The step nearest to moving only document ``at`` that changes neither the number nor the words."""
    n, words, squares = float(len(sizes)), float(sizes.sum()), float((sizes * sizes).sum())
    own = float(sizes[at])
    even = n * squares - words * words
    if even > TINY * n * squares:
        u = -((squares - words * own) + (n * own - words) * sizes) / even
    else:  # all of one size, so one constraint
        u = np.full(len(sizes), -1.0 / n)
    u[at] += 1.0
    return u


def flight(chances: np.ndarray, sizes: np.ndarray, draw: np.random.Generator, land: bool) -> np.ndarray:
    """Cube method with two constraints, the number of documents and their words.

    Every step goes up or down with chances that keep all expectations, and settles at least
    one document. Documents far over the mean come first, the largest ahead: the step that is
    nearest to moving such a document alone is shared by all the others, each of which hardly
    moves. The rest are settled three at a time, as three span one direction that keeps both
    sums. When it is to ``land``, all are settled in the first way, so that the two at most that
    are left are among the smallest; then the number is given up, and last the words.
    """
    out = chances.astype(np.float64).copy()
    sizes = sizes.astype(np.float64)

    def step(held: np.ndarray, u: np.ndarray) -> None:
        now = out[held]
        with np.errstate(divide="ignore", invalid="ignore"):
            rise, fall = (1 - now) / np.abs(u), now / np.abs(u)
        some = u != 0
        up = np.where(u > 0, rise, fall)[some].min()
        down = np.where(u > 0, fall, rise)[some].min()
        now = now + (up if draw.random() * (up + down) < down else -down) * u
        out[held] = np.where(now < TINY, 0.0, np.where(now > 1 - TINY, 1.0, now))

    def fractional(of: np.ndarray) -> np.ndarray:
        return of[(out[of] > TINY) & (out[of] < 1 - TINY)]

    held = fractional(np.arange(len(out)))
    first = held if land else held[sizes[held] > LARGE * sizes[held].mean()] if len(held) else held
    for i in first[np.argsort(-sizes[first], kind="stable")].tolist():
        while len(held) > 2 and 0.0 < out[i] < 1.0:
            at = int(np.searchsorted(held, i))
            u = _direction(sizes[held], at)
            if abs(u[at]) < TINY:
                break
            u[np.abs(u) < TINY * abs(u[at])] = 0.0
            step(held, u)
            held = fractional(held)
    open_ = np.empty(0, np.int64)
    for k in held.tolist():
        open_ = np.append(open_, k)
        if len(open_) == 3:
            a, b, c = sizes[open_].tolist()
            scale = max(abs(b - c), abs(c - a), abs(a - b))
            step(open_, np.array([(b - c) / scale, (c - a) / scale, (a - b) / scale] if scale else [1.0, -1.0, 0.0]))
            open_ = fractional(open_)
    if land:
        if len(open_) == 2:
            a, b = sizes[open_].tolist()
            most = max(a, b)
            step(open_, np.array([b / most, -a / most] if min(a, b) > 0 else [1.0, -1.0]))
        for i in fractional(open_).tolist():
            out[i] = 1.0 if draw.random() < out[i] else 0.0
    out[out <= TINY] = 0.0
    out[out >= 1 - TINY] = 1.0
    return out


def _fly(land: bool, number: int):
    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values(["size", "code", "row"], ascending=[False, True, True], kind="stable")
        name = f"{SEED}/{number}/{block['source'].iloc[0]!r}/{block['block'].iloc[0]}"
        draw = np.random.default_rng(zlib.crc32(name.encode("utf-8", "surrogatepass")))
        chance = flight(block["chance"].to_numpy(), block["size"].to_numpy(), draw, land)
        return block.assign(chance=chance)[["row", "source", "size", "code", "whole", "chance"]]

    return run


def _spread(units: DataFrame) -> DataFrame:
    """``units`` with other codes for rows of a document that repeats over ``CROWD`` times.

    They would all be dealt to one block; by code and row they go to all.
    """
    crowds = units.groupBy(F.col("code").alias("crowd")).agg(F.count("*").alias("n")).where(F.col("n") > CROWD)
    joined = units.join(crowds.drop("n"), F.col("code") == F.col("crowd"), "left")
    own = F.when(F.col("crowd").isNull(), F.col("code")).otherwise(F.xxhash64("code", "row"))
    return joined.withColumn("code", own).drop("crowd")


def balanced_copies(units: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(row, copies)`` from ``row``, ``source``, ``size``, ``code``, ``times``.

    ``code`` is a hash of the document that rows with different content hardly share; it deals
    documents to blocks, so that reruns and other partitionings choose alike. Only where one
    row is there over ``CROWD`` times do its copies go by their row numbers.
    """
    whole = F.floor("times").cast("long")
    state = _spread(units).select(
        "row", "source", "size", "code", whole.alias("whole"), (F.col("times") - whole).alias("chance")
    )
    kind = dict(units.dtypes)["source"]
    schema = f"row long, source {kind}, size long, code long, whole long, chance double"
    done, number = None, 0
    while True:
        counts = state.groupBy("source").agg(F.ceil(F.count("*") / block).alias("blocks"))
        most = counts.agg(F.max("blocks")).first()[0] or 1
        named = counts.withColumnRenamed("source", "of")
        dealt = state.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")
        place = F.pmod(F.xxhash64("code", F.lit(SEED + number)), F.col("blocks"))
        flown = dealt.withColumn("block", place).drop("blocks").groupBy("source", "block").applyInPandas(
            _fly(most == 1, number), schema
        )
        flown = stage(flown, "mix-flight")
        settled = flown.where("chance = 0 or chance = 1")
        done = settled if done is None else done.unionByName(settled)
        if most == 1:
            break
        state, number = flown.where("chance > 0 and chance < 1"), number + 1
    return done.select("row", (F.col("whole") + F.col("chance").cast("long")).alias("copies"))


def _mix(units: DataFrame) -> DataFrame:
    """Units with ``source_size``, ``target`` and ``copies``; ``units`` is a written table."""
    targets = stage(source_targets(units), "mix-targets").withColumnRenamed("source", "of")
    joined = units.join(targets, F.col("source").eqNullSafe(F.col("of"))).drop("of")
    times = F.coalesce(F.try_divide("target", F.col("source_size").cast("double")), F.lit(0.0))
    joined = stage(joined.withColumn("times", F.least(times, F.lit(float(MOST_TIMES)))), "mix-units")
    copies = balanced_copies(joined).withColumnRenamed("row", "at")
    return joined.join(copies, F.col("row") == F.col("at")).drop("at")


def mix_sources(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """Per input row ``id``, ``size``, ``source_size``, ``target`` and ``copies``, 0 to 3.

    NULL and empty texts have size 0; they are drawn like others of their source and add no
    words. A source without words has target 0 and is not taken. NULL is a source, the last.
    Repeated rows are drawn each for itself.
    """
    units = stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            F.col(id).alias("id"),
            F.col(source).alias("source"),
            text_size(F.col(text)).alias("size"),
            F.xxhash64(F.col(id), F.col(text)).alias("code"),
        ),
        "mix-documents",
    )
    return _mix(units).select(F.col("id").alias(id), "size", "source_size", "target", "copies")


def take_mix(docs: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``docs`` as the mix takes them: each row as often as it is drawn, or not at all.

    NULLs, empty texts and repeated rows are as in ``mix_sources``; names of columns do not matter.
    """
    row, size, at = (fresh(docs, name) for name in ("row", "size", "at"))
    held = stage(
        docs.withColumn(row, F.monotonically_increasing_id()).withColumn(size, text_size(column_of(text))), "mix-input"
    )
    units = held.select(
        F.col(row).alias("row"),
        column_of(source).alias("source"),
        F.col(size).alias("size"),
        F.xxhash64(column_of(id), column_of(text)).alias("code"),
    )
    drawn = _mix(stage(units, "mix-documents")).where("copies > 0").select(F.col("row").alias(at), "copies")
    times = fresh(docs, "copies")
    drawn = drawn.withColumnRenamed("copies", times)
    taken = held.join(drawn, F.col(row) == F.col(at))
    copy = fresh(docs, "copy")
    return taken.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(times)))).select(*map(column_of, docs.columns))


def mixing_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return mix_sources(docs).select(
        "doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )
