"""Quality rules with cutoffs that labelled documents back by exact binomial bounds.

Each rule rejects a document whose ratio lies above a cutoff. Per stratum and rule, cutoffs
are tried from the loosest to the strictest on the documents labelled good. A cutoff passes
when its rejections are so few that, if it truly rejected more than the allowed share of good
documents, so few would be seen with a probability of at most ``delta`` over the number of
strata and rules. The first cutoff that does not pass ends the series (fixed-sequence
testing), so the order costs no correction; Bonferroni covers strata and rules. With
probability 1 - ``delta`` no rule of any stratum rejects more of its good documents than
``risk`` over the number of rules, hence all rules together at most ``risk``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.llm.common import SPACES, MemberFilter, column_of, fresh, words
from purseline.staging import stage

# Fixed values of the base rules.
SYMBOLS = "#*$%&|<>"
RUN = 8
FEWEST_WORDS = 20
MOST_REPEATED = 30

#: Share of good documents of a stratum that all rules together may reject, and the
#: probability that any stratum exceeds it.
RISK = 0.04
DELTA = 0.05

#: Cutoffs by rule, loosest first. They are set before any data is seen.
CUTOFFS: dict[str, list[float]] = {
    "symbols": [3.0, 2.0, 1.5, 1.0, 0.75, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1],
    "dup_lines": [0.9, 0.75, 0.6, 0.5, 0.4, 0.3],
    "repeats": [0.29, 0.27, 0.25, 0.2, 0.15],
    "capitals": [0.95, 0.8, 0.6, 0.5, 0.4, 0.3],
}

FEATURES = "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, n_lines long, n_capitals long, n_letters long"


def repeated_words(ids: np.ndarray, run: int = RUN) -> int:
    """Words inside runs of ``run`` ids that are found twice or more, the first included.

    Equal runs get equal numbers by doubling: 1, 2, 4, 8 words, each pair ranked anew, so
    no two different runs can meet.
    """
    n = len(ids) - run + 1
    if n < 2:
        return 0
    ranks, span = ids, 1
    while span < run:
        pairs = ranks[:-span] * np.int64(len(ids)) + ranks[span:]
        values, ranks = np.unique(pairs, return_inverse=True)
        span *= 2
        if len(values) == len(pairs) and span <= run:
            return 0  # all shorter runs differ, so all longer ones do
    twice = np.bincount(ranks)[ranks] > 1
    covered = np.zeros(len(ids) + 1, np.int64)
    starts = np.flatnonzero(twice)
    np.add.at(covered, starts, 1)
    np.add.at(covered, starts + run, -1)
    return int((np.cumsum(covered) > 0).sum())


def text_features(text: str | None) -> tuple[int, ...]:
    if not text:
        return (0,) * 8
    found = words(text)
    order: dict[bytes, int] = {}
    ids = np.fromiter((order.setdefault(word, len(order)) for word in found), np.int64, len(found))
    lines = [line for line in text.encode("utf-8", "surrogatepass").split(b"\n") if line.strip()]
    raw = text.encode("utf-8", "surrogatepass")
    return (
        len(found),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        repeated_words(ids),
        len(lines),
        len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ")),
        len(raw) - len(raw.translate(None, b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")),
    )


def features(text: Column) -> Column:
    """The measures of a text as a struct; those of a NULL text are 0."""

    @F.pandas_udf(FEATURES)
    def measure(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            yield pd.DataFrame([text_features(x) for x in texts], columns=[c.split()[0] for c in FEATURES.split(", ")])

    return measure.asNondeterministic()(text)


def base_failed(f: Column) -> Column:
    """Too short, or too much of it in repeated runs."""
    return (f["n_words"] < FEWEST_WORDS) | (f["n_repeat_words"] * 100 > f["n_words"] * MOST_REPEATED)


def ratios(f: Column) -> dict[str, Column]:
    def over(a: str, b: str) -> Column:
        return F.coalesce(F.try_divide(f[a].cast("double"), f[b].cast("double")), F.lit(0.0))

    return {
        "symbols": over("n_symbols", "n_words"),
        "dup_lines": over("n_dup_lines", "n_lines"),
        "repeats": over("n_repeat_words", "n_words"),
        "capitals": over("n_capitals", "n_letters"),
    }


def binomial_tail(k: int, n: int, p: float) -> float:
    """P(X <= k) of a binomial: the incomplete beta function at 1 - p, by continued fraction.

    The number of steps grows with the root of n, so counts may be of any size.
    """
    if k >= n:
        return 1.0
    a, b, x = n - k, k + 1, 1.0 - p
    if x <= 0.0 or x >= 1.0:
        return x
    flip = x > (a + 1) / (a + b + 2)
    if flip:
        a, b, x = b, a, p
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    ) / a
    c, d, i = 1.0, 1.0 - (a + b) * x / (a + 1), 0
    d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
    value = d
    while True:
        i += 1
        for step in (
            i * (b - i) * x / ((a + 2 * i - 1) * (a + 2 * i)),
            -(a + i) * (a + b + i) * x / ((a + 2 * i) * (a + 2 * i + 1)),
        ):
            d = 1.0 + step * d
            c = 1.0 + step / c
            d = 1.0 / (d if abs(d) > 1e-300 else 1e-300)
            c = c if abs(c) > 1e-300 else 1e-300
            value *= d * c
        if abs(d * c - 1.0) < 1e-14:
            break
    return 1.0 - front * value if flip else front * value


@F.pandas_udf(T.DoubleType())
def _tail(k: pd.Series, n: pd.Series, p: pd.Series) -> pd.Series:
    return pd.Series([binomial_tail(int(x), int(y), float(z)) for x, y, z in zip(k, n, p, strict=True)], dtype="float64")


def choose_cutoffs(
    good: DataFrame,
    stratum: str,
    values: Mapping[str, Column],
    cutoffs: Mapping[str, Sequence[float]] = CUTOFFS,
    risk: float = RISK,
    delta: float = DELTA,
) -> DataFrame:
    """One row per stratum: ``stratum`` and ``cutoffs``, a map from rule to chosen cutoff.

    ``good`` holds documents labelled good. A rule without a backed cutoff is not in the map
    and rejects nothing; NULL is a stratum of its own.
    """
    def cutoffs_below(rule: str, value: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cutoffs[rule])), lambda c: c < value))

    passed = [
        F.struct(F.lit(rule).alias("rule"), cutoffs_below(rule, value).alias("above"))
        for rule, value in values.items()
    ]
    rows = good.select(F.col(stratum).alias("stratum"), F.explode(F.array(*passed)).alias("x"))
    counts = rows.groupBy("stratum", F.col("x.rule").alias("rule"), F.col("x.above").alias("above")).count()
    # Cutoffs fall, so a value above the strictest `above` cutoffs is rejected by the last ones:
    # cutoff number j (0 the loosest) rejects values with at least len - j cutoffs below them.
    ladder = F.explode(F.sequence(F.lit(0), F.size("steps") - 1))
    per_rule = counts.groupBy("stratum", "rule").agg(
        F.sum("count").alias("n"), F.map_from_entries(F.collect_list(F.struct("above", "count"))).alias("by_above")
    )
    lists = F.create_map(*[x for r, cs in cutoffs.items() for x in (F.lit(r), F.array(*map(F.lit, cs)))])
    tried = per_rule.withColumn("steps", lists[F.col("rule")]).select("*", ladder.alias("step"))
    least = F.size("steps") - F.col("step")
    seen = F.aggregate(
        F.map_entries("by_above"),
        F.lit(0).cast("long"),
        lambda s, e: s + F.when(e["key"] >= least, e["value"]).otherwise(F.lit(0).cast("long")),
    )
    families = counts.select("stratum", "rule").distinct().count()
    share = risk / max(1, len(values))
    tested = tried.withColumn("seen", seen).withColumn("tail", _tail("seen", "n", F.lit(share)))
    order = Window.partitionBy("stratum", "rule").orderBy("step")
    backed = tested.withColumn(
        "all_so_far", F.min((F.col("tail") <= delta / max(1, families)).cast("int")).over(order)
    ).where("all_so_far = 1")
    chosen = backed.groupBy("stratum", "rule").agg(F.min(F.element_at("steps", F.col("step") + 1)).alias("cutoff"))
    return chosen.groupBy("stratum").agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("cutoffs"))


def good_documents(labels: DataFrame, id: str = "doc_id", label: str = "quality") -> DataFrame:
    """Ids that are labelled good and never bad; NULL ids and labels say nothing."""
    marks = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull())
    return marks.groupBy(F.col(id).alias("good_id")).agg(F.min(label).alias("least")).where("least >= 1").select("good_id")


def rejected(values: Mapping[str, Column], cutoffs: Column) -> Column:
    """Above any chosen cutoff; rules without one reject nothing."""
    out = F.lit(False)
    for rule, value in values.items():
        out = out | F.coalesce(value > cutoffs[rule], F.lit(False))
    return out


def _measure(
    docs: DataFrame, labels: DataFrame, id: str, text: str, stratum: str, label: str
) -> tuple[DataFrame, DataFrame]:
    """``(id, stratum, features)`` of every row, and the cutoffs that the labels back; both written."""
    slim = docs.select(F.col(id).alias("id"), F.col(stratum).alias("stratum"), features(F.col(text)).alias("features"))
    measured = stage(slim, "quality-features")
    good = measured.join(good_documents(labels, id, label), F.col("id") == F.col("good_id"), "left_semi")
    tested = choose_cutoffs(good.where(~base_failed(F.col("features"))), "stratum", ratios(F.col("features")))
    return measured, stage(tested, "quality-cutoffs")


def quality_verdicts(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
) -> DataFrame:
    """Per document its id, ``stratum``, the struct ``features``, ``base_failed`` and ``kept``.

    One row per input row: equal rows get equal verdicts. NULL and empty texts have no words
    and fail the base rules. Without labels no cutoff is backed and the base rules decide.
    """
    measured, chosen = _measure(docs, labels, id, text, stratum, label)
    joined = measured.join(
        chosen.withColumnRenamed("stratum", "of"), F.col("stratum").eqNullSafe(F.col("of")), "left"
    )
    failed = base_failed(F.col("features"))
    return joined.select(
        F.col("id").alias(id),
        "stratum",
        "features",
        failed.alias("base_failed"),
        (~failed & ~rejected(ratios(F.col("features")), F.col("cutoffs"))).alias("kept"),
    )


def keep_good(
    docs: DataFrame,
    labels: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    stratum: str = "lang",
    label: str = "quality",
) -> DataFrame:
    """The rows of ``docs`` that pass, with their columns.

    NULL and empty texts fail the base rules; equal rows pass together; an empty table stays
    empty, and names of columns do not matter. Every text is measured once, and those of
    labelled documents once before, for the cutoffs; a filter finds these without a shuffle.
    """
    measure, of, chosen = (fresh(docs, name) for name in ("features", "cutoffs_of", "cutoffs"))
    good = good_documents(labels, id, label)
    good = stage(good.withColumn("good_hash", F.xxhash64(F.col("good_id").cast("string"))), "quality-good")
    texts = docs.select(
        column_of(id).alias("id"),
        column_of(stratum).alias("stratum"),
        column_of(text).alias("body"),
        F.xxhash64(column_of(id).cast("string")).alias("hash"),
    )
    some = MemberFilter(good, "good_hash").split(texts, "hash")
    slim = stage(some.select("id", "stratum", features(F.col("body")).alias("features")), "quality-features")
    slim = slim.join(good, F.col("id") == F.col("good_id"), "left_semi").where(~base_failed(F.col("features")))
    backed = stage(choose_cutoffs(slim, "stratum", ratios(F.col("features"))), "quality-cutoffs")
    backed = backed.select(F.col("stratum").alias(of), F.col("cutoffs").alias(chosen))
    rows = docs.withColumn(measure, features(column_of(text))).where(~base_failed(F.col(measure)))
    rows = rows.join(backed, column_of(stratum).eqNullSafe(F.col(of)), "left")
    return rows.where(~rejected(ratios(F.col(measure)), F.col(chosen))).select(*map(column_of, docs.columns))


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The columns of the contract."""
    f = F.col("features")
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return quality_verdicts(docs, labels).select("doc_id", *[f[n].alias(n) for n in names], "base_failed", "kept")
