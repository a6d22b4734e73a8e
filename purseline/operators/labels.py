"""Label index: labels numbered by falling frequency, equal frequencies by label."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from purseline.operators.prefix import with_ordered_state
from purseline.sources.local import local_table
from purseline.staging import stage

# So many labels, the most frequent ones, come to the driver and are broadcast.
LOCAL_LABELS = 1_000


@dataclass(frozen=True)
class LabelIndex:
    """A fitted index: ``_label`` and ``_index`` for every label, split by frequency.

    ``common`` has at most ``LOCAL_LABELS`` rows and is safe to broadcast. ``rare`` is None
    unless there are more labels; each of those is on less than 1/LOCAL_LABELS of the rows,
    so a join by label meets no hot key.
    """

    common: DataFrame
    rare: DataFrame | None
    size: int

    def apply(self, df: DataFrame, column: str, output: str = "category_index") -> DataFrame:
        """Add the index as double; NULL and unseen labels get the number of labels."""
        text = F.col(column).cast("string")
        found = df.join(F.broadcast(self.common), text == F.col("_label"), "left").drop("_label")
        unseen = F.lit(float(self.size))
        if self.rare is None:
            return found.withColumn(output, F.coalesce("_index", unseen)).drop("_index")
        settled = F.col("_index").isNotNull() | F.col(column).isNull()
        done = found.where(settled).withColumn(output, F.coalesce("_index", unseen)).drop("_index")
        open_rows = found.where(~settled).drop("_index")
        late = open_rows.join(self.rare, text == F.col("_label"), "left").drop("_label")
        return done.unionByName(late.withColumn(output, F.coalesce("_index", unseen)).drop("_index"))


def fit_label_index(
    df: DataFrame,
    column: str,
    local_labels: int = LOCAL_LABELS,
    slices: int | None = None,
) -> LabelIndex:
    """Count labels (combined map side) and number them; labels that are not text count as their text.

    The counts are staged, so the table is read once and nothing is held on executors. At most
    ``local_labels + 1`` rows come to the driver. More labels than that are numbered in slices
    of their order, however few they are.
    """
    spark = df.sparkSession
    text = F.col(column).cast("string").alias("_label")
    counted = df.where(F.col(column).isNotNull()).groupBy(text).agg(F.count(F.lit(1)).alias("n"))
    counts = stage(counted, "label-counts")
    ranked = counts.orderBy(F.desc("n"), F.asc("_label"))
    top = [row["_label"] for row in ranked.limit(local_labels + 1).collect()]
    common = local_table(
        spark,
        {"_label": top[:local_labels], "_index": [float(i) for i in range(min(len(top), local_labels))]},
        {"_label": T.StringType(), "_index": T.DoubleType()},
    )
    if len(top) <= local_labels:
        return LabelIndex(common, None, len(top))

    staged = counts.select("_label", (-F.col("n")).alias("minus_n"), F.lit(0).alias("all"))
    numbered = stage(
        with_ordered_state(staged, "all", ("minus_n", "_label"), "minus_n", 0, slices, unique=True).select(
            "_label", (F.col("_rank") - 1).cast("double").alias("_index")
        ),
        "label-index",
    )
    rare = numbered.where(F.col("_index") >= local_labels)
    return LabelIndex(common, rare, numbered.count())
