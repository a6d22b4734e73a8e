"""A corpus from raw documents to training shards, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from purseline.llm.common import table
from purseline.llm.decontaminate import keep_clean
from purseline.llm.jaccard import keep_one_each
from purseline.llm.mixing import take_mix
from purseline.llm.quality import keep_good
from purseline.llm.sharding import assign_shards
from purseline.staging import stage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rules or a cutoff backed by the labels go.

    NULL and empty texts have no words and go. Equal rows stay or go together; an empty table
    stays empty. Columns of other names, dots included, are passed on, here and in all stages.
    """
    return keep_good(docs, table(spark, sf_dir, "labels"))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies stays, the one with the least id.

    Near copies share 80 % of their runs of five words; op8's contract, 90 % of runs of three,
    binds that query alone. Of repeated rows one stays; NULL ids are the largest; documents
    without words are copies of nothing and stay. An empty table stays empty.
    """
    return keep_one_each(docs, size=5, percent=80)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold too much of the benchmark go.

    NULL and empty texts are clean, equal rows stay or go together, and without a benchmark or
    documents nothing changes. Benchmark items without an id count.
    """
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; what it does not take goes.

    Texts without words add none and are drawn like others of their source; a source without
    words, and an empty table, give nothing. NULL is a source. Repeated rows are drawn each
    for itself, equal sizes by a hash of id and text.
    """
    return take_mix(docs)


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Shard and slot of each row.

    NULL texts have no bytes and no copies; repeated rows have slots of their own; an empty
    table has no rows. The columns are those of the operator, whatever others there are.
    """
    return assign_shards(docs)


STAGES = [
    ("quality rules", quality_rules),
    ("n-gram jaccard join", jaccard_join),
    ("benchmark decontamination", decontamination),
    ("mixing sources", mixing),
    ("sharding", sharding),
]

# The quality rules take binomial bounds and the mix draws a sample: neither is SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written and read again before the next."""
    docs = table(spark, sf_dir, "documents")
    for name, step in STAGES:
        docs = stage(step(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
