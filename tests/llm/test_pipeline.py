"""The pipeline's stages on the small tables: columns, decisions, and brute force where it is exact."""

from __future__ import annotations

import random

import __spark_entry__ as driver
import corpus_pipeline
import numpy as np
import pytest
from compare import mismatches

from purseline.llm import decontaminate, jaccard, mixing, quality
from purseline.llm.common import table
from purseline.llm.queries import QUERIES, SQL
from purseline.staging import stage


def test_all_queries_are_registered():
    assert {*QUERIES, "pipeline"} <= set(driver.queries())
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}


@pytest.mark.parametrize("name", list(SQL))
def test_query_matches_sql(spark, sf_dir, name):
    assert mismatches(QUERIES[name](spark, sf_dir), SQL[name], sf_dir) == []


def test_stages_decide(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    names = docs.columns
    ids = [{r[0] for r in docs.select("doc_id").collect()}]
    for name, step in corpus_pipeline.STAGES[:4]:
        docs = stage(step(spark, docs, sf_dir), "test-stage")
        assert docs.columns == names, name
        ids.append({r[0] for r in docs.select("doc_id").collect()})
        assert ids[-1] <= ids[-2]
        if name == "quality rules":
            want = quality.quality_verdicts(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
            assert ids[-1] == {r["doc_id"] for r in want.where("kept").collect()}
        if name == "n-gram jaccard join":
            texts = [" ".join((r["text"] or "").lower().split()) for r in docs.collect()]
            assert len(texts) == len(set(texts))
        if name == "benchmark decontamination":
            left = decontaminate.contamination_report(docs, table(spark, sf_dir, "benchmark"))
            assert left.where("contaminated").count() == 0
            before = docs
    copies = mixing.mix_sources(before).agg({"copies": "sum"}).first()[0]
    assert docs.count() == copies
    shards = corpus_pipeline.STAGES[4][1](spark, docs, sf_dir)
    assert shards.count() == copies and shards.select("shard", "slot").distinct().count() == copies


def test_run_gives_the_last_stage(spark, sf_dir):
    out = corpus_pipeline.run(spark, sf_dir)
    assert out.columns == ["doc_id", "size", "text_crc32", "shard", "slot"] and out.count() > 0


def test_near_copies_go_at_five_words_and_four_fifths(spark, sf_dir):
    """Planted copies about the bound, against the product of all sets of five words."""
    draw = random.Random(5)
    words = [f"w{i}" for i in range(3_000)]
    line = "all rights are reserved by the owners of this site and its pages".split()
    texts = []
    for n in (8, 30, 100, 200, 200, 600):
        for _ in range(12):
            base = draw.choices(words, k=n - 13 if n > 30 else n) + (line if n > 30 else [])
            texts.append(base)
            for changes in {1, 2, n // 50, n // 40, n // 30}:
                copy = list(base)
                for at in draw.sample(range(n), changes):
                    copy[at] = draw.choice(words)
                texts.append(copy)
    texts = [" ".join(t) for t in texts]
    sets = [{tuple(t[i : i + 5]) for i in range(len(t) - 4)} for t in map(str.split, texts)]
    head = list(range(len(sets)))
    near = 0
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            both = len(a & b)
            if 100 * both >= 80 * (len(a) + len(b) - both):
                near += 100 * both < 90 * (len(a) + len(b) - both)
                low, high = sorted((head[i], head[j]))
                head = [low if x == high else x for x in head]
    assert near > 20
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    kept = corpus_pipeline.jaccard_join(spark, docs, sf_dir)
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(head))


@pytest.mark.parametrize(("size", "percent"), [(40, 80), (200, 80), (200, 90), (1_000, 80), (20_000, 80)])
def test_linked_sets_meet_and_strangers_do_not(size, percent):
    draw = np.random.default_rng(size)
    counts = draw.integers(0, 9, 1 << 12).astype(np.uint32)
    for _ in range(40):
        base = draw.integers(0, 2**64, size, np.uint64)
        off = draw.integers(0, size * (100 - percent) // 100 + 1)
        base, other = np.sort(base), np.sort(base[off:])
        assert len(np.intersect1d(jaccard.prefix(base, counts, percent), jaccard.prefix(other, counts, percent)))
        assert len(jaccard.prefix(base, counts, percent)) == jaccard.prefix_size(size, percent) <= size * (100 - percent) // 100 + 1
        stranger = np.sort(draw.integers(0, 2**64, size, np.uint64))
        differ = sum(int(x).bit_count() for x in (jaccard.parities(base) ^ jaccard.parities(stranger)).view(np.uint64))
        assert differ > 2 * size - 2 * -(-2 * size * percent // (100 + percent))


def test_rarest_grams_come_first():
    grams = np.sort(np.random.default_rng(1).integers(0, 2**64, 500, np.uint64))
    counts = np.zeros(1 << 8, np.uint32)
    counts[jaccard.counter_of(grams[:250], 1 << 8)] = 1_000
    rare = grams[counts[jaccard.counter_of(grams, 1 << 8)] == 0]
    chosen = jaccard.prefix(grams, counts, 80)
    assert set(chosen[: len(rare)].tolist()) <= set(rare.tolist()) or len(rare) < len(chosen)


def test_sketch_counts_all_documents(spark):
    frame = spark.createDataFrame([(i, f"w{i % 7} w{i % 3} x y z") for i in range(300)], "doc_id long, text string")
    sets = stage(jaccard.describe(frame.repartition(9), "doc_id", "text", 3), "test-sets").where("packed is not null")
    counts = jaccard.count_grams(sets, 3, 1 << 12)
    assert counts.sum() == sets.agg({"n_shingles": "sum"}).first()[0]
    assert np.array_equal(counts, jaccard.count_grams(sets.repartition(70), 3, 1 << 12))


def odd_tables(spark):
    """NULLs in any column, empty texts, repeats, and columns whose names have dots or are used inside."""
    text = " ".join(f"word{i % 40} in{i}" for i in range(60))
    rows = [(1, text, "en", "a", 5), (1, text, "en", "a", 5), (2, text + " end", "en", None, None), (3, None, None, "a", 1)]
    rows += [(4, "", "de", "b", 0), (None, text.upper(), None, "b", 2), (None, None, None, None, None), (5, "one two", "en", "a", 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    names = ("a.b", "code", "head", "row", "size", "features", "contamination", "copies", "key", "shard", "id", "n", "short", "sign")
    from pyspark.sql import functions as F

    return docs.withColumns({name: F.lit("x") for name in names})


@pytest.mark.parametrize("empty", [False, True])
def test_stages_take_odd_rows_and_none(spark, sf_dir, empty):
    docs = odd_tables(spark)
    docs = docs.limit(0) if empty else docs
    for _, step in corpus_pipeline.STAGES[:4]:
        before, docs = docs, stage(step(spark, docs, sf_dir), "test-odd")
        assert docs.columns == before.columns
    kept = docs.collect()
    assert not empty or not kept
    assert {r["doc_id"] for r in kept} <= {1}  # the others are near copies, or have too few words
    assert corpus_pipeline.STAGES[4][1](spark, docs, sf_dir).count() == len(kept)


def test_each_stage_alone_takes_odd_rows(spark, sf_dir):
    for docs in (odd_tables(spark), odd_tables(spark).limit(0)):
        for _, step in corpus_pipeline.STAGES:
            assert step(spark, docs, sf_dir).count() <= 3 * docs.count()
    kept = corpus_pipeline.jaccard_join(spark, odd_tables(spark), sf_dir).collect()
    # One of the long texts and "one two"; texts without words are copies of nothing.
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["text"] or "") for r in kept)[0][1] == 1
    assert len(kept) == 5
