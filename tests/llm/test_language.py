"""Language labels: the best path against brute force, spans of mixed texts, held-out accuracy."""

from __future__ import annotations

import itertools
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from purseline.llm import language
from purseline.llm.common import table

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
WORDS = {
    "aa": "kalo miru tesan dolak marin",
    "bb": "schtrof gwent zwyrd pfrulg",
    "ru": "привет дорога зима человек",
    "ja": "かな 漢字 ひらがな 東京",
}


def prose(lang: str, n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice(WORDS[lang].split()) for _ in range(n))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, prose(lang, 3 + i % 40, i), lang, None, 0) for i, lang in zip(range(200), itertools.cycle(WORDS))]
    rows += [(900, None, "aa", None, 0), (901, "", "aa", None, 0), (902, " 12 -- 7\n", "bb", None, 0)]
    rows += [(903, "Привет 12 ДОРОГА", None, None, 0), (904, prose("aa", 30_000, 1), None, None, None)]
    rows += [(None, prose("bb", 9, 2), None, None, None), rows[0], rows[0]]
    return spark.createDataFrame(rows, DOCS)


def test_report(docs):
    clash = {name: F.lit("x") for name in ("id", "body", "score", "spans", "a.b", "bucket")}
    out = language.language_report(docs.withColumns(clash)).collect()
    assert len(out) == docs.count()
    truth = {i: lang for i, lang in zip(range(200), itertools.cycle(WORDS))} | {903: "ru", 904: "aa", None: "bb"}
    truth |= dict.fromkeys((900, 901, 902), "und")
    for row in out:
        assert row["lang_pred"] == truth[row["doc_id"]]
        assert row["held_out"] == (zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode()) % 3 == 1)
        assert 0 <= row["score"] <= 1 and (row["score"] > 0) == (row["lang_pred"] != "und")


def test_spans_of_a_mixed_text(docs):
    model = language.learn(docs)
    parts = [prose("aa", 12, 1), prose("bb", 9, 2), prose("ru", 4, 3), prose("aa", 15, 4)]
    text = ". ".join(parts)
    (main, score, spans), = language.label([text], model)
    assert main == "aa" and 0.4 < score < 0.9
    assert [(text[a:b], lang) for a, b, lang in spans] == list(zip(parts, ("aa", "bb", "ru", "aa"), strict=True))


def test_scripts_narrow_the_candidates(docs):
    model = language.learn(docs)
    names = np.array(model.languages)
    scores = model.scores(language.spell(["漢 кот abc"]))
    assert [names[row > -1e5].tolist() for row in scores] == [["ja"], ["ru"], ["aa", "bb"]]


def test_one_letter_of_another_word_does_not_switch(docs):
    model = language.learn(docs)
    text = prose("aa", 10, 1) + " gw " + prose("aa", 10, 2)
    assert [x[2] for x in language.label([text], model)[0][2]] == ["aa"]


@pytest.mark.parametrize("texts, few", [(1, 16), (40, 16), (40, 3), (5, 1)])
def test_best_path_is_the_best_of_all(monkeypatch, texts, few):
    monkeypatch.setattr(language, "FEW", few)
    draw = np.random.default_rng(texts * 100 + few)
    sizes = draw.integers(0, 7, texts)
    scores = draw.normal(0, 2, (sizes.sum(), 3))
    path = language.best_path(scores, sizes, 1.5)

    def value(rows, steps):
        return sum(rows[i, l] for i, l in enumerate(steps)) - 1.5 * sum(a != b for a, b in itertools.pairwise(steps))

    start = 0
    for size in sizes.tolist():
        rows, own = scores[start : start + size], path[start : start + size].tolist()
        best = max(value(rows, steps) for steps in itertools.product(range(3), repeat=size))
        assert value(rows, own) == pytest.approx(best)
        start += size


def test_words_are_runs_of_letters_of_one_script():
    text = "Don't я-abc漢字かな 3²x é"
    words = language.spell(["", text, None])
    assert [text[a:b] for a, b in zip(words.begins, words.ends, strict=True)] == ["Don", "t", "я", "abc", "漢字", "かな", "x", "é"]
    assert set(words.texts.tolist()) == {1}
    assert len(words.grams) == words.sizes.sum()
    again = language.spell(["DON"])
    assert again.grams.tolist() == words.grams[:3].tolist()


def test_counts_do_not_depend_on_partitions(docs):
    one, many = language.learn(docs.repartition(1)), language.learn(docs.repartition(7))
    assert one.languages == many.languages and np.array_equal(one.table, many.table)


def test_nothing_to_learn_from(spark, docs):
    for rows in (docs.limit(0), docs.withColumn("lang", F.lit(None).cast("string"))):
        out = language.language_report(rows).collect()
        assert len(out) == rows.count() and {row["lang_pred"] for row in out} <= {"und"}


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = language.language_report(docs).where("held_out").join(docs.select("doc_id", "lang"), "doc_id")
    right = out.where("lang_pred <> 'und'").agg(F.avg((F.col("lang_pred") == F.col("lang")).cast("int"))).first()[0]
    assert right >= 0.97


def test_buckets_keep_the_model_small():
    assert language.buckets_for(4) == language.BUCKETS
    for n in (1, 64, 65, 1_000, language.LANGUAGES):
        assert n * language.buckets_for(n) <= language.CELLS and language.buckets_for(n) >= 1_024
