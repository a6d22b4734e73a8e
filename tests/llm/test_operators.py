"""The operators on hand-made rows: NULLs, empty and long texts, ties, repeats, clashing names."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict
from math import comb, log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from purseline.llm import decontaminate, jaccard, licenses, lm, mixing, quality, secrets, sharding, substrings, warc
from purseline.llm.common import Words, by_size, fresh, most_frequent, run_hashes

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside or return.
CLASH = ("row", "id", "size", "key", "shard", "digest", "component", "copies", "contamination", "features", "code", "n")


def prose(n: int, seed: int) -> str:
    draw = random.Random(seed)
    return " ".join("".join(draw.choices("abcdefgh", k=draw.randint(1, 6))) for _ in range(n))


def swap(text: str, *places: int) -> str:
    found = text.split()
    for i in places:
        found[i] = "zzz"
    return " ".join(found)


LONG = prose(4_000, 1)
TEXTS = [
    None,
    "",
    " \n\t ",
    "One",
    "one two",
    prose(60, 2),
    prose(60, 2),  # a tie: an exact copy
    prose(200, 3),
    swap(prose(200, 3), 0),
    swap(prose(200, 3), 0, 100),
    LONG,
    LONG + " tail",
    "ha " * 300,
    "É " + prose(40, 4) + "\n" + "Under THE mit\nlicense " + prose(5, 5),
]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, ("en", "de", None)[i % 3], ("a", "b", "c", None)[i % 4], None) for i, t in enumerate(TEXTS)]
    rows += [rows[5], (None, prose(60, 2), None, None, None), (None, None, None, None, None)]  # repeats, NULLs
    frame = spark.createDataFrame(rows, DOCS)
    return frame.withColumns({name: F.lit("x") for name in CLASH})


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


@pytest.fixture(scope="module")
def benchmark(spark):
    found = LONG.split()
    rows = [(1, " ".join(found[50:80])), (2, "ONE  two"), (3, ""), (4, None), (None, prose(60, 2)), (10, " ".join(found[60:90]))]
    return spark.createDataFrame(rows, "item_id long, text string")


def rows(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


# helpers


def test_word_hashes_tell_words_apart_and_ignore_spaces():
    a, b = Words([b"  ab\tcd ", b"", b"ab cd"]), Words([b"ab cd", b"x" * 9 + b" " + b"x" * 17])
    assert a.sizes.tolist() == [2, 0, 2] and (a.hashes[:2] == a.hashes[2:]).all()
    assert len(set(b.hashes.tolist())) == 4 and b.hashes[0] == a.hashes[0]
    assert Words([b"", b""]).hashes.size == 0
    some = Words([prose(300, 9).encode()]).hashes
    for n in (1, 2, 3, 13, 35):
        runs = run_hashes(np.concatenate([some, some]), n)
        assert (runs[: len(some) - n + 1] == runs[len(some) :]).all() and len(set(runs.tolist())) <= len(runs)


def test_most_frequent_takes_whole_levels(spark):
    counts = spark.createDataFrame([(i, n) for i, n in enumerate([100, 100, 50, 1, 1, 1])], "t long, n long")
    assert sorted(r["n"] for r in rows(most_frequent(counts, 3))) == [50, 100, 100]
    assert rows(most_frequent(counts, 1)) == [] and most_frequent(counts, 10).count() == 6


def test_fresh_names(docs):
    assert fresh(docs, "row") == "row_" and fresh(docs, "ROW") == "ROW_" and fresh(docs, "new") == "new"


# decontamination


def brute_hits(text, items):
    words = decontaminate.terms(text)
    hit, found = set(), set()
    for item, body in items:
        w = decontaminate.terms(body)
        for i in range(max(1, len(w) - 12) if w else 0):
            pattern = w[i : i + 13]
            for j in range(len(words) - len(pattern) + 1):
                if words[j : j + len(pattern)] == pattern:
                    hit |= set(range(j, j + len(pattern)))
                    found |= {str(item)} - {"None"}
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("most", [decontaminate.AUTOMATON_BYTES, 700])
def test_contamination_matches_brute_force_in_one_pass_and_in_blocks(docs, benchmark, most):
    items = [(r["item_id"], r["text"]) for r in rows(benchmark)]
    found = rows(decontaminate.find_contamination(docs, benchmark, automaton_bytes=most))
    assert len(found) == docs.count()
    for row in found:
        c = row["contamination"]
        assert (c["n_words"], c["n_hit"], c["items"]) == brute_hits(row["text"], items)
        assert c["contaminated"] == (c["n_hit"] > 0 and 20 * c["n_hit"] >= c["n_words"])
        covered = [decontaminate.terms(row["text"][s["start"] : s["end"]]) for s in c["spans"]]
        assert sum(map(len, covered)) == c["n_hit"]


def test_items_without_an_id_count_as_hits(spark):
    text = prose(20, 77)
    docs = spark.createDataFrame([(1, text), (2, prose(20, 78))], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, text), (None, text), (None, None)], "item_id long, text string")
    found = {r["doc_id"]: r for r in rows(decontaminate.contamination_report(docs, benchmark))}
    assert (found[1]["n_hit"], found[1]["n_items"], found[1]["contaminated"]) == (20, 0, True)
    assert (found[2]["n_hit"], found[2]["contaminated"]) == (0, False)


def test_contamination_of_empty_tables(docs, empty, benchmark):
    none = benchmark.limit(0)
    assert all(r["contamination"]["items"] == [] for r in rows(decontaminate.find_contamination(docs, none)))
    assert decontaminate.contamination_report(empty, benchmark).count() == 0
    kept = decontaminate.keep_clean(docs, benchmark)
    assert kept.columns == docs.columns and {3, 4}.isdisjoint({r["doc_id"] for r in rows(kept)} & {4})


# secrets

ASSIGN = re.compile(r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def base_spans(text):
    text, out = text or "", []
    out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{secrets.BASE[k]}:{a}:{b}" for a, k, b in sorted(out))


def test_base_spans_and_ownership(spark):
    hexes, live, copied = "0123456789abcdef" * 2, "gQ7xR2mK9pLw4Zt8Vb3NcY6", "Ex4mpleEx4mpleEx4mpl7ky"
    texts = [
        None,
        "",
        f'é😀 Token = "{hexes}" and SECRET:short secret=token:abcdef passwd==x api_key:  \'a.b/c+d=\'',
        "AKIA" + "Z" * 15 + " AKIA" + "Q" * 16 + "!AKIAAKIA" + "1" * 16,
        f"x{hexes}{hexes} " * 50,
        f"my key {live} here",
        *[f"see {copied} there"] * 4,
        "a" * 30_000,
    ]
    rows_ = [(i, t, None, f"s{i % 4}", 0) for i, t in enumerate(texts)] + [(2, texts[2], None, None, 0)]
    frame = spark.createDataFrame(rows_, DOCS).withColumns({n: F.lit(1) for n in ("kind", "start", "value", "rank")})
    found = rows(secrets.secrets_report(frame))
    assert len(found) == len(rows_)
    by_id = defaultdict(list)
    for row in found:
        by_id[row["doc_id"]].append(row)
        assert row["base_sha256"] == hashlib.sha256(base_spans(texts[row["doc_id"]]).encode()).hexdigest()
    assert by_id[5][0]["spans"] == f"opaque:7:{7 + len(live)}" and by_id[5][0]["n_live"] == 1
    assert all(by_id[i][0]["spans"] == "" for i in (0, 1, 6, 7, 8, 9))
    verdict = {r["value_sha256"]: r for r in rows(secrets.ownership(secrets.candidates(frame, "text", "doc_id", F.col("source"), F.col("source"))[1]))}
    shared = verdict[hashlib.sha256(copied.encode()).hexdigest()]
    assert (shared["verdict"], shared["n_owners"], shared["n_places"]) == ("shared", 4, 4)


@pytest.mark.parametrize(
    ("owners", "repositories", "verdict"),
    [(1, 1, "live"), (1, 2, "live"), (1, 3, "unclear"), (1, 50, "shared"), (2, 1, "unclear"), (2, 3, "shared"), (3, 1, "shared")],
)
def test_owners_and_repositories_decide_together(spark, owners, repositories, verdict):
    """A varied value in so many repositories of each of so many owners, twice in each."""
    uses = [("aB3dE5gH7jK9mN1pQ", f"o{i}", f"r{j}") for i in range(owners) for j in range(repositories)] * 2
    found = spark.createDataFrame(uses, "value string, owner string, repository string")
    (row,) = rows(secrets.ownership(found))
    assert (row["n_owners"], row["n_repositories"], row["n_places"]) == (owners, owners * repositories, len(uses))
    assert row["verdict"] == verdict


def test_secrets_of_an_empty_table(empty):
    assert secrets.secrets_report(empty).count() == 0


# quality


def test_binomial_tail_is_exact():
    for n, k, p in [(10, 3, 0.2), (100, 0, 0.01), (300, 5, 0.05), (75, 74, 0.3), (5, 5, 0.5)]:
        exact = sum(comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
        assert quality.binomial_tail(k, n, p) == pytest.approx(exact, rel=1e-9)
    assert 0 < quality.binomial_tail(9_900_000, 10**9, 0.01) < 1e-100


def test_repeated_words_match_brute_force():
    draw = random.Random(3)
    for _ in range(400):
        ids = [draw.randrange(2) for _ in range(draw.randrange(50))] * draw.randint(1, 2)
        counts = Counter(tuple(ids[i : i + 8]) for i in range(len(ids) - 7))
        hit = {j for i in range(len(ids) - 7) if counts[tuple(ids[i : i + 8])] > 1 for j in range(i, i + 8)}
        assert quality.repeated_words(np.array(ids, np.int64)) == len(hit)


def test_text_features():
    n, chars, symbols, dups, repeats, *_ = quality.text_features("a #b\n\n a #b \na #b\n é é\x0b|")
    assert (n, chars, symbols, dups, repeats) == (8, 13, 4, 1, 0)
    assert quality.text_features(None) == quality.text_features("") == (0,) * 8


def test_cutoffs_keep_their_promise(spark):
    draw = np.random.default_rng(5)
    values = np.where(draw.random(6_000) < 0.02, 0.35, 0.0)
    rows_ = [("en", float(v)) for v in values] + [(None, 0.0)] * 5
    good = spark.createDataFrame(rows_, "lang string, v double")
    chosen = {r["stratum"]: r["cutoffs"] for r in rows(quality.choose_cutoffs(good, "lang", {"symbols": F.col("v")}, risk=0.01))}
    assert chosen == {"en": {"symbols": 0.4}}  # 0.3 would reject 2 % of the good; 5 rows back nothing


def test_verdicts_with_and_without_labels(spark, docs, empty):
    labels = spark.createDataFrame([(5, 1), (5, 1), (5, 0), (None, 1), (7, None)], "doc_id long, quality int")
    for marks in (labels, labels.limit(0)):
        found = rows(quality.quality_verdicts(docs, marks))
        assert len(found) == docs.count()
        assert all(not r["kept"] for r in found if r["base_failed"])
        assert {r["doc_id"] for r in found if r["kept"]} >= {5, 7, 8, 9, 10, 11}
        kept = quality.keep_good(docs, marks)
        assert kept.columns == docs.columns and kept.count() == sum(r["kept"] for r in found)
    assert quality.quality_report(empty, labels).count() == 0


# language model


def test_model_is_normalised_and_base_scores_are_exact(docs, empty):
    found = rows(lm.score_texts(docs))
    assert len(found) == docs.count() and lm.score_texts(empty).count() == 0
    train = Counter()
    for r in rows(docs):
        if zlib.crc32(str("" if r["doc_id"] is None else r["doc_id"]).encode()) % 7 != 2:
            train.update(lm.tokens(r["text"]))
    total, types = sum(train.values()), len(train)
    texts = dict(enumerate(TEXTS))
    for r in found:
        assert r["train_tokens"] == total and r["score"] <= 0
        if r["doc_id"] is not None:
            known = lm.tokens(texts[r["doc_id"]])
            assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 7 == 2)
            assert r["n_tokens"] == len(known) and r["n_known"] == sum(train[t] > 0 for t in known)
            exact = sum(log10((train[t] + 1) / (total + types + 1)) for t in known)
            assert r["base_score"] == pytest.approx(exact)


def test_training_beats_the_unigrams_it_starts_from():
    draw, following = np.random.default_rng(1), np.array([3, 0, 1, 2])
    ids = [0]
    for _ in range(40_000):
        ids.append(int(following[ids[-1]]) if draw.random() < 0.9 else int(draw.integers(4)))
    classes = np.array(ids)
    counts = np.bincount(classes, minlength=4)
    vocabulary = lm.Vocabulary({bytes([65 + i]): i for i in range(4)}, counts, int(counts.sum()), 4)
    model = lm.Model.start(vocabulary)
    trainer = lm.Trainer(model.like(model.flat()), vocabulary.noise(), 0)
    context = lm.contexts(classes, np.array([len(classes)]), 5)
    for _ in range(8):
        trainer.batch(*context, classes)
    before = model.log_probabilities(*context, classes).mean()
    after = trainer.model.log_probabilities(*context, classes).mean()
    assert after > before + 0.5
    sums = sum(np.exp(trainer.model.log_probabilities(*(c[:50] for c in context), np.full(50, k))) for k in range(5))
    assert sums == pytest.approx(np.ones(50), rel=1e-4)


# licenses


def test_template_join_is_exact():
    draw = random.Random(8)
    vocabulary = sorted({t for _, text in licenses.TEMPLATES for t in text.split()} | {"foo", "bar"})
    for threshold in (0.95, 0.7, 0.5):
        index = licenses.TemplateIndex(licenses.TEMPLATES, {t: draw.randrange(9) for t in vocabulary}, threshold)
        for _ in range(400):
            block = set(draw.sample(vocabulary, draw.randrange(1, 40)))
            if draw.random() < 0.6:
                block |= set(draw.choice(licenses.TEMPLATES)[1].split()[draw.randrange(3) :])
            met = [(label, frozenset(text.split())) for label, text in licenses.TEMPLATES]
            met = [(label, t) for label, t in met if len(t & block) >= licenses.least_overlap(len(t), threshold)]
            want = sorted((label, len(t & block) / len(t)) for label, t in met if not any(t < o for _, o in met))
            assert sorted(index.meet(block)) == pytest.approx(want) if not want else sorted(index.meet(block)) == want


def test_wrapped_notices_meet_their_template(spark):
    mit = """ * Permission is hereby granted, free of charge, to any person obtaining a copy
 * of this software and associated documentation files (the "Software"), to deal"""
    bsd = """# Redistribution and use in source and binary forms, with or without
# modification, are permitted provided that the following conditions are met:"""
    lgpl = "This work is licensed under the GNU Lesser\nGeneral Public License version 3"
    both = lgpl + " " + "word " * 40 + "This work is licensed under the\nGNU General Public License version 3"
    far = mit.replace("of this", "word " * 40 + "of this")
    texts = [mit, bsd, lgpl, both, far]
    found = rows(licenses.scan_licenses(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(texts)], DOCS)))
    labels = {r["doc_id"]: (r["labels"], r["score"]) for r in found}
    assert labels == {0: ("mit", 1.0), 1: ("bsd", 1.0), 2: ("lgpl-3", 1.0), 3: ("gpl-3,lgpl-3", 1.0), 4: ("", 0.0)}


def test_reworded_notices_keep_their_label(spark):
    wanted = {
        "This software is licensed under the GNU General Public License version 3": "gpl-3",
        "This software is licensed under the\nGNU Lesser General Public License, version 3": "lgpl-3",
        "Redistribution and use in source and binary forms, with or\nwithout modifications, are permitted": "bsd",
        "Licensed under the Apache License 2.0": "apache-2",
        "Licensed under CC BY-NC 3.0": "cc-by-nc",
        "Licenced under CC BY 4.0": "cc-by",
        "Released under the license": "",
        "Licensed under the license, version 2.0": "",
        "This work is licensed under the GNU General Public License version": "",
        "Released under " + "word " * 9 + "MIT license": "",
    }
    found = rows(licenses.scan_licenses(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(wanted)], DOCS)))
    assert {r["doc_id"]: r["labels"] for r in found} == dict(enumerate(wanted.values()))
    assert {r["score"] for r in found if r["doc_id"] == 0} == {11 / 12}


def test_runs_of_words_are_found_like_all_runs():
    draw = random.Random(9)
    index = licenses.TemplateIndex(licenses.TEMPLATES, {}, keys=licenses.KEYS, missing=licenses.MISSING)
    vocabulary = sorted(index.order)
    for _ in range(300):
        words = draw.choices(vocabulary[:12] + ["foo"], k=draw.randrange(30))
        for _ in range(2):
            words += [w for w in draw.choice(licenses.TEMPLATES)[1].split() if draw.random() < 0.95]
        for (_, tokens, _), need, length, keys in zip(index.templates, index.least, index.lengths, index.keys, strict=True):
            runs = [set(words[i : i + length]) & tokens for i in range(len(words))]
            want = max((len(run) for run in runs if len(run) >= need and keys <= run), default=0)
            spans, most = licenses.shortest_runs(words, tokens, need, length, keys)
            assert (most if spans else 0) == want
        assert index.runs([]) == []


def test_license_rows(spark, docs, empty):
    found = {r["doc_id"]: r for r in rows(licenses.scan_licenses(docs)) if r["doc_id"] is not None}
    assert (found[13]["n_base"], found[13]["base_labels"], found[13]["score"]) == (1, "mit", 1.0)
    assert found[13]["first_word"] == found[13]["last_word"] == 41
    assert found[0]["labels"] == found[1]["labels"] == "" and found[0]["first_word"] is None
    lines = ["This work is licensed under the GNU General Public License, version 3.", "CC BY-NC cc by nc", "license version"]
    more = rows(licenses.scan_licenses(spark.createDataFrame([(i, t, "", "", 0) for i, t in enumerate(lines)], DOCS)))
    assert [(r["labels"], r["n_base"]) for r in more] == [("gpl-3", 0), ("cc-by-nc", 2), ("", 0)]
    assert licenses.scan_licenses(empty).count() == 0
    index = licenses.TemplateIndex(licenses.TEMPLATES, {})
    found = licenses._scan("a cc by nc\nb cc by nc, cc by nc by " * 20_000, index, licenses.PHRASES)
    assert found[:4] == (12 * 20_000, 3 * 20_000, 1, 12 * 19_999 + 8)


# mixing


def brute_targets(sizes):
    weight = {s: mixing.WEIGHTS[i % 3] for i, s in enumerate(sorted(sizes))}
    total, full = sum(sizes.values()), set()
    while True:
        rest = [s for s in sizes if s not in full]
        left = total - sum(3 * sizes[s] for s in full)
        target = {s: left * weight[s] / sum(weight[x] for x in rest) for s in rest}
        over = {s for s in rest if target[s] > 3 * sizes[s]}
        if not over:
            return target | {s: 3.0 * sizes[s] for s in full}
        full |= over


def test_targets_reshare_the_excess(spark):
    sizes = {"a": 10, "b": 1, "c": 500, "d": 90, "e": 2_000, "f": 3}
    frame = spark.createDataFrame(list(sizes.items()), "source string, size long")
    found = {r["source"]: r["target"] for r in rows(mixing.source_targets(frame))}
    assert found == pytest.approx(brute_targets(sizes))


def test_flight_keeps_both_totals():
    draw = np.random.default_rng(2)
    sizes = draw.integers(1, 500, 3_000)
    chances = np.full(3_000, 0.37)
    out = mixing.flight(chances, sizes, draw, land=False)
    assert ((out > 0) & (out < 1)).sum() <= 2
    assert out.sum() == pytest.approx(chances.sum()) and (out * sizes).sum() == pytest.approx((chances * sizes).sum())
    landed = mixing.flight(chances, sizes, draw, land=True)
    assert set(landed) <= {0.0, 1.0} and abs((landed * sizes).sum() - (chances * sizes).sum()) < 1_000
    taken = np.mean([mixing.flight(np.full(5, 0.4), np.arange(5), np.random.default_rng(i), True) for i in range(3_000)], axis=0)
    assert taken == pytest.approx(np.full(5, 0.4), abs=0.05)


@pytest.mark.parametrize("n, huge", [(500, 20_000), (60, 5_000), (3_000, 60_000)])
def test_large_documents_are_not_left_to_chance(n, huge):
    """One document far over the others; the words taken come near the target all the same."""
    off = []
    for seed in range(30):
        draw = np.random.default_rng(seed)
        sizes = np.append(draw.integers(5, 900, n), [huge, huge // 2, 4_000])
        chances = np.full(len(sizes), 0.43)
        out = mixing.flight(chances, sizes, draw, land=True)
        assert set(out) <= {0.0, 1.0}
        off.append(abs((out * sizes).sum() - (chances * sizes).sum()))
    assert max(off) <= 200
    ups = [mixing.flight(np.full(60, 0.3), np.append(np.arange(1, 60), 5_000), np.random.default_rng(i), True)[-1] for i in range(1_500)]
    assert np.mean(ups) == pytest.approx(0.3, abs=0.05)


def test_blocks_and_partitionings_agree(spark):
    rows_ = [(i, i // 900, ("a", "b")[i % 2], 1 + i % 97, i * 7_919) for i in range(1_800)]
    units = spark.createDataFrame(rows_, "row long, x long, source string, size long, code long").drop("x")
    units = units.withColumn("times", F.when(F.col("source") == "a", 1.25).otherwise(0.5))
    one = {r["row"]: r["copies"] for r in rows(mixing.balanced_copies(units, block=100))}
    two = {r["row"]: r["copies"] for r in rows(mixing.balanced_copies(units.repartition(7), block=100))}
    assert one == two and len(one) == 1_800
    words = sum(one[i] * (1 + i % 97) for i in range(0, 1_800, 2))
    assert words == pytest.approx(1.25 * sum(1 + i % 97 for i in range(0, 1_800, 2)), rel=0.01)


def test_rows_of_one_document_are_dealt_to_all_blocks(spark):
    units = spark.range(3_000).selectExpr("id as row", "'a' as source", "10L as size", "if(id < 2500, 7L, id) as code")
    spread = mixing._spread(units.withColumn("times", F.lit(0.5)))
    assert spread.count() == 3_000 and spread.select("code").distinct().count() == 3_000
    found = rows(mixing.balanced_copies(units.withColumn("times", F.lit(0.5)), block=100))
    assert len(found) == 3_000 and sum(r["copies"] for r in found) == pytest.approx(1_500, abs=2)


def test_mix_rows(docs, empty):
    found = rows(mixing.mix_sources(docs))
    assert len(found) == docs.count() and all(0 <= r["copies"] <= 3 for r in found)
    taken = mixing.take_mix(docs)
    assert taken.columns == docs.columns and taken.count() == sum(r["copies"] for r in found)
    assert mixing.mixing_report(empty).count() == 0 and mixing.take_mix(empty).count() == 0


# repeated windows


def brute_kept(texts, size):
    split = [(t or "").encode().split() for t in texts]
    counts = Counter(tuple(w[i : i + size]) for w in split for i in range(len(w) - size + 1))
    out = []
    for w in split:
        gone = {j for i in range(len(w) - size + 1) if counts[tuple(w[i : i + size])] > 1 for j in range(i, i + size)}
        out.append((len(w), len(gone), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()))
    return out


def test_repeats_match_brute_force(spark, docs, empty):
    want = Counter(brute_kept([r["text"] for r in rows(docs)], 35))
    found = Counter((r["n_words"], r["n_removed"], r["kept"]) for r in rows(substrings.remove_repeats(docs)))
    assert found == want and substrings.repeats_report(empty).count() == 0
    draw = random.Random(4)
    texts = [" ".join(draw.choices("abc", k=draw.randrange(40))) for _ in range(120)] + [prose(50, 6)[:90]] * 2
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    for size in (1, 2, 5, 8):
        got = Counter((r["n_words"], r["n_removed"], r["kept"]) for r in rows(substrings.remove_repeats(frame, size=size)))
        assert got == Counter(brute_kept(texts, size))


@pytest.mark.parametrize("remembered", [0, 200_000])
def test_crowds_of_copies_over_many_batches(spark, monkeypatch, remembered):
    """Copies within batches and across them, and strings first seen once, then often."""
    monkeypatch.setattr(substrings, "REMEMBERED", remembered)
    monkeypatch.setattr(substrings, "by_size", lambda batches, column: by_size(batches, column, 2_000))
    same, line = prose(120, 9), prose(50, 10)
    texts = [same] * 60 + [f"{prose(20, 100 + i)} {line} {prose(20, 300 + i)}" for i in range(60)] + [prose(80, 11)]
    random.Random(3).shuffle(texts)
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = Counter((r["n_words"], r["n_removed"], r["kept"]) for r in rows(substrings.remove_repeats(frame)))
    assert got == Counter(brute_kept(texts, 35))


def test_merged_stretches():
    of, a, b = substrings.merged_stretches(np.array([1, 1, 1, 2]), np.array([0, 5, 50, 3]), np.array([40, 45, 90, 60]))
    assert (of.tolist(), a.tolist(), b.tolist()) == ([1, 1, 2], [0, 50, 3], [45, 90, 60])


def test_hot_order_changes_no_result_and_stretches_are_cut():
    hashes = Words([("ha " * 3_000 + prose(500, 7)).encode()])
    mers, valid = run_hashes(hashes.hashes, 3), substrings.windows_of(hashes, 35)
    for hot in (np.empty(0, np.uint64), np.unique(mers[:1]), np.unique(mers)):
        at, n, _ = substrings.super_kmers(mers, valid, np.zeros(1, np.int64), 35, 3, hot)
        covered = np.concatenate([np.arange(a, a + k) for a, k in zip(at, n, strict=True)])
        assert (covered == valid).all() and n.max() <= substrings.LONGEST


# Jaccard join


def brute_components(texts):
    sets = []
    for t in texts:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i : i + 3]) for i in range(len(w) - 2)} if len(w) > 2 else {tuple(w)} if w else set())
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets):
                if a and 100 * len(a & b) >= 90 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return [(len(s), x) for s, x in zip(sets, label, strict=True)]


def apart(a, b):
    """Places that differ, by the fewer places of the two."""
    a, b = sorted((a, b), key=len)
    while len(b) > len(a):
        b = b[: len(b) // 2] ^ b[len(b) // 2 :]
    return sum(int(x).bit_count() for x in (a ^ b).view(np.uint64))


def test_linked_sets_share_a_prefix_and_are_close():
    draw = random.Random(6)
    counts = np.random.default_rng(6).integers(0, 4, 1 << 10).astype(np.uint32)
    for _ in range(3_000):
        n = draw.randrange(1, 160)
        base = np.unique(np.array([draw.getrandbits(64) for _ in range(n)], np.uint64))
        other = np.unique(np.append(np.delete(base, draw.sample(range(len(base)), min(len(base) - 1, draw.randint(0, n // 12)))), [np.uint64(draw.getrandbits(64)) for _ in range(draw.randint(0, n // 12))]).astype(np.uint64))
        both, either = len(np.intersect1d(base, other)), len(np.union1d(base, other))
        linked = 100 * both >= 90 * either
        assert len(jaccard.overlaps([base, other], 90)) == linked
        if linked and both < either:
            assert len(np.intersect1d(jaccard.prefix(base, counts, 90), jaccard.prefix(other, counts, 90)))
            assert apart(jaccard.parities(base), jaccard.parities(other)) <= len(base) + len(other) - 2 * both


@pytest.mark.parametrize("block", [jaccard.BLOCK, 4])
def test_components_match_brute_force(spark, block):
    base = [prose(120, seed) for seed in range(3)]
    draw, texts = random.Random(7), [None, "", "one", "One", "one two"]
    for text in base:
        texts += [swap(text, *draw.sample(range(120), draw.randrange(4))) for _ in range(14)]
    texts += [texts[9], swap(texts[9], 1, 2), texts[9].upper()]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumn("digest", F.lit("x"))
    found = {r["doc_id"]: (r["n_shingles"], r["component"]) for r in rows(jaccard.jaccard_components(frame, block=block))}
    assert [found[i] for i in range(len(texts))] == brute_components(texts)


def test_one_of_each_component_stays(docs, empty):
    found = rows(jaccard.jaccard_components(docs))
    assert len(found) == docs.count()
    kept = jaccard.keep_one_each(docs)
    ids = [r["doc_id"] for r in rows(kept)]
    assert kept.columns == docs.columns
    assert sorted(x for x in ids if x is not None) == [0, 1, 2, 3, 4, 5, 7, 9, 10, 12, 13] or len(ids) == len(
        {(r["component"], r["doc_id"] if not r["n_shingles"] else 0) for r in found}
    )
    assert jaccard.jaccard_report(empty).count() == 0


# archives


def test_archives_hold_every_page(spark, tmp_path):
    html = ["<p>ü</p>" * 400, "<p>ü</p>" * 400, "", None, "x" * 200_000, "\r\n\r\nContent-Length: 3\r\n\r\n"]
    html += [f"<html>{prose(80, i)}</html>" for i in range(60)]
    data = [(i, None if i % 5 == 0 else f"http://h/{i}\r\nX: é", h) for i, h in enumerate(html)]
    data += [(1, "http://again", html[1]), (None, None, html[0]), (None, None, "only here")]
    pages = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({"id": F.lit(1), "sha": F.lit(2)})
    firsts = {}
    for i, _, h in data:
        if i is not None:
            firsts[h or ""] = min(i, firsts.get(h or "", i))
    for size in (warc.ARCHIVE_BYTES, 3_000):
        folder = str(tmp_path / f"a{size}")
        listed = warc.write_archives(pages, folder, archive_bytes=size)
        back = rows(warc.read_archives(spark, listed, folder))
        want = Counter()
        for i, _, h in data:
            payload = (h or "").encode()
            first = firsts.get(h or "")
            response = i == first
            want[(None if i is None else str(i), len(payload), warc.payload_digest(payload), "response" if response else "revisit", None if response else str(first))] += 1
        assert Counter(tuple(r.values()) for r in back) == want
        assert sum(r["records"] for r in rows(listed)) == len(data)
    assert warc.archive_report(pages.limit(0)).count() == 0


def test_dictionary_frame_leads_and_damage_is_found(tmp_path):
    records = [warc.record(str(i), None, prose(200, i).encode(), warc.payload_digest(prose(200, i).encode()), None, False) for i in range(200)]
    name = warc.write_archive(str(tmp_path), records)
    data = (tmp_path / name).read_bytes()
    assert int.from_bytes(data[:4], "little") == warc.DICTIONARY_FRAME
    with (tmp_path / name).open("rb") as stream:
        assert list(warc.frames(stream)) == records
    with pytest.raises(ValueError, match="damaged"):
        warc.parse(records[0].replace(b"\r\n\r\nHTTP", b"\r\n\r\nHTTP", 1).replace(prose(200, 0)[:3].encode(), b"###"))


# sharding


def test_shards_are_even_and_slots_have_no_gaps(spark, docs, empty):
    texts = [prose(3 + i % 40, i) for i in range(1_500)] + [prose(30, 1)] * 700 + [prose(20, i // 4) for i in range(800)]
    big = spark.createDataFrame([(i, t, None, None, 0) for i, t in enumerate(texts)], DOCS)
    found = rows(sharding.sharding_report(big.repartition(6)))
    loads, slots, places = Counter(), defaultdict(list), defaultdict(set)
    for r in found:
        text = texts[r["doc_id"]]
        assert (r["size"], r["text_crc32"]) == (len(text.encode()) + 1, zlib.crc32(text.encode()))
        loads[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        places[text].add(r["shard"])
    assert len(found) == len(texts) and all(sorted(x) == list(range(len(x))) for x in slots.values())
    assert max(loads.values()) < 1.03 * min(loads.values()) and len(loads) == sharding.SHARDS
    small = [p for t, p in places.items() if texts.count(t) == 4]
    assert sum(len(p) == 1 for p in small) > 0.7 * len(small)
    assert len(rows(sharding.sharding_report(docs))) == docs.count() and sharding.sharding_report(empty).count() == 0


def test_admitted_shares_keep_to_the_cap():
    asked = [[0, 50, 0], [80, 0, 0], [30, 0, 0]]
    share = sharding.admitted(asked, [100, 100, 100], 105)
    after = [100 - sum(asked[i][j] * share[j] for j in range(3)) + share[i] * sum(r[i] for r in asked) for i in range(3)]
    assert max(after) <= 105.001 and min(share) > 0.3
