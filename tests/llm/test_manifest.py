"""The manifest against a tree built in one place, and proofs folded one by one."""

from __future__ import annotations

import hashlib

import pytest
from pyspark.sql import functions as F

from purseline.llm import manifest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
LONG = "Ärger " * 40_000


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row) -> str:
    shown = [None if row[x] is None else str(row[x]) for x in manifest.FIELDS]
    return sha("".join("-" if x is None else f"{len(x.encode())}:{x}" for x in shown))


def tree(leaves: list[str], fan: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root and the steps of each leaf, level by level."""
    steps = [[] for _ in leaves]
    under = [[i] for i in range(len(leaves))]
    level = leaves
    while len(level) > 1:
        runs = [range(a, min(a + fan, len(level))) for a in range(0, len(level), fan)]
        for run in runs:
            for i in run:
                before = "".join(level[j] for j in run if j < i)
                after = "".join(level[j] for j in run if j > i)
                for k in under[i]:
                    steps[k].append((before, after))
        under = [[k for i in run for k in under[i]] for run in runs]
        level = [sha("".join(level[i] for i in run)) for run in runs]
    return level[0], steps


def expected(rows, fan: int) -> list[tuple]:
    """(doc_id, leaf, subroot, root, proof_sha256) of all rows."""
    by_source: dict = {}
    for row in rows:
        by_source.setdefault(row["source"], []).append((row["doc_id"] is not None, row["doc_id"] or 0, leaf_of(row)))
    sources = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for source in sources:
        order = sorted(by_source[source])
        trees[source] = (order, *tree([x[2] for x in order], fan))
    root, above = tree([trees[s][1] for s in sources], fan)
    out = []
    for source, high in zip(sources, above, strict=True):
        order, subroot, steps = trees[source]
        for (named, key, leaf), low in zip(order, steps, strict=True):
            proof = "".join(b + a for b, a in low + high)
            out.append((key if named else None, leaf, subroot, root, sha(proof)))
    return sorted(out, key=repr)


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f"Text {i} of All", "en", ("a", "b", "ä", "", None)[i % 7 % 5], i) for i in range(150)]
    rows += [(900, LONG, None, "a", None), (901, "", "de", "a", 0), (902, None, None, "lone", None)]
    rows += [(None, "no id", None, "a", 1), (None, None, None, None, None)]
    rows += [rows[3], rows[3], (3, "same id, other Text", "en", rows[3][3], 1)]
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.mark.parametrize("fan, band", [(2, 1), (2, 3), (3, 2), (16, 3)])
def test_manifest_is_the_tree_built_in_one_place(docs, fan, band):
    clash = {name: F.lit("x") for name in ("tree", "digest", "id", "note", "position", "n", "a.b", "leaf")}
    out = manifest.build_manifest(docs.withColumns(clash), fan=fan, band=band, proofs=True).collect()
    found = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], r["proof_sha256"]) for r in out]
    assert sorted(found, key=repr) == expected(docs.collect(), fan)
    for row in out:
        assert manifest.fold(row["leaf"], row["proof"]) == row["root"] == row["folded_root"]
        assert manifest.fold(sha("another"), row["proof"]) != row["root"]


def test_tampered_leaves_do_not_verify(docs):
    import zlib

    out = {(r["doc_id"], r["leaf"]): r["verified"] for r in manifest.manifest_report(docs).collect()}
    for row in docs.collect():
        hit = zlib.crc32(str("" if row["doc_id"] is None else row["doc_id"]).encode()) % manifest.TAMPERED == 0
        changed = hit and row["text"] is not None and any("A" <= c <= "Z" for c in row["text"])
        assert out[row["doc_id"], leaf_of(row)] == (not changed)


def test_one_source_one_row_and_no_rows(spark):
    one = spark.createDataFrame([(7, "only", "en", "a", 4)], DOCS)
    row = manifest.manifest_report(one).first()
    assert row["leaf"] == row["subroot"] == row["root"] and row["proof_sha256"] == sha("")
    assert manifest.manifest_report(one.limit(0)).count() == 0


def test_partitions_do_not_matter(spark, docs):
    first = sorted(map(repr, manifest.manifest_report(docs).collect()))
    assert sorted(map(repr, manifest.manifest_report(docs.repartition(1)).collect())) == first
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", 13)
    try:
        assert sorted(map(repr, manifest.manifest_report(docs).collect())) == first
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
