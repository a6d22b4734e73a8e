"""Vector codes against Lloyd rounds in plain Python, and what comes of odd vectors."""

from __future__ import annotations

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from purseline.llm import codes

VECTORS = "vec_id long, embedding array<float>, label int"


def expected(rows) -> list[tuple]:
    """The contract's rows, one part after another."""
    kept = []
    for row in rows:
        v = row["embedding"]
        if v is not None and all(x is not None and math.isfinite(x) for x in v):
            kept.append((row["vec_id"], row["label"], [math.floor(codes.SCALE * x) for x in v]))
    if not kept:
        return []
    d = len(kept[0][2]) // codes.PARTS
    first = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[2]))[: codes.ENTRIES]
    found = [["", 0] for _ in kept]
    books = []
    for j in range(codes.PARTS):
        parts = [r[2][j * d : (j + 1) * d] for r in kept]
        book = [r[2][j * d : (j + 1) * d] for r in first]

        def nearest(part, book=book):
            return min((sum((a - b) ** 2 for a, b in zip(part, c, strict=True)), e) for e, c in enumerate(book))

        for _ in range(codes.ROUNDS):
            chosen = [nearest(p, book)[1] for p in parts]
            for e in range(len(book)):
                own = [p for p, c in zip(parts, chosen, strict=True) if c == e]
                if own:
                    book[e] = [sum(x) // len(own) for x in zip(*own, strict=True)]
        for i, p in enumerate(parts):
            error, e = nearest(p, book)
            found[i][0] += f"{e:02x}"
            found[i][1] += error
        books += [str(x) for c in book for x in c]
    digest = hashlib.sha256(",".join(books).encode()).hexdigest()
    by_label: dict = {}
    for (_, label, _), (_, error) in zip(kept, found, strict=True):
        by_label[label] = by_label.get(label, 0) + error
    out = [(r[0], c, e, by_label[r[1]], digest) for r, (c, e) in zip(kept, found, strict=True)]
    return sorted(out, key=repr)


def vectors(spark, n: int, d: int = 16):
    draw = random.Random(5)
    rows = [(i, [draw.gauss(i % 5 - 2, 0.7) for _ in range(d)], i % 4 or None) for i in range(n)]
    hot = [draw.gauss(0, 1) for _ in range(d)]
    rows += [(10_000 + i, hot, 1) for i in range(n // 2)]  # one vector, a third of all
    odd = list(hot)
    rows += [(3, None, 1), (-1, [*odd[:-1], None], 2), (-2, [*odd[:-1], float("nan")], 2), (-3, [*odd[:-1], -math.inf], 2)]
    rows += [(None, hot, 2), (None, rows[0][1], None), rows[7], rows[7], (8, hot, None), (8, rows[8][1], 3)]
    return spark.createDataFrame(rows, VECTORS).repartition(5)


@pytest.mark.parametrize("n, d", [(160, 16), (400, 8), (6, 8)])
def test_codes_are_those_of_plain_rounds(spark, n, d):
    table = vectors(spark, n, d)
    clash = {name: F.lit("x") for name in ("row", "entry", "part", "code", "position", "a.b", "whole", "key")}
    out = codes.compression_report(table.withColumns(clash)).collect()
    assert sorted(map(tuple, out), key=repr) == expected(table.collect())


def test_partitions_and_salts_do_not_matter(spark, monkeypatch):
    table = vectors(spark, 90)
    first = sorted(map(tuple, codes.compression_report(table).collect()), key=repr)
    monkeypatch.setattr(codes, "OWNER_ROWS", 7)
    assert sorted(map(tuple, codes.compression_report(table.repartition(1)).collect()), key=repr) == first


def test_no_vectors(spark):
    none = spark.createDataFrame([(1, None, 2), (2, [None, 1.0], 3)], VECTORS)
    for table in (none, none.limit(0)):
        out = codes.compression_report(table)
        assert out.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
        assert out.count() == 0


@pytest.mark.parametrize("rows", [[(1, [0.0] * 8, 1), (2, [0.0] * 16, 1)], [(1, [0.5] * 9, 1)], [(1, [1e9] * 8, 1)]])
def test_lengths_and_sizes_that_have_no_result_are_errors(spark, rows):
    with pytest.raises(Exception, match="components|larger"):
        codes.compression_report(spark.createDataFrame(rows, VECTORS)).collect()


def test_only_parts_that_change_their_entry_are_written_again(spark, monkeypatch):
    written = []
    stage = codes.stage
    monkeypatch.setattr(codes, "stage", lambda df, name: written.append((name, stage(df, name))) or written[-1][1])
    table = vectors(spark, 400)
    codes.compression_report(table).collect()
    residents = [df for name, df in written if name == "codes-residents"]
    kept = len(expected(table.collect()))
    assert residents[0].count() == kept * codes.PARTS
    moved = [df.where("members = 1").count() for df in residents[1:]]
    assert sum(moved) < kept * codes.PARTS and all(m < kept * codes.PARTS / 2 for m in moved)


def test_means_floor_and_ties_take_the_lower_entry():
    parts = np.array([[0, 0], [2, 0], [1, 0]])
    entry, distance = codes.nearest(parts, np.array([[0, 0], [2, 0]]))
    assert entry.tolist() == [0, 1, 0] and distance.tolist() == [0, 0, 1]
