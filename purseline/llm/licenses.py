"""License scan: an exact set-similarity join of text blocks with license templates.

A block is a line, or a run of consecutive words of the text, a quarter longer than the
template: a notice may be wrapped over lines. It meets a template when it contains at least ``THRESHOLD`` of the
template's distinct tokens. Tokens are ordered by their frequency in the whole corpus, rarest
first. A block that misses few enough tokens must hold one of the first ones (prefix filter),
must have enough tokens at all (length filter), and the tokens after the first common one must
be able to make up the rest (positional filter). What passes is counted in full. Runs of words
are only looked at where the text as a whole holds enough tokens of the template. As the
threshold asks for all tokens of a short template, a run may miss one of those that do not
tell licenses apart; a line, which can be as long as a text, may not.
"""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator, Mapping

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import TERM, ascii_lower

# Fixed values of the contract: phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Notices that state a license, by label.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache-2", "licensed under the apache license version 2 0"),
    ("gpl-3", "this work is licensed under the gnu general public license version 3"),
    ("gpl-2", "this work is licensed under the gnu general public license version 2"),
    ("lgpl-3", "this work is licensed under the gnu lesser general public license version 3"),
    ("agpl-3", "this work is licensed under the gnu affero general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl-2", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
)

THRESHOLD = 0.95

#: Per template the words that tell its license: a run of words must hold them all.
KEYS = (
    "mit license",
    "permission this software",
    "apache license 2",
    "gnu general public 3",
    "gnu general public 2",
    "gnu lesser 3",
    "gnu affero 3",
    "cc by nc",
    "cc by sa",
    "cc by",
    "redistribution source binary forms",
    "mozilla 2",
    "unencumbered public domain",
)
#: Other tokens of a template that a run of words may miss, whatever the threshold.
MISSING = 1

COLUMNS = "id string, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double"


def least_overlap(size: int, threshold: float = THRESHOLD) -> int:
    """Tokens of a template of ``size`` that a block must hold."""
    return max(1, math.ceil(threshold * size - 1e-9))


class TemplateIndex:
    """Templates with their tokens in corpus order, and an index on the prefixes."""

    def __init__(self, templates, frequency: Mapping[str, int], threshold: float = THRESHOLD, keys=None, missing: int = 0):
        self.order = {
            token: i
            for i, token in enumerate(sorted({t for _, text in templates for t in text.split()}, key=lambda t: (frequency.get(t, 0), t)))
        }
        self.templates = []
        self.lengths, self.least, self.keys = [], [], []
        self.prefixes: dict[str, list[tuple[int, int]]] = {}
        for number, (label, text) in enumerate(templates):
            tokens = sorted(set(text.split()), key=self.order.__getitem__)
            need = least_overlap(len(tokens), threshold)
            self.templates.append((label, frozenset(tokens), need))
            self.lengths.append(len(text.split()) * 5 // 4)
            self.keys.append(frozenset(keys[number].split()) if keys else frozenset())
            self.least.append(max(1, min(need, len(tokens) - missing)))
            for place, token in enumerate(tokens[: len(tokens) - need + 1]):
                self.prefixes.setdefault(token, []).append((number, place))

    def meet(self, block: set[str]) -> list[tuple[str, float]]:
        """``(label, containment)`` of the templates that the block meets.

        A template whose tokens are all in another one that is met says less, and is left out.
        """
        if block.isdisjoint(self.prefixes):
            return []
        tried: set[int] = set()
        met: list[tuple[str, frozenset[str], float]] = []
        held = sorted(block & self.order.keys(), key=self.order.__getitem__)
        for at, token in enumerate(held):
            for number, place in self.prefixes.get(token, ()):
                if number in tried:
                    continue
                tried.add(number)
                label, tokens, need = self.templates[number]
                # The first common token: all others come after it, in the block and the template.
                if len(held) < need or min(len(held) - at, len(tokens) - place) < need:
                    continue
                overlap = len(tokens & block)
                if overlap >= need:
                    met.append((label, tokens, overlap / len(tokens)))
        return [(label, score) for label, tokens, score in met if not any(tokens < other for _, other, _ in met)]

    def runs(self, words: list[str]) -> list[tuple[str, float]]:
        """``(label, containment)`` of the templates that some run of words meets.

        A run says less where it overlaps one that meets a template with all of its tokens and more.
        """
        held = self.order.keys() & words
        met = []
        for (label, tokens, _), need, length, keys in zip(self.templates, self.least, self.lengths, self.keys, strict=True):
            if keys <= held and len(tokens & held) >= need:
                spans, most = shortest_runs(words, tokens, need, length, keys)
                if spans:
                    met.append((label, tokens, spans, most / len(tokens)))
        out = []
        for label, tokens, spans, score in met:
            more = [other for _, wider, other, _ in met if tokens < wider]
            if not all(any(_overlaps(span, other) for other in more) for span in spans):
                out.append((label, score))
        return out


def _overlaps(span: tuple[int, int], others: list[tuple[int, int]]) -> bool:
    """Whether one of the others, whose starts and ends both rise, overlaps the span."""
    at = bisect_right(others, span[1], key=lambda other: other[0])
    return at > 0 and others[at - 1][1] >= span[0]


def _drop(counts: Counter[str], word: str) -> None:
    counts[word] -= 1
    if not counts[word]:
        del counts[word]


def shortest_runs(
    words: list[str], tokens: frozenset[str], need: int, length: int, keys: frozenset[str] = frozenset()
) -> tuple[list[tuple[int, int]], int]:
    """Runs of at most ``length`` words with ``need`` of the tokens, all ``keys`` among them, and the most tokens in any.

    Of runs with one end the shortest is given, by its first and last place.
    """
    places = [i for i, word in enumerate(words) if word in tokens]
    spans: list[tuple[int, int]] = []
    inside: Counter[str] = Counter()  # of the longest run that ends here
    short: Counter[str] = Counter()  # of the shortest one with enough tokens
    first = a = most = 0
    for end in places:
        inside[words[end]] += 1
        short[words[end]] += 1
        while places[first] <= end - length:
            _drop(inside, words[places[first]])
            first += 1
        if keys <= inside.keys():
            most = max(most, len(inside))
        while short[words[places[a]]] > 1 or (len(short) > need and words[places[a]] not in keys):
            _drop(short, words[places[a]])
            a += 1
        if len(short) >= need and keys <= short.keys() and end - places[a] < length and (not spans or places[a] > spans[-1][0]):
            spans.append((places[a], end))
    return spans, most


def token_frequency(docs: DataFrame, text: str, tokens: frozenset[str]) -> dict[str, int]:
    """How many blocks of all texts hold each of the given tokens."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter[str] = Counter()
            for body in batch["body"]:
                for line in ascii_lower(body).split("\n") if body else ():
                    found.update(tokens.intersection(TERM.findall(line)))
            if found:
                yield pd.DataFrame({"token": list(found), "n": list(found.values())})

    counts = docs.select(F.col(text).alias("body")).mapInPandas(count, "token string, n long")
    rows = counts.groupBy("token").agg(F.sum("n").alias("n")).collect()  # no more rows than tokens
    return {row["token"]: row["n"] for row in rows}


def _scan(text: str | None, index: TemplateIndex, phrases: Mapping[str, str]) -> tuple:
    lines = [TERM.findall(line) for line in ascii_lower(text).split("\n")] if text else []
    found = [word for line in lines for word in line]
    joined = f" {' '.join(found)} "
    places, base = [], set()
    for phrase, label in phrases.items():
        at, word, seen = joined.find(f" {phrase} "), 0, 0
        while at >= 0:
            word, seen = word + joined.count(" ", seen, at), at
            places.append(word)
            base.add(label)
            at = joined.find(f" {phrase} ", at + 1)
    labels, score = set(base), 1.0 if base else 0.0
    for line in lines:
        for label, containment in index.meet(set(line)) if line else ():
            labels.add(label)
            score = max(score, containment)
    for label, containment in index.runs(found):
        labels.add(label)
        score = max(score, containment)
    return (
        len(found),
        len(places),
        min(places, default=None),
        max(places, default=None),
        ",".join(sorted(base)),
        ",".join(sorted(labels)),
        score,
    )


def scan_licenses(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    templates: tuple[tuple[str, str], ...] = TEMPLATES,
    threshold: float = THRESHOLD,
    keys: tuple[str, ...] | None = KEYS,
    missing: int = MISSING,
) -> DataFrame:
    """Per input row its words, phrase places, labels and the best containment as ``score``.

    Labels of phrases are always there, with score 1; the join adds those of the templates
    that some line or run of words meets. ``keys`` and ``missing`` are those of ``TEMPLATES``; other templates
    need their own, or may miss no token but for the threshold. A NULL or empty text has no words and no labels. Rows move in no
    shuffle: templates are a stated list, broadcast with their index.
    """
    if templates != TEMPLATES and keys is KEYS:
        keys, missing = None, 0
    tokens = frozenset(t for _, body in templates for t in body.split())
    index = TemplateIndex(templates, token_frequency(docs, text, tokens), threshold, keys, missing)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [_scan(body, shared.value, PHRASES) for body in batch["body"]]
            names = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
            out = pd.DataFrame(rows, columns=names)
            out["first_word"] = out["first_word"].astype("Int64")
            out["last_word"] = out["last_word"].astype("Int64")
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    # The id travels as text: a NULL among numbers would make them doubles.
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("body"))
    found = rows.mapInPandas(scan, COLUMNS).withColumn("id", F.col("id").cast(docs.schema[id].dataType))
    return found.withColumnRenamed("id", id)

