"""Benchmark decontamination with one Aho-Corasick automaton over the benchmark's word windows.

Every window of consecutive benchmark words is a pattern, written with single spaces around
its words. A document is normalised the same way and read once; matches come back as places
in the normalised text, then as words, then as code points of the original.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import TERM, ascii_lower, column_of, fresh, terms
from purseline.staging import stage

# Fixed values of the contamination rule: words in a window, share of words hit in percent.
WINDOW = 13
PERCENT = 5

#: Most bytes of patterns in one automaton, which takes up to about 60 times as much memory.
#: A larger benchmark is scanned in several passes.
AUTOMATON_BYTES = 2_000_000

FOUND = "n_words long, n_hit long, items array<string>, hits array<struct<first: long, last: long>>, spans array<struct<start: long, end: long>>"


def windows(benchmark: DataFrame, item: str = "item_id", text: str = "text", size: int = WINDOW) -> DataFrame:
    """Distinct ``(pattern, item)``: ``size`` consecutive words, or all words of a shorter text.

    Texts without words have no window. Windows of rows without an id have a NULL item: they
    are found like others, but no item is named.
    """

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for name, body in zip(batch["item"], batch["body"], strict=True):
                found = terms(body)
                for i in range(max(1, len(found) - size + 1) if found else 0):
                    rows.append((f" {' '.join(found[i : i + size])} ", name))
            if rows:
                yield pd.DataFrame(rows, columns=["pattern", "item"])

    rows = benchmark.select(F.col(item).cast("string").alias("item"), F.col(text).alias("body"))
    return rows.mapInPandas(cut, "pattern string, item string").distinct()


def _automaton(patterns: dict[str, list[str]]) -> ahocorasick.Automaton:
    automaton = ahocorasick.Automaton()
    for pattern, items in patterns.items():
        automaton.add_word(pattern, (len(pattern), pattern.count(" ") - 1, items))
    automaton.make_automaton()
    return automaton


def _scan(automaton: ahocorasick.Automaton, text: str | None, items: set[str], hits: list[tuple[int, int]]) -> tuple:
    """One document against one automaton, added to what earlier automata found."""
    found = terms(text)
    ends, sizes = [], []
    if found:
        for end, (length, n, names) in automaton.iter(f" {' '.join(found)} "):
            ends.append(end - length + 1)
            sizes.append(n)
            items.update(names)
    if ends:
        starts = np.cumsum([0, *(len(word) + 1 for word in found)])
        first = np.searchsorted(starts, ends)
        hits = hits + list(zip(first.tolist(), (first + sizes - 1).tolist(), strict=True))
    merged: list[list[int]] = []
    for a, b in sorted(hits):
        if merged and a <= merged[-1][1] + 1:
            merged[-1][1] = max(merged[-1][1], b)
        else:
            merged.append([a, b])
    spans = []
    if merged:
        places = [m.span() for m in TERM.finditer(ascii_lower(text))]
        spans = [{"start": places[a][0], "end": places[b][1]} for a, b in merged]
    n_hit = sum(b - a + 1 for a, b in merged)
    return len(found), n_hit, sorted(items), [{"first": a, "last": b} for a, b in merged], spans


def _scanner(patterns: dict[str, list[str]], spark_broadcast: Callable) -> Callable[..., Column]:
    shared = spark_broadcast(patterns)

    @F.pandas_udf(FOUND)
    def scan(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        automaton = _automaton(shared.value) if shared.value else None
        for texts, items, hits in batches:
            rows = [
                _scan(automaton, text, set(names), [(h["first"], h["last"]) for h in places])
                if automaton
                else (len(terms(text)), 0, [], [], [])
                for text, names, places in zip(texts, items, hits, strict=True)
            ]
            yield pd.DataFrame(rows, columns=["n_words", "n_hit", "items", "hits", "spans"])

    return scan.asNondeterministic()  # so that no filter above runs it a second time


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    into: str = "contamination",
    size: int = WINDOW,
    automaton_bytes: int = AUTOMATON_BYTES,
) -> DataFrame:
    """``docs`` with a struct column ``into``, which replaces any column of that name.

    ``n_words``; ``n_hit``, words inside any window; ``items``, ids with windows that occur;
    ``hits``, first and last word of each hit stretch; ``spans``, the same as code points of
    the original text, end exclusive; ``contaminated``, at least 5 % of the words are hit.

    A NULL or wordless text has no words and is clean, an empty benchmark hits nothing.
    Equal rows get equal results. The benchmark is cut into blocks of at most
    ``automaton_bytes`` of patterns; rows move in no shuffle, and between two blocks they are
    written, so no task holds more than one automaton.
    """
    spark = docs.sparkSession
    patterns = stage(windows(benchmark, item, item_text, size), "benchmark-windows")
    total = patterns.agg(F.sum(F.octet_length("pattern") + F.coalesce(F.octet_length("item"), F.lit(0)))).first()[0] or 0
    blocks = max(1, -(-total // automaton_bytes))
    place = F.pmod(F.xxhash64("pattern", "item"), F.lit(blocks))
    out = docs
    for block in range(blocks):
        held: dict[str, list[str]] = {}
        for row in patterns.where(place == block).collect():  # bounded by automaton_bytes
            items = held.setdefault(row["pattern"], [])
            if row["item"] is not None:
                items.append(row["item"])
        scan = _scanner(held, spark.sparkContext.broadcast)
        before = (
            (F.col(into)["items"], F.col(into)["hits"])
            if block
            else (F.array().cast("array<string>"), F.array().cast("array<struct<first: long, last: long>>"))
        )
        out = out.withColumn(into, scan(column_of(text), *before))
        if block < blocks - 1:
            out = stage(out, "decontaminate-pass")
    found = F.col(into)
    guilty = (found["n_hit"] > 0) & (found["n_hit"] * 100 >= found["n_words"] * PERCENT)
    return out.withColumn(into, found.withField("contaminated", guilty))



def keep_clean(docs: DataFrame, benchmark: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with their columns, whatever their names.

    NULL and empty texts are clean and stay, so does everything without a benchmark; equal rows
    stay or go together.
    """
    found = fresh(docs, "contamination")
    marked = find_contamination(docs, benchmark, text, into=found)
    return marked.where(~F.col(found)["contaminated"]).select(*map(column_of, docs.columns))


def contamination_report(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The columns of the contract."""
    found = find_contamination(docs.select("doc_id", "text"), benchmark)
    c = F.col("contamination")
    return found.select(
        "doc_id",
        c["n_words"].alias("n_words"),
        c["n_hit"].alias("n_hit"),
        F.size(c["items"]).cast("long").alias("n_items"),
        F.sha2(F.array_join(c["items"], ","), 256).alias("items_sha256"),
        c["contaminated"].alias("contaminated"),
    )


SQL = """
with dw as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from documents),
iw as (
    select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w from benchmark),
pat as (
    select distinct item_id, w[i : i + 12] as p from (
        select item_id, w, unnest(generate_series(1, greatest(1, len(w) - 12))) as i from iw where len(w) > 0)),
sizes as (select distinct len(p) as n from pat),
cand as (
    select doc_id, i, n, w[i : i + n - 1] as p from (
        select doc_id, w, n, unnest(generate_series(1, len(w) - n + 1)) as i from dw, sizes where len(w) >= n)),
occ as (select doc_id, i, n, item_id from cand join pat using (p)),
hit as (select doc_id, count(distinct j) as n_hit from (
            select doc_id, unnest(generate_series(i, i + n - 1)) as j from occ) group by 1),
its as (select doc_id, count(distinct item_id) as n_items,
               string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as items from occ group by 1)
select doc_id, coalesce(len(w), 0)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= coalesce(len(w), 0) as contaminated
from dw left join hit using (doc_id) left join its using (doc_id)
"""
