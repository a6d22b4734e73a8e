"""Removal of word windows that occur more than once, by super-k-mer partitioning.

A window's minimiser is the least of its m-word hashes. Consecutive windows that share it
form a super-k-mer, which travels as one packed string to the bucket of its minimiser; equal
windows have equal minimisers, so a bucket sees all copies of its windows. There the windows
are sorted by a hash, and those with equal hashes are compared word for word.

Hot places stay small: frequent m-word hashes come last in the order of minimisers, so a
window that holds a common line is filed under its own rare words. A packed string that
repeats within a batch of documents is sent once by its task, marked as repeated; the places
it comes from need no bucket, and go to addresses of their own, dealt by batch.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from purseline.llm.common import Words, by_size, group_ends, mix, most_frequent, raw, run_hashes, words
from purseline.staging import stage

# Fixed value of the contract: words in a window.
WINDOW = 35
#: Words in an m-mer.
MER = 3
#: An m-mer is hot when it makes up this share of a batch, and is found this often there.
HOT_SHARE = 1 / 16_384
HOT_COUNT = 8
#: Hot m-mers kept, the most frequent. Any choice gives right results, as all tasks share it.
MOST_HOT = 65_536
#: Text in a bucket; packed strings are about three times as long.
BUCKET_BYTES = 4_000_000
#: Windows in a packed string.
LONGEST = 1_024
#: Repeated strings that a task remembers having sent; it would send any others again.
REMEMBERED = 200_000


def windows_of(rows: Words, length: int) -> np.ndarray:
    """Places at which ``length`` words of one text start."""
    firsts, counts = rows.starts[:-1], np.maximum(rows.sizes - length + 1, 0)
    before = np.concatenate([[0], np.cumsum(counts)])
    return np.arange(before[-1]) + np.repeat(firsts - before[:-1], counts)


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` consecutive values, by doubling."""
    span, least = 1, values
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    rest = width - span
    return np.minimum(least[: len(least) - rest], least[rest:]) if rest else least


def hot_mers(docs: DataFrame, text: str, m: int = MER) -> np.ndarray:
    """Sorted hashes of the m-mers that are frequent in some batch; at most ``MOST_HOT``.

    Only they order minimisers, so which of them are found decides speed and nothing else.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in by_size(batches, "body"):
            mers = run_hashes(Words([raw(x) for x in batch["body"]]).hashes, m)
            values, counts = np.unique(mers, return_counts=True)
            often = counts >= max(HOT_COUNT, HOT_SHARE * len(mers))
            yield pd.DataFrame({"mer": values[often].view(np.int64), "n": counts[often]})

    found = docs.select(F.col(text).alias("body")).mapInPandas(count, "mer long, n long")
    counts = stage(found.groupBy("mer").agg(F.sum("n").alias("n")), "hot-mers")
    top = most_frequent(counts, MOST_HOT).collect()
    return np.sort(np.array([row["mer"] for row in top], np.int64).view(np.uint64))


def _is_in(values: np.ndarray, ordered: np.ndarray) -> np.ndarray:
    if not len(ordered):
        return np.zeros(len(values), bool)
    place = np.minimum(np.searchsorted(ordered, values), len(ordered) - 1)
    return ordered[place] == values


def super_kmers(
    mers: np.ndarray, valid: np.ndarray, begins: np.ndarray, size: int, m: int, hot: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first window, number of windows, minimiser) of each stretch that shares a minimiser.

    ``valid`` are the places where windows of one document start, in order, ``begins`` those
    where documents do.
    """
    if not len(valid):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.uint64)
    order = (mix(mers) >> np.uint64(1)) | (_is_in(mers, hot).astype(np.uint64) << np.uint64(63))
    least = _sliding_min(order, size - m + 1)[valid]
    new = np.empty(len(valid), bool)
    new[0] = True
    new[1:] = (least[1:] != least[:-1]) | (valid[1:] != valid[:-1] + 1)
    new[np.searchsorted(valid, begins[begins <= valid[-1]])] = True
    firsts = np.flatnonzero(new)
    counts = np.diff(np.append(firsts, len(valid)))
    pieces = -(-counts // LONGEST)  # a stretch of one repeated word may be as long as its text
    within = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    starts = np.repeat(firsts, pieces) + within * LONGEST
    lengths = np.minimum(np.repeat(counts, pieces) - within * LONGEST, LONGEST)
    return valid[starts], lengths, np.repeat(least[firsts], pieces)


def text_key(id: object, text: str) -> bytes:
    """Names a document by its id and text; equal rows share it, and their result."""
    return xxhash.xxh3_128_digest(f"{id}\0{text}".encode("utf-8", "surrogatepass"))


def merged_stretches(owner: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Stretches in order of owner and place, with those that touch or overlap made one."""
    new = np.append(True, (owner[1:] != owner[:-1]) | (first[1:] > last[:-1]))
    begins = np.flatnonzero(new)
    return owner[begins], first[begins], last[np.append(begins[1:], len(first)) - 1]


def _pack(docs: DataFrame, hot: np.ndarray, buckets: int, size: int, m: int) -> DataFrame:
    """Per batch and bucket the packed strings, with the places they come from.

    A string found again in its batch is certain to repeat: the task sends it once, with no
    place, and its places are known to be covered from there on. These, merged by document,
    are a row without strings per batch, whose address above the buckets follows the batch.
    So a bucket does not grow with the documents that hold a string.
    """
    shared = docs.sparkSession.sparkContext.broadcast(hot)

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze, sent = zstandard.ZstdCompressor(level=3), set()
        task = TaskContext.get().partitionId()
        for turn, batch in enumerate(by_size(batches, "body")):
            rows = Words([raw(x) for x in batch["body"]])
            valid = windows_of(rows, size)
            if not len(valid):
                continue
            at, n, least = super_kmers(
                run_hashes(rows.hashes, m), valid, rows.starts[:-1], size, m, shared.value
            )
            first, last, whole = rows.begins[at].tolist(), rows.ends[at + n + size - 2].tolist(), rows.whole
            owner = np.searchsorted(rows.starts, at, side="right") - 1
            place = at - rows.starts[owner]
            owners = owner.tolist()
            used = set(owners)
            keys = [
                text_key(i, x) if k in used else b"" for k, (i, x) in enumerate(zip(batch["id"], batch["body"], strict=True))
            ]
            bucket = mix(least) % np.uint64(buckets)
            order = np.argsort(bucket, kind="stable")
            begins, stops = group_ends(bucket[order])
            out, covered = [], []
            for a, b in zip(begins.tolist(), stops.tolist(), strict=True):
                seen: dict[bytes, list[int]] = {}
                for r in order[a:b].tolist():
                    seen.setdefault(whole[first[r] : last[r]], []).append(r)
                single, strings, twice = [], [], []
                for string, runs in seen.items():
                    name = xxhash.xxh3_128_digest(string) if sent or len(runs) > 1 else b""
                    if name in sent:
                        covered += runs
                    elif len(runs) > 1:
                        covered += runs
                        twice.append(string)
                        if len(sent) < REMEMBERED:
                            sent.add(name)
                    else:
                        single.append(runs[0])
                        strings.append(string)
                if strings or twice:
                    out.append(
                        (
                            int(bucket[order[a]]),
                            squeeze.compress(b"\n".join(strings + twice)),
                            len(twice),
                            b"".join(keys[owners[r]] for r in single),
                            place[single].astype(np.int32).tobytes(),
                        )
                    )
            if covered:
                at_ = np.sort(np.array(covered))
                of, a, b = merged_stretches(owner[at_], place[at_], place[at_] + n[at_] + size - 1)
                address = buckets + int(mix(np.array([task << 32 | turn], np.uint64))[0] % np.uint64(buckets))
                bounds = np.concatenate([a, b]).astype(np.int32).tobytes()
                out.append((address, None, 0, b"".join(keys[k] for k in of.tolist()), bounds))
            yield pd.DataFrame(out, columns=["bucket", "strings", "n_twice", "keys", "places"])

    return docs.mapInPandas(pack, "bucket long, strings binary, n_twice int, keys binary, places binary")


def repeated_windows(strings: list[bytes], twice: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Which windows of some different strings are found again, and where each string's begin.

    ``twice`` marks strings that stand for two or more places.
    """
    rows = Words(strings, normal=True)
    valid = windows_of(rows, size)
    counts = rows.sizes - size + 1
    before = np.concatenate([[0], np.cumsum(counts)])
    found = np.repeat(twice, counts)
    values = run_hashes(rows.hashes, size)[valid]
    order = np.argsort(values, kind="stable")
    begins, stops = group_ends(values[order])
    several = stops - begins > 1
    for a, b in zip(begins[several].tolist(), stops[several].tolist(), strict=True):
        same: dict[bytes, list[int]] = {}
        for w in order[a:b].tolist():
            words_of = rows.whole[rows.begins[valid[w]] : rows.ends[valid[w] + size - 1]]
            same.setdefault(words_of, []).append(w)
        for group in same.values():
            if len(group) > 1:
                found[group] = True
    return found, before


def _count_bucket(size: int):
    def count(packed: pd.DataFrame) -> pd.DataFrame:
        expand = zstandard.ZstdDecompressor()
        number: dict[bytes, int] = {}
        of, sent, keys, places = [], [], [], []
        out_keys, out_first, out_last = [], [np.empty(0, np.int32)], [np.empty(0, np.int32)]
        if packed["strings"].iloc[0] is None:  # an address of covered stretches
            for row in packed.itertuples(index=False):
                bounds = np.frombuffer(row.places, np.int32)
                half = len(bounds) // 2
                out_keys += [row.keys[16 * i : 16 * i + 16] for i in range(half)]
                out_first.append(bounds[:half])
                out_last.append(bounds[half:])
            return pd.DataFrame({"key": out_keys, "first": np.concatenate(out_first), "last": np.concatenate(out_last)})
        for row in packed.itertuples(index=False):
            strings = expand.decompress(row.strings).split(b"\n")
            of += [number.setdefault(s, len(number)) for s in strings]
            sent += [True] * (len(strings) - row.n_twice) + [False] * row.n_twice
            keys.append(row.keys + bytes(16 * row.n_twice))
            places.append(np.concatenate([np.frombuffer(row.places, np.int32), np.zeros(row.n_twice, np.int32)]))
        names, at, came = b"".join(keys), np.concatenate(places), np.array(sent)
        copies = np.bincount(of, np.where(came, 1, 2))
        found, before = repeated_windows(list(number), copies > 1, size)
        some = np.logical_or.reduceat(found, before[:-1])
        for i in np.flatnonzero(came & some[of]).tolist():
            flags = found[before[of[i]] : before[of[i] + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.view(np.int8), [0]])))
            out_keys += [names[16 * i : 16 * i + 16]] * (len(edges) // 2)
            out_first.append(edges[::2] + at[i])
            out_last.append(edges[1::2] + size - 1 + at[i])
        return pd.DataFrame(
            {
                "key": out_keys,
                "first": np.concatenate(out_first).astype(np.int32),
                "last": np.concatenate(out_last).astype(np.int32),
            }
        )

    return count


def repeated_stretches(docs: DataFrame, size: int, m: int = MER, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """``(key, stretches)``: word ranges, end exclusive, covered by windows found again."""
    total = docs.agg(F.sum(F.octet_length("body"))).first()[0] or 0
    buckets = max(64, -(-total // bucket_bytes))
    m = min(m, size)
    packed = _pack(docs, hot_mers(docs, "body", m), buckets, size, m)
    marks = packed.groupBy("bucket").applyInPandas(_count_bucket(size), "key binary, first int, last int")
    return marks.groupBy("key").agg(F.collect_set(F.struct("first", "last")).alias("stretches"))


def remove_repeats(
    docs: DataFrame, id: str = "doc_id", text: str = "text", size: int = WINDOW, bucket_bytes: int = BUCKET_BYTES
) -> DataFrame:
    """Per input row ``id``, ``n_words``, ``n_removed`` and ``kept``, the words left.

    A word goes when any window of ``size`` words that covers it starts anywhere else too,
    in the same text or in another; all places are judged on the input, so no copy stays.
    NULL and empty texts have no words and an empty ``kept``; a text of fewer than ``size``
    words stays whole. Rows that repeat with id and text repeat each other's windows.
    """
    # The id travels as text: a NULL among numbers would make them doubles.
    rows = docs.select(F.col(id).cast("string").alias("id"), F.col(text).alias("body"))
    marks = stage(repeated_stretches(rows, size, bucket_bytes=bucket_bytes), "repeated-stretches")

    def keyed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in batches:
            texts = [b" ".join(words(x)) for x in batch["body"]]
            yield pd.DataFrame(
                {
                    "id": batch["id"],
                    "of": [text_key(i, x or "") for i, x in zip(batch["id"], batch["body"], strict=True)],
                    "n_words": [x.count(b" ") + 1 if x else 0 for x in texts],
                    "packed": [squeeze.compress(x) for x in texts],
                }
            )

    sent = rows.mapInPandas(keyed, "id string, of binary, n_words long, packed binary")
    joined = sent.join(marks, F.col("of") == F.col("key"), "left")

    @F.pandas_udf("n_removed long, kept string")
    def cut(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        expand = zstandard.ZstdDecompressor()
        for packed, stretches in batches:
            out = []
            for data, ranges in zip(packed, stretches, strict=True):
                found = expand.decompress(data)
                if ranges is None or not len(ranges):
                    out.append((0, found.decode("utf-8", "surrogatepass")))
                    continue
                found = found.split()
                kept, at = [], 0
                for a, b in sorted((r["first"], r["last"]) for r in ranges):
                    if b > at:
                        kept += found[at : max(at, a)]
                        at = b
                kept += found[at:]
                out.append((len(found) - len(kept), b" ".join(kept).decode("utf-8", "surrogatepass")))
            yield pd.DataFrame(out, columns=["n_removed", "kept"])

    done = joined.withColumn("x", cut.asNondeterministic()("packed", "stretches"))
    return done.select(F.col("id").cast(docs.schema[id].dataType).alias(id), "n_words", F.col("x.n_removed"), F.col("x.kept"))


def repeats_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    cleaned = remove_repeats(docs)
    return cleaned.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL = f"""
with d as (select doc_id, regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+') as w from documents),
win as (
    select doc_id, i, sha256(array_to_string(w[i : i + {WINDOW - 1}], ' ')) as h from (
        select doc_id, w, unnest(generate_series(1, len(w) - {WINDOW - 1})) as i from d where len(w) >= {WINDOW})),
dup as (select h from win group by 1 having count(*) > 1),
gone as (select distinct doc_id, unnest(generate_series(i, i + {WINDOW - 1})) as j from win join dup using (h)),
wordlist as (select doc_id, unnest(w) as word, unnest(generate_series(1, len(w))) as j from d),
kept as (
    select doc_id, count(*) as n, string_agg(word, ' ' order by j) as t
    from wordlist anti join gone using (doc_id, j) group by 1)
select doc_id, coalesce(len(w), 0)::bigint as n_words, (coalesce(len(w), 0) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
"""
