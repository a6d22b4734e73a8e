"""N-gram Jaccard join as a blocked sparse product of the document by n-gram incidence.

Candidates come from postings of the rarest n-grams. All sets are put in one order, by the
counts of a sketch of fixed size and then by hash; any order shared by all is exact. Two sets
that reach the threshold both hold the same share of their union, so at least one of them is
missing few enough n-grams to have one in common within the prefix that the size cuts off.
A list of documents that share such an n-gram may hold strangers; so each document has the
parities of its n-grams by place, two to four places for each, and a pair is dropped before any
text is read if these, or the sizes, differ in more n-grams than two linked sets can.

In a block of documents overlap counts are summed up column slice by column slice, and a pair
is given up as soon as the n-grams left cannot lift it to what its two sizes ask for. Before
the lists are looked at, documents of equal least hashes are joined through one leader each,
which finds most links of crowds of copies. Entries of a list that are close to one of another
component are then put together, also across lists where they share documents, and multiplied
out in blocks, so that every qualifying pair is either computed or known to be connected.
Equal sets are one row from the start.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from purseline.llm.common import MemberFilter, Words, by_size, column_of, fresh, mix, raw, run_hashes
from purseline.staging import stage

# Fixed values of the contract: words in a shingle, similarity in percent.
SHINGLE = 3
PERCENT = 90

#: Documents in a block of the product, and n-grams in a column slice of it.
BLOCK = 256
SLICE = 4_096
#: Counters of the sketch that orders n-grams: one for so many of them, and at most; and those that travel as one row.
COUNTER_LOAD = 32
COUNTERS = 1 << 22
COUNTER_PART = 1 << 15
#: Words of the parities that entries of lists carry; the whole ones are looked at where these cannot tell.
CARRIED = 4
#: Sketches of so many tasks are added up by one.
FANOUT = 64
#: Orders in which the least n-gram of a document is taken, for its leaders.
LEASTS = 4


def shingle_sets(texts: list[bytes], size: int = SHINGLE) -> list[np.ndarray]:
    """Per text the sorted 64-bit hashes of its shingles; of all words where there are fewer."""
    rows = Words(texts)
    runs = run_hashes(rows.hashes, size)
    out = []
    for a, n in zip(rows.starts.tolist(), rows.sizes.tolist(), strict=False):
        if n >= size:
            out.append(np.unique(runs[a : a + n - size + 1]))
        else:
            out.append(run_hashes(rows.hashes[a : a + n], n) if n else np.empty(0, np.uint64))
    return out


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """N-grams of ``n``, in the shared order, of which a linked set must have one in its own prefix."""
    return n - -(-n * percent // 100) + 1


def counter_of(grams: np.ndarray, counters: int) -> np.ndarray:
    return (grams >> np.uint64(64 - (counters.bit_length() - 1))).astype(np.int64)


def prefix(grams: np.ndarray, counts: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The rarest n-grams of a set, as many as a linked set must share one of."""
    order = np.argsort(counts[counter_of(grams, len(counts))], kind="stable")  # then by hash
    return grams[order[: prefix_size(len(grams), percent)]]


def parities(grams: np.ndarray) -> np.ndarray:
    """Parities of the n-grams by place, in words of 64; there are two to four places for an n-gram.

    Sets that differ in d n-grams differ in d places at most. Half of the words added to the
    other half are the parities by half as many places.
    """
    places = 64 << max(0, (len(grams) - 1).bit_length() - 5)
    place = (mix(grams) & np.uint64(places - 1)).astype(np.int64)
    odd = (np.bincount(place, minlength=places) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def folded(bits: np.ndarray, words: int) -> np.ndarray:
    """The parities by the places of so many words at most, filled up with zeros."""
    while len(bits) > words:
        bits = bits[: len(bits) // 2] ^ bits[len(bits) // 2 :]
    return np.concatenate([bits, np.zeros(words - len(bits), np.int64)])


def leasts(grams: np.ndarray) -> np.ndarray:
    """The least hash of the set in each of several orders; near copies share most of them."""
    return np.array([mix(grams ^ mix(np.array([i + 1], np.uint64))).min() for i in range(LEASTS)], np.uint64)


def overlaps(sets: list[np.ndarray], percent: int, known: np.ndarray | None = None) -> np.ndarray:
    """Pairs (i < j) of different sets that reach the threshold, as an array of two columns.

    ``known`` numbers components already found; pairs within one are not looked at.
    """
    n = len(sets)
    sizes = np.fromiter(map(len, sets), np.int64, n)
    low, high = np.minimum.outer(sizes, sizes), np.maximum.outer(sizes, sizes)
    # 100 I >= p (a + b - I)  <=>  I >= p (a + b) / (100 + p)
    need = -(-(sizes[:, None] + sizes[None, :]) * percent // (100 + percent))
    alive = np.triu(np.ones((n, n), bool), 1) & (low * 100 >= high * percent)
    if known is not None:
        alive &= known[:, None] != known[None, :]
    rows = np.repeat(np.arange(n), sizes)
    values, column, found = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = found[column] > 1
    rows, column = rows[shared], column[shared]
    order = np.argsort(column, kind="stable")
    rows, column = rows[order], column[order]
    left = np.bincount(rows, minlength=n)
    total = np.zeros((n, n), np.int64)
    alive &= np.minimum.outer(left, left) >= need
    for start in range(0, len(values), SLICE):
        if not alive.any():
            break
        a, b = np.searchsorted(column, [start, start + SLICE])
        if a == b:
            continue
        used, local = np.unique(column[a:b], return_inverse=True)
        incidence = np.zeros((n, len(used)), np.float32)
        incidence[rows[a:b], local] = 1
        total += (incidence @ incidence.T).astype(np.int64)
        left = left - np.bincount(rows[a:b], minlength=n)
        alive &= total + np.minimum.outer(left, left) >= need
    return np.argwhere(alive & (total >= need))


def _forest(pairs: np.ndarray, n: int) -> list[tuple[int, int]]:
    """Pairs that connect what ``pairs`` connect, at most n - 1."""
    above = list(range(n))

    def root(x: int) -> int:
        while above[x] != x:
            above[x] = above[above[x]]
            x = above[x]
        return x

    kept = []
    for a, b in pairs.tolist():
        x, y = root(a), root(b)
        if x != y:
            above[max(x, y)] = min(x, y)
            kept.append((a, b))
    return kept


def _multiply(size: int, percent: int):
    """The product of one block: rows ``(digest, packed[, label])`` to links."""

    def links(block: pd.DataFrame) -> pd.DataFrame:
        block = block.drop_duplicates("digest")
        expand = zstandard.ZstdDecompressor()
        sets = shingle_sets([expand.decompress(x) for x in block["packed"]], size)
        known = pd.factorize(block["label"])[0] if "label" in block else None
        digests = block["digest"].tolist()
        kept = _forest(overlaps(sets, percent, known), len(sets)) if len(sets) > 1 else []
        return pd.DataFrame({"a": [digests[i] for i, _ in kept], "b": [digests[j] for _, j in kept]})

    return links


def components(links: DataFrame) -> DataFrame:
    """``(node, label)``: the least node reachable, by alternating large and small stars.

    Each round is written to the shared folder. It ends when every node hangs directly on the
    least node of its component. A node with very many neighbours is one row per task and
    label in the sums, and its join is split by Spark.
    """
    star = stage(links.select(F.least("a", "b").alias("v"), F.greatest("a", "b").alias("u")).distinct(), "stars")

    def both(edges: DataFrame) -> DataFrame:
        return edges.select(F.col("u").alias("x"), F.col("v").alias("y")).union(
            edges.select(F.col("v").alias("x"), F.col("u").alias("y"))
        )

    def rehang(edges: DataFrame, upwards: bool) -> DataFrame:
        least = edges.groupBy("x").agg(F.min("y").alias("m"))
        least = least.select(F.col("x").alias("of"), F.least("x", "m").alias("m"))
        joined = edges.join(least, F.col("x") == F.col("of"))
        kept = joined.where("y > x") if upwards else joined.where("y < x")
        out = kept.select(F.col("y").alias("u"), F.col("m").alias("v"))
        if not upwards:
            out = out.union(least.select(F.col("of").alias("u"), F.col("m").alias("v")))
        return out.where("u <> v").distinct()

    while True:
        large = rehang(both(star), True)
        small = stage(rehang(large.select(F.col("u").alias("x"), F.col("v").alias("y")), False), "stars")
        mark = F.struct(F.count("*"), F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)))
        if small.agg(mark).first() == star.agg(mark).first():
            break
        star = small
    return small.select(F.col("u").alias("node"), F.col("v").alias("label")).union(
        small.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct()
    )


def _code(id: str, text: str) -> Column:
    """128 bits that name a document by id and text."""

    def told(value: Column) -> Column:
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.unhex(F.md5(F.concat(told(column_of(id).cast("string")), told(column_of(text)))))


def describe(docs: DataFrame, id: str, text: str, size: int) -> DataFrame:
    """Per input row ``id``, ``code``, ``digest`` of its set, ``n_shingles``, ``packed``.

    ``code`` names a document by id and text. The words, compressed, are there once for each
    set in a batch: equal sets have equal ones.
    """

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for batch in by_size(batches, "body"):
            rows, seen = [], set()
            texts = [raw(body).lower() for body in batch["body"]]  # of bytes: A-Z only
            for body, grams in zip(texts, shingle_sets(texts, size), strict=True):
                digest = xxhash.xxh3_128_digest(grams.tobytes())
                if digest in seen or not len(grams):
                    rows.append((digest, len(grams), None))
                    continue
                seen.add(digest)
                rows.append((digest, len(grams), squeeze.compress(body)))
            out = pd.DataFrame(rows, columns=["digest", "n_shingles", "packed"])
            out.insert(0, "code", batch["code"].to_numpy())
            out.insert(0, "id", batch["id"].to_numpy())
            yield out

    # The id travels as text: a NULL among numbers would make them doubles.
    rows = docs.select(column_of(id).cast("string").alias("id"), _code(id, text).alias("code"), column_of(text).alias("body"))
    schema = "id string, code binary, digest binary, n_shingles long, packed binary"
    return rows.mapInPandas(read, schema).withColumn("id", F.col("id").cast(docs.schema[id].dataType))


def _short(digest: str) -> Column:
    """First 8 bytes of a digest, as ``describe`` reads them: a name for lists, not for links."""
    return F.conv(F.hex(F.col(digest).substr(1, 8)), 16, -10).cast("long")


def _grams(batches: Iterator[pd.DataFrame], size: int) -> Iterator[tuple[pd.DataFrame, list[np.ndarray]]]:
    """The sets of packed texts, batch by batch."""
    expand = zstandard.ZstdDecompressor()
    for batch in by_size(batches, "packed", 1_000_000):
        yield batch, shingle_sets([expand.decompress(x) for x in batch["packed"]], size)


def _added(parts: list[bytes]) -> bytes:
    expand = zstandard.ZstdDecompressor()
    total = sum(np.frombuffer(expand.decompress(x), "<u8") for x in parts)
    return zstandard.ZstdCompressor(level=1).compress(total.tobytes())


def counters_for(grams: int) -> int:
    """A power of two, so that the sketch is as busy for a small corpus as for one that fills it."""
    return min(COUNTERS, 1 << max(10, (grams // COUNTER_LOAD).bit_length()))


def count_grams(sets: DataFrame, size: int, counters: int) -> np.ndarray:
    """How many documents have n-grams of each counter, over all documents.

    A task counts what it reads; sketches are added up ``FANOUT`` at a time, so neither a task
    nor the driver gets more of them at any number of tasks.
    """
    part = min(COUNTER_PART, counters)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = np.zeros(counters, np.uint32)
        for _, found in _grams(batches, size):
            for grams in found:
                np.add.at(held, counter_of(grams, counters), np.uint32(1))
        squeeze = zstandard.ZstdCompressor(level=1)
        task = TaskContext.get().partitionId()
        parts = (held[i * part : (i + 1) * part].astype("<u8") for i in range(counters // part))
        rows = [(i, task, squeeze.compress(x.tobytes())) for i, x in enumerate(parts)]
        yield pd.DataFrame(rows, columns=["part", "task", "counts"])

    def add(group: pd.DataFrame) -> pd.DataFrame:
        first = group.iloc[:1]
        return first.assign(counts=[_added(group["counts"].tolist())])

    schema = "part int, task int, counts binary"
    rows = stage(sets.select("packed").mapInPandas(count, schema), "jaccard-counts")
    while (rows.agg(F.max("task")).first()[0] or 0) >= FANOUT:
        rows = rows.withColumn("task", F.floor(F.col("task") / FANOUT).cast("int"))
        rows = stage(rows.groupBy("part", "task").applyInPandas(add, schema), "jaccard-counts")
    expand, out = zstandard.ZstdDecompressor(), np.zeros(counters, np.uint64)
    for row in rows.select("part", "counts").toLocalIterator():  # FANOUT sketches at most, one after another
        out[row["part"] * part : (row["part"] + 1) * part] += np.frombuffer(expand.decompress(row["counts"]), "<u8")
    return out


def ranks(counts: np.ndarray) -> np.ndarray:
    """The counts by their logarithm in a byte: only their order is used, and a step is 4 %."""
    return np.minimum(255, np.rint(16 * np.log2(1.0 + counts))).astype(np.uint8)


def _signed(sets: DataFrame, size: int, percent: int, counts: np.ndarray) -> DataFrame:
    """``(short, n, signs, bits, few, leasts)`` of each set: its size, prefix, parities and least hashes."""

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch, found in _grams(batches, size):
            signs = [prefix(grams, counts, percent).view(np.int64) for grams in found]
            bits = [parities(grams) for grams in found]
            yield pd.DataFrame(
                {
                    "short": batch["short"],
                    "n": [len(grams) for grams in found],
                    "signs": signs,
                    "bits": bits,
                    "few": [folded(x, CARRIED) for x in bits],
                    "leasts": [leasts(grams).view(np.int64) for grams in found],
                }
            )

    schema = "short long, n long, signs array<long>, bits array<long>, few array<long>, leasts array<long>"
    return stage(sets.select("short", "packed").mapInPandas(read, schema), "jaccard-signed")


def _folded(bits: Column) -> Column:
    """The parities by half as many places."""
    half = (F.size(bits) / 2).cast("int")
    return F.zip_with(F.slice(bits, 1, half), F.slice(bits, half + 1, half), lambda x, y: x.bitwiseXOR(y))


def _fits(one: str, other: str, percent: int, apart: Column) -> Column:
    """Whether sets of such sizes that differ in ``apart`` places can be linked; columns begin with these."""
    a, b = F.col(f"{one}n"), F.col(f"{other}n")
    need = F.expr(f"({percent} * ({one}n + {other}n) + {99 + percent}) div {100 + percent}")
    like = F.least(a, b) * 100 >= F.greatest(a, b) * percent
    return F.when(like, apart <= a + b - 2 * need).otherwise(F.lit(False))


def _maybe(one: str, other: str, percent: int) -> Column:
    """By the parities that entries carry. Short sets have fewer places than these; if the two differ
    in that, the places do not compare, and the pair passes."""
    apart = sum((F.bit_count(F.col(f"{one}{p}").bitwiseXOR(F.col(f"{other}{p}"))) for p in _FEW), F.lit(0))
    compare = F.least(F.col(f"{one}words"), F.lit(CARRIED)) == F.least(F.col(f"{other}words"), F.lit(CARRIED))
    return _fits(one, other, percent, F.when(compare, apart).otherwise(F.lit(0)))


def _close(one: str, other: str, percent: int) -> Column:
    """By all parities."""
    x, y = F.col(f"{one}bits"), F.col(f"{other}bits")
    # Linked sets are of like size, so one has twice the places of the other at most.
    less = F.when(F.size(x) > F.size(y), _folded(x)).otherwise(x), F.when(F.size(y) > F.size(x), _folded(y)).otherwise(y)
    each = F.zip_with(*less, lambda p, q: F.bit_count(p.bitwiseXOR(q)))
    return _fits(one, other, percent, F.aggregate(each, F.lit(0), lambda total, bits: total + bits))


_FEW = [f"f{i}" for i in range(CARRIED)]


def _named(slim: DataFrame, start: str) -> DataFrame:
    return slim.select(*[F.col(name).alias(f"{start}{name}") for name in slim.columns])


def _unlike(lists: DataFrame) -> DataFrame:
    """Of lists with the same members only one; documents that share a passage share all its n-grams."""
    alike = [F.bit_xor(F.xxhash64("member", F.lit(i))).alias(f"x{i}") for i in range(2)]
    alike = lists.groupBy("sign").agg(*alike, F.count("*").alias("x2")).groupBy("x0", "x1", "x2")
    return lists.join(alike.agg(F.min("sign").alias("at")), F.col("sign") == F.col("at"), "left_semi")


def _prune(rows: DataFrame, members: DataFrame, member: str) -> DataFrame:
    """The rows whose ``short`` is a member, but for what a filter lets through, unshuffled."""
    return MemberFilter(members, member).split(rows, "short")


def jaccard_links(
    sets: DataFrame, size: int = SHINGLE, percent: int = PERCENT, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """``(a, b)`` digests of linked sets, enough to connect all that are linked; their labels.

    ``sets`` is a written table as ``describe`` gives it.
    """
    some = sets.where("packed is not null").withColumn("short", _short("digest"))
    grams = some.agg(F.sum("n_shingles")).first()[0] or 0
    signed = _signed(some, size, percent, ranks(count_grams(some, size, counters_for(grams))))
    few = [F.get("few", F.lit(i)).alias(name) for i, name in enumerate(_FEW)]
    slim = signed.select("short", "n", F.size("bits").alias("words"), *few).distinct()
    product = _multiply(size, percent)

    # In each order, the documents of one least hash and the leader that a hash of it picks.
    rows = signed.select(F.col("short").alias("member"), F.posexplode("leasts").alias("turn", "least")).distinct()
    pick = F.xxhash64("member", "turn")
    crowds = rows.groupBy(F.col("turn").alias("in_turn"), F.col("least").alias("of_least")).agg(
        F.min_by("member", pick).alias("leader"), F.min("member").alias("low"), F.max("member").alias("high")
    )
    crowds = crowds.where("low <> high").drop("low", "high")
    pairs = rows.join(crowds, (F.col("turn") == F.col("in_turn")) & (F.col("least") == F.col("of_least")))
    pairs = pairs.where("member <> leader").select("leader", "member").distinct()
    pairs = pairs.join(_named(slim, "l_"), F.col("leader") == F.col("l_short"))
    pairs = pairs.join(_named(slim, "m_"), F.col("member") == F.col("m_short")).where(_maybe("l_", "m_", percent))
    pairs = stage(pairs.select("leader", "member"), "jaccard-pairs")
    paired = stage(pairs.select(F.col("leader").alias("of")).union(pairs.select("member")).distinct(), "jaccard-paired")
    texts = _prune(some.select("digest", "short", "packed"), paired, "of")
    texts = texts.join(paired, F.col("short") == F.col("of"), "left_semi")
    texts = texts.groupBy("digest", "short").agg(F.min("packed").alias("packed"))
    crowd = pairs.groupBy("leader").agg(F.ceil(F.count("*") / block).alias("blocks"))
    pairs = pairs.join(crowd, "leader").withColumn("block", F.pmod(F.xxhash64("member"), "blocks")).drop("blocks")
    pairs = pairs.union(pairs.select("leader", F.col("leader").alias("member"), "block").distinct())
    placed = pairs.join(texts, F.col("member") == F.col("short")).select("leader", "block", "digest", "packed")
    first = stage(placed.groupBy("leader", "block").applyInPandas(product, "a binary, b binary"), "jaccard-links")

    labels = components(first)
    columns = signed.select(F.explode("signs").alias("sign"), F.col("short").alias("member"))
    spread = columns.groupBy("sign").agg(F.min("member").alias("low"), F.max("member").alias("high"))
    spread = spread.where("low <> high").select(F.col("sign").alias("at"))
    lists = stage(columns.join(spread, F.col("sign") == F.col("at")).drop("at").distinct(), "jaccard-lists")
    lists = stage(_unlike(lists), "jaccard-lists")
    members = lists.select("member").distinct()
    known = some.select("digest", "short").distinct().join(members, F.col("short") == F.col("member"), "left_semi")
    known = known.join(labels, F.col("digest") == F.col("node"), "left").select(
        "digest", "short", F.coalesce("label", "digest").alias("label")
    )
    known = stage(known, "jaccard-labelled")
    # Lists whose members are not all connected yet. All entries of a list that are close to one
    # of another component are put together, in rows no more than entries; strangers stay out.
    named = lists.join(known, F.col("member") == F.col("short")).select("sign", "member", "digest", "label")
    named = stage(named, "jaccard-named")
    mixed = named.groupBy("sign").agg(F.min("label").alias("low"), F.max("label").alias("high"))
    named = named.join(mixed.where("low <> high").select("sign"), "sign")
    named = stage(named.join(_named(slim, "m_"), F.col("member") == F.col("m_short")).drop("m_short"), "jaccard-mixed")

    def meeting(rows: DataFrame, fits: Callable[[str, str, int], Column]) -> DataFrame:
        """The rows that have one of another component in their list which fits them."""
        carried = [name for name in rows.columns if name.startswith("m_")]
        other = rows.select(
            F.col("sign").alias("at"), F.col("label").alias("other_label"), *[F.col(x).alias(f"o{x[1:]}") for x in carried]
        )
        meets = (F.col("sign") == F.col("at")) & (F.col("label") != F.col("other_label")) & fits("m_", "o_", percent)
        return rows.join(other, meets, "left_semi").select("sign", "member", "digest", "label")

    near = stage(_unlike(stage(meeting(named, _maybe), "jaccard-near")), "jaccard-near")
    whole = _prune(signed.select("short", "n", "bits"), near.select(F.col("member").alias("of")).distinct(), "of").distinct()
    near = near.join(_named(whole, "m_"), F.col("member") == F.col("m_short")).drop("m_short")
    near = stage(meeting(stage(near, "jaccard-near"), _close).select("sign", "digest"), "jaccard-close")
    hubs = near.groupBy("sign").agg(F.min("digest").alias("a"))
    pairs = near.join(hubs, "sign").where("a <> digest").select("a", F.col("digest").alias("b")).distinct()
    clusters = stage(components(pairs).withColumnRenamed("label", "cluster"), "jaccard-clusters")
    half = block // 2
    crowd = clusters.groupBy("cluster").agg(F.ceil(F.count("*") / half).alias("blocks"))
    wide = clusters.join(crowd, "cluster").withColumn("mine", F.pmod(F.xxhash64("node"), "blocks"))
    wide = wide.select("cluster", "node", "mine", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("yours"))
    wide = wide.select("cluster", "node", F.least("mine", "yours").alias("i"), F.greatest("mine", "yours").alias("j"))
    clustered = known.join(clusters, F.col("digest") == F.col("node"), "left_semi").select(F.col("short").alias("of"))
    texts = _prune(some.select("digest", "short", "packed"), clustered, "of")
    texts = texts.join(clusters, F.col("digest") == F.col("node"), "left_semi")
    texts = texts.groupBy("digest").agg(F.min("packed").alias("packed")).join(known.select("digest", "label"), "digest")
    wide = wide.join(texts, F.col("node") == F.col("digest")).select("cluster", "i", "j", "digest", "packed", "label")
    second = stage(wide.groupBy("cluster", "i", "j").applyInPandas(product, "a binary, b binary"), "jaccard-links")
    found = first.union(second)
    if second.isEmpty():
        return found, labels
    return found, components(found)


def _headed(docs: DataFrame, id: str, text: str, size: int, percent: int, block: int) -> DataFrame:
    """Per input row ``id``, ``code``, ``n_shingles`` and ``head`` of its component.

    The head has the least id, NULL being the largest, and of equal ids the least code; rows
    without shingles have no head.
    """
    rows = stage(describe(docs, id, text, size), "jaccard-sets")
    _, labels = jaccard_links(rows, size, percent, block)
    place = F.struct(F.col("id").isNull().alias("unnamed"), "id", "code")
    sets = rows.where("n_shingles > 0").groupBy("digest").agg(F.min(place).alias("first"))
    labelled = sets.join(labels, F.col("digest") == F.col("node"), "left").select(
        "digest", "first", F.coalesce("label", "digest").alias("label")
    )
    labelled = stage(labelled, "jaccard-heads")
    least = labelled.groupBy(F.col("label").alias("of")).agg(F.min("first").alias("head"))
    named = labelled.join(least, F.col("label") == F.col("of")).select(F.col("digest").alias("set"), "head")
    return rows.join(named, (F.col("digest") == F.col("set")) & (F.col("n_shingles") > 0), "left").select(
        "id", "code", "n_shingles", "head"
    )


def jaccard_components(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """Per input row ``id``, ``n_shingles`` and ``component``, the least id reachable by links.

    A text of fewer words than a shingle is one shingle. Empty and NULL texts have no shingles
    and are linked with nothing, so they are components of their own. Repeated rows are linked
    like any equal texts. NULL ids never name a component that has another id.
    """
    out = _headed(docs, id, text, size, percent, block)
    component = F.when(F.col("n_shingles") > 0, F.col("head.id")).otherwise(F.col("id"))
    return out.select(F.col("id").alias(id), "n_shingles", component.alias("component"))


def keep_one_each(
    docs: DataFrame,
    id: str = "doc_id",
    text: str = "text",
    size: int = SHINGLE,
    percent: int = PERCENT,
    block: int = BLOCK,
) -> DataFrame:
    """The head of each component, once, with its columns; documents without words stay.

    Of equal ids the one with the least code stays, of equal rows any one. NULL ids are larger
    than others, so they stay only where all of a component have none. An empty table stays
    empty; columns of any other name are passed on as they are.
    """
    rows = stage(_headed(docs, id, text, size, percent, block), "jaccard-components")
    code, head, n = (fresh(docs, name) for name in ("code", "head", "n"))
    heads = rows.where("code = head.code").groupBy(F.col("code").alias(head)).agg(F.count("*").alias(n))
    kept = docs.withColumn(code, _code(id, text)).join(heads, F.col(code) == F.col(head))
    if not heads.where(F.col(n) > 1).isEmpty():
        kept = kept.where(F.col(n) == 1).union(kept.where(F.col(n) > 1).dropDuplicates([code]))
    wordless = column_of(text).isNull() | ~column_of(text).rlike(r"[^\x20\x09-\x0D]")
    return kept.select(*map(column_of, docs.columns)).union(docs.where(wordless))


def jaccard_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return jaccard_components(docs).withColumnRenamed("component", "component_id")


SQL = """
with recursive d as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (
    select doc_id, list_sort(list_distinct(case when len(w) >= 3
        then list_transform(generate_series(1, len(w) - 2), lambda i: array_to_string(w[i : i + 2], ' '))
        when len(w) > 0 then [array_to_string(w, ' ')] else [] end)) as g from d),
grams as (select doc_id, len(g) as n, unnest(g) as x from s where len(g) > 0),
ranked as (select *, row_number() over (partition by doc_id order by f, x) as r
           from (select *, count(*) over (partition by x) as f from grams)),
cand as (
    select distinct a.doc_id as p, b.doc_id as q from ranked a join ranked b
    on a.x = b.x and a.doc_id < b.doc_id and a.n * 10 >= b.n * 9 and b.n * 10 >= a.n * 9
    where a.r <= a.n - ceil(a.n * 0.9) + 1 and b.r <= b.n - ceil(b.n * 0.9) + 1),
links as (
    select p, q from cand join s sa on sa.doc_id = p join s sb on sb.doc_id = q
    where 190 * len(list_intersect(sa.g, sb.g)) >= 90 * (len(sa.g) + len(sb.g))),
edge as (select p, q from links union select q, p from links),
walk as (
    select doc_id, doc_id as seen from s where doc_id in (select p from edge)
    union select doc_id, q from walk join edge on seen = p)
select s.doc_id, len(g)::bigint as n_shingles, coalesce(min(seen), s.doc_id) as component_id
from s left join walk using (doc_id) group by s.doc_id, len(g)
"""
