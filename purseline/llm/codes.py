"""Vector codes by member-resident Lloyd rounds over the parts of product quantisation.

A vector is cut into parts; each part position has a codebook of a few entries. Parts lie with
their owner, the triple (position, entry, salt), in a table that is written once. In a round
every task reads the members that are resident with it, finds the nearest entry of the newest
codebooks, and sends on two things by owner: the parts that change their entry, which become
a further table of residents, and the sums of those that stay. Both together give the next
codebooks, a few numbers by entry.

Tables of residents are not written again. A member that left is known by replaying the
codebooks since it came: it is gone if one of them put it elsewhere. So over all rounds a part
is written once, and once more for each time that it moves.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.taskcontext import TaskContext

from purseline.llm.common import column_of
from purseline.staging import stage

# Fixed values of the contract: parts of a vector, entries of a codebook, rounds, steps in 1.
PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4_096

#: Components beyond this size could make the error of a vector overflow 64 bits.
LARGEST = 1 << 15
#: Members of one owner, where even all parts of a position have the same entry.
OWNER_ROWS = 250_000

Books = list[np.ndarray]

_RESIDENT = "row long, position int, entry int, salt int, born int, members long, part binary"


def _finite(vector: Column) -> Column:
    """Whether the vector is there and all its components are numbers."""
    ok = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & ok


def _whole(vector: Column) -> Column:
    """Components in whole steps, each floored; too large ones are an error."""
    beyond = F.exists(vector, lambda x: F.abs(x) > LARGEST)
    steps = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return F.when(beyond, F.raise_error(F.lit(f"a component is larger than {LARGEST}"))).otherwise(steps)


def nearest(parts: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Entry and squared distance of each part, ties to the lower entry."""
    distances = np.empty((len(parts), len(book)), np.int64)
    for i, entry in enumerate(book):
        apart = parts - entry
        distances[:, i] = np.einsum("ij,ij->i", apart, apart)
    chosen = distances.argmin(axis=1)
    return chosen, distances[np.arange(len(parts)), chosen]


def _unpack(rows: pd.DataFrame) -> np.ndarray:
    return np.frombuffer(b"".join(rows["part"]), "<i4").reshape(len(rows), -1).astype(np.int64)


def _pack(parts: np.ndarray) -> list[bytes]:
    return [x.tobytes() for x in parts.astype("<i4")]


def _place(book: np.ndarray, salts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Vectors to parts with their owners."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            whole = np.stack(batch["whole"].to_list()).astype(np.int64).reshape(len(batch), PARTS, -1)
            for position in range(PARTS):
                parts = whole[:, position]
                out = pd.DataFrame({"row": batch["row"], "position": np.int32(position)})
                out["entry"] = nearest(parts, book[position])[0].astype(np.int32)
                out["salt"] = (out["row"] % salts).astype(np.int32)
                yield out.assign(born=np.int32(0), members=1, part=_pack(parts))

    return cut


def _resident(rows: pd.DataFrame, books: Books) -> Iterator[tuple[pd.DataFrame, np.ndarray, np.ndarray, np.ndarray]]:
    """Rows still resident by all books but the newest, by position and birth.

    With them their parts, and entry and distance by the newest book.
    """
    for (position, born), some in rows[rows["members"] == 1].groupby(["position", "born"]):
        parts = _unpack(some)
        own = some["entry"].to_numpy()
        for book in books[born + 1 : -1]:
            here = nearest(parts, book[position])[0] == own
            some, parts, own = some[here], parts[here], own[here]
        entry, distance = nearest(parts, books[-1][position])
        yield some, parts, entry.astype(np.int32), distance


class _Sums:
    """Members and component sums by (position, entry)."""

    def __init__(self) -> None:
        self.held: dict[tuple[int, int], tuple[int, np.ndarray]] = {}

    def add(self, position: int, entry: np.ndarray, members: np.ndarray, sums: np.ndarray) -> None:
        for e in np.unique(entry).tolist():
            of = entry == e
            n, total = self.held.get((position, e), (0, 0))
            self.held[position, e] = n + int(members[of].sum()), total + sums[of].sum(axis=0)


def _move(books: Books, salts: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Parts that change their entry, with the new one; and the sums of those that stay.

    Sums are rows without ``row``: any number of ``members``, and their sums as the ``part``.
    """

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        stay, born = _Sums(), np.int32(len(books) - 1)
        for batch in batches:
            for some, parts, entry, _ in _resident(batch, books):
                goes = entry != some["entry"].to_numpy()
                kept = ~goes
                stay.add(int(some["position"].iat[0]) if len(some) else 0, entry[kept], np.ones(kept.sum(), np.int64), parts[kept])
                yield some[goes].assign(entry=entry[goes], born=born)
        salt = TaskContext.get().partitionId() % salts
        rows = [(-1, p, e, salt, born, -n, s.astype("<i8").tobytes()) for (p, e), (n, s) in stay.held.items()]
        yield pd.DataFrame(rows, columns=["row", "position", "entry", "salt", "born", "members", "part"])

    return sweep


def _total(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Members and sums of what has just come to its owners."""
    sums = _Sums()
    for batch in batches:
        come = batch[batch["members"] == 1]
        for position, some in come.groupby("position"):
            sums.add(position, some["entry"].to_numpy(), np.ones(len(some), np.int64), _unpack(some))
        for row in batch[batch["members"] < 0].itertuples():
            one = np.frombuffer(row.part, "<i8")[None, :]
            sums.add(row.position, np.array([row.entry]), np.array([-row.members]), one)
    rows = [(p, e, n, s.tolist()) for (p, e), (n, s) in sums.held.items()]
    yield pd.DataFrame(rows, columns=["position", "entry", "members", "sums"])


def _update(arrived: DataFrame, book: np.ndarray) -> np.ndarray:
    """The next codebooks: floored means, as many numbers as entries and components."""
    totals = arrived.mapInPandas(_total, "position int, entry int, members long, sums array<long>")
    each = totals.select("position", "entry", "members", F.posexplode("sums").alias("at", "s"))
    sums = each.groupBy("position", "entry", "at").agg(
        F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("members").alias("n")
    )
    book = book.copy()
    for row in sums.collect():
        book[row["position"], row["entry"], row["at"]] = int(row["s"]) // row["n"]
    return book


def _measure(books: Books) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Each part's entry and distance by the last codebooks."""

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for some, _, entry, distance in _resident(batch, books):
                yield pd.DataFrame({"row": some["row"], "position": some["position"], "entry": entry, "error": distance})

    return sweep


def _owned(rows: DataFrame) -> DataFrame:
    return stage(rows.repartition("position", "entry", "salt"), "codes-residents")


def digest_books(book: np.ndarray) -> str:
    """SHA-256 of all components, by part, entry and place."""
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def compress(
    vectors: DataFrame,
    id: str = "vec_id",
    vector: str = "embedding",
    carry: tuple[str, ...] = (),
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> tuple[DataFrame, np.ndarray | None]:
    """``id``, the columns of ``carry``, ``code`` and ``error`` of each kept vector; the codebooks.

    Vectors that are NULL or hold a NULL, NaN or infinite component are left out. Codebooks
    begin with the parts of the vectors of the smallest ids, NULL ids last and equal ids in
    the order of their components; with fewer vectors they have fewer entries. Repeated rows
    are vectors of their own; where they make entries equal, the lower one takes the parts.
    Vectors must be of one length, a multiple of 8, and components at most ``LARGEST`` in size;
    anything else is an error. Without vectors there are no rows, and no codebooks. Columns
    of any other name are not read.
    """
    spark = vectors.sparkSession
    kept = vectors.where(_finite(column_of(vector))).select(
        column_of(id).alias("key"),
        F.struct(*[column_of(name).alias(f"c{i}") for i, name in enumerate(carry)] or [F.lit(0).alias("none")]).alias("carried"),
        _whole(column_of(vector)).alias("whole"),
        F.monotonically_increasing_id().alias("row"),
    )
    kept = stage(kept, "codes-vectors")  # rows keep their numbers from here on
    sizes = kept.agg(F.min(F.size("whole")).alias("least"), F.max(F.size("whole")).alias("most"), F.count("*").alias("n")).first()
    if sizes["n"] and (sizes["least"] != sizes["most"] or sizes["most"] % PARTS):
        raise ValueError(f"vectors have {sizes['least']} to {sizes['most']} components; one multiple of {PARTS} is needed")
    schema = [column_of(id).alias(id), *[F.col(f"carried.c{i}").alias(name) for i, name in enumerate(carry)]]
    if not sizes["n"]:
        empty = kept.select(F.col("key").alias(id), *schema[1:], F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, None

    first = kept.orderBy(F.asc_nulls_last("key"), "whole").limit(entries).select("whole").collect()
    book = np.array([row["whole"] for row in first], np.int64).reshape(len(first), PARTS, -1).transpose(1, 0, 2)
    # A position whose parts are all with one entry is still as many owners as others are tasks.
    salts = max(-(-int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTS), -(-sizes["n"] // OWNER_ROWS))
    books = [book]
    tables = [_owned(kept.select("row", "whole").mapInPandas(_place(book, salts), _RESIDENT))]
    for number in range(rounds):
        books.append(_update(tables[-1], books[-1]))
        if number + 1 == rounds or np.array_equal(books[-1], books[-2]):
            break  # equal codebooks: nothing would move any more
        members = tables[0]
        for more in tables[1:]:
            members = members.unionByName(more)
        tables.append(_owned(members.mapInPandas(_move(books, salts), _RESIDENT)))
    members = tables[0]
    for more in tables[1:]:
        members = members.unionByName(more)
    measured = members.mapInPandas(_measure(books), "row long, position int, entry int, error long")
    # Two digits per part fit one 64-bit number, so this is a hash aggregate of fixed width.
    digits = F.expr(f"shiftleft(cast(entry as bigint), 8 * ({PARTS - 1} - position))")
    coded = measured.groupBy(F.col("row").alias("of")).agg(F.sum(digits).alias("code"), F.sum("error").alias("error"))
    out = kept.drop("whole").join(coded, F.col("row") == F.col("of"))
    code = F.lower(F.lpad(F.hex("code"), 2 * PARTS, "0"))
    return out.select(F.col("key").alias(id), *schema[1:], code.alias("code"), "error"), books[-1]


def compression_report(vectors: DataFrame) -> DataFrame:
    """The columns of the contract."""
    coded, book = compress(vectors, carry=("label",))
    coded = stage(coded, "codes")
    errors = coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error"))
    out = coded.join(errors, F.col("label").eqNullSafe(F.col("of")))
    digest = F.lit(None if book is None else digest_books(book)).cast("string")
    return out.select("vec_id", "code", "error", "label_error", digest.alias("codebooks_sha256"))


def _sql() -> str:
    """One more step of Lloyd per round; integer division floors."""
    steps = [
        f"""
kept as materialized (
    select vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::double)::bigint) as x from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
p as materialized (
    select vec_id, label, j, x[j * len(x) // {PARTS} + 1 : (j + 1) * len(x) // {PARTS}] as v
    from kept cross join range({PARTS}) as r(j)),
c0 as materialized (
    select j, row_number() over (partition by j order by vec_id) - 1 as e, v as c from p
    where vec_id in (select vec_id from kept order by vec_id limit {ENTRIES}))"""
    ]
    assign = """
a{k} as materialized (
    select vec_id, label, j, any_value(v) as v, min({{'d': list_sum(list_transform(list_zip(v, c), lambda z:
        (z[1] - z[2]) * (z[1] - z[2])))::bigint, 'e': e}}) as best from p join c{k} using (j) group by vec_id, label, j)"""
    for k in range(ROUNDS):
        steps.append(assign.format(k=k))
        steps.append(f"""
m{k} as (
    select j, e, i, sum(v[i])::hugeint as s, count(*) as n
    from (select j, best.e as e, v, unnest(range(1, len(v) + 1)) as i from a{k}) group by j, e, i),
n{k} as (select j, e, list((s - (s % n + n) % n) // n order by i) as c from m{k} group by j, e),
c{k + 1} as materialized (
    select old.j, old.e, coalesce(n{k}.c, old.c) as c from c{k} as old left join n{k} on n{k}.j = old.j and n{k}.e = old.e)""")
    steps.append(assign.format(k=ROUNDS))
    return f"""with {",".join(steps)},
coded as (
    select vec_id, label, string_agg(printf('%02x', best.e), '' order by j) as code, sum(best.d)::bigint as error
    from a{ROUNDS} group by vec_id, label),
book as (
    select sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' order by j, e)) as codebooks_sha256 from c{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256
from coded cross join book
"""


SQL = _sql()
