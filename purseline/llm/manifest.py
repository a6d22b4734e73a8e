"""Merkle manifest of a dataset by time-forward processing.

Nodes are labelled by tree, level and place. A queue ordered by label delivers the digests of
children to their parent: between tasks it is a shuffle sorted by label, which spills to disk
as any sort does; within a task it is a heap over the ``FAN`` ** ``BAND`` nodes of one block.
So each sweep of ``BAND`` levels sends one digest per block, whatever the size of a source.
The subroots of the sources are the leaves of one more tree, built alike.

The sweep back goes from the root to the leaves. What a node gets from its parent is its proof
suffix, the siblings of all nodes above; a block gets it once, ahead of its nodes, as it has
the least label in the block. Leaves fold proofs where they lie, so proofs are never shuffled.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from purseline.llm.common import column_of
from purseline.staging import stage

# Fixed values of the contract: children of a node, columns of a leaf, one in so many is tampered with.
FAN = 16
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPERED = 5

#: Levels that one sweep climbs; a block has FAN ** BAND nodes.
BAND = 3

_NODE = "tree string, position long, n long, digest string, id string, note string"
_MESSAGE = f"{_NODE}, block long, subroot string, root string, steps string"
_RESULT = "id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, proof string"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: ``-``, or its UTF-8 byte count, a colon and itself."""
    text = value.cast("string")
    return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(values: list[Column]) -> Column:
    """The digest of one row."""
    return F.sha2(F.concat(*map(field, values)), 256)


def joined(digests: list[str]) -> str:
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def height(n: int, fan: int) -> int:
    """Levels above ``n`` leaves until one node remains."""
    levels = 0
    while n > 1:
        n = -(-n // fan)
        levels += 1
    return levels


def climb(digests: list[str], levels: int, fan: int) -> tuple[str, dict[tuple[int, int], list[str]]]:
    """The node ``levels`` above a block, and the children of each node by (level, place).

    Messages wait for their parent in a heap; those of the least label are taken out together.
    """
    if not levels:
        return digests[0], {}
    queue = [(1, i // fan, i % fan, digest) for i, digest in enumerate(digests)]  # in order: a heap
    runs: dict[tuple[int, int], list[str]] = {}
    while True:
        level, place = label = queue[0][:2]
        run = []
        while queue and queue[0][:2] == label:
            run.append(heapq.heappop(queue)[3])
        runs[label] = run
        if level == levels:
            return joined(run), runs
        heapq.heappush(queue, (level + 1, place // fan, place % fan, joined(run)))


def suffixes(
    runs: dict[tuple[int, int], list[str]], levels: int, above: str, fan: int
) -> Iterator[tuple[int, str, str, str]]:
    """``(place, before, after, suffix)`` of the nodes of a block, from its top's suffix ``above``.

    A step is the siblings before, a comma, the siblings after and a semicolon.
    """
    told = {(levels, 0): above}
    for (level, place), run in sorted(runs.items(), reverse=True):
        suffix = told.pop((level, place))
        for slot in range(len(run)):
            before, after = "".join(run[:slot]), "".join(run[slot + 1 :])
            child = place * fan + slot
            if level == 1:
                yield child, before, after, suffix
            else:
                told[level - 1, child] = f"{before},{after};{suffix}"


def fold(digest: str, steps: str) -> str:
    """The root that a leaf and the steps of its proof lead to."""
    for step in steps.split(";")[:-1]:
        before, after = step.split(",")
        digest = joined([before, digest, after])
    return digest


def _blocks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by label, as one frame per (tree, block)."""
    held: list[pd.DataFrame] = []
    last = None
    for batch in batches:
        for key, part in batch.groupby(["tree", "block"], sort=False):
            if key != last and held:
                yield pd.concat(held) if len(held) > 1 else held[0]
                held = []
            held.append(part)
            last = key
    if held:
        yield pd.concat(held) if len(held) > 1 else held[0]


def _queue(rows: DataFrame) -> DataFrame:
    """Rows of a block in one task, in the order of their labels."""
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "position")


def _up(fan: int, band: int) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """One digest per block, as a node of the next band."""

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out = []
        for block in _blocks(batches):
            n = int(block["n"].iat[0])
            levels = min(band, height(n, fan))
            top, _ = climb(block["digest"].tolist(), levels, fan)
            out.append((block["tree"].iat[0], int(block["block"].iat[0]), -(-n // fan**levels), top, None, None))
            if len(out) == 1_000:
                yield pd.DataFrame(out, columns=["tree", "position", "n", "digest", "id", "note"])
                out = []
        yield pd.DataFrame(out, columns=["tree", "position", "n", "digest", "id", "note"])

    return sweep


def _down(fan: int, band: int, at_leaves: bool, proofs: bool) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    """Suffixes from the tops of blocks to their nodes.

    Above the leaves what comes out are messages to the blocks below; at the leaves, results.
    """
    columns = [x.split()[0] for x in (_RESULT if at_leaves else _MESSAGE).split(", ")]

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for block in _blocks(batches):
            told = block.iloc[0]  # the message to the block has place -1
            nodes = block.iloc[1:]
            digests, ids, notes = (nodes[x].tolist() for x in ("digest", "id", "note"))
            tree, subroot, root, above = told["tree"], told["subroot"], told["root"], told["steps"]
            levels = min(band, height(int(nodes["n"].iat[0]), fan))
            first = int(told["block"]) * fan**band
            _, runs = climb(digests, levels, fan)
            out = []
            for i, before, after, suffix in suffixes(runs, levels, above, fan) if levels else [(0, "", "", above)]:
                steps = f"{before},{after};{suffix}" if levels else above
                if not at_leaves:
                    out.append((tree, -1, 0, digests[i], ids[i], notes[i], first + i, subroot, root, steps))
                    continue
                proof = steps.replace(",", "").replace(";", "")
                folded = fold(notes[i] or digests[i], steps)
                digest = hashlib.sha256(proof.encode()).hexdigest()
                out.append((ids[i], digests[i], subroot, root, digest, folded, steps if proofs else None))
            yield pd.DataFrame(out, columns=columns)

    return sweep


def _placed(rows: DataFrame, order: list[str], name: str) -> DataFrame:
    """Written rows with their place in the tree, from 0, and the number ``n`` of rows in it.

    Rows are range-partitioned into slices of the whole order, so a source with a third of the
    rows is many slices. Only counts by slice and tree are added up.
    """
    keys = ["tree", *order, "tie"]
    rows = rows.withColumn("tie", F.monotonically_increasing_id())
    rows = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    # Within a slice the numbers are consecutive, in the order of the sort.
    rows = rows.withColumn("slice", F.spark_partition_id()).withColumn("at", F.monotonically_increasing_id())
    rows = stage(rows.drop("tie"), f"{name}-sorted")
    counts = rows.groupBy("tree", "slice").agg(F.min("at").alias("first"), F.count("*").alias("held"))
    all_of = Window.partitionBy("tree")
    before = all_of.orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        F.col("tree").alias("of"),
        F.col("slice").alias("part"),
        "first",
        F.coalesce(F.sum("held").over(before), F.lit(0)).alias("before"),
        F.sum("held").over(all_of).alias("n"),
    )
    placed = rows.join(counts, (F.col("tree") == F.col("of")) & (F.col("slice") == F.col("part")))
    position = F.col("at") - F.col("first") + F.col("before")
    return stage(placed.select("tree", position.alias("position"), "n", "digest", "id", "note"), f"{name}-leaves")


def _in_blocks(nodes: DataFrame, fan: int, band: int) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("position") / fan**band))


def _grow(leaves: DataFrame, fan: int, band: int) -> tuple[list[DataFrame], DataFrame]:
    """Nodes at the foot of each band, and ``(tree, digest, band)`` of the roots.

    ``band`` is the one whose only block has the root as its top.
    """
    most = leaves.agg(F.max("n")).first()[0] or 0
    bands, roots = [leaves], [leaves.where("n = 1").select("tree", "digest", F.lit(0).alias("band"))]
    while most > 1:
        crowded = _in_blocks(bands[-1].where("n > 1"), fan, band)
        nodes = stage(_queue(crowded).mapInPandas(_up(fan, band), _NODE), "manifest-nodes")
        roots.append(nodes.where("n = 1").select("tree", "digest", F.lit(len(bands) - 1).alias("band")))
        bands.append(nodes)
        most = -(-most // fan**band)
    out = roots[0]
    for more in roots[1:]:
        out = out.unionByName(more)
    return bands[: max(1, len(bands) - 1)], out


def _tell(bands: list[DataFrame], first: DataFrame, fan: int, band: int, at_leaves: bool, proofs: bool) -> DataFrame:
    """From the messages to the top blocks, by the ``band`` that they enter at, to all leaves."""
    columns = [x.split()[0] for x in _MESSAGE.split(", ")]
    sent = None
    for i in reversed(range(len(bands))):
        messages = first.where(F.col("band") == i).select(*columns)
        if sent is not None:
            messages = messages.unionByName(sent.withColumns({x: F.lit(None).cast("string") for x in ("digest", "id", "note")}))
        nodes = bands[i] if i == 0 else bands[i].where("n > 1")
        nodes = _in_blocks(nodes, fan, band).withColumns({x: F.lit(None).cast("string") for x in ("subroot", "root", "steps")})
        last = at_leaves and i == 0
        rows = _queue(nodes.select(*columns).unionByName(messages))
        sent = rows.mapInPandas(_down(fan, band, last, proofs), _RESULT if last else _MESSAGE)
        sent = sent if last else stage(sent, "manifest-suffixes")
    return sent


def _message(tree: Column, subroot: Column, root: Column, steps: Column) -> list[Column]:
    none = F.lit(None).cast("string")
    zero = F.lit(0).cast("long")
    return [
        tree.alias("tree"),
        (zero - 1).alias("position"),
        zero.alias("n"),
        none.alias("digest"),
        none.alias("id"),
        none.alias("note"),
        zero.alias("block"),
        subroot.alias("subroot"),
        root.alias("root"),
        steps.alias("steps"),
    ]


def build_manifest(
    docs: DataFrame,
    id: str = "doc_id",
    source: str = "source",
    fields: tuple[str, ...] = FIELDS,
    tampered: dict[str, Column] | None = None,
    changed: Column | None = None,
    fan: int = FAN,
    band: int = BAND,
    proofs: bool = False,
) -> DataFrame:
    """Per input row ``id``, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``proof``.

    ``proof`` has the steps that ``fold`` takes, NULL unless ``proofs``. ``folded_root`` comes
    from the leaf as it is now: where ``changed`` holds, columns in ``tampered`` have these
    values. NULL and the empty string differ, as values and as sources; the NULL source comes
    first. NULL ids come first in their source; repeated rows, and rows of equal id, are leaves
    of their own, in the order of their digests. Texts of any length are hashed whole. A column
    of any other name is not read. An empty table has no rows.
    """
    now = [(tampered or {}).get(name, column_of(name)) for name in fields]
    rows = docs.select(
        F.when(column_of(source).isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), column_of(source).cast("string"))).alias("tree"),
        leaf([column_of(name) for name in fields]).alias("digest"),
        column_of(id).alias("key"),
        column_of(id).cast("string").alias("id"),
        (F.lit(None) if changed is None else F.when(changed, leaf(now))).cast("string").alias("note"),
    )
    leaves = _placed(stage(rows, "manifest-documents"), ["key", "digest"], "manifest")
    bands, subroots = _grow(leaves, fan, band)
    # The sources' tree: a leaf carries its source, and the band in which its own tree begins.
    crown = subroots.select(F.lit("").alias("tree"), "digest", F.col("tree").alias("id"), F.col("band").cast("string").alias("note"))
    crown = _placed(stage(crown, "manifest-subroots"), ["id"], "manifest-crown")
    crown_bands, root = _grow(crown, fan, band)
    first = root.select(*_message(F.col("tree"), F.lit(None).cast("string"), F.col("digest"), F.lit("")), "band")
    told = _tell(crown_bands, first, fan, band, False, False)
    first = told.select(
        *_message(F.col("id"), F.col("digest"), F.col("root"), F.col("steps")), F.col("note").cast("int").alias("band")
    )
    out = _tell(bands, first, fan, band, True, proofs)
    return out.withColumn("id", F.col("id").cast(docs.schema[id].dataType)).withColumnRenamed("id", id)


def manifest_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract, tampering with the text of one document in five."""
    hit = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % TAMPERED == 0
    lower = F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    out = build_manifest(docs, tampered={"text": lower}, changed=hit)
    return out.drop("proof").withColumn("verified", F.col("folded_root") == F.col("root"))


SQL = """
with recursive f as (
    select doc_id, case when source is null then 'n' else 's' || source end as tree,
        case when doc_id is null then '-' else strlen(doc_id::varchar) || ':' || doc_id end ||
        case when source is null then '-' else strlen(source) || ':' || source end ||
        case when lang is null then '-' else strlen(lang) || ':' || lang end ||
        case when n_chars is null then '-' else strlen(n_chars::varchar) || ':' || n_chars end as head,
        case when text is null then '-' else strlen(text) || ':' || text end as body,
        case when text is null then '-' else strlen(text) || ':' ||
            translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') end as lower_body,
        -- A byte goes in, then eight shifts (-1); the polynomial is that of every CRC-32.
        list_reduce(flatten(list_transform(range(strlen(doc_id::varchar)), lambda i:
                [ascii(substr(doc_id::varchar, (i + 1)::int, 1))::bigint, -1, -1, -1, -1, -1, -1, -1, -1])),
            lambda c, x: case when x >= 0 then xor(c, x) when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end,
            4294967295::bigint) as crc
    from documents),
d as (
    select doc_id, tree, row_number() over (partition by tree order by doc_id) - 1 as p, sha256(head || body) as leaf,
        case when xor(crc, 4294967295) % 5 = 0 then sha256(head || lower_body) else sha256(head || body) end as now
    from f),
up as (
    select 0 as level, tree, p, leaf as h, count(*) over (partition by tree) as n from d
    union all
    select level + 1, tree, p // 16, sha256(string_agg(h, '' order by p)), (n + 15) // 16
    from up where n > 1 group by level, tree, p // 16, n),
sub as (select tree, h as subroot, row_number() over (order by tree) - 1 as r from up where n = 1),
crown as (
    select 0 as level, r as p, subroot as h, count(*) over () as n from sub
    union all
    select level + 1, p // 16, sha256(string_agg(h, '' order by p)), (n + 15) // 16
    from crown where n > 1 group by level, p // 16, n),
low as (
    select level, tree, p, coalesce(string_agg(h, '') over (partition by tree, level, p // 16 order by p
            rows between unbounded preceding and 1 preceding), '') as before,
        coalesce(string_agg(h, '') over (partition by tree, level, p // 16 order by p
            rows between 1 following and unbounded following), '') as after
    from up where n > 1),
high as (
    select level, p, coalesce(string_agg(h, '') over (partition by level, p // 16 order by p
            rows between unbounded preceding and 1 preceding), '') as before,
        coalesce(string_agg(h, '') over (partition by level, p // 16 order by p
            rows between 1 following and unbounded following), '') as after
    from crown where n > 1),
steps as (
    select doc_id, level as s, before, after from d join low on low.tree = d.tree and low.p = d.p // (16 ** level)::bigint
    union all
    select doc_id, 100 + level, before, after from d join sub using (tree) join high on high.p = r // (16 ** level)::bigint),
numbered as (select doc_id, before, after, row_number() over (partition by doc_id order by s) as s from steps),
fold as (
    select doc_id, 0::bigint as s, now as h from d
    union all
    select doc_id, numbered.s, sha256(before || h || after) from fold join numbered using (doc_id) where numbered.s = fold.s + 1),
proofs as (select doc_id, sha256(string_agg(before || after, '' order by s)) as proof_sha256 from numbered group by doc_id),
peak as (select h as root from crown where n = 1),
ends as (select doc_id, arg_max(h, s) as folded_root from fold group by doc_id)
select doc_id, leaf, subroot, root,
    coalesce(proof_sha256, sha256('')) as proof_sha256, folded_root, folded_root = root as verified
from d cross join peak join sub using (tree) join ends using (doc_id) left join proofs using (doc_id)
"""
