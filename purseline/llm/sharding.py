"""Sharding by balanced label propagation, with built-in functions only.

Documents start on shards by a hash of what they are. In each round a group of linked documents
looks for the shard that holds most of it and has room; its other members ask to move there.
Room is what other linked documents leave of a shard, as those without links can go anywhere.
Parts of groups that are large against a shard, of which there cannot be many, are admitted
one by one, the largest first. The bytes that smaller ones ask to move between each two shards
are a small matrix, from which the shares that capacity admits are worked out; who moves is
decided by hash, so no task ever needs all askers. Rounds end when no group comes together any
more. Then documents with no links even out what the moves and chance left uneven.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from purseline.llm.common import column_of
from purseline.staging import stage

SHARDS = 16
#: Rounds of propagation at most, and those without a gain that end it; rounds of evening out at most.
ROUNDS = 24
PATIENCE = 2
EVENINGS = 6
#: Bytes that a shard may hold over the mean in the end.
EVEN = 0.001
#: A part of a group of more than this share of a shard is large: there are fewer than shards / LARGE.
LARGE = 1 / 64
#: Rows of one numbering window over all shards together.
BUCKET_ROWS = 100_000


def _chance(*columns: str | int) -> Column:
    """A number in [0, 1) that the columns decide."""
    values = [F.lit(c) if isinstance(c, int) else F.col(c) for c in columns]
    return F.pmod(F.xxhash64(*values), F.lit(1 << 40)) / float(1 << 40)


def _loads(nodes: DataFrame, shards: int) -> list[int]:
    """Bytes by shard: as many numbers as there are shards."""
    rows = nodes.groupBy("shard").agg(F.sum("size").alias("size")).collect()
    held = {row["shard"]: row["size"] for row in rows}
    return [held.get(i, 0) for i in range(shards)]


def _by_shard(values: list[float], of: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), of + 1)


def admitted(asked: list[list[float]], loads: list[float], cap: float) -> list[float]:
    """Share of the asked bytes that each shard takes in, so that none ends over ``cap``.

    A shard that gives bytes away has so much more room; shares fall until all fit, and a
    shard already over ``cap`` takes nothing in.
    """
    n = len(loads)
    share = [1.0] * n
    for _ in range(200):
        given = [sum(asked[i][j] * share[j] for j in range(n)) for i in range(n)]
        wanted = [sum(asked[i][j] for i in range(n)) for j in range(n)]
        fits = [max(0.0, cap - loads[j] + given[j]) / wanted[j] if wanted[j] else 1.0 for j in range(n)]
        lower = [min(s, f) for s, f in zip(share, fits, strict=True)]
        if max(s - f for s, f in zip(share, lower, strict=True)) < 1e-6:
            break
        share = lower
    return share


def admit_large(asks: list[tuple], loads: list[float], cap: float) -> list[bool]:
    """Which ``(weight, shard, goal)`` move whole, the largest first, so that no goal ends over ``cap``.

    ``loads`` is brought up to date.
    """
    out = [False] * len(asks)
    for i in sorted(range(len(asks)), key=lambda i: (-asks[i][0], asks[i][1:], i)):
        weight, shard, goal = asks[i]
        if loads[goal] + weight <= cap:
            loads[goal] += weight
            loads[shard] -= weight
            out[i] = True
    return out


def _propagate(linked: DataFrame, mean: float, shards: int, number: int) -> DataFrame | None:
    """Linked documents after one round; None if no part of a group has anywhere to go."""
    loads = [float(x) for x in _loads(linked, shards)]
    parts = linked.groupBy("key", "shard").agg(F.sum("size").alias("weight"))
    room = _by_shard([float(mean - x > 0) for x in loads], F.col("shard"))
    # Most bytes of the group first; equal ones by a hash, so that ties do not favour a shard.
    rank = F.struct(room.alias("room"), "weight", F.xxhash64("key", "shard").alias("tie"), F.col("shard").alias("goal"))
    goals = parts.groupBy("key").agg(F.max(rank).alias("best"), F.sum("weight").alias("group"))
    asks = parts.join(goals, "key").where(
        (F.col("best.room") > 0) & (F.col("best.goal") != F.col("shard")) & (F.col("best.weight") >= F.col("weight"))
    )
    # A group that no shard can hold goes row by row, all others in whole parts.
    fits, large = F.col("group") <= mean, F.col("weight") > mean * LARGE
    asks = asks.select("key", "shard", "weight", F.col("best.goal").alias("goal"), fits.alias("whole"), (fits & large).alias("large"))
    asks = stage(asks, "shard-asks")
    if asks.isEmpty():
        return None
    few = asks.where("large").orderBy("key", "shard").collect()  # fewer than shards / LARGE
    chosen = admit_large([(x["weight"], x["shard"], x["goal"]) for x in few], loads, mean)
    asked = [[0.0] * shards for _ in range(shards)]
    small = asks.where("not large").groupBy("shard", "goal").agg(F.sum("weight").alias("w"))
    for row in small.collect():  # shards x shards at most
        asked[row["shard"]][row["goal"]] = float(row["w"])
    share = _by_shard(admitted(asked, loads, mean), F.col("goal"))
    small = asks.where("not large").select("key", "shard", "goal", "whole", share.alias("share"))
    moved = [(bytearray(x["key"]), x["shard"], x["goal"], True, 1.0) for x, goes in zip(few, chosen, strict=True) if goes]
    moves = small.unionByName(linked.sparkSession.createDataFrame(moved, small.schema)) if moved else small
    moves = moves.select(F.col("key").alias("of"), F.col("shard").alias("start"), "goal", "share", "whole")
    joined = linked.join(moves, (F.col("key") == F.col("of")) & (F.col("shard") == F.col("start")), "left")
    chance = F.when(F.col("whole"), _chance("key", "shard", number)).otherwise(_chance("name", number))
    goes = F.coalesce(chance < F.col("share"), F.lit(False))
    return joined.select("row", "name", "key", "size", F.when(goes, F.col("goal")).otherwise(F.col("shard")).alias("shard"))


def _even_out(nodes: DataFrame, loads: list[int], shards: int, number: int) -> DataFrame:
    """Documents without links, and others only where these are too few, leave full shards.

    Only documents no larger than the excess move, so the last rounds move small ones.
    """
    mean = sum(loads) / shards
    excess = [max(0.0, x - mean) for x in loads]
    lack = [max(0.0, mean - x) for x in loads]
    bounds, total = [], 0.0
    for x in lack:
        total += x
        bounds.append(total)
    over = _by_shard(excess, F.col("shard"))
    movable = F.col("size") <= over
    able = nodes.where(movable).groupBy("shard").agg(
        F.sum(F.when(F.col("key").isNull(), F.col("size")).otherwise(0)).alias("free"), F.sum("size").alias("all")
    )
    free, rest = [0.0] * shards, [0.0] * shards
    for row in able.collect():  # one row per shard
        i = row["shard"]
        free[i] = min(1.0, excess[i] / row["free"]) if row["free"] else 0.0
        left = excess[i] - free[i] * row["free"]
        linked = row["all"] - row["free"]
        rest[i] = min(1.0, left / linked) if linked and left > 0 else 0.0
    share = F.when(F.col("key").isNull(), _by_shard(free, F.col("shard"))).otherwise(_by_shard(rest, F.col("shard")))
    chance = _chance("name", 1_000 + number)
    place = _chance("name", 2_000 + number) * total
    goal = F.lit(shards - 1)
    for i in reversed(range(shards)):
        goal = F.when(place < bounds[i], i).otherwise(goal)
    return nodes.withColumn("shard", F.when(movable & (chance < share), goal).otherwise(F.col("shard")))


def assign_shards(
    docs: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, rounds: int = ROUNDS
) -> DataFrame:
    """Per input row ``id``, ``size``, ``text_crc32``, ``shard`` and ``slot``.

    Equal texts are linked. ``size`` is the bytes of the text plus 1; a NULL text has no
    bytes, crc 0 and no links. Shards get nearly equal bytes; a group that is larger than a
    shard is split over as few as quotas allow. Repeated rows are rows of their own. ``slot``
    counts from 0 without gaps in each shard. An empty table has no rows, and columns of any
    other name are not read. Shards do not depend on how the rows are dealt over tasks, but
    for rows equal in id and text, which they tell apart.
    """
    body = F.coalesce(column_of(text), F.lit(""))
    base = docs.select(
        column_of(id).alias("id"),
        (F.octet_length(body) + 1).cast("long").alias("size"),
        F.crc32(body).alias("crc"),
        F.when(column_of(text).isNotNull(), F.unhex(F.md5(body))).alias("hash"),
        F.xxhash64(column_of(id), column_of(text)).alias("code"),
        F.monotonically_increasing_id().alias("row"),
    )
    base = stage(base, "shard-documents")
    groups = base.where("hash is not null").groupBy("hash").agg(F.count("*").alias("n")).where("n > 1")
    groups = groups.select(F.col("hash").alias("key"))
    again = base.groupBy(F.col("code").alias("again")).agg(F.count("*").alias("n")).where("n > 1").select("again")
    # What a row is called in all draws: by id and text, repeated rows by their number as well.
    name = F.when(F.col("again").isNull(), F.col("code")).otherwise(F.xxhash64("code", "row"))
    called = base.join(again, F.col("code") == F.col("again"), "left").select("row", "hash", "size", name.alias("name"))
    nodes = called.join(groups, F.col("hash") == F.col("key"), "left")
    start = F.pmod(F.xxhash64("name", F.lit("start")), F.lit(shards)).cast("int")
    nodes = stage(nodes.select("row", "name", "key", "size", start.alias("shard")), "shard-nodes")
    linked = nodes.where("key is not null")
    alone = nodes.where("key is null")
    if not linked.isEmpty():
        mean, least, idle = sum(_loads(nodes, shards)) / shards, None, 0
        for number in range(rounds):
            moved = _propagate(linked, mean, shards, number)
            if moved is None:
                break
            linked = stage(moved, "shard-linked")
            parts = linked.select("key", "shard").distinct().count()
            idle = 0 if least is None or parts < least else idle + 1
            least = parts if least is None else min(least, parts)
            if idle == PATIENCE:
                break
    nodes = linked.unionByName(alone)
    for number in range(EVENINGS):
        loads = _loads(nodes, shards)
        mean = sum(loads) / shards
        if max(loads) <= mean * (1 + EVEN) and min(loads) >= mean * (1 - EVEN):
            break
        nodes = stage(_even_out(nodes, loads, shards, number), "shard-nodes")
    placed = base.drop("hash", "code").join(nodes.select(F.col("row").alias("at"), "name", "shard"), F.col("row") == F.col("at")).drop("at")
    return _numbered(placed).select(F.col("id").alias(id), "size", F.col("crc").alias("text_crc32"), "shard", "slot")


def _numbered(placed: DataFrame) -> DataFrame:
    """``slot``: numbered within buckets of a shard, after the rows of the buckets before."""
    placed = stage(placed, "shard-placed")
    buckets = max(64, placed.count() // BUCKET_ROWS)
    # Another hash than the one that chose the first shard, or a shard has few buckets.
    placed = placed.withColumn("bucket", F.pmod(F.xxhash64("name", F.lit("slot")), F.lit(buckets)))
    counts = placed.groupBy("shard", "bucket").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(
        F.col("shard").alias("in"), F.col("bucket").alias("of"), F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first")
    )
    within = F.row_number().over(Window.partitionBy("shard", "bucket").orderBy("name", "row"))
    rows = placed.withColumn("n", within).join(first, (F.col("shard") == F.col("in")) & (F.col("bucket") == F.col("of")))
    return rows.withColumn("slot", F.col("first") + F.col("n") - 1)


def sharding_report(docs: DataFrame) -> DataFrame:
    """The columns of the contract."""
    return assign_shards(docs).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
