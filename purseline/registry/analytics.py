"""Queries beyond the feature table: joins, sessions, frames, groupings and sets, next to their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purseline.operators.asof import asof_join
from purseline.operators.cube import cube_sets, grouped_totals, rollup_sets
from purseline.operators.frames import with_recent_spend
from purseline.operators.intervals import interval_join
from purseline.operators.latency import PERCENTILES, latency_by_load
from purseline.operators.sessions import sessions
from purseline.operators.sets import except_all, intersect_all
from purseline.operators.sketches import (
    DEVIATION,
    ERROR,
    bucket_percentiles,
    distinct_sketches,
    percentile_buckets,
    sketch_distinct,
)
from purseline.operators.sliding import sliding_totals
from purseline.operators.topk import top_rows
from purseline.registry.batch import MONEY, WHALE
from purseline.registry.bindings import EVENTS, Query, rounded, stream_events, table
from purseline.schema import Events


def _owned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events in which clicks and views, two fifths of the table, belong to one user, -1."""
    shared = F.col("event_type").isin("click", "view")
    rows = table(spark, sf_dir, "events")
    return rows.withColumn("owner", F.when(shared, F.lit(-1)).otherwise(F.col("user_id")).cast("bigint"))


def _quarter(rows: DataFrame) -> int:
    """Keys of more rows than this are heavy: the shared user is, all others are not."""
    return rows.count() // 4


def user_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions(stream_events(spark, sf_dir), "6 hours", scale=2)


def user_sessions_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _owned(spark, sf_dir)
    names = Events("event_id", "owner", "value", "ts")
    return sessions(rows, "10 minutes", names, scale=2, heavy_rows=_quarter(rows))


def sessions_sql(user: str, gap: str, source: str = "events") -> str:
    """Sessions of ``source``; a condition on closed ones may follow."""
    return f"""
        with gaps as (select *, ts - lag(ts) over (partition by {user} order by ts) as apart from {source}),
        runs as (
            select *, sum((apart is null or apart > interval '{gap}')::int)
                over (partition by {user} order by ts rows unbounded preceding) as run from gaps)
        select {user}, min(ts) as session_start, max(ts) + interval '{gap}' as session_end, count(*) as event_count,
               sum(value::{MONEY})::double as total_volume
        from runs group by {user}, run"""


def asof_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views and purchases with the latest click or error of their owner, at most two days old."""
    rows = _owned(spark, sf_dir)
    asked = rows.where(F.col("event_type").isin("view", "purchase")).select("event_id", "owner", "ts", "value")
    given = rows.where(F.col("event_type").isin("click", "error")).select(
        "owner", F.col("ts").alias("rate_ts"), F.col("value").alias("rate"), F.col("event_id").alias("rate_id")
    )
    return asof_join(
        asked, given, "owner", "ts", "rate_ts", ("rate", "rate_id"), ("rate_id",), "2 days", heavy_rows=_quarter(rows)
    )


def recent_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend in the last day and week before each event, one owner having two fifths of the table."""
    rows = _owned(spark, sf_dir).select("event_id", "owner", "ts", "value", "event_type")
    cols = EVENTS.__class__("owner", "value", "ts", "event_type", ("event_id",), scale=2)
    found = with_recent_spend(rows, cols, (1, 7), heavy_rows=_quarter(rows))
    return found.select("event_id", "spend_1d", "count_1d", "spend_7d", "count_7d")


def _frame_sql(days: int) -> str:
    frame = f"over (partition by owner order by ts range between interval {days} days preceding and current row)"
    return f"(sum(value::{MONEY}) {frame})::double as spend_{days}d, count(value) {frame} as count_{days}d"


def _offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each signup opens an offer to its user, open for as many hours as its value says."""
    rows = table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    begin = F.col("ts").cast("timestamp")
    length = F.rint(F.col("value") * 3_600_000_000).cast("bigint")
    return rows.select(
        "user_id",
        F.col("event_id").alias("offer_id"),
        F.col("ts").alias("opens"),
        F.timestamp_micros(F.unix_micros(begin) + length).cast("timestamp_ntz").alias("closes"),
    )


def interval_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases with the offers open at the time, or without."""
    purchases = table(spark, sf_dir, "events").where(F.col("event_type") == "purchase").select("event_id", "user_id", "ts")
    found = interval_join(purchases, _offers(spark, sf_dir), "user_id", "ts", "opens", "closes", "left")
    return found.select("event_id", "user_id", "ts", "offer_id")


CUBE = ("o_orderstatus", "o_orderpriority", "o_year")


def _yearly(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("o_year", F.year("o_orderdate").cast("bigint"))


def spend_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_totals(_yearly(spark, sf_dir), CUBE, "o_totalprice", cube_sets(CUBE), scale=2)


def spend_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return grouped_totals(_yearly(spark, sf_dir), CUBE, "o_totalprice", rollup_sets(CUBE), scale=2)


def spend_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    sets = [("o_year",), ("o_orderstatus", "o_orderpriority")]
    return grouped_totals(_yearly(spark, sf_dir), CUBE, "o_totalprice", sets, scale=2)


def _cube_sql(groups: str) -> str:
    return f"""
        select o_orderstatus, o_orderpriority, year(o_orderdate) as o_year,
               grouping(o_orderstatus, o_orderpriority, o_year) as grouping_id, count(*) as row_count,
               count(o_totalprice) as amount_count, sum(o_totalprice::{MONEY})::double as total,
               sum(o_totalprice::{MONEY})::double / count(o_totalprice) as mean, min(o_totalprice) as least,
               max(o_totalprice) as most
        from orders group by {groups}"""


def sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sliding_totals(stream_events(spark, sf_dir), Events(), "90 minutes", "1 hour", scale=2)


def sliding_sql(width: str, slide: str) -> str:
    """Every event in each window that holds it; a condition on closed ones may follow."""
    return f"""
        select w as window_start, w + interval '{width}' as window_end, sum(value::{MONEY})::double as total_volume,
               count(*) as event_count
        from events, unnest(generate_series(time_bucket(interval '{slide}', ts - interval '{width}'),
                                            time_bucket(interval '{slide}', ts), interval '{slide}')) as s(w)
        where w + interval '{width}' > ts group by w"""


def sketched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Percentiles of order prices from summaries stored by year, and whether customers are counted about right."""
    rows = _yearly(spark, sf_dir)
    buckets = percentile_buckets(rows, ["o_year", "o_orderpriority"], "o_totalprice")
    users = sketch_distinct(distinct_sketches(rows, ["o_year", "o_orderpriority"], "o_custkey"), ["o_orderpriority"])
    exact = rows.groupBy(F.col("o_orderpriority").alias("of")).agg(F.count_distinct("o_custkey").alias("exact"))
    near = F.abs(F.col("distinct_values") / F.col("exact") - 1) <= 4 * DEVIATION
    found = bucket_percentiles(buckets, ["o_orderpriority"]).join(users, "o_orderpriority")
    found = found.join(exact, F.col("o_orderpriority") == F.col("of"))
    return rounded(found.select("o_orderpriority", "n", *PERCENTILES, near.alias("users_near")), dict.fromkeys(PERCENTILES, 4))


def sketches_sql(by: str, value: str, source: str, more: str, digits: int = 6) -> str:
    """The value in the middle of the bucket that holds the one of each rank."""
    factor = (1 + ERROR) / (1 - ERROR)
    at = "list_sort(list({v}))[(floor({p} * (count(*) - 1)) + 1)::bigint]"
    middles = ", ".join(
        f"round(pow({factor!r}, ceil(ln({at.format(v=value, p=p)}) / ln({factor!r}))) * {1 - ERROR!r}, {digits}) as {name}"
        for name, p in PERCENTILES.items()
    )
    return f"select {by}, count(*) as n, {middles}, {more} from {source} group by {by}"


def top_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five dearest orders of each priority; of equal ones the first."""
    rows = table(spark, sf_dir, "orders").select("o_orderpriority", "o_totalprice", "o_orderkey")
    found = top_rows(rows, "o_orderpriority", [F.desc("o_totalprice"), F.asc("o_orderkey")], 5)
    return found.withColumn("position", F.col("position").cast("bigint"))


def top_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders of the three latest days of each status, all of a day having one position."""
    rows = table(spark, sf_dir, "orders").select("o_orderstatus", "o_orderdate", "o_orderkey")
    found = top_rows(rows, "o_orderstatus", [F.desc("o_orderdate")], 3, ties=True)
    return found.withColumn("position", F.col("position").cast("bigint"))


def _marks(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Customer and priority of cheap and of dear orders, with as many copies as orders."""
    rows = table(spark, sf_dir, "orders")
    slim = rows.select((F.col("o_custkey") % 50).alias("customer"), "o_orderpriority", "o_totalprice")
    cheap = F.col("o_totalprice") < 200_000
    return slim.where(cheap).drop("o_totalprice"), slim.where(~cheap).drop("o_totalprice")


def rows_except(spark: SparkSession, sf_dir: str) -> DataFrame:
    return except_all(*_marks(spark, sf_dir))


def rows_intersect(spark: SparkSession, sf_dir: str) -> DataFrame:
    return intersect_all(*_marks(spark, sf_dir))


def _marks_sql(operation: str) -> str:
    side = "select o_custkey % 50 as customer, o_orderpriority from orders where"
    return f"{side} o_totalprice < 200000 {operation} all {side} not o_totalprice < 200000"


HOURLY_LOADS = (5, 10, 14, 18, 100, 140, 180)


def loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latencies by the events of the hour, taking an event's value for its delay in milliseconds."""
    rows = table(spark, sf_dir, "events").withColumn("latency_ms", F.col("value"))
    return rounded(latency_by_load(rows, "ts", "1 hour", HOURLY_LOADS), dict.fromkeys(PERCENTILES, 6))


LOADS_SQL = f"""
    hours as (select time_bucket(interval '1 hour', ts) as h, count(*) as c from events group by 1),
    levels as (select h, case {" ".join(f"when c <= {b} then {b}" for b in HOURLY_LOADS)} end::bigint as load from hours)"""

OWNED_SQL = f"(select *, {WHALE} as owner from events)"

ANALYTICS: dict[str, Query] = {
    "user_sessions": Query(user_sessions, sessions_sql("user_id", "6 hours")),
    "user_sessions_skewed": Query(user_sessions_skewed, sessions_sql("owner", "10 minutes", OWNED_SQL)),
    "asof_rate": Query(
        asof_rate,
        f"""with o as {OWNED_SQL},
            asked as (select * from o where event_type in ('view', 'purchase')),
            given as (select * from o where event_type in ('click', 'error'))
            select a.event_id, a.owner, a.ts, a.value,
                   case when g.ts + interval 2 days >= a.ts then g.value end as rate,
                   case when g.ts + interval 2 days >= a.ts then g.event_id end as rate_id
            from asked a asof left join given g on a.owner = g.owner and a.ts >= g.ts""",
    ),
    "recent_spend": Query(recent_spend, f"select event_id, {_frame_sql(1)}, {_frame_sql(7)} from {OWNED_SQL}"),
    "interval_match": Query(
        interval_match,
        """with offers as (
               select user_id, event_id as offer_id, ts as opens,
                      ts + to_microseconds(round(value * 3600000000)::bigint) as closes
               from events where event_type = 'signup'),
           bought as (select event_id, user_id, ts from events where event_type = 'purchase')
           select event_id, bought.user_id, ts, offer_id from bought left join offers
           on offers.user_id = bought.user_id and opens <= ts and ts < closes""",
    ),
    "spend_cube": Query(spend_cube, _cube_sql("cube (o_orderstatus, o_orderpriority, o_year)")),
    "spend_rollup": Query(spend_rollup, _cube_sql("rollup (o_orderstatus, o_orderpriority, o_year)")),
    "spend_sets": Query(spend_sets, _cube_sql("grouping sets ((o_year), (o_orderstatus, o_orderpriority))")),
    "sliding_totals": Query(sliding, sliding_sql("90 minutes", "1 hour")),
    "sketched_orders": Query(
        sketched, sketches_sql("o_orderpriority", "o_totalprice", "orders", "true as users_near", 4)
    ),
    "top_orders": Query(
        top_orders,
        """select o_orderpriority, o_totalprice, o_orderkey,
                  row_number() over (partition by o_orderpriority order by o_totalprice desc, o_orderkey) as position
           from orders qualify position <= 5""",
    ),
    "top_days": Query(
        top_days,
        """select o_orderstatus, o_orderdate, o_orderkey,
                  rank() over (partition by o_orderstatus order by o_orderdate desc) as position
           from orders qualify position <= 3""",
    ),
    "latency_by_load": Query(
        loads,
        f"""with {LOADS_SQL}
            select load, {", ".join(f"round(quantile_cont(value, {p}), 6) as {n}" for n, p in PERCENTILES.items())},
                   count(*) as n
            from events join levels on h = time_bucket(interval '1 hour', ts) group by load""",
    ),
    "except_all": Query(rows_except, _marks_sql("except")),
    "intersect_all": Query(rows_intersect, _marks_sql("intersect")),
}
