"""Queries over static tables, each next to its SQL."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from purseline.functions.categories import with_category_flags
from purseline.functions.messages import decode_events, encode_events
from purseline.functions.temporal import with_time_parts
from purseline.operators.dedup import dedup_events, dedup_metrics
from purseline.operators.filters import amount_above
from purseline.operators.labels import fit_label_index
from purseline.operators.latency import latency_ms, latency_summary, throughput
from purseline.operators.normalise import population_stats, with_zscores
from purseline.operators.profile import (
    user_amount_stats,
    user_category_stats,
    user_sequence_stats,
    user_temporal_stats,
)
from purseline.operators.quality import table_diff, table_fingerprint
from purseline.operators.sequence import with_sequence_features
from purseline.operators.totals import tumbling_totals
from purseline.plans.row_features import row_features
from purseline.plans.user_features import user_features
from purseline.registry.bindings import (
    EVENT_LABELS,
    EVENTS,
    ORDERS,
    Query,
    events,
    orders,
    rounded,
    stream_events,
    table,
)
from purseline.schema import CATEGORIES, Events
from purseline.sources.tables import write_table
from purseline.staging import staging_path

MONEY = "decimal(18,2)"


def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).withColumnRenamed("value", "amount").withColumnRenamed("event_type", "category")


def filter_positive_amount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return amount_above(scan_transactions(spark, sf_dir), "amount", 20.0)


def _parts(df: DataFrame, key: str, time: str) -> DataFrame:
    parts = ("hour_of_day", "day_of_week", "month", "is_weekend")
    return with_time_parts(df, time).select(key, *[F.col(name).cast("bigint") for name in parts])


def temporal_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(events(spark, sf_dir), "event_id", "ts")


def temporal_features_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _parts(orders(spark, sf_dir), "o_orderkey", "o_orderdate")


def _parts_sql(key: str, time: str, source: str) -> str:
    return f"""
        select {key}, hour({time})::bigint as hour_of_day, (dayofweek({time}) + 1)::bigint as day_of_week,
               month({time})::bigint as month, (dayofweek({time}) in (0, 6))::bigint as is_weekend
        from {source}"""


def category_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = orders(spark, sf_dir).select("o_orderkey", F.col("o_orderpriority").alias("category"))
    return fit_label_index(rows, "category").apply(rows, "category")


def category_index_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as labels: more of them than the 100 that are broadcast here."""
    rows = orders(spark, sf_dir).select("o_orderkey", F.col("o_custkey").cast("string").alias("category"))
    return fit_label_index(rows, "category", local_labels=100).apply(rows, "category")


def _index_sql(label: str, source: str) -> str:
    return f"""
        select {label} as label, (row_number() over (order by count(*) desc, {label}) - 1)::double as category_index
        from {source} where {label} is not null group by 1"""


def category_indicators(spark: SparkSession, sf_dir: str) -> DataFrame:
    flags = with_category_flags(events(spark, sf_dir), "event_type", EVENT_LABELS)
    return flags.select("event_id", *[F.col(f"is_{label}").cast("bigint") for label in EVENT_LABELS])


def amount_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sequence_features(orders(spark, sf_dir), ORDERS).select("o_orderkey", "prev_amount", "amount_delta")


def txn_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sequence_features(orders(spark, sf_dir), ORDERS).select("o_orderkey", "txn_rank")


def running_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_sequence_features(orders(spark, sf_dir), ORDERS).select("o_orderkey", "running_total")


ORDER_WINDOW = "over (partition by o_custkey order by o_orderdate, o_orderkey)"


def sequence_features_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_whale(events(spark, sf_dir))
    return with_sequence_features(rows, EVENTS, heavy_rows=rows.count() // 4).select(
        "event_id", "prev_amount", "amount_delta", "txn_rank", "running_total"
    )


def _amount_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_amount_stats(amount_above(orders(spark, sf_dir), "o_totalprice"), ORDERS)


def amount_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_amount_stats(spark, sf_dir), {"stddev_transaction": 4, "avg_log_amount": 6})


def temporal_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_temporal_stats(events(spark, sf_dir), EVENTS)


def temporal_stats_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_temporal_stats(orders(spark, sf_dir), ORDERS)


def _temporal_stats_sql(user: str, time: str, source: str) -> str:
    return f"""
        select {user}, sum(hour({time}))::double / count({time}) as avg_hour,
               sum(dayofweek({time}) + 1)::double / count({time}) as avg_day_of_week,
               sum((dayofweek({time}) in (0, 6))::int)::double / count({time}) as weekend_ratio,
               count(distinct month({time})) as active_months
        from {source} group by 1"""


def category_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = events(spark, sf_dir)
    indexed = fit_label_index(rows, "event_type").apply(rows, "event_type")
    return user_category_stats(indexed, EVENTS, EVENT_LABELS)


LABEL_COUNTS = ", ".join(f"sum((event_type = '{x}')::int)::bigint as {x}_count" for x in EVENT_LABELS)


def sequence_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user_sequence_stats(amount_above(orders(spark, sf_dir), "o_totalprice"), ORDERS)


STATISTICS = {"mu_total": 4, "sigma_total": 4, "mu_avg": 4, "sigma_avg": 4, "mu_count": 6, "sigma_count": 6}


def order_population(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(population_stats(_amount_stats(spark, sf_dir)), STATISTICS)


USER_TOTALS = f"""
        select o_custkey, sum(o_totalprice::{MONEY})::double as total_spent,
               sum(o_totalprice::{MONEY})::double / count(o_totalprice) as avg_transaction,
               count(o_totalprice) as transaction_count
        from orders where o_totalprice > 0 group by 1"""

Z_NAMES = ("total_spent_zscore", "avg_transaction_zscore", "txn_count_zscore")


def user_zscores(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _amount_stats(spark, sf_dir).select("o_custkey", "total_spent", "avg_transaction", "transaction_count")
    return rounded(with_zscores(totals).select("o_custkey", *Z_NAMES), dict.fromkeys(Z_NAMES, 6))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = user_features(events(spark, sf_dir), EVENTS, EVENT_LABELS)
    return rounded(features, dict.fromkeys(("stddev_transaction", "avg_log_amount", *Z_NAMES), 6))


def _with_whale(df: DataFrame) -> DataFrame:
    """Events in which clicks and views, two fifths of the table, belong to one user."""
    shared = F.col("event_type").isin("click", "view")
    return df.withColumn("user_id", F.when(shared, F.lit(-1)).otherwise(F.col("user_id")))


def user_features_skewed(spark: SparkSession, sf_dir: str) -> DataFrame:
    features = user_features(_with_whale(events(spark, sf_dir)), EVENTS, EVENT_LABELS)
    return rounded(features, dict.fromkeys(("stddev_transaction", "avg_log_amount", *Z_NAMES), 6))


def all_row_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = row_features(events(spark, sf_dir), EVENTS, EVENT_LABELS)
    whole = ("hour_of_day", "day_of_week", "month", "is_weekend", *[f"is_{label}" for label in EVENT_LABELS])
    return rows.withColumns({name: F.col(name).cast("bigint") for name in whole})


# Orders in the shape of the default transaction table: text user ids, the four default
# categories, orders without a stated priority in none of them.
PRIORITY_CATEGORIES = {
    "1-URGENT": "Electronics",
    "2-HIGH": "Groceries",
    "3-MEDIUM": "Clothing",
    "5-LOW": "Entertainment",
}


def transaction_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The feature table as a user of the defaults gets it: double sums, ties broken by amount."""
    category = F.lit(None).cast("string")
    for priority, name in PRIORITY_CATEGORIES.items():
        category = F.when(F.col("o_orderpriority") == priority, name).otherwise(category)
    transactions = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").cast("string").alias("user_id"),
        F.col("o_totalprice").alias("amount"),
        F.col("o_orderdate").alias("timestamp"),
        category.alias("category"),
    )
    digits = dict.fromkeys(("avg_transaction", "avg_log_amount", "avg_amount_delta", *Z_NAMES), 6)
    digits |= {"stddev_transaction": 4, "total_spent": 2, "final_running_total": 2}
    return rounded(user_features(transactions), digits)


WHALE = "case when event_type in ('click', 'view') then -1 else user_id end"


def features_sql(
    source: str, tie: str, labels: Sequence[str], stddev_digits: int = 6, mean_digits: int | None = None
) -> str:
    """All 22 features of ``source``, which has the default column names."""
    means = "avg_transaction", "avg_amount_delta"
    rounded_means = ", ".join(f"round({name}, {mean_digits}) as {name}" for name in means if mean_digits is not None)
    counts = ", ".join(f"sum((category = '{x}')::int)::bigint as {x.lower()}_count" for x in labels)
    return f"""
    with valid as (select * from ({source}) where amount > 0),
    labels as ({_index_sql("category", "valid")}),
    t as (
        select v.* exclude (amount), v.amount::double as paid, v.amount::{MONEY} as amount,
               coalesce(category_index, (select count(*) from labels)) as category_index,
               v.amount::{MONEY} - coalesce(lag(v.amount::{MONEY}) over w, 0) as amount_delta,
               row_number() over w as txn_rank,
               sum(v.amount::{MONEY}) over (w rows between unbounded preceding and current row) as running_total
        from valid v left join labels on category = label
        window w as (partition by user_id order by "timestamp", v.{tie})),
    u as (
        select user_id, sum(amount)::double as total_spent,
               sum(amount)::double / count(amount) as avg_transaction, count(amount) as transaction_count,
               max(paid) as max_transaction, min(paid) as min_transaction,
               round(stddev_samp(paid), {stddev_digits}) as stddev_transaction,
               round(avg(ln(1 + paid)), 6) as avg_log_amount,
               sum(hour("timestamp"))::double / count("timestamp") as avg_hour,
               sum(dayofweek("timestamp") + 1)::double / count("timestamp") as avg_day_of_week,
               sum((dayofweek("timestamp") in (0, 6))::int)::double / count("timestamp") as weekend_ratio,
               count(distinct month("timestamp")) as active_months, {counts},
               sum(category_index) / count(*) as avg_category_index,
               sum(amount_delta)::double / count(*) as avg_amount_delta,
               max(txn_rank) as total_transactions_ranked,
               max_by(running_total, txn_rank)::double as final_running_total
        from t group by 1),
    p as (
        select avg(total_spent) as m1, stddev_samp(total_spent) as s1, avg(avg_transaction) as m2,
               stddev_samp(avg_transaction) as s2, avg(transaction_count) as m3, stddev_samp(transaction_count) as s3
        from u)
    select u.* {f"replace ({rounded_means})" if rounded_means else ""},
           round((total_spent - m1) / s1, 6) as total_spent_zscore,
           round((avg_transaction - m2) / s2, 6) as avg_transaction_zscore,
           round((transaction_count - m3) / s3, 6) as txn_count_zscore
    from u, p order by user_id"""


def parquet_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice to one place, in files of at most 4,096 rows, then read back."""
    path = staging_path(spark, "roundtrip")
    rows = table(spark, sf_dir, "events")
    for _ in range(2):
        write_table(rows, path, rows_per_file=4_096)
    return spark.read.schema(rows.schema).parquet(path)


MESSAGE_COLUMNS = ["event_id", "user_id", "transaction_amount", "timestamp"]


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_events(stream_events(spark, sf_dir), MESSAGE_COLUMNS, key="event_id")


def decoded(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decode_events(messages(spark, sf_dir)).select(*MESSAGE_COLUMNS)
    return rows.withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz"))


DECODED_SQL = 'select event_id, user_id, value as transaction_amount, ts as "timestamp" from events'


def _with_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every purchase is delivered a second time."""
    rows = table(spark, sf_dir, "events")
    return rows.unionByName(rows.where(F.col("event_type") == "purchase"))


def deduplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_events(_with_repeats(spark, sf_dir), ["event_id"], "ts")


def repeats_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_metrics(_with_repeats(spark, sf_dir), "event_id", F.to_date("ts"))


def window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tumbling_totals(stream_events(spark, sf_dir), Events(), "10 seconds", scale=2)


def totals_sql(width: str, source: str = "events", having: str = "") -> str:
    return f"""
        select time_bucket(interval '{width}', ts) as window_start,
               time_bucket(interval '{width}', ts) + interval '{width}' as window_end,
               sum(value::{MONEY})::double as total_volume, count(*) as event_count
        from {source} group by 1, 2 {having}"""


ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
ORDER_TEXTS = {"o_totalprice": f"o_totalprice::{MONEY}", "o_orderdate": "strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')"}


def fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns; dates and amounts as texts that both engines write alike."""
    price, day = F.col("o_totalprice").cast(MONEY), F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss")
    rows = table(spark, sf_dir, "orders").withColumns({"o_totalprice": price, "o_orderdate": day})
    return table_fingerprint(rows, ORDER_COLUMNS)


def differences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders against a copy in which the largest ones cost 1 more."""
    rows = table(spark, sf_dir, "orders")
    raised = F.when(F.col("o_totalprice") > 495_000, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    return table_diff(rows, rows.withColumn("o_totalprice", raised))


def _processed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events processed ``value`` milliseconds after they happened."""
    happened = F.col("ts").cast("timestamp")
    delay = F.rint(F.col("value") * 1000).cast("bigint")
    return table(spark, sf_dir, "events").select(
        "event_type", happened.alias("ts"), F.timestamp_micros(F.unix_micros(happened) + delay).alias("processed_at")
    )


def latencies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = latency_ms(_processed(spark, sf_dir), "ts", "processed_at")
    return rounded(latency_summary(rows, "event_type"), {"p50": 6, "p95": 6, "p99": 6})


def throughputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = throughput(_processed(spark, sf_dir), "event_type", "processed_at")
    return rounded(rates, {"seconds": 6, "events_per_second": 9})


PROCESSED_SQL = "(select event_type, epoch_us(ts) + round(value * 1000)::bigint as done from events)"

BATCH: dict[str, Query] = {
    "scan_transactions": Query(
        scan_transactions, "select user_id, value as amount, ts, event_type as category, event_id from events"
    ),
    "filter_positive_amount": Query(
        filter_positive_amount,
        "select user_id, value as amount, ts, event_type as category, event_id from events where value > 20",
    ),
    "temporal_features": Query(temporal_features, _parts_sql("event_id", "ts", "events")),
    "temporal_features_orders": Query(temporal_features_orders, _parts_sql("o_orderkey", "o_orderdate", "orders")),
    "category_index": Query(
        category_index,
        f"""with labels as ({_index_sql("o_orderpriority", "orders")})
            select o_orderkey, label as category, category_index from orders join labels on label = o_orderpriority""",
    ),
    "category_index_wide": Query(
        category_index_wide,
        f"""with labels as ({_index_sql("o_custkey::varchar", "orders")})
            select o_orderkey, label as category, category_index from orders join labels on label = o_custkey::varchar""",
    ),
    "category_indicators": Query(
        category_indicators,
        "select event_id, "
        + ", ".join(f"(event_type = '{x}')::bigint as is_{x}" for x in EVENT_LABELS)
        + " from events",
    ),
    "amount_delta": Query(
        amount_delta,
        f"""select o_orderkey, lag(o_totalprice) {ORDER_WINDOW} as prev_amount,
                   (o_totalprice::{MONEY} - coalesce(lag(o_totalprice::{MONEY}) {ORDER_WINDOW}, 0))::double as amount_delta
            from orders""",
    ),
    "txn_rank": Query(txn_rank, f"select o_orderkey, row_number() {ORDER_WINDOW} as txn_rank from orders"),
    "running_total": Query(
        running_total,
        f"""select o_orderkey, (sum(o_totalprice::{MONEY}) over (partition by o_custkey order by o_orderdate, o_orderkey
                   rows between unbounded preceding and current row))::double as running_total
            from orders""",
    ),
    "sequence_features_skewed": Query(
        sequence_features_skewed,
        f"""with t as (select *, {WHALE} as owner from events)
            select event_id, lag(value) over w as prev_amount,
                   (value::{MONEY} - coalesce(lag(value::{MONEY}) over w, 0))::double as amount_delta,
                   row_number() over w as txn_rank,
                   (sum(value::{MONEY}) over (w rows between unbounded preceding and current row))::double
                       as running_total
            from t window w as (partition by owner order by ts, event_id)""",
    ),
    "user_amount_stats": Query(
        amount_stats,
        f"""select o_custkey, sum(o_totalprice::{MONEY})::double as total_spent,
                   sum(o_totalprice::{MONEY})::double / count(o_totalprice) as avg_transaction,
                   count(o_totalprice) as transaction_count, max(o_totalprice) as max_transaction,
                   min(o_totalprice) as min_transaction, round(stddev_samp(o_totalprice), 4) as stddev_transaction,
                   round(avg(ln(1 + o_totalprice)), 6) as avg_log_amount
            from orders where o_totalprice > 0 group by 1""",
    ),
    "user_temporal_stats": Query(temporal_stats, _temporal_stats_sql("user_id", "ts", "events")),
    "user_temporal_stats_orders": Query(
        temporal_stats_orders, _temporal_stats_sql("o_custkey", "o_orderdate", "orders")
    ),
    "user_category_stats": Query(
        category_stats,
        f"""with labels as ({_index_sql("event_type", "events")})
            select user_id, {LABEL_COUNTS}, sum(category_index) / count(*) as avg_category_index
            from events join labels on label = event_type group by 1""",
    ),
    "user_sequence_stats": Query(
        sequence_stats,
        f"""with t as (
                select o_custkey, o_totalprice::{MONEY} - coalesce(lag(o_totalprice::{MONEY}) {ORDER_WINDOW}, 0) as delta,
                       row_number() {ORDER_WINDOW} as rn,
                       sum(o_totalprice::{MONEY}) over (partition by o_custkey order by o_orderdate, o_orderkey
                           rows between unbounded preceding and current row) as total
                from orders where o_totalprice > 0)
            select o_custkey, sum(delta)::double / count(*) as avg_amount_delta,
                   max(rn) as total_transactions_ranked, max_by(total, rn)::double as final_running_total
            from t group by 1""",
    ),
    "population_stats": Query(
        order_population,
        f"""with u as ({USER_TOTALS})
            select round(avg(total_spent), 4) as mu_total, round(stddev_samp(total_spent), 4) as sigma_total,
                   round(avg(avg_transaction), 4) as mu_avg, round(stddev_samp(avg_transaction), 4) as sigma_avg,
                   round(avg(transaction_count), 6) as mu_count, round(stddev_samp(transaction_count), 6) as sigma_count
            from u""",
    ),
    "user_zscores": Query(
        user_zscores,
        f"""with u as ({USER_TOTALS}),
            p as (select avg(total_spent) as m1, stddev_samp(total_spent) as s1, avg(avg_transaction) as m2,
                         stddev_samp(avg_transaction) as s2, avg(transaction_count) as m3,
                         stddev_samp(transaction_count) as s3 from u)
            select o_custkey, round((total_spent - m1) / s1, 6) as total_spent_zscore,
                   round((avg_transaction - m2) / s2, 6) as avg_transaction_zscore,
                   round((transaction_count - m3) / s3, 6) as txn_count_zscore
            from u, p""",
    ),
    "user_features": Query(
        flagship,
        features_sql(
            'select user_id, value as amount, ts as "timestamp", event_type as category, event_id from events',
            "event_id",
            EVENT_LABELS,
        ),
    ),
    "user_features_skewed": Query(
        user_features_skewed,
        features_sql(
            f"""select {WHALE} as user_id, value as amount, ts as "timestamp", event_type as category, event_id
                from events""",
            "event_id",
            EVENT_LABELS,
        ),
    ),
    "row_features": Query(
        all_row_features,
        f"""with valid as (select user_id, value, ts, event_type, event_id from events where value > 0),
            labels as ({_index_sql("event_type", "valid")})
            select v.*, category_index, hour(ts)::bigint as hour_of_day, (dayofweek(ts) + 1)::bigint as day_of_week,
                   month(ts)::bigint as month, (dayofweek(ts) in (0, 6))::bigint as is_weekend,
                   {", ".join(f"(event_type = '{x}')::bigint as is_{x}" for x in EVENT_LABELS)},
                   lag(value) over w as prev_amount,
                   (value::{MONEY} - coalesce(lag(value::{MONEY}) over w, 0))::double as amount_delta,
                   row_number() over w as txn_rank,
                   (sum(value::{MONEY}) over (w rows between unbounded preceding and current row))::double
                       as running_total
            from valid v join labels on label = event_type
            window w as (partition by user_id order by ts, event_id)""",
    ),
    "transaction_features": Query(
        transaction_features,
        features_sql(
            f"""select o_custkey::varchar as user_id, o_totalprice as amount, o_orderdate as "timestamp",
                       case o_orderpriority {" ".join(f"when '{k}' then '{v}'" for k, v in PRIORITY_CATEGORIES.items())}
                       end as category from orders""",
            "amount",
            CATEGORIES,
            stddev_digits=4,
            mean_digits=6,
        ),
    ),
    "parquet_roundtrip": Query(parquet_roundtrip, "select * from events"),
    "encode_events": Query(
        messages,
        """select event_id::varchar as key,
                  to_json({'event_id': event_id, 'user_id': user_id, 'transaction_amount': value,
                           'timestamp': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')})::varchar as value
           from events""",
    ),
    "decode_events": Query(decoded, DECODED_SQL),
    "dedup_events": Query(deduplicated, "select * from events"),
    "dedup_metrics": Query(
        repeats_per_day,
        """with t as (select * from events union all select * from events where event_type = 'purchase')
           select ts::date as batch, count(*) as raw_rows, count(distinct event_id) as distinct_rows,
                  count(*) - count(distinct event_id) as dropped_rows
           from t group by 1""",
    ),
    "tumbling_totals": Query(window_totals, totals_sql("10 seconds")),
    "table_fingerprint": Query(
        fingerprint,
        f"""with t as (select {", ".join(f"{ORDER_TEXTS.get(c, c)}::varchar as {c}" for c in ORDER_COLUMNS)} from orders),
            h as (select md5({" || ".join(f"coalesce(length({c}) || ':' || {c}, '-')" for c in ORDER_COLUMNS)}) as m from t),
            s as (select {", ".join(f"sum(('0x' || substr(m, {1 + 8 * i}, 8))::bigint)::varchar as p{i}" for i in range(4))},
                         count(*) as row_count from h)
            select substr(sha256(concat_ws(':', p0, p1, p2, p3, row_count)), 1, 16) as fingerprint, row_count from s""",
    ),
    "table_diff": Query(
        differences,
        """with r as (select * replace (case when o_totalprice > 495000 then o_totalprice + 1 else o_totalprice end
                                        as o_totalprice) from orders)
           select 'left_only' as side, count(*) as differing_rows
           from (select * from orders except all select * from r)
           union all
           select 'right_only', count(*) from (select * from r except all select * from orders)""",
    ),
    "latency_summary": Query(
        latencies,
        """select event_type, round(quantile_cont(round(value * 1000) / 1000, 0.5), 6) as p50,
                  round(quantile_cont(round(value * 1000) / 1000, 0.95), 6) as p95,
                  round(quantile_cont(round(value * 1000) / 1000, 0.99), 6) as p99, count(*) as n
           from events group by 1""",
    ),
    "throughput": Query(
        throughputs,
        f"""select event_type, count(*) as n, round((max(done) - min(done)) / 1e6, 6) as seconds,
                  round(count(*) / ((max(done) - min(done)) / 1e6), 9) as events_per_second
           from {PROCESSED_SQL} group by 1""",
    ),
}
