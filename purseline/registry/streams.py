"""Queries that run a stream to its end over the events table, each next to its SQL.

The events reach the stream as JSON messages in folders of files, in three slices of equal
time. A query is started once per slice on the same checkpoint, so each slice is a
micro-batch whatever the number of its files, and every run but the first is a resume.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from purseline.functions.messages import decode_events, encode_events, split_rejects
from purseline.operators.latency import PERCENTILES, latency_by_load, latency_ms, latency_summary, with_processing_time
from purseline.operators.totals import merge_totals
from purseline.registry.analytics import HOURLY_LOADS, LOADS_SQL, sessions_sql, sketches_sql, sliding_sql
from purseline.registry.batch import DECODED_SQL, LABEL_COUNTS, MESSAGE_COLUMNS, MONEY, totals_sql
from purseline.registry.bindings import EVENT_LABELS, Query, rounded, table
from purseline.schema import Events, Transactions
from purseline.sources.topics import read_message_files, write_message_files
from purseline.staging import staging_path
from purseline.streaming.dedup import dedup_stream
from purseline.sources.local import local_table
from purseline.streaming.sinks import batch_counts, batch_totals_writer, start_batches, start_table, state_partitions
from purseline.operators.sketches import (
    DEVIATION,
    bucket_percentiles,
    distinct_sketches,
    percentile_buckets,
    sketch_distinct,
)
from purseline.streaming.features import UPDATES, current_features, feature_updates
from purseline.streaming.matching import match_earlier
from purseline.streaming.sessions import session_totals
from purseline.streaming.sliding import sliding_window_totals
from purseline.streaming.totals import deduplicated_totals, windowed_totals

SLICES = 3
HOUR = "1 hour"
DELAY = "10 seconds"
TOTALS_SCHEMA = "window_start timestamp, window_end timestamp, total_volume double, event_count bigint"


def _feed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.col("value").alias("transaction_amount"), F.col("ts").alias("timestamp"), "event_type"
    )


def _slice_number(rows: DataFrame) -> Column:
    """0, 1, 2 for the first, second and third part of the time covered."""
    micros = F.unix_micros(F.col("timestamp").cast("timestamp"))
    first, last = rows.agg(F.min(micros), F.max(micros)).first()
    return F.floor((micros - F.lit(first)) * SLICES / F.lit(last - first + 1))


def _slices(rows: DataFrame, repeated: bool = False, late: bool = False) -> list[DataFrame]:
    """The deliveries of each slice.

    ``repeated``: purchases are delivered twice at once, errors again with the next slice.
    ``late``: errors are delivered again with the next slice under new ids.
    """
    number = _slice_number(rows)
    parts = []
    for k in range(SLICES):
        part = rows.where(number == k)
        errors = rows.where((number == k - 1) & (F.col("event_type") == "error"))
        if repeated:
            part = part.unionByName(part.where(F.col("event_type") == "purchase")).unionByName(errors)
        if late:
            part = part.unionByName(errors.withColumn("event_id", -1 - F.col("event_id")))
        parts.append(part)
    return parts


def _replay(
    spark: SparkSession, deliveries: Iterable[DataFrame], start: Callable[[DataFrame, str], StreamingQuery]
) -> None:
    """Deliver slice by slice; run the query to the end of what is there after each."""
    feed, checkpoint = staging_path(spark, "feed"), staging_path(spark, "stream-checkpoint")
    for delivery in deliveries:
        write_message_files(encode_events(delivery, MESSAGE_COLUMNS), feed)
        usable, _ = split_rejects(decode_events(read_message_files(spark, feed)))
        with state_partitions(spark):
            start(usable, checkpoint).awaitTermination()


def _replay_to_table(
    spark: SparkSession, deliveries: Iterable[DataFrame], transform: Callable[[DataFrame], DataFrame], schema: str
) -> DataFrame:
    path = staging_path(spark, "stream-output")
    _replay(spark, deliveries, lambda rows, checkpoint: start_table(transform(rows), path, checkpoint))
    return spark.read.schema(schema).parquet(path)


def _plain_times(df: DataFrame) -> DataFrame:
    """Zone-less times, as the given tables have them."""
    times = [field.name for field in df.schema if field.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in times})


DECODED_SCHEMA = "event_id bigint, user_id bigint, transaction_amount double, timestamp timestamp"


def stream_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feed_rows(spark, sf_dir)
    return _plain_times(_replay_to_table(spark, [rows], lambda events: events, DECODED_SCHEMA))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    deliveries = _slices(_feed_rows(spark, sf_dir), repeated=True)
    once = _replay_to_table(
        spark, deliveries, lambda events: dedup_stream(events, ["event_id"], "timestamp", DELAY), DECODED_SCHEMA
    )
    return _plain_times(once)


def stream_window_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _replay_to_table(
        spark,
        [_feed_rows(spark, sf_dir)],
        lambda events: windowed_totals(events, Events(), HOUR, DELAY, scale=2),
        TOTALS_SCHEMA,
    )
    return _plain_times(totals)


def stream_resume(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Deduplicated totals of a query stopped and resumed between slices."""
    totals = _replay_to_table(
        spark,
        _slices(_feed_rows(spark, sf_dir), repeated=True),
        lambda events: deduplicated_totals(events, Events(), HOUR, DELAY, scale=2),
        TOTALS_SCHEMA,
    )
    return _plain_times(totals)


def stream_late_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    totals = _replay_to_table(
        spark,
        _slices(_feed_rows(spark, sf_dir), late=True),
        lambda events: windowed_totals(events, Events(), HOUR, DELAY, scale=2),
        TOTALS_SCHEMA,
    )
    return _plain_times(totals)


def stream_batch_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per slice, a micro-batch with data: rows read, rows dropped as repeats and rows dropped as late."""
    path, counts = staging_path(spark, "stream-output"), []
    feed, checkpoint = staging_path(spark, "feed"), staging_path(spark, "stream-checkpoint")
    for number, delivery in enumerate(_slices(_feed_rows(spark, sf_dir), repeated=True)):
        write_message_files(encode_events(delivery, MESSAGE_COLUMNS), feed)
        usable, _ = split_rejects(decode_events(read_message_files(spark, feed)))
        with state_partitions(spark):
            query = start_table(dedup_stream(usable, ["event_id"], "timestamp", DELAY), path, checkpoint)
            query.awaitTermination()
        counts += [{**c, "slice": number} for c in batch_counts(query) if c["raw_rows"]]
    schema = {name: T.LongType() for name in ("slice", "raw_rows", "repeats", "late")}
    rows = local_table(spark, {name: [c[name] for c in counts] for name in schema}, schema)
    return rows


def stream_latency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per day of the events, how many the stream passed on, and whether its latencies can be true.

    The latencies themselves differ from run to run: the time of an event's micro-batch less
    the event's own.
    """
    started = spark.range(1).select(F.unix_micros(F.current_timestamp())).first()[0]
    passed = _replay_to_table(
        spark, _slices(_feed_rows(spark, sf_dir)), with_processing_time, f"{DECODED_SCHEMA}, processed_at timestamp"
    )
    day = F.date_format("timestamp", "yyyy-MM-dd").alias("day")
    rows = latency_ms(passed, "timestamp", "processed_at").select(day, "latency_ms", "timestamp")
    least = rows.groupBy(F.col("day").alias("of")).agg(F.max(F.unix_micros("timestamp")).alias("latest"))
    both = latency_summary(rows.select("day", "latency_ms"), "day").join(least, F.col("day") == F.col("of"))
    ordered = (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99"))
    after = F.col("p50") >= (F.lit(started) - F.col("latest")) / 1000.0
    return both.select("day", "n", ordered.alias("ordered"), after.alias("after_start"))


def stream_load_levels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per load of the events' hour, how many the stream passed on, and whether its latencies can be true.

    The latencies are those of this run, from an event's time to that of its micro-batch.
    """
    passed = _replay_to_table(
        spark, _slices(_feed_rows(spark, sf_dir)), with_processing_time, f"{DECODED_SCHEMA}, processed_at timestamp"
    )
    found = latency_by_load(latency_ms(passed, "timestamp", "processed_at"), "timestamp", HOUR, HOURLY_LOADS)
    ordered = (F.lit(0) < F.col("p50")) & (F.col("p50") <= F.col("p95")) & (F.col("p95") <= F.col("p99"))
    return found.select("load", "n", ordered.alias("ordered"))


def stream_batch_partials(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = staging_path(spark, "batch-totals")
    write = batch_totals_writer(path, Events(), HOUR, scale=2)
    _replay(
        spark,
        _slices(_feed_rows(spark, sf_dir), repeated=True),
        lambda events, checkpoint: start_batches(
            dedup_stream(events, ["event_id"], "timestamp", DELAY), write, checkpoint
        ),
    )
    partials = spark.read.schema(f"{TOTALS_SCHEMA}, processed_at timestamp, batch_id bigint").parquet(path)
    return _plain_times(merge_totals(partials, scale=2))


def stream_batch_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per micro-batch with data, told apart by its number alone: its first window, windows and events."""
    path = staging_path(spark, "batch-totals")
    started = spark.range(1).select(F.current_timestamp()).first()[0]
    write = batch_totals_writer(path, Events(), HOUR, scale=2)
    deliveries = _slices(_feed_rows(spark, sf_dir))
    _replay(spark, deliveries, lambda events, checkpoint: start_batches(events, write, checkpoint))
    partials = spark.read.schema(f"{TOTALS_SCHEMA}, processed_at timestamp, batch_id bigint").parquet(path)
    batches = partials.groupBy("batch_id").agg(
        F.min("window_start").alias("first_window"),
        F.count(F.lit(1)).alias("windows"),
        F.sum("event_count").alias("events"),
        (F.count_distinct("processed_at") == 1).alias("one_time"),
        (F.min("processed_at") >= F.lit(started)).alias("after_start"),
    )
    return _plain_times(batches.drop("batch_id"))


FEED = Transactions("user_id", "transaction_amount", "timestamp", "event_type", ("event_id",), scale=2)
FEED_SCHEMA = f"{DECODED_SCHEMA}, event_type string"
EXPIRY = "1 day"


def _feed_files(
    spark: SparkSession, deliveries: Iterable[DataFrame], start: Callable[[DataFrame, str], StreamingQuery]
) -> None:
    """As ``_replay``, for events with their type, which the messages do not have."""
    feed, checkpoint = staging_path(spark, "feed"), staging_path(spark, "stream-checkpoint")
    for delivery in deliveries:
        rows = delivery.select("event_id", "user_id", "transaction_amount", F.col("timestamp").cast("timestamp"), "event_type")
        rows.write.mode("append").parquet(feed)
        with state_partitions(spark):
            start(spark.readStream.schema(FEED_SCHEMA).parquet(feed), checkpoint).awaitTermination()


def _feed_to_batches(spark: SparkSession, sf_dir: str, transform: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    """The stream's rows as stored by micro-batch, with ``batch_id``; a replayed batch takes its own place."""
    path = staging_path(spark, "stream-batches")

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    _feed_files(
        spark,
        _slices(_feed_rows(spark, sf_dir)),
        lambda rows, checkpoint: start_batches(transform(rows), write, checkpoint, mode="update"),
    )
    return spark.read.schema(f"{schema}, batch_id bigint").parquet(path)


def _feed_to_table(spark: SparkSession, sf_dir: str, transform: Callable[[DataFrame], DataFrame], schema: str) -> DataFrame:
    path = staging_path(spark, "stream-output")
    _feed_files(
        spark, _slices(_feed_rows(spark, sf_dir)), lambda rows, checkpoint: start_table(transform(rows), path, checkpoint)
    )
    return spark.read.schema(schema).parquet(path)


def stream_user_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of each user's tenures, which a day without events ends, after the last slice."""
    updates = _feed_to_batches(
        spark, sf_dir, lambda rows: feature_updates(rows, FEED, EVENT_LABELS, EXPIRY, DELAY), UPDATES
    )
    found = current_features(updates, FEED, EVENT_LABELS).withColumnRenamed("user", "user_id")
    digits = {"stddev_transaction": 6, "avg_log_amount": 6}
    return rounded(_plain_times(found.withColumn("user_id", F.col("user_id").cast("bigint"))), digits)


def _clicks_and_purchases(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    purchases = rows.where(F.col("event_type") == "purchase").select(
        F.col("event_id").alias("purchase_id"), "user_id", F.col("timestamp").alias("bought")
    )
    clicks = rows.where(F.col("event_type") == "click").select(
        F.col("event_id").alias("click_id"), "user_id", F.col("timestamp").alias("clicked")
    )
    return purchases, clicks


MATCH_SCHEMA = "purchase_id bigint, user_id bigint, bought timestamp, click_id bigint, clicked timestamp"


def _match(spark: SparkSession, sf_dir: str, how: str, hot: tuple = ()) -> DataFrame:
    def matched(rows: DataFrame) -> DataFrame:
        purchases, clicks = _clicks_and_purchases(rows)
        return match_earlier(purchases, clicks, "user_id", "bought", "clicked", HOUR, how, DELAY, hot)

    return _plain_times(_feed_to_table(spark, sf_dir, matched, MATCH_SCHEMA))


def stream_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _match(spark, sf_dir, "inner")


def stream_match_left(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users 1 to 8 are dealt over several tasks."""
    return _match(spark, sf_dir, "leftOuter", tuple(range(1, 9)))


SESSION_SCHEMA = (
    "user_id bigint, session_start timestamp, session_end timestamp, event_count bigint, total_volume double"
)


def stream_sessions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feed_to_table(
        spark, sf_dir, lambda rows: session_totals(rows, Events(), "6 hours", DELAY, scale=2), SESSION_SCHEMA
    )
    return _plain_times(rows)


def stream_sliding_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _feed_to_table(
        spark,
        sf_dir,
        lambda rows: sliding_window_totals(rows, Events(), "3 hours", "1 hour", DELAY, scale=2),
        TOTALS_SCHEMA,
    )
    return _plain_times(rows)


def stream_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per event type, percentiles of amounts from the merged summaries of all micro-batches.

    Numbers of users are about right; whether within four deviations of the sketch is told.
    """
    root = staging_path(spark, "stream-sketches")

    def write(batch: DataFrame, batch_id: int) -> None:
        buckets = percentile_buckets(batch, ["event_type"], "transaction_amount")
        buckets.write.mode("overwrite").parquet(f"{root}/buckets/batch_id={batch_id}")
        users = distinct_sketches(batch, ["event_type"], "user_id")
        users.write.mode("overwrite").parquet(f"{root}/users/batch_id={batch_id}")

    rows = _feed_rows(spark, sf_dir)
    _feed_files(spark, _slices(rows), lambda events, checkpoint: start_batches(events, write, checkpoint))
    buckets = spark.read.schema("event_type string, bucket bigint, n bigint, batch_id bigint").parquet(f"{root}/buckets")
    sketches = spark.read.schema("event_type string, sketch binary, batch_id bigint").parquet(f"{root}/users")
    about = bucket_percentiles(buckets, ["event_type"]).join(sketch_distinct(sketches, ["event_type"]), "event_type")
    exact = rows.groupBy(F.col("event_type").alias("type")).agg(F.count_distinct("user_id").alias("users"))
    counted = F.abs(F.col("distinct_values") / F.col("users") - 1) <= 4 * DEVIATION
    both = about.join(exact, F.col("event_type") == F.col("type"))
    return rounded(both.select("event_type", "n", *PERCENTILES, counted.alias("users_near")), dict.fromkeys(PERCENTILES, 6))


CLOSED = (
    "having time_bucket(interval '1 hour', ts) + interval '1 hour' <= "
    "(select max(ts) from events) - interval '10 seconds'"
)

LATE_ROWS = f"""
    with bounds as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from events),
    sliced as (
        select e.*, floor((epoch_us(ts) - lo) * {SLICES} / (hi - lo + 1)) as slice from events e, bounds),
    seen as (select slice, max(ts) - interval '10 seconds' as watermark from sliced group by 1),
    delivered as (
        select ts, value from sliced
        union all
        select ts, value from sliced join seen using (slice)
        where event_type = 'error' and slice < {SLICES - 1}
          and time_bucket(interval '1 hour', ts) + interval '1 hour' > watermark)"""

MATCH_SQL = """
    select p.event_id as purchase_id, p.user_id, p.ts as bought, c.event_id as click_id, c.ts as clicked
    from (select * from events where event_type = 'purchase') p
    {join} (select * from events where event_type = 'click') c
    on c.user_id = p.user_id and c.ts <= p.ts and c.ts >= p.ts - interval '1 hour' {where}"""

STREAMS: dict[str, Query] = {
    "stream_decode": Query(stream_decode, DECODED_SQL),
    "stream_dedup": Query(stream_dedup, DECODED_SQL),
    "stream_window_totals": Query(stream_window_totals, totals_sql(HOUR, having=CLOSED)),
    "stream_resume": Query(stream_resume, totals_sql(HOUR, having=CLOSED)),
    "stream_late_data": Query(stream_late_data, LATE_ROWS + totals_sql(HOUR, "delivered", CLOSED)),
    "stream_batch_counts": Query(
        stream_batch_counts,
        f"""with bounds as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from events),
            sliced as (
                select ts, event_type, floor((epoch_us(ts) - lo) * {SLICES} / (hi - lo + 1)) as k from events, bounds),
            marks as (select k + 1 as k, (max(epoch_ms(ts)) - 10000) * 1000 as mark from sliced group by 1),
            delivered as (
                select ts, k, 0 as again from sliced
                union all select ts, k, 1 from sliced where event_type = 'purchase'
                union all select ts, k + 1, 1 from sliced where event_type = 'error' and k < {SLICES - 1})
            -- Of what came before, the part behind the watermark of the slices read by then is late.
            select k::bigint as slice, count(*) as raw_rows,
                   count(*) filter (again = 1 and not coalesce(epoch_us(ts) <= mark, false)) as repeats,
                   count(*) filter (again = 1 and coalesce(epoch_us(ts) <= mark, false)) as late
            from delivered left join marks using (k) group by 1""",
    ),
    "stream_latency": Query(
        stream_latency,
        """select strftime(ts, '%Y-%m-%d') as day, count(*) as n, true as ordered, true as after_start
           from events group by 1""",
    ),
    "stream_load_levels": Query(
        stream_load_levels,
        f"""with {LOADS_SQL}
            select load, count(*) as n, true as ordered
            from events join levels on h = time_bucket(interval '1 hour', ts) group by load""",
    ),
    "stream_batch_tags": Query(
        stream_batch_tags,
        f"""with bounds as (select min(epoch_us(ts)) as lo, max(epoch_us(ts)) as hi from events),
            sliced as (
                select floor((epoch_us(ts) - lo) * {SLICES} / (hi - lo + 1)) as k, time_bucket(interval '1 hour', ts) as h
                from events, bounds)
            select min(h) as first_window, count(distinct h) as windows, count(*) as events,
                   true as one_time, true as after_start
            from sliced group by k""",
    ),
    "stream_batch_partials": Query(stream_batch_partials, totals_sql(HOUR)),
    "stream_user_features": Query(
        stream_user_features,
        f"""with gaps as (
                select *, ts - lag(ts) over (partition by user_id order by ts, event_id) as apart from events),
            tenures as (
                select *, sum((apart is null or apart > interval '{EXPIRY}')::int)
                    over (partition by user_id order by ts, event_id) as tenure from gaps)
            select user_id, min(ts) as tenure_start, max(ts) as last_seen,
                   epoch_us(max(ts) + interval '{EXPIRY}')
                       < epoch_ms((select max(ts) - interval '10 seconds' from events)) * 1000 as closed,
                   sum(value::{MONEY})::double as total_spent, sum(value::{MONEY})::double / count(*) as avg_transaction,
                   count(*) as transaction_count, max(value) as max_transaction, min(value) as min_transaction,
                   round(stddev_samp(value), 6) as stddev_transaction, round(avg(ln(1 + value)), 6) as avg_log_amount,
                   sum(hour(ts))::double / count(*) as avg_hour,
                   sum(dayofweek(ts) + 1)::double / count(*) as avg_day_of_week,
                   sum((dayofweek(ts) in (0, 6))::int)::double / count(*) as weekend_ratio,
                   count(distinct month(ts)) as active_months, {LABEL_COUNTS},
                   arg_max(value, (ts, event_id)) / count(*) as avg_amount_delta,
                   count(*) as total_transactions_ranked, sum(value::{MONEY})::double as final_running_total
            from tenures where value > 0 group by user_id, tenure""",
    ),
    "stream_match": Query(stream_match, MATCH_SQL.format(join="join", where="")),
    "stream_match_left": Query(
        stream_match_left,
        MATCH_SQL.format(
            join="left join",
            where="""where click_id is not null or epoch_ms(bought) < (
                select least(epoch_ms(max(ts) filter (event_type = 'purchase')),
                             epoch_ms(max(ts) filter (event_type = 'click'))) - 10000 from events)""",
        ),
    ),
    "stream_sessions": Query(
        stream_sessions,
        sessions_sql("user_id", "6 hours")
        + " having max(ts) + interval '6 hours' <= (select max(ts) - interval '10 seconds' from events)",
    ),
    "stream_sliding_totals": Query(
        stream_sliding_totals,
        sliding_sql("3 hours", "1 hour")
        + " having w + interval '3 hours' <= (select max(ts) - interval '10 seconds' from events)",
    ),
    "stream_sketches": Query(stream_sketches, sketches_sql("event_type", "value", "events", "true as users_near")),
}
