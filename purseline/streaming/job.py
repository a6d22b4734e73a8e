"""Command line job: topic in, deduplicated window totals out.

    python -m purseline.streaming.job --servers HOST:9092 --topic T --output OUT --checkpoint DIR

or, where the package is not installed, with it in a zip (see README):

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \\
        --py-files purseline.zip purseline/streaming/job.py --servers HOST:9092 --topic T --output OUT --checkpoint DIR
"""

from __future__ import annotations

import argparse
import time
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery

from purseline.functions.messages import decode_events, split_rejects
from purseline.schema import Events
from purseline.session import ROCKSDB, build_session
from purseline.sources.topics import read_topic, topic_options
from purseline.streaming.dedup import DELAY, dedup_stream
from purseline.streaming.sinks import (
    CountLog,
    batch_totals_writer,
    start_batches,
    start_console,
    start_table,
    state_partitions,
)
from purseline.streaming.totals import deduplicated_totals


def start(
    messages: DataFrame,
    output: str,
    checkpoint: str,
    width: str = "10 seconds",
    delay: str = DELAY,
    every: str | None = "10 seconds",
    console: bool = False,
    keys: Sequence[str] = (),
    partials: bool = False,
) -> list[StreamingQuery]:
    """Totals to ``output/totals`` and unreadable messages to ``output/rejects``.

    ``partials`` writes each micro-batch's own totals with its number and time instead of
    those of closed windows; counts per micro-batch go to ``output/counts`` either way.
    """
    usable, rejects = split_rejects(decode_events(messages))
    totals = deduplicated_totals(usable, Events(), width, delay, keys=keys)
    if console:
        return [start_console(totals, f"{checkpoint}/console", every)]
    spark = usable.sparkSession
    spark.streams.addListener(CountLog(spark, f"{output}/counts", "totals"))
    if partials:
        once = dedup_stream(usable, list(keys) or [Events().key], Events().time, delay)
        write = batch_totals_writer(f"{output}/totals", Events(), width)
        first = start_batches(once, write, f"{checkpoint}/totals", every, name="totals")
    else:
        first = start_table(totals, f"{output}/totals", f"{checkpoint}/totals", every, name="totals")
    return [
        first,
        start_table(rejects.select("value"), f"{output}/rejects", f"{checkpoint}/rejects", every),
    ]


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Window totals of a topic of JSON transactions")
    parser.add_argument("--servers", required=True)
    parser.add_argument("--topic", required=True)
    parser.add_argument("--output", required=True)
    parser.add_argument("--checkpoint", required=True, help="folder of this job only, kept between runs")
    parser.add_argument("--master")
    parser.add_argument("--starting", default="latest", choices=["latest", "earliest"])
    parser.add_argument("--max-per-trigger", type=int, help="most messages in one micro-batch")
    parser.add_argument("--window", default="10 seconds")
    parser.add_argument("--delay", default=DELAY)
    parser.add_argument("--every", default="10 seconds", help="trigger interval")
    parser.add_argument("--state-partitions", type=int, help="fixed by the first start")
    parser.add_argument("--keys", nargs="*", default=[], help="columns that name an event; event_id by default")
    parser.add_argument("--partials", action="store_true", help="totals of each micro-batch, not of closed windows")
    parser.add_argument("--console", action="store_true", help="print totals instead of writing them")
    args = parser.parse_args(argv)

    spark = build_session(
        "window-totals", args.master, extra={"spark.sql.streaming.stateStore.providerClass": ROCKSDB}
    )
    # One place for totals and rejects to start from.
    now_ms = int(time.time() * 1_000)
    source = read_topic(spark, topic_options(args.servers, args.topic, args.starting, args.max_per_trigger, now_ms))
    with state_partitions(spark, args.state_partitions):
        start(
            source,
            args.output,
            args.checkpoint,
            args.window,
            args.delay,
            args.every,
            args.console,
            args.keys,
            args.partials,
        )
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
