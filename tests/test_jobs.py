"""The command line job, file layout, and what the plans must look like."""

import contextlib
import io

import pyarrow.parquet as pq
import pytest

from purseline.functions.messages import decode_events, split_rejects
from purseline.operators.filters import amount_above
from purseline.operators.normalise import with_zscores
from purseline.operators.profile import user_amount_stats
from purseline.operators.sequence import with_sequence_features
from purseline.plans import feature_job
from purseline.plans.row_features import row_features
from purseline.plans.user_features import user_statistics
from purseline.registry.bindings import EVENT_LABELS, EVENTS, ORDERS, events, orders, table
from purseline.schema import Transactions
from purseline.sources.tables import read_transactions, write_table
from purseline.staging import staging_root


def plan(df, mode="formatted"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def test_job_replaces_its_output_and_sorts_it(spark, sf_dir, tmp_path):
    target = str(tmp_path / "features")
    for _ in range(2):
        report = feature_job.run(spark, f"{sf_dir}/events.parquet", target, EVENTS, EVENT_LABELS)
    assert report["num_features_engineered"] == 22 and report["total_runtime_seconds"] > 0
    users = [r.user_id for r in spark.read.parquet(target).collect()]
    files = sorted(p for p in (tmp_path / "features").iterdir() if p.suffix == ".parquet")
    in_file_order = [u for f in files for u in pq.read_table(f, columns=["user_id"]).column(0).to_pylist()]
    assert in_file_order == sorted(users) and len(set(users)) == len(users)


def test_rows_per_file_and_microseconds(spark, sf_dir, tmp_path):
    rows = table(spark, sf_dir, "events")
    write_table(rows.coalesce(1), str(tmp_path / "t"), rows_per_file=300)
    files = [pq.ParquetFile(p) for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet"]
    assert sorted(f.metadata.num_rows for f in files) == [100, 300, 300, 300]
    assert {str(f.schema_arrow.field("ts").type) for f in files} == {"timestamp[us]"}


def test_zoned_timestamps_are_written_with_microseconds(spark, sf_dir, tmp_path):
    spark.conf.set("spark.sql.parquet.outputTimestampType", "INT96")
    try:
        write_table(table(spark, sf_dir, "events").selectExpr("cast(ts as timestamp) ts"), str(tmp_path / "t"))
        assert spark.conf.get("spark.sql.parquet.outputTimestampType") == "INT96"
    finally:
        spark.conf.set("spark.sql.parquet.outputTimestampType", "TIMESTAMP_MICROS")
    file = next(p for p in (tmp_path / "t").iterdir() if p.suffix == ".parquet")
    column = pq.ParquetFile(file).schema.column(0)
    assert column.physical_type == "INT64" and "microseconds" in str(column.logical_type)


def test_read_with_declared_schema(spark, sf_dir):
    path = f"{sf_dir}/events.parquet"
    inferred = read_transactions(spark, path, EVENTS)
    declared = read_transactions(spark, path, EVENTS, schema=spark.read.parquet(path).schema)
    assert declared.exceptAll(inferred).count() == 0 and declared.columns == list(EVENTS.required)


def test_statistics_plan(spark, sf_dir):
    text = plan(user_statistics(events(spark, sf_dir), EVENTS, EVENT_LABELS))
    assert "PushedFilters: [IsNotNull(value), GreaterThan(value,0.0)]" in text
    assert "props" not in text.split("ReadSchema:")[1].split("\n")[0]
    assert text.count("hashpartitioning") == 1
    for unwanted in ("Window", "SortAggregate", "ObjectHashAggregate", "SortMergeJoin", "Cartesian", "NestedLoop"):
        assert unwanted not in text
    assert "BroadcastHashJoin" in text


def test_statistics_plan_without_tiebreak_has_one_exchange(spark, sf_dir):
    plain = Transactions("user_id", "value", "ts", "event_type")
    text = plan(user_statistics(events(spark, sf_dir), plain, EVENT_LABELS))
    assert text.count("hashpartitioning") == 1 and "Window" not in text and "SortAggregate" not in text


def test_money_without_tiebreak_needs_no_sort(spark, sf_dir):
    money = Transactions("user_id", "value", "ts", "event_type", scale=2)
    assert "SortAggregate" not in plan(user_statistics(events(spark, sf_dir), money, EVENT_LABELS))


def test_message_text_is_parsed_once(spark):
    messages = spark.createDataFrame([("{}",)], "value string")
    assert plan(split_rejects(decode_events(messages))[0], "simple").count("from_json") == 1


def test_sequence_plan_has_one_exchange_and_one_sort(spark, sf_dir):
    text = plan(with_sequence_features(orders(spark, sf_dir), ORDERS), "simple")
    assert text.count("Exchange") == 1 and text.count("Sort ") == 1


def test_row_features_move_rows_once(spark, sf_dir):
    text = plan(row_features(events(spark, sf_dir), EVENTS, EVENT_LABELS), "simple")
    assert text.count("Exchange hashpartitioning") == 1 and "SortMergeJoin" not in text
    exchange = text[: text.index("Exchange hashpartitioning")]
    assert "dayofweek" in exchange and "hour(" in exchange


def test_zscores_join_nothing(spark, sf_dir):
    stats = user_amount_stats(amount_above(orders(spark, sf_dir), "o_totalprice"), ORDERS)
    text = plan(with_zscores(stats), "simple")
    assert "Subquery" in text and "Join" not in text


def test_staging_uses_the_shared_folder(spark):
    shared = spark.conf.get("spark.checkpoint.dir", None)
    root = staging_root(spark)
    assert root == shared.rstrip("/") if shared else root


@pytest.mark.parametrize("flag", [[], ["--unsorted"]])
def test_command_line(spark, sf_dir, tmp_path, flag, monkeypatch):
    monkeypatch.setattr(feature_job, "build_session", lambda *a, **k: spark)
    monkeypatch.setattr(type(spark), "stop", lambda self: None)
    source, target = str(tmp_path / "in"), str(tmp_path / "out")
    rows = table(spark, sf_dir, "events").selectExpr(
        "cast(user_id as string) user_id", "value as amount", "ts as timestamp", "event_type as category", "event_id"
    )
    rows.write.parquet(source)
    feature_job.main(["--input", source, "--output", target, "--tiebreak", "event_id", "--scale", "2", *flag])
    assert spark.read.parquet(target).count() == rows.select("user_id").distinct().count()
