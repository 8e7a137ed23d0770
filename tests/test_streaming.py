"""Streams against their batch twins, late rows included."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import time_bucket_agg
from tidemark.operators.reads import CLIMATE_LIMITS
from tidemark.plans import rollups
from tidemark.sources import tables
from tidemark.streaming import flows

SCHEMA = "time timestamp, entity_id string, value double, value2 double, value3 double, value4 double, metadata string"


@pytest.fixture
def feed(spark, tmp_path):
    """A folder that takes one file of (minute, entity, value) rows per call, and its stream."""
    folder = tmp_path / "feed"
    folder.mkdir()

    def add(*rows):
        full = [(datetime(2024, 1, 15) + timedelta(minutes=m), e, v, None, None, None, "{}") for m, e, v in rows]
        spark.createDataFrame(full, SCHEMA).coalesce(1).write.mode("append").parquet(str(folder))

    return add, lambda: flows.read_stream(spark, str(folder), SCHEMA, max_files=1), str(folder)


def _run(stream, tmp_path, name="out"):
    flows.run_available(flows.write_stream(stream, str(tmp_path / name), str(tmp_path / f"{name}-state")))
    return str(tmp_path / name)


def test_late_rows_are_dropped_and_recovered_by_refresh(spark, feed, tmp_path):
    add, stream, folder = feed
    build = lambda: flows.stream_bucket_agg(stream(), "1 hour", "10 minutes")
    add((5, "a", 1.0), (50, "a", 3.0), (130, "a", 5.0))
    out = _run(build(), tmp_path)
    assert {r["bucket"].hour: r["count"] for r in spark.read.parquet(out).collect()} == {0: 2}
    add((20, "a", 100.0), (300, "a", 7.0))
    _run(build(), tmp_path)
    streamed = {r["bucket"].hour: (r["count"], r["max"]) for r in spark.read.parquet(out).collect()}
    assert streamed == {0: (2, 3.0), 2: (1, 5.0)}
    stored = str(tmp_path / "stored")
    tables.append_days(spark.read.parquet(out), stored, time="bucket")
    hourly = rollups.Rollup(
        "hourly", "records", "1 hour",
        lambda df: time_bucket_agg(df, "1 hour", "2024-01-01", "2024-02-01"),
        timedelta(hours=3), timedelta(0))
    source = spark.read.schema(SCHEMA).parquet(folder)
    rollups.refresh_rollup(spark, hourly, source, stored, "2024-01-15", "2024-01-15 02:00")
    fixed = {r["bucket"].hour: (r["count"], r["max"]) for r in spark.read.parquet(stored).collect()}
    assert fixed == {0: (3, 100.0), 2: (1, 5.0)}


def test_ingest_merges_batches_and_keeps_rejects(spark, feed, tmp_path):
    add, stream, _ = feed
    add((0, "a", 1.0), (1, "bad id", 2.0))
    add((0, "a", 9.0), (2, "b", float("nan")))
    path, bad = str(tmp_path / "records"), str(tmp_path / "bad")
    flows.run_available(flows.stream_ingest(stream(), path, str(tmp_path / "state"), rejects_path=bad))
    assert spark.read.parquet(bad).count() == 2
    got = flows.merged_records(spark, path).collect()
    assert [(r["entity_id"], r["value"]) for r in got] == [("a", 9.0)]
    assert flows.fold_pending(spark, path) == 2
    add((0, "a", 10.0), (3, "c", 1.0))
    flows.run_available(flows.stream_ingest(stream(), path, str(tmp_path / "state"), rejects_path=bad))
    assert [r["value"] for r in tables.load_records(spark, path).collect()] == [9.0]
    for _ in range(2):
        got = {r["entity_id"]: r["value"] for r in flows.merged_records(spark, path).collect()}
        assert got == {"a": 10.0, "c": 1.0}
        flows.fold_pending(spark, path)
    assert flows.fold_pending(spark, path) == 0


def test_a_trigger_writes_what_it_brought(spark, feed, tmp_path):
    """Files of earlier batches are not touched, and a replay of a batch takes its own place."""
    add, stream, _ = feed
    add(*[(m, f"e{m % 5}", float(m)) for m in range(50)])
    path, state = str(tmp_path / "records"), str(tmp_path / "state")
    flows.run_available(flows.stream_ingest(stream(), path, state))
    before = {f: f.stat().st_mtime_ns for f in (tmp_path / "records-pending").rglob("*.parquet")}
    add((7, "e0", 1.0))
    flows.run_available(flows.stream_ingest(stream(), path, state))
    after = {f: f.stat().st_mtime_ns for f in (tmp_path / "records-pending").rglob("*.parquet")}
    assert before.items() < after.items()
    flows.run_available(flows.stream_ingest(stream(), path, str(tmp_path / "again")))
    assert flows.merged_records(spark, path).count() == 51


def test_latest_keeps_the_newest_over_batches(spark, feed, tmp_path):
    add, stream, _ = feed
    add((10, "a", 1.0), (20, "b", 2.0))
    add((5, "a", 99.0), (30, "b", 3.0), (1, "c", 4.0))
    path = str(tmp_path / "latest")
    flows.run_available(flows.stream_latest(stream(), path, str(tmp_path / "state")))
    for left in (2, 1):
        got = {r["entity_id"]: r["value"] for r in flows.load_latest(spark, path).collect()}
        assert got == {"a": 1.0, "b": 3.0, "c": 4.0}
        assert flows.fold_latest(spark, path) == left
    add((40, "c", 5.0))
    flows.run_available(flows.stream_latest(stream(), path, str(tmp_path / "state")))
    assert {r["entity_id"]: r["value"] for r in flows.load_latest(spark, path).collect()}["c"] == 5.0


def test_a_batch_replayed_after_a_fold_loses_no_entity(spark, feed, tmp_path):
    add, stream, _ = feed
    path, state = str(tmp_path / "latest"), str(tmp_path / "state")

    def run():
        flows.run_available(flows.stream_latest(stream(), path, state))
        return {r["entity_id"]: r["value"] for r in flows.load_latest(spark, path).collect()}

    add((10, "a", 1.0), (20, "b", 2.0))
    run()
    add((30, "b", 3.0), (1, "c", 4.0))
    assert run() == {"a": 1.0, "b": 3.0, "c": 4.0}
    last = flows.last_committed(spark, state)
    tables.drop_folder(spark, f"{state}/commits/{last}")  # as after a crash before the commit
    assert flows.fold_latest(spark, path) == 2
    assert run() == {"a": 1.0, "b": 3.0, "c": 4.0}
    assert tables.folders(spark, path, "batch=") == [f"batch={last}"]  # it was replayed
    assert flows.fold_latest(spark, path) == 2
    add((0, "d", 9.0))
    assert run() == {"a": 1.0, "b": 3.0, "c": 4.0, "d": 9.0}


def test_a_fold_that_was_not_finished_is_not_read(spark, feed, tmp_path):
    add, stream, _ = feed
    path = str(tmp_path / "latest")
    add((10, "a", 1.0))
    flows.run_available(flows.stream_latest(stream(), path, str(tmp_path / "state")))
    flows.fold_latest(spark, path)
    half = tmp_path / "latest-folded" / "folded=2"
    half.mkdir()
    assert flows.load_latest(spark, path).count() == 1
    add((20, "b", 1.0))
    flows.run_available(flows.stream_latest(stream(), path, str(tmp_path / "state")))
    flows.fold_latest(spark, path)
    assert flows.load_latest(spark, path).count() == 2 and not half.exists()


def test_pending_batches_are_folded_once_they_are_committed(spark, feed, tmp_path):
    add, stream, _ = feed
    path, state = str(tmp_path / "records"), str(tmp_path / "state")
    add((10, "a", 1.0))
    flows.run_available(flows.stream_ingest(stream(), path, state))
    add((20, "a", 2.0))
    flows.run_available(flows.stream_ingest(stream(), path, state))
    last = flows.last_committed(spark, state)
    tables.drop_folder(spark, f"{state}/commits/{last}")
    assert flows.fold_pending(spark, path, checkpoint=state) == 1
    flows.run_available(flows.stream_ingest(stream(), path, state))
    assert flows.fold_pending(spark, path, checkpoint=state) == 1
    assert flows.fold_pending(spark, path, checkpoint=state) == 0
    assert flows.merged_records(spark, path).count() == 2


def test_silence(spark, feed, tmp_path):
    add, stream, _ = feed
    add((0, "a", 1.0), (8, "a", 1.0), (40, "a", 1.0), (0, "b", 1.0), (45, "b", 1.0))
    out = spark.read.parquet(_run(flows.stream_stale(stream(), 10, "1 minute"), tmp_path))
    found = sorted((r["entity_id"], r["last_seen"].minute, r["silent_at"].minute) for r in out.collect())
    assert found == [("a", 8, 18), ("b", 0, 10)]


def test_alerts_and_dedupe(spark, feed, tmp_path):
    add, stream, _ = feed
    add((0, "a", 50.0), (0, "a", 50.0), (1, "a", 20.0))
    alerts = spark.read.parquet(_run(flows.stream_alerts(stream(), CLIMATE_LIMITS), tmp_path, "alerts"))
    assert alerts.count() == 2
    single = spark.read.parquet(_run(flows.stream_dedupe(stream(), "1 hour"), tmp_path, "single"))
    assert single.count() == 2


@pytest.mark.parametrize("width", ["1 month", "1 quarter", "1 year"])
def test_calendar_buckets_from_a_stream_equal_the_batch_ones(spark, feed, tmp_path, width):
    add, stream, folder = feed
    width = "3 months" if width == "1 quarter" else width
    day = 24 * 60
    # From 15 January 2024 on: leap day, ends of months to the minute, two years.
    add(*[(m, e, float(m % 97)) for m in range(0, 700 * day, 5 * day + 7) for e in ("a", "b")])
    add((45 * day - 1, "a", 1000.0), (46 * day - 1, "a", 2000.0), (900 * day, "c", 1.0))
    out = _run(flows.stream_bucket_agg(stream(), width, "1000 days"), tmp_path)
    source = spark.read.schema(SCHEMA).parquet(folder)
    end = "2026-07-03"  # of the newest row
    batch = time_bucket_agg(source, width, "2000-01-01", end)
    columns = ["bucket", "entity_id", "count", "avg", "min", "max", "first", "last"]
    assert spark.read.parquet(out).count() == 0  # nothing is closed within the delay
    again = str(tmp_path / "again")
    flows.run_available(flows.write_stream(flows.stream_bucket_agg(flows.read_stream(spark, folder, SCHEMA), width, "1 day"), again, str(tmp_path / "s2")))
    got = {tuple(r) for r in spark.read.parquet(again).select(*columns).collect()}
    wanted = {tuple(r) for r in batch.select(*columns).collect() if r["entity_id"] != "c"}
    assert got == wanted and len(got) > 3


def test_a_month_closes_when_its_lateness_has_passed(spark, feed, tmp_path):
    add, stream, _ = feed
    day = 24 * 60
    march = 46 * day  # 1 March 2024
    add((30 * day, "a", 1.0), (march + 5, "a", 2.0))
    add((march - 2, "a", 3.0))  # seven minutes late, of ten
    add((march + 20, "a", 4.0))
    add((march + 21, "a", 4.0))  # a batch takes late rows by the watermark of the one before
    add((march - 1, "a", 5.0), (march + 22, "a", 4.0))  # too late
    out = _run(flows.stream_bucket_agg(stream(), "1 month", "10 minutes"), tmp_path)
    got = {(r["bucket"].month, r["count"], r["max"]) for r in spark.read.parquet(out).collect()}
    assert got == {(2, 2, 3.0)}


def test_the_delay_on_the_even_calendar_is_never_shorter(spark):
    assert flows.even_delay("10 minutes") == "600 seconds"
    assert flows.even_delay("40 days") == f"{43 * 86_400} seconds"
    start = datetime(2023, 1, 1)
    rows = [(start + timedelta(hours=7 * k),) for k in range(4_000)]
    df = spark.createDataFrame(rows, "time timestamp")
    for width in ("1 month", "5 months", "1 year"):
        found = [r[0] for r in df.orderBy("time").select(F.unix_micros(flows.even_calendar(width))).collect()]
        assert found == sorted(set(found))


def test_calendar_widths_have_no_window_of_fixed_length(spark):
    with pytest.raises(ValueError):
        flows.tumbling("1 month")
    df = spark.range(1).select(F.current_timestamp().alias("time"))
    assert df.select(flows.tumbling("1 day")).count() == 1
