"""Bucket grids, widths, instants."""

from datetime import datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.functions import buckets, instants
from tidemark.sources import tables


@pytest.mark.parametrize(
    ("text", "micros", "months"),
    [
        ("1 minute", 60_000_000, 0),
        ("5 Minutes", 300_000_000, 0),
        ("1h", 3_600_000_000, 0),
        ("1m", 60_000_000, 0),
        ("1M", 0, 1),
        ("2 years", 0, 24),
        ("1w", 604_800_000_000, 0),
    ],
)
def test_width_spellings(text, micros, months):
    assert buckets.parse_width(text) == buckets.Width(micros, months)


@pytest.mark.parametrize("text", ["", "hour", "0 hours", "1 fortnight", "1.5 hours", "1 hour; x", "1h\n"])
def test_bad_widths(text):
    with pytest.raises(ValueError):
        buckets.parse_width(text)


@pytest.mark.parametrize(
    ("time", "width", "start"),
    [
        ("2024-01-07 23:59:59.999999", "1 week", "2024-01-01 00:00:00"),
        ("2024-01-08 00:00:00", "1 week", "2024-01-08 00:00:00"),
        ("1999-12-31 12:00:00", "1 week", "1999-12-27 00:00:00"),
        ("2024-02-29 10:00:00", "1 month", "2024-02-01 00:00:00"),
        ("1999-11-30 10:00:00", "5 months", "1999-08-01 00:00:00"),
        ("2024-05-05 00:00:00", "1 year", "2024-01-01 00:00:00"),
        ("2024-01-15 10:59:59.999999", "1 hour", "2024-01-15 10:00:00"),
        ("1969-12-31 23:59:59", "1 day", "1969-12-31 00:00:00"),
    ],
)
def test_bucket_edges(spark, time, width, start):
    row = spark.range(1).select(
        buckets.bucket(instants.at(time), width).cast("string").alias("start"),
        buckets.bucket_start(buckets.bucket_index(instants.at(time), width), width)
        .cast("string")
        .alias("again"),
    ).first()
    assert row["start"] == row["again"] == start
    assert buckets.start_of(buckets.index_of(time, width), width) == instants.instant(start)


@settings(max_examples=200, deadline=None)
@given(
    st.datetimes(datetime(1970, 1, 1), datetime(2100, 1, 1)),
    st.integers(1, 400),
    st.sampled_from(["second", "minute", "hour", "day", "week", "month", "year"]),
)
def test_python_grid_is_consistent(moment, amount, unit):
    width = f"{amount} {unit}s"
    index = buckets.index_of(moment, width)
    assert buckets.start_of(index, width) <= moment < buckets.start_of(index + 1, width)


def test_whole_buckets_shrink_inwards():
    low, high = buckets.whole_buckets("2024-01-05 07:25", "2024-01-05 13:40", "1 hour")
    assert (low.hour, high.hour) == (8, 13)
    low, high = buckets.whole_buckets("2024-01-05 07:25", "2024-01-05 07:50", "1 hour")
    assert low == high
    assert buckets.buckets_between("2024-01-01", "2024-01-02", "1 hour") == 24
    assert buckets.buckets_between("2024-01-01 00:30", "2024-01-01 01:30", "1 hour") == 2


def test_instants_are_utc():
    assert instants.instant("2024-01-15T12:00:00+02:00") == datetime(2024, 1, 15, 10)
    assert instants.instant("2024-01-15T10:00:00Z") == datetime(2024, 1, 15, 10)
    assert instants.back("2024-01-15", hours=1) == datetime(2024, 1, 14, 23)


def test_range_reaches_the_scan_and_prunes_days(spark, tmp_path):
    df = spark.range(48).select(
        F.timestamp_seconds(F.col("id") * 3600 + 1_704_067_200).alias("time"), F.col("id").alias("n")
    )
    path = str(tmp_path / "t")
    df.withColumn("day", F.to_date("time")).write.partitionBy("day").parquet(path)
    stored = instants.within(tables.read_days(spark, path), "2024-01-02", "2024-01-02 06:00")
    plan = stored._sc._jvm.PythonSQLUtils.explainString(stored._jdf.queryExecution(), "formatted")
    assert "PartitionFilters: [isnotnull(day" in plan
    assert "GreaterThanOrEqual(time,2024-01-02" in plan and "LessThan(time,2024-01-02" in plan
    assert stored.count() == 6


def test_span_guard():
    instants.check_span("2024-01-01", "2024-06-01")
    with pytest.raises(ValueError):
        instants.check_span("2022-01-01", "2024-01-01")
    with pytest.raises(ValueError):
        instants.within(None, "2024-01-02", "2024-01-01")


def test_stream_window_grid_matches_bucket(spark):
    from tidemark.streaming.flows import tumbling

    df = spark.range(0, 3000, 7).select(
        (instants.at("1999-06-01 00:00:01") + F.make_dt_interval(hours=F.col("id").cast("int") * 11)).alias("time")
    )
    for width in ("1 week", "7 hours", "10 days", "5 minutes"):
        wrong = df.select(
            tumbling(width).getField("start").alias("a"), buckets.bucket("time", width).alias("b")
        ).filter("a <> b")
        assert wrong.count() == 0
