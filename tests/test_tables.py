"""Stored tables: ingest, upsert, refresh, retention, compaction."""

import dataclasses
from datetime import date, datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from tidemark.functions.instants import within
from tidemark.operators import lifecycle, quality
from tidemark.plans import rollups
from tidemark.session import scratch_path, shared_dir
from tidemark.sources import ingest, tables


def _values(spark, path):
    return {
        (r["entity_id"], str(r["time"])): r["value"]
        for r in tables.load_records(spark, path).collect()
    }


def test_scratch_lies_in_the_named_folder(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_last_write_wins_also_inside_a_batch(spark, records, tmp_path):
    path = str(tmp_path / "records")
    first = records(("2024-01-15 10:00:00", "a", 1.0), ("2024-01-16 10:00:00", "a", 2.0))
    ingest.insert_records(first, path)
    batch = records(("2024-01-15 10:00:00", "a", 5.0), ("2024-01-15 11:00:00", "b", 6.0))
    batch = batch.withColumn("n", F.lit(1)).unionByName(
        records(("2024-01-15 10:00:00", "a", 7.0)).withColumn("n", F.lit(2))
    )
    untouched = [f.stat().st_mtime_ns for f in (tmp_path / "records/day=2024-01-16").glob("*.parquet")]
    ingest.upsert_records(batch, path, ["n"])
    assert _values(spark, path) == {
        ("a", "2024-01-15 10:00:00"): 7.0,
        ("a", "2024-01-16 10:00:00"): 2.0,
        ("b", "2024-01-15 11:00:00"): 6.0,
    }
    after = [f.stat().st_mtime_ns for f in (tmp_path / "records/day=2024-01-16").glob("*.parquet")]
    assert untouched == after


def test_upsert_into_nothing_and_idempotence(spark, records, tmp_path):
    path = str(tmp_path / "records")
    batch = records(("2024-01-15 10:00:00", "a", 1.0, 0.0))
    for _ in range(2):
        ingest.upsert_records(batch, path)
    row = tables.load_records(spark, path).collect()
    assert len(row) == 1 and row[0]["value2"] == 0.0


def test_batch_result_and_strict_mode(spark, tmp_path):
    raw = spark.createDataFrame(
        [("2024-01-15 10:00:00", "a", "1"), ("never", "a", "2"), ("2024-01-15 10:00:00", "b b", "3")],
        "time string, entity_id string, value string",
    ).select("*", *[F.lit(None).cast("string").alias(c) for c in ("value2", "value3", "value4", "metadata")])
    path, rejects = str(tmp_path / "r"), str(tmp_path / "bad")
    result = ingest.insert_many(raw, path, rejects_path=rejects)
    assert (result.processed, result.failed) == (1, 2)
    assert spark.read.parquet(rejects).count() == 2
    with pytest.raises(ingest.BatchError) as error:
        ingest.insert_many(raw, path, strict=True)
    assert error.value.result.failed == 2 and len(_values(spark, path)) == 1
    nothing = ingest.insert_many(raw.limit(0), path)
    assert (nothing.processed, nothing.failed) == (0, 0)


def test_entities_keep_their_creation_time(spark):
    schema = ("entity_id string, entity_type string, name string, created_at timestamp, "
              "updated_at timestamp, is_active boolean")
    born = datetime(2023, 1, 1)
    known = spark.createDataFrame([("a", "sensor", "old", born, born, True)], schema)
    more = spark.createDataFrame(
        [("a", "sensor", "new", None, None, True), ("b", "server", "b", None, None, True),
         ("c", "Bad Type", "c", None, None, True)], schema)
    found = {r["entity_id"]: r for r in ingest.upsert_entities(known, more, "2024-01-01").collect()}
    assert set(found) == {"a", "b"}
    assert found["a"]["name"] == "new" and found["a"]["created_at"] == born
    assert found["a"]["updated_at"] == found["b"]["created_at"] == datetime(2024, 1, 1)


def test_insert_if_absent(spark):
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    new = spark.createDataFrame([("a", 2), ("b", 3), ("b", 3)], "k string, v int")
    assert [tuple(r) for r in ingest.insert_if_absent(old, new, ["k"]).collect()] == [("b", 3)]


def test_refresh_recomputes_whole_buckets_only(spark, ticks, tmp_path):
    path = str(tmp_path / "hourly")
    rollup = rollups.Rollup("h", "price_ticks", "1h", lambda t: rollups.ohlc_from_ticks(t, "1 hour"),
                            rollups.ROLLUPS["ticks_1hour"].start, rollups.ROLLUPS["ticks_1hour"].end)
    old = ticks(*[(f"2024-01-15 {h:02}:30:00", "A", float(h)) for h in range(24)],
                ("2024-01-16 05:00:00", "A", 99.0))
    rollups.refresh_rollup(spark, rollup, old, path, "2024-01-15", "2024-01-17")
    changed = old.filter("time < '2024-01-16'").withColumn("price", F.col("price") + 100)
    low, high = rollups.refresh_rollup(spark, rollup, changed, path, "2024-01-15 03:20", "2024-01-15 06:50")
    assert (low.hour, high.hour) == (4, 6)
    closes = {r["bucket"].hour: r["close"] for r in spark.read.parquet(path).filter("day = '2024-01-15'").collect()}
    assert closes == {h: float(h) + (100 if h in (4, 5) else 0) for h in range(24)}
    # a day whose source rows are gone disappears when it is refreshed
    rollups.refresh_rollup(spark, rollup, changed, path, "2024-01-16", "2024-01-17")
    assert tables.stored_days(spark, path) == [date(2024, 1, 15)]
    assert rollups.refresh_rollup(spark, rollup, old, path, "2024-01-15 03:20", "2024-01-15 03:50")[0].hour == 4


def test_refresh_that_looks_back_equals_the_whole(spark, ticks, tmp_path):
    rows = [(f"2024-01-{d:02} {h:02}:15:00", s, float((d * 7 + h * 3) % 11 + i))
            for d in (14, 15) for h in range(0, 24, 2) for i, s in enumerate("AB")]
    source = ticks(*rows).withColumns({"exchange": F.lit("X"), "data_source": F.lit("S")})
    rollup = rollups.ROLLUPS["market_volatility_hourly"]
    path = str(tmp_path / "vol")
    rollups.refresh_rollup(spark, rollup, source, path, "2024-01-15 05:00", "2024-01-15 20:00")
    whole = rollup.build(source).filter("bucket >= '2024-01-15 05:00' AND bucket < '2024-01-15 20:00'")
    part = spark.read.parquet(path).select(*whole.columns)
    assert sorted(map(repr, part.collect())) == sorted(map(repr, whole.collect()))


def test_policies_cover_all_rollups(spark, ticks, tmp_path):
    source = ticks(*[(f"2024-01-15 {h:02}:30:00", "A", float(h + 1), 2.0) for h in range(12)]).withColumns(
        {"exchange": F.lit("X"), "data_source": F.lit("S"), "bid_price": F.col("price"), "ask_price": F.col("price")})
    bars = rollups.ohlc_from_ticks(source, "1 hour").select(
        F.col("bucket").alias("time"), "symbol", F.lit("1h").alias("interval_duration"), "open", "high", "low",
        "close", "volume", F.lit(0.0).alias("price_change_percent"), F.lit("S").alias("data_source"))
    done = rollups.refresh_all(spark, {"price_ticks": source, "ohlc_data": bars}, str(tmp_path), "2024-01-22", "2024-01-15")
    assert set(done) == set(rollups.ROLLUPS)
    for name in done:
        assert rollups.continuous_aggregate_read(spark, str(tmp_path), name, "2024-01-15", "2024-01-22").count() > 0
    with pytest.raises(ValueError):
        rollups.continuous_aggregate_read(spark, str(tmp_path), "a; drop", "2024-01-15", "2024-01-22")
    hourly = rollups.route_rollup(spark, str(tmp_path), "1h", "2024-01-15", "2024-01-22", "A")
    assert hourly.count() == 12
    with pytest.raises(ValueError):
        rollups.route_rollup(spark, str(tmp_path), "2h", "2024-01-15", "2024-01-22")


def _stored_ticks(spark, ticks, path):
    df = ticks(*[(f"2024-01-{d:02} 10:00:00", s, float(p)) for d in range(1, 11) for s, p in (("A", d), ("B", -d))])
    tables.append_days(df, path)
    return spark.read.parquet(path)


def test_retention_by_symbol_rows_and_days(spark, ticks, tmp_path):
    stored = _stored_ticks(spark, ticks, str(tmp_path / "t"))
    rows = lifecycle.retention_by_symbol(stored, "2024-01-15", "A", 10)
    assert sorted((r["symbol"], r["time"].day) for r in rows.collect() if r["time"].day <= 4) == [
        ("B", 1), ("B", 2), ("B", 3), ("B", 4)]
    days = lifecycle.retention_by_symbol(stored, "2024-01-15", "A", 10, chunk_semantics=True)
    assert min(r["time"].day for r in days.collect()) == 5


def test_tiers(spark):
    df = spark.createDataFrame(
        [(datetime(2024, 1, 1), c) for c in ("1m", "5m", "2h", "1M")] + [(datetime(2024, 2, 28), "1m")],
        "time timestamp, interval_duration string")
    kept = lifecycle.tiered_ohlc_retention(df, "2024-03-01")
    assert sorted((r[0].month, r[1]) for r in kept.collect()) == [(1, "1M"), (1, "2h"), (1, "5m"), (2, "1m")]
    assert lifecycle.tiered_ohlc_retention(df, "2024-03-01", chunk_semantics=True).count() == 1


def test_clean_table_rewrites_only_bad_days(spark, ticks, tmp_path):
    path = str(tmp_path / "t")
    _stored_ticks(spark, ticks, path)
    tables.append_days(ticks(("2024-01-20 10:00:00", "B", -1.0)), path)
    assert lifecycle.clean_ticks_table(spark, path, "2024-01-03", "2024-01-05 12:00") == "Cleaned 3 rows with invalid prices"
    left = spark.read.parquet(path)
    assert left.filter("price < 0").count() == 8
    assert lifecycle.clean_ticks_table(spark, path, "2024-01-01", "2024-02-01").startswith("Cleaned 8")
    assert date(2024, 1, 20) not in tables.stored_days(spark, path)
    assert spark.read.parquet(path).count() == 10


def test_run_retention(spark, ticks, tmp_path):
    ticks_path, bars_path = str(tmp_path / "t"), str(tmp_path / "b")
    _stored_ticks(spark, ticks, ticks_path)
    bars = spark.createDataFrame(
        [(datetime(2023, 11, 1), "1m", "S"), (datetime(2023, 11, 1), "1h", "S"), (datetime(2023, 12, 30), "1m", "S")],
        "time timestamp, interval_duration string, data_source string")
    tables.append_days(bars, bars_path)
    stored = spark.read.parquet(ticks_path).withColumn("data_source", F.lit("S"))
    fresh = str(tmp_path / "fresh")
    stored.write.partitionBy("day").parquet(fresh)
    sources = spark.createDataFrame(
        [("S", True, datetime(2022, 1, 1)), ("gone", True, datetime(2022, 1, 1)), ("new", True, datetime(2024, 1, 1))],
        "name string, is_active boolean, updated_at timestamp")
    log = spark.createDataFrame(
        [(f"v{i:02}", "x", datetime(2023, 1, 1 + i), None) for i in range(25)],
        "version string, description string, applied_at timestamp, applied_by string")
    new_sources, new_log = lifecycle.run_retention(
        spark, "2024-01-15", ticks_path=fresh, bars_path=bars_path, sources=sources, log=log, tick_days=10)
    assert tables.stored_days(spark, fresh) == [date(2024, 1, d) for d in range(5, 11)]
    assert sorted(r["interval_duration"] for r in spark.read.parquet(bars_path).collect()) == ["1h", "1m"]
    assert {r["name"]: r["is_active"] for r in new_sources.collect()} == {"S": True, "gone": False, "new": True}
    entries = {r["version"]: r["description"] for r in new_log.collect()}
    assert len(entries) == 21
    assert entries["retention_run_2024_01_15_00_00_00"] == "retention: 4 tick days dropped; 1 bars removed"


def test_compaction_and_report(spark, ticks, tmp_path):
    path = str(tmp_path / "t")
    for _ in range(3):
        _stored_ticks(spark, ticks, path)
    report = lifecycle.partition_report(spark.read.parquet(path), "2024-01-13", 7)
    advice = {r["day"].day: (r["row_count"], r["file_count"], r["recommendation"]) for r in report.collect()}
    assert advice[1] == (6, 3, "compact") and advice[9][2] == "keep"
    text = lifecycle.partition_findings(report, "price_ticks").first()[0]
    assert text.splitlines()[0] == "price_ticks 2024-01-01: compact" and len(text.splitlines()) == 5
    entry = lifecycle.maintenance_entry(report, "price_ticks", "2024-01-13").first()
    assert entry["version"] == "maintenance_2024_01_13_00_00_00" and entry["description"] == text
    assert len(lifecycle.compact_partitions(spark, path, ["symbol"], 7, "2024-01-13")) == 5
    after = lifecycle.partition_report(spark.read.parquet(path), "2024-01-13", 7)
    assert {r["day"].day: r["file_count"] for r in after.collect()}[1] == 1
    assert spark.read.parquet(path).count() == 60
    first = spark.read.parquet(f"{path}/day=2024-01-01").collect()
    assert [r["symbol"] for r in first] == ["A"] * 3 + ["B"] * 3
    assert lifecycle.partition_findings(after, "price_ticks").first()[0] == "nothing to do"


def test_compaction_leaves_few_sorted_files(spark, tmp_path):
    """Forty days of many files become one file each, and larger days as many as their bytes need."""
    path = str(tmp_path / "ticks")
    rows = spark.range(40_000).select(
        (F.lit("2024-01-01").cast("timestamp") + F.make_dt_interval(F.col("id") % 40, F.lit(0), F.lit(0), F.col("id") / 100)).alias("time"),
        F.when(F.col("id") % 3 == 0, "HOT").otherwise(F.concat(F.lit("S"), F.col("id") % 97)).alias("symbol"),
        F.rand(1).alias("price"),
    )
    rows = rows.cache()
    for part in range(3):
        tables.append_days(rows.filter(F.col("price") * 3 >= part).filter(F.col("price") * 3 < part + 1), path)
    target = max(tables.day_bytes(spark, path, tables.stored_days(spark, path)).values()) // 2 + 1
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    done = lifecycle.compact_partitions(spark, path, ["symbol"], 1, "2024-03-01", target)
    assert len(done) == 40
    report = lifecycle.partition_report(spark.read.parquet(path), "2024-03-01", 1, target).collect()
    assert {r["file_count"] for r in report} <= {1, 2, 3} and max(r["file_count"] for r in report) > 1
    lifecycle.compact_partitions(spark, path, ["symbol"], 1, "2024-03-01", target)
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    report = lifecycle.partition_report(spark.read.parquet(path), "2024-03-01", 1, target).collect()
    assert {r["recommendation"] for r in report} == {"keep"}
    assert sum(r["row_count"] for r in report) == 40_000
    stored = tables.read_days(spark, path)
    assert stored.select(*rows.columns).exceptAll(rows).isEmpty()
    lifecycle.compact_partitions(spark, path, ["symbol"], 1, "2024-03-01")
    report = lifecycle.partition_report(spark.read.parquet(path), "2024-03-01", 1).collect()
    assert {(r["file_count"], r["recommendation"]) for r in report} == {(1, "keep")}
    assert lifecycle.compact_partitions(spark, path, ["symbol"], 1, "2024-03-01") == []


def test_look_back_reads_older_history_only_for_missing_symbols(spark, ticks, tmp_path):
    path = str(tmp_path / "ticks")
    rows = [(f"2024-01-{d:02} {h:02}:15:00", s, float(h + i)) for d in (14, 15) for h in range(0, 24, 3) for i, s in enumerate("AB")]
    tables.append_days(ticks(*rows).withColumns({"exchange": F.lit("X"), "data_source": F.lit("S")}), path)
    old = tmp_path / "ticks" / "day=2023-06-01"
    old.mkdir()
    (old / "part-0.parquet").write_bytes(b"not a table")
    source = tables.load_ticks(spark, path)
    rollup = rollups.ROLLUPS["market_volatility_hourly"]
    out = rollups.compute_rollup(rollup, source, "2024-01-15 05:00", "2024-01-15 20:00")
    assert out.count() == 10  # would fail on the broken file of the older day
    lone = source.filter("symbol = 'A' OR time >= '2024-01-15 05:00'")
    with pytest.raises(Exception):
        rollups.compute_rollup(rollup, lone, "2024-01-15 05:00", "2024-01-15 20:00").collect()


def test_spans_follow_the_calendar():
    assert rollups.before("2024-03-31", "1 month") == datetime(2024, 2, 29)
    assert rollups.before("2025-03-01", "1 year") == datetime(2024, 3, 1)
    assert rollups.before("2024-02-29 06:00", "2 years") == datetime(2022, 2, 28, 6)
    assert rollups.before("2024-03-01 00:30", "1 hour") == datetime(2024, 2, 29, 23, 30)


def test_refresh_honours_what_a_rollup_is_defined_on(spark, ticks, tmp_path):
    rollup = dataclasses.replace(
        rollups.ROLLUPS["ticks_1day"], build=lambda t: rollups.ohlc_from_ticks(t, "1 day"), keep=rollups.parse_width("1 year"))
    source = ticks(("2024-02-29 12:00:00", "A", 1.0), ("2024-03-01 12:00:00", "A", 2.0))
    rollups.refresh_rollup(spark, rollup, source, str(tmp_path / "r"), "2024-02-01", "2024-04-01", "2025-03-01 10:00")
    assert [r["close"] for r in spark.read.parquet(str(tmp_path / "r")).collect()] == [2.0]


@pytest.mark.parametrize("bad", [
    {"symbol": None}, {"time": None}, {"price": float("nan")}, {"price": float("inf")}, {"volume": float("nan")},
    {"bid_price": float("inf")}, {"price": -1.0},
])
def test_ticks_that_break_a_rule_are_not_stored(spark, tmp_path, bad):
    good = {"time": datetime(2024, 1, 1), "symbol": "A", "price": 1.0, "volume": 1.0, "bid_price": 1.0, "ask_price": 1.0}
    schema = "time timestamp, symbol string, price double, volume double, bid_price double, ask_price double"
    rows = spark.createDataFrame([tuple(good.values()), tuple((good | bad).values())], schema)
    ingest.insert_ticks(rows, str(tmp_path / "t"))
    assert [r["price"] for r in spark.read.parquet(str(tmp_path / "t")).collect()] == [1.0]


def test_writes_refuse_what_they_would_lose(spark, records, tmp_path):
    path = str(tmp_path / "r")
    rows = records(("2024-01-01 00:00:00", "a", 1.0), ("2024-01-01 00:00:01", "bad id", 1.0), ("2024-01-01 00:00:02", "b", float("nan")))
    ingest.insert_records(rows, path)
    assert [r["entity_id"] for r in spark.read.parquet(path).collect()] == ["a"]
    with pytest.raises(ValueError):
        ingest.upsert_records(rows.withColumn("unit", F.lit("C")), path)
    with pytest.raises(Exception, match="key columns"):
        ingest.upsert_days(rows.withColumn("entity_id", F.lit(None).cast("string")), path, ingest.RECORD_KEY)
    assert spark.read.parquet(path).count() == 1


def test_a_day_column_of_ones_own_is_left_alone(spark, ticks, tmp_path):
    own = ticks(("2024-01-15 12:00:00", "A", 1.0)).withColumn("day", F.lit("2020-01-01").cast("date"))
    assert within(own, "2024-01-01", "2024-02-01").count() == 1
    assert within(own.withColumn("day", F.lit("Monday")), "2024-01-01", "2024-02-01").count() == 1
    tables.append_days(ticks(("2024-01-15 12:00:00", "A", 1.0)), str(tmp_path / "t"))
    plan = within(tables.read_days(spark, str(tmp_path / "t")), "2024-01-01")._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_a_named_symbol_without_ticks_has_its_four_counts(ticks):
    some = ticks(("2024-01-15 12:00:00", "A", 1.0))
    got = quality.validate_ticks(some, "2024-01-01", "2024-02-01", "ZZ").collect()
    assert sorted((r["symbol"], r["issue_count"]) for r in got) == [("ZZ", 0)] * 4


def test_batches_leave_nothing_behind(spark, tmp_path):
    raw = spark.createDataFrame([("2024-01-01 00:00:00", "a", "1", None, None, None, "{}")],
        "time string, entity_id string, value string, value2 string, value3 string, value4 string, metadata string")
    shared = Path(spark.conf.get("spark.checkpoint.dir").removeprefix("file:"))
    before = {p.name for p in shared.glob("batch-*")}
    assert ingest.insert_many(raw, str(tmp_path / "r")).processed == 1
    assert {p.name for p in shared.glob("batch-*")} == before
