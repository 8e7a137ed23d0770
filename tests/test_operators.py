"""Edge cases with results worked out by hand."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tidemark.operators import aggregates as agg
from tidemark.operators import gaps, indicators, latest, quality, reads, reports, risk

DAY = ("2024-01-15", "2024-01-16")


def one(df):
    return df.first().asDict(recursive=True)


@pytest.fixture
def sensor(records):
    return records(
        ("2024-01-15 10:00:00", "sensor_001", 23.5, 60.0),
        ("2024-01-15 10:01:00", "sensor_001", 23.7, 0.0),
        ("2024-01-15 10:02:00", "sensor_001", 23.4, None),
        ("2024-01-15 10:00:00", "server_web_01", 45.2, 70.0),
        ("2024-01-15 11:01:00", "server_web_01", 48.7, 72.0),
        ("2024-01-15 13:02:00", "server_web_01", 43.1, 71.0),
    )


def test_bucket_statistics(sensor):
    rows = {
        (r["entity_id"], r["bucket"].hour): r
        for r in agg.time_bucket_agg(sensor, "1 hour", *DAY).collect()
    }
    hour = rows["sensor_001", 10]
    assert (hour["count"], hour["min"], hour["max"]) == (3, 23.4, 23.7)
    assert (hour["first"], hour["last"]) == (23.5, 23.4)
    assert hour["avg"] == pytest.approx(70.6 / 3) and hour["stddev"] == pytest.approx(0.152752523)
    assert rows["server_web_01", 11]["stddev"] is None
    assert len(rows) == 4


def test_first_keeps_a_null_at_the_first_time(records):
    df = records(("2024-01-15 10:00", "e", 1.0, None), ("2024-01-15 10:01", "e", 2.0, 5.0))
    stats = one(agg.multi_value_agg(df, "1 day", *DAY))["value2_stats"]
    assert stats["first"] is None and stats["last"] == 5.0 and stats["avg"] == 5.0


def test_weights(records):
    df = records(
        ("2024-01-15 10:00", "a", 10.0, 1.0),
        ("2024-01-15 10:01", "a", 20.0, 3.0),
        ("2024-01-15 10:02", "a", 99.0, None),
        ("2024-01-15 10:00", "zero", 10.0, 0.0),
        ("2024-01-15 10:00", "none", 10.0, None),
    )
    rows = agg.weighted_average(df, "1 hour", *DAY).collect()
    assert [(r["entity_id"], r["weighted_avg"], r["total_weight"]) for r in rows] == [("a", 17.5, 4.0)]
    assert rows[0]["value_range"].asDict() == {"min": 10.0, "max": 20.0}


def test_delta_is_closed_and_guards_zero(records):
    df = records(
        ("2024-01-15 00:00:00", "a", 0.0),
        ("2024-01-16 00:00:00", "a", 5.0),
        ("2024-01-15 00:00:00", "b", 4.0),
        ("2024-01-15 23:00:00", "b", 5.0),
        ("2024-01-17 00:00:00", "c", 5.0),
    )
    found = {r["entity_id"]: r for r in agg.value_delta(df, *DAY).collect()}
    assert (found["a"]["delta"], found["a"]["percent_change"]) == (5.0, 0.0)
    assert found["b"]["percent_change"] == 25.0
    assert "c" not in found


def test_variability_is_zero_without_data(records, spark):
    df = records(("2024-01-15 10:00", "a", 1.0), ("2024-01-15 11:00", "a", 3.0), ("2024-01-15 10:00", "b", 1.0))
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    found = {r[0]: (r[1], r[2]) for r in agg.variability(df, 24, "2024-01-15 12:00", ids).collect()}
    assert found["a"] == (pytest.approx(2**0.5), 2) and found["b"] == (0.0, 1) and found["c"] == (0.0, 0)
    with pytest.raises(ValueError):
        agg.variability(df, 0, "2024-01-15")


def test_gap_fill_start_middle_end(records):
    df = records(
        ("2024-01-15 02:10", "a", 5.0),
        ("2024-01-15 02:50", "a", 7.0),
        ("2024-01-15 04:10", "a", 9.0),
        ("2024-01-16 09:00", "late", 1.0),
    )
    rows = gaps.gap_filled_agg(df, "1 hour", "2024-01-15 01:00", "2024-01-15 06:00", -1.0, order="asc")
    assert [(r["bucket"].hour, r["count"], r["avg"], r["last"]) for r in rows.collect()] == [
        (1, 0, -1.0, -1.0),
        (2, 2, 6.0, 7.0),
        (3, 0, 6.0, 7.0),
        (4, 1, 9.0, 9.0),
        (5, 0, 9.0, 9.0),
    ]
    monthly = gaps.gap_filled_agg(df, "1M", "2023-12-01", "2024-03-01", order="asc", ids="a").collect()
    assert [(r["bucket"].month, r["count"], r["avg"]) for r in monthly] == [
        (12, 0, None), (1, 3, 7.0), (2, 0, 7.0),
    ]


def test_histogram_of_equal_values(records):
    df = records(("2024-01-15 10:00", "a", 2.0), ("2024-01-15 11:00", "a", 2.0))
    row = one(agg.value_distribution(df, *DAY, 4))
    assert (row["bin"], row["count"], row["percentage"]) == (0, 2, 100.0)


def test_statistics_replace_null_with_zero(records):
    row = one(agg.statistics(records(("2024-01-15 10:00", "a", 2.0)), *DAY))
    assert (row["stddev"], row["variance"], row["count"]) == (0.0, 0.0, 1)


def test_named_aggregates(sensor):
    for fn, want in {"first": 23.5, "last": 23.4, "count": 3, "sum": 70.6}.items():
        got = agg.aggregate(sensor, fn, "value", *DAY, ids="sensor_001").first()["result"]
        assert got == pytest.approx(want)
    with pytest.raises(ValueError):
        agg.aggregate(sensor, "mode", "value")
    with pytest.raises(ValueError):
        agg.aggregate(sensor, "avg", "price")


def test_reads_are_half_open_and_paged(sensor):
    got = reads.get_records(sensor, "2024-01-15 10:00", "2024-01-15 10:02", "sensor_001", order="asc")
    assert [r["value"] for r in got.collect()] == [23.5, 23.7]
    assert "metadata" not in got.columns
    page = reads.get_records(sensor, *DAY, "sensor_001", limit=1, offset=1).collect()
    assert [r["value"] for r in page] == [23.7]
    assert reads.get_multi_entity_records(sensor, [], *DAY).count() == 0
    with pytest.raises(ValueError):
        reads.get_records(sensor, *DAY, order="up")


def test_batches_cover_the_whole_range(sensor):
    batches = list(reads.get_records_batches(sensor, *DAY, batch_size=4))
    assert [len(b) for b in batches] == [4, 2]
    times = [r["time"] for b in batches for r in b]
    assert times == sorted(times, reverse=True)


def test_alerts_keep_zero_and_skip_null(records):
    df = records(
        ("2024-01-15 10:00", "hot", 41.0, 50.0),
        ("2024-01-15 10:00", "dry", 20.0, 0.0),
        ("2024-01-15 10:00", "unknown", 20.0, None),
        ("2024-01-15 10:00", "edge", 40.0, 95.0),
    )
    found = {r["entity_id"]: (r["value_alert"], r["value2_alert"])
             for r in reads.threshold_alerts(df, reads.CLIMATE_LIMITS).collect()}
    assert found == {"hot": (True, False), "dry": (False, True)}


def test_latest(sensor, spark):
    ids = spark.createDataFrame([("sensor_001",), ("ghost",)], "entity_id string")
    full = {r["entity_id"]: r["value"] for r in latest.multi_entity_latest_map(sensor, ids).collect()}
    assert full == {"sensor_001": 23.4, "ghost": None}
    assert latest.multi_entity_latest(sensor, ids).count() == 1
    assert tuple(latest.latest_coverage(sensor, ids).first()) == (2, 1)
    assert latest.latest_value(sensor, "server_web_01").first()["value"] == 43.1
    assert one(latest.latest_record(sensor, "sensor_001"))["metadata"] == "{}"


def test_keep_newest(spark):
    log = spark.createDataFrame([(f"v{i:02}", datetime(2024, 1, 1 + i)) for i in range(25)],
                                "version string, applied_at timestamp")
    kept, removed = latest.keep_newest(log, 20, "version")
    assert kept.count() == 20 and sorted(r[0] for r in removed.collect()) == [f"v0{i}" for i in range(5)]


def test_rsi_extremes(ticks):
    rising = [(f"2024-01-15 10:{i:02}:00", "UP", 10.0 + i) for i in range(20)]
    df = ticks(*rising, ("2024-01-15 10:00:00", "ONE", 5.0),
               *[(f"2024-01-15 10:0{i}:00", "DOWN", 9.0 - i) for i in range(4)])
    found = {r["symbol"]: r["rsi"] for r in indicators.rsi(df, "2024-01-16").collect()}
    assert found == {"UP": 100.0, "ONE": None, "DOWN": 0.0}
    signals = {r["symbol"]: r["signal"] for r in indicators.rsi_signal(df, "2024-01-16").collect()}
    assert signals == {"UP": "overbought", "ONE": None, "DOWN": "oversold"}


def test_bollinger_positions(ticks):
    df = ticks(("2024-01-15 10:00", "FLAT", 5.0), ("2024-01-15 10:01", "FLAT", 5.0),
               ("2024-01-15 10:00", "ONE", 5.0), ("2024-01-15 10:00", "UP", 1.0), ("2024-01-15 10:01", "UP", 3.0))
    found = {r["symbol"]: r for r in indicators.bollinger(df, "2024-01-16").collect()}
    assert found["FLAT"]["price_position"] == 0.5 and found["FLAT"]["upper_band"] == 5.0
    assert found["ONE"]["price_position"] == 0.5 and found["ONE"]["upper_band"] is None
    assert found["UP"]["price_position"] == pytest.approx((1 + 2 * 2**0.5) / (4 * 2**0.5))


def test_ema_equals_the_recursion(ticks):
    prices = [10.0, 12.0, 11.0, 15.0, 14.0]
    df = ticks(*[(f"2024-01-15 10:0{i}:00", "A", p) for i, p in enumerate(prices)])

    def fold(series, period):
        value, k = sum(series) / len(series), 2 / (period + 1)
        for p in series:
            value = p * k + value * (1 - k)
        return value

    newest = indicators.ema(df, 4, "2024-01-16").first()["ema"]
    assert newest == pytest.approx(fold(prices[1:][::-1], 4))
    usual = indicators.ema(df, 9, "2024-01-16", oldest_first=True).first()["ema"]
    assert usual == pytest.approx(fold(prices, 9))
    assert indicators.sma(df, 3, "2024-01-15 10:03:00").first()["sma"] == pytest.approx(38 / 3)


def test_obv_and_vwap_with_missing_volume(ticks):
    df = ticks(("2024-01-15 10:00", "A", 1.0, 100.0), ("2024-01-15 10:01", "A", 2.0, 10.0),
               ("2024-01-15 10:02", "A", 2.0, 7.0), ("2024-01-15 10:03", "A", 1.0, 3.0),
               ("2024-01-15 10:04", "A", 5.0, None))
    assert indicators.obv(df, "2024-01-16").first()["obv"] == 7.0
    assert indicators.vwap(df, *DAY).first()["vwap"] == pytest.approx((100 + 20 + 14 + 3) / 120)


def test_risk_by_hand(ticks):
    df = ticks(*[(f"2024-01-1{d} {h}:00", "A", p) for d, h, p in
                 [(1, 10, 100.0), (1, 16, 110.0), (2, 10, 110.0), (2, 16, 99.0), (3, 16, 105.0)]])
    vol = risk.volatility(df, "2024-01-15").first()["volatility"]
    import math, statistics
    want = statistics.stdev([math.log(99 / 110), math.log(105 / 99)]) * math.sqrt(252)
    assert vol == pytest.approx(want)
    assert risk.value_at_risk(df, "2024-01-15", 0.5).first()["value_at_risk"] == pytest.approx(0.0)


def test_support_and_resistance(ticks):
    df = ticks(*[(f"2024-01-15 10:0{i}", "A", 10.001) for i in range(3)],
               *[(f"2024-01-15 11:0{i}", "A", 12.0) for i in range(4)], ("2024-01-15 12:00", "A", 11.0))
    found = [(r["price_level"], r["level_type"], r["touch_count"], r["strength"])
             for r in indicators.support_resistance(df, "2024-01-16").orderBy("price_level").collect()]
    assert found == [(10.0, "support", 3, 0.3), (12.0, "resistance", 4, 0.4)]


def test_correlation_of_identical_series(ticks):
    rows = [(f"2024-01-1{d} {h}:00", s, p * f) for s, f in (("A", 1), ("B", 3))
            for d, h, p in [(1, 10, 10.0), (1, 11, 12.0), (2, 10, 12.0), (2, 11, 9.0), (3, 10, 9.0), (3, 11, 9.5)]]
    assert risk.correlate_symbols(ticks(*rows), "A", "B", "2024-01-15").first()["correlation"] == pytest.approx(1)


def test_interpolation(records):
    df = records(("2024-01-15 10:00:00", "a", 0.0, 10.0), ("2024-01-15 10:10:00", "a", 10.0, None),
                 ("2024-01-15 10:12:00", "a", 11.0, None))
    rows = gaps.fill_interpolate(df, 240, 300).orderBy("time").collect()
    assert [(r["time"].minute, r["value"], r["value2"], r["interpolated"]) for r in rows] == [
        (0, 0.0, 10.0, False), (4, 4.0, None, True), (8, 8.0, None, True), (10, 10.0, None, False), (12, 11.0, None, False),
    ]


def test_completeness_and_staleness(records, spark):
    df = records(*[(f"2024-01-15 10:0{i}:00", "a", 1.0) for i in range(9)], ("2024-01-15 09:00:00", "b", 1.0))
    ids = spark.createDataFrame([("a",), ("b",), ("c",)], "entity_id string")
    found = {r[0]: (r[1], r[3]) for r in
             gaps.completeness(df, ids, "2024-01-15 10:00", "2024-01-15 11:00", 10).collect()}
    assert found == {"a": (9, False), "b": (0, True), "c": (0, True)}
    assert [r[0] for r in gaps.stale_entities(df, 10, "2024-01-15 10:10").collect()] == ["b"]


def test_health_and_profile(sensor):
    found = {r[0]: r["is_healthy"] for r in reports.server_health(sensor, *DAY).collect()}
    assert found == {"sensor_001": True, "server_web_01": True}
    tight = reports.server_health(sensor, *DAY, max_memory=50)
    assert {r[0]: r["is_healthy"] for r in tight.collect()}["server_web_01"] is False
    assert tuple(reports.table_profile(sensor).first()) == ("row_count", "6", "Normal table size")


def test_validation_reasons(spark):
    good = ("2024-01-15T10:00:00Z", "sensor-1.a_B", "1.5", None, None, None, "{}")
    cases = {
        None: good,
        "entity_id is missing": (good[0], "", *good[2:]),
        "entity_id is too long": (good[0], "x" * 101, *good[2:]),
        "entity_id has illegal characters": (good[0], "sensor 1", *good[2:]),
        "time is missing or unreadable": ("not-a-date", *good[1:]),
        "value is missing": (*good[:2], None, *good[3:]),
        "value is not a number": (*good[:2], "abc", *good[3:]),
        "value is not finite": (*good[:2], "NaN", *good[3:]),
        "value2 is not finite": (*good[:3], "-Infinity", *good[4:]),
        "metadata is not an object": (*good[:6], "[1]"),
    }
    schema = ("time string, entity_id string, value string, value2 string, value3 string, "
              "value4 string, metadata string")
    for reason, row in cases.items():
        judged = quality.with_record_reason(spark.createDataFrame([row], schema))
        assert judged.first()[quality.REASON] == reason
    edge = [(good[0], "x" * 100, *good[2:]), (good[0], "trailing\n", *good[2:])]
    kept, refused = quality.split_valid(spark.createDataFrame(edge, schema))
    assert kept.count() == 1 and refused.first()[quality.REASON] == "entity_id has illegal characters"


def test_finite_check_and_zero(records):
    df = records(("2024-01-15 10:00", "a", float("nan")), ("2024-01-15 10:01", "a", float("inf")),
                 ("2024-01-15 10:02", "a", 0.0, 0.0))
    assert [r["is_valid"] for r in quality.check_finite(df).orderBy("time").collect()] == [False, False, True]


def test_tick_and_bar_rules(spark):
    ticks = spark.createDataFrame(
        [(1.0, None, None, None), (0.0, None, None, None), (1.0, -1.0, None, None), (1.0, 0.0, 2.0, 1.0),
         (1.0, 0.0, 1.0, 2.0)], "price double, volume double, bid_price double, ask_price double")
    assert [r["is_valid"] for r in quality.check_ticks(ticks).collect()] == [True, False, False, False, True]
    bars = spark.createDataFrame(
        [(1.0, 3.0, 0.5, 2.0, "1h"), (1.0, 1.5, 0.5, 2.0, "1h"), (1.0, 3.0, 0.5, 2.0, "3h"), (0.0, 3.0, 0.0, 2.0, "1h")],
        "open double, high double, low double, close double, interval_duration string")
    bars = bars.withColumn("volume", F.lit(None).cast("double"))
    assert [r["is_valid"] for r in quality.check_ohlc(bars).collect()] == [True, False, False, False]
    derived = quality.derive_ohlc_columns(bars).collect()
    assert derived[0]["price_change_percent"] == 100.0 and derived[3]["price_change_percent"] is None


def test_cleaning_and_repair(spark):
    raw = spark.createDataFrame(
        [("2024-01-15 10:00:00", "Sensor-01!", "x", "0", "3", None, None)],
        "time string, entity_id string, value string, value2 string, value3 string, value4 string, metadata string")
    row = one(quality.clean_records(raw))
    assert (row["entity_id"], row["value"], row["value2"], row["value3"], row["metadata"]) == (
        "sensor01", 0.0, None, 3.0, "{}")
    tick = spark.createDataFrame([("bad", "btc-usd", "-5")], "time string, symbol string, price string")
    row = one(quality.repair_ticks(tick, "2024-01-31"))
    assert (row["time"], row["symbol"], row["price"]) == (datetime(2024, 1, 31), "BTCUSD", 5.0)


def test_duplicate_issue_counts(ticks):
    df = ticks(("2024-01-15 10:00", "A", 10.0, 1.0), ("2024-01-15 10:00", "A", 10.0), ("2024-01-15 10:00", "A", 10.0),
               ("2024-01-15 10:01", "A", 12.0), ("2024-01-15 10:02", "A", 0.0, 1.0), ("2024-01-15 10:03", "A", 5.0, 1.0))
    found = {r["issue_type"]: r["issue_count"] for r in quality.validate_ticks(df, *DAY).collect()}
    assert found == {"duplicate_timestamps": 1, "large_price_gaps": 3, "missing_volume": 3, "invalid_prices": 1}


def test_top_changes_skip_zero_starts(records):
    df = records(("2024-01-15 10:00", "a", 0.0), ("2024-01-15 11:00", "a", 9.0), ("2024-01-15 10:00", "b", 10.0),
                 ("2024-01-15 11:00", "b", 5.0), ("2024-01-15 10:00", "c", 10.0), ("2024-01-15 11:00", "c", 11.0))
    assert [r["entity_id"] for r in latest.top_changes(df, 5, 24, "2024-01-15 12:00").collect()] == ["b", "c"]


def test_indicators_of_one_symbol_look_back_as_far_as_they_must(ticks):
    rows = [(f"2023-{m:02}-01 00:00:00", "OLD", float(m)) for m in range(1, 13)]
    rows += [(f"2024-01-{d:02} 00:00:00", "NEW", float(d)) for d in range(1, 29)]
    some = ticks(*rows)
    for symbol in ("OLD", "NEW", "NONE"):
        for count in (3, 11, 40):
            one = indicators.sma(some, count, "2024-01-28", symbol).collect()
            every = [r for r in indicators.sma(some, count, "2024-01-28").collect() if r["symbol"] == symbol]
            assert one == every


def test_batches_are_numbered_and_pages_cut_by_time(records):
    rows = records(*[(f"2024-01-15 {k // 60:02d}:{k % 60:02d}:{k * 7 % 60:02d}", f"e{k % 5}", float(k)) for k in range(300)])
    rows = rows.union(rows.limit(40)).repartition(3)
    whole = [tuple(r) for r in rows.orderBy(F.desc("time"), "entity_id", "value").collect()]
    numbered = reads.numbered_records(rows, *DAY, batch_size=7).collect()
    assert sorted(r["batch"] for r in numbered) == [k // 7 for k in range(340)]
    by_batch = {}
    for r in numbered:
        by_batch.setdefault(r["batch"], set()).add((r["time"], r["entity_id"]))
    assert by_batch[3] == {(r[0], r[1]) for r in whole[21:28]}
    for offset, limit in ((0, 5), (100, 33), (333, 50), (340, 5), (900, 1), (10, 0)):
        page = reads.records_page(rows, *DAY, offset, limit).collect()
        assert [(r["time"], r["entity_id"]) for r in page] == [(r[0], r[1]) for r in whole[offset : offset + limit]]
    with pytest.raises(ValueError):
        reads.records_page(rows, *DAY, -1, 5)


def test_values_that_are_missing_are_in_no_bin(records):
    rows = records(("2024-01-15 10:00", "a", 5.0), ("2024-01-15 11:00", "a", 10.0), ("2024-01-15 12:00", "a", None), ("2024-01-15 13:00", "b", None))
    got = {(r["entity_id"], r["bin"]): (r["count"], r["percentage"]) for r in agg.value_distribution(rows, *DAY, 2).collect()}
    assert got == {("a", 0): (1, 50.0), ("a", 1): (1, 50.0)}
