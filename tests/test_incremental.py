"""The ledger, refresh by change and reads with the fresh tail."""

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import incremental, rollups
from tidemark.plans.incremental import read_fresh, read_mark, refresh_changed
from tidemark.plans.rollups import ROLLUPS
from tidemark.sources import ingest, ledger, tables

HOURLY, MOVES = ROLLUPS["ticks_1hour"], ROLLUPS["market_volatility_hourly"]
BASE = datetime(2024, 1, 1)


def hours(*pairs):
    return [(BASE + timedelta(hours=a), BASE + timedelta(hours=b)) for a, b in pairs]


@pytest.fixture
def stock(ticks):
    """Ticks of three symbols, one every twenty minutes, over four days."""

    def build(low=0, high=288, price=1.0):
        rows = [
            (str(BASE + timedelta(minutes=20 * k)), "ABC"[k % 3], price + (k * 7 % 11) / 4, None if k % 5 == 0 else k % 4 + 1.0)
            for k in range(low, high)
        ]
        return ticks(*rows).withColumns({"exchange": F.lit("X"), "data_source": F.lit("S"), "bid_price": F.lit(1.0), "ask_price": F.lit(2.0)})

    return build


def shown(df):
    return sorted(str([round(v, 9) if isinstance(v, float) else v for v in r]) for r in df.select(*sorted(df.columns)).collect())


def test_spans_are_joined_widened_and_clipped():
    assert ledger.joined(hours((5, 6), (0, 1), (1, 2), (5, 5))) == hours((0, 2), (5, 6))
    assert ledger.joined(hours((0, 1), (3, 4), (5, 6), (20, 21)), 2) == hours((0, 6), (20, 21))
    assert ledger.widened(hours((1, 2), (23, 25)), "1 day") == hours((0, 48))
    assert ledger.clipped(hours((0, 5), (8, 9)), BASE + timedelta(hours=4), "2024-01-01 08:30:00")[0] == hours((4, 5))[0]
    assert len(ledger.days_in(hours((0, 24)))) == 1 and len(ledger.days_in(hours((23, 25)))) == 2


def test_writes_note_what_they_change(spark, stock, tmp_path):
    path = str(tmp_path / "ticks")
    tables.append_days(stock(0, 9), path)
    assert not ledger.has_ledger(spark, path) and ledger.changes(spark, path).spans == []
    ledger.keep_ledger(spark, path)
    tables.append_days(stock(9, 12), path)
    ingest.upsert_days(stock(30, 31, 5.0), path, ingest.TICK_KEY)
    seen = ledger.changes(spark, path)
    assert seen.spans == hours((3, 4), (10, 11)) and seen.upto == 4
    assert ledger.changes(spark, path, seen.upto) == ledger.Changes([], 4)
    ledger.forget_changes(spark, path, 4)
    tables.append_days(stock(60, 61), path)
    assert ledger.changes(spark, path, 4).spans == hours((20, 21))


def test_a_note_that_was_never_closed_keeps_counting(spark, tmp_path):
    path = str(tmp_path / "t")
    ledger.keep_ledger(spark, path)
    with pytest.raises(RuntimeError), ledger.noted(spark, path, hours((1, 2))):
        raise RuntimeError("lost")
    with ledger.noted(spark, path, hours((5, 6))):
        pass
    seen = ledger.changes(spark, path)
    assert seen.spans == hours((1, 2), (5, 6)) and seen.upto == 0
    assert ledger.changes(spark, path, seen.upto).spans == seen.spans


@pytest.mark.parametrize("rollup", [HOURLY, MOVES, ROLLUPS["ticks_1day"]], ids=lambda r: r.name)
def test_reads_equal_the_rollup_of_all_rows_at_any_moment(spark, stock, tmp_path, rollup):
    table, path = str(tmp_path / "ticks"), str(tmp_path / "rollup")
    ledger.keep_ledger(spark, table)

    def agree():
        whole = rollup.build(tables.read_days(spark, table).drop("day"))
        assert shown(read_fresh(spark, rollup, table, path, "2023-12-31", "2024-02-01")) == shown(whole)
        part = whole.filter("bucket >= '2024-01-02 05:00:00' AND bucket < '2024-01-03 07:30:00'")
        assert shown(read_fresh(spark, rollup, table, path, "2024-01-02 05:00:00", "2024-01-03 07:30:00")) == shown(part)

    tables.append_days(stock(0, 200), table)
    agree()
    refresh_changed(spark, rollup, table, path)
    agree()
    tables.append_days(stock(200, 230), table)  # newer rows
    ingest.upsert_days(stock(100, 102, 9.0), table, ingest.TICK_KEY)  # changed and late ones
    agree()
    refresh_changed(spark, rollup, table, path, end="2024-01-03 12:10:00")
    agree()
    assert refresh_changed(spark, rollup, table, path) != []
    agree()
    assert shown(tables.read_days(spark, path).drop("day")) == shown(rollup.build(tables.read_days(spark, table).drop("day")))


def test_a_refresh_reads_what_changed_and_nothing_when_idle(spark, stock, tmp_path, monkeypatch):
    table, path = str(tmp_path / "ticks"), str(tmp_path / "rollup")
    ledger.keep_ledger(spark, table)
    tables.append_days(stock(), table)
    assert refresh_changed(spark, HOURLY, table, path) == hours((0, 96))
    assert refresh_changed(spark, HOURLY, table, path) == []
    ingest.upsert_days(stock(100, 101, 9.0), table, ingest.TICK_KEY)
    read = []
    plain = incremental.rolled
    monkeypatch.setattr(incremental, "rolled", lambda r, s, spans: read.append(incremental.among(s, spans)) or plain(r, s, spans))
    assert refresh_changed(spark, HOURLY, table, path) == hours((33, 34))
    assert len(read) == 1 and {f.split("/")[-2] for f in read[0].select(F.input_file_name()).toPandas().iloc[:, 0]} == {"day=2024-01-02"}
    scan = read[0]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in scan and "2024-01-02" in scan
    assert refresh_changed(spark, HOURLY, table, path) == [] and len(read) == 1


def test_a_read_scans_raw_rows_of_the_tail_only(spark, stock, tmp_path):
    table, path = str(tmp_path / "ticks"), str(tmp_path / "rollup")
    ledger.keep_ledger(spark, table)
    tables.append_days(stock(0, 216), table)
    refresh_changed(spark, HOURLY, table, path)
    tables.append_days(stock(216, 288), table)
    files = read_fresh(spark, HOURLY, table, path, "2024-01-01", "2024-02-01").inputFiles()
    metrics = [f for f in files if f"{table}/" in f]
    assert metrics  # the listing names the table; the plan's filters cut it to the new day
    plan = read_fresh(spark, HOURLY, table, path, "2024-01-01", "2024-02-01")._jdf.queryExecution().optimizedPlan().toString()
    assert "2024-01-04" in plan


def test_buckets_whose_rows_are_gone_go(spark, stock, tmp_path):
    table, path = str(tmp_path / "ticks"), str(tmp_path / "rollup")
    ledger.keep_ledger(spark, table)
    tables.append_days(stock(), table)
    refresh_changed(spark, HOURLY, table, path)
    with ledger.noted(spark, table, hours((24, 48))):
        tables.drop_days(spark, table, [datetime(2024, 1, 2).date()])
    refresh_changed(spark, HOURLY, table, path)
    assert [str(d) for d in tables.stored_days(spark, path)] == ["2024-01-01", "2024-01-03", "2024-01-04"]
    mark = read_mark(spark, path)
    assert mark.water == BASE + timedelta(hours=96) and mark.left == []


def test_an_empty_table_and_a_table_without_a_ledger(spark, stock, tmp_path):
    table, path = str(tmp_path / "ticks"), str(tmp_path / "rollup")
    tables.append_days(stock(0, 60), table)
    refresh_changed(spark, HOURLY, table, path)
    tables.append_days(stock(60, 90), table)  # nothing is noted, but the rows lie above the mark
    whole = rollups.ticks_1hour(tables.read_days(spark, table).drop("day"))
    assert shown(read_fresh(spark, HOURLY, table, path, "2024-01-01", "2024-02-01")) == shown(whole)
    none = str(tmp_path / "none")
    tables.read_days(spark, table).limit(0).drop("day").write.parquet(none)
    assert refresh_changed(spark, HOURLY, none, str(tmp_path / "empty")) == []
    assert read_fresh(spark, HOURLY, none, str(tmp_path / "empty"), "2024-01-01", "2024-02-01").count() == 0
