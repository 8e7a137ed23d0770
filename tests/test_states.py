"""Tick bars by merged states equal the direct ones, and a refresh reads what changed."""

import math
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans import rollups, states
from tidemark.sources import ledger, tables

BASE = datetime(2024, 1, 1)


@pytest.fixture
def stock(spark):
    """Ticks with nulls in every column, equal prices, and prices far from zero."""

    def build(low=0, high=900):
        rows = []
        for k in range(low, high):
            price = None if k % 17 == 0 else 1e6 + (k * 7 % 13) / 8
            rows.append(
                (
                    BASE + timedelta(seconds=97 * k),
                    "AB"[k % 2] if k % 41 else None,
                    price,
                    None if k % 5 == 0 else float(k % 4),
                    None if k % 11 == 0 else f"X{k % 3}",
                    "S",
                    None if k % 7 == 0 else 1.0,
                    1.5 + k % 3,
                )
            )
        schema = "time timestamp, symbol string, price double, volume double, exchange string, data_source string, bid_price double, ask_price double"
        return spark.createDataFrame(rows, schema)

    return build


def rows_of(df, keys):
    return {tuple(str(r[k]) for k in keys): r.asDict() for r in df.collect()}


def equal(got, expected):
    keys = [k for k in ("bucket", "symbol", "exchange", "data_source") if k in expected.columns]
    assert sorted(got.columns) == sorted(expected.columns)
    got, expected = rows_of(got, keys), rows_of(expected, keys)
    assert got.keys() == expected.keys()
    for key, row in expected.items():
        for name, value in row.items():
            if isinstance(value, float):
                assert math.isclose(got[key][name], value, rel_tol=1e-9, abs_tol=1e-6), (key, name)
            else:
                assert got[key][name] == value, (key, name)


@pytest.fixture
def stored(spark, stock, tmp_path):
    table, root = str(tmp_path / "ticks"), str(tmp_path / "states")
    ledger.keep_ledger(spark, table)
    tables.append_days(stock(0, 500), table)
    states.refresh_states(spark, table, root)
    tables.append_days(stock(500, 900), table)
    done = states.refresh_states(spark, table, root)
    return table, root, done


def test_every_view_equals_the_direct_rollup(spark, stock, stored):
    _, root, _ = stored
    for name in states.VIEWS:
        direct = rollups.ROLLUPS[name].build(stock())
        equal(states.read_view(spark, root, name, "2024-01-01", "2024-01-03"), direct)


def test_a_refresh_takes_the_changed_hours_through_all_levels(spark, stock, stored, monkeypatch):
    table, root, done = stored
    first = BASE + timedelta(seconds=97 * 500)
    assert done["1 minute"][0][0] == first.replace(minute=0, second=0)
    assert set(done) == set(states.LEVELS) and done["1 day"][0][0] == BASE
    assert states.refresh_states(spark, table, root) == {}
    read = []
    plain = states.minute_states
    monkeypatch.setattr(states, "minute_states", lambda raw: read.append(raw.agg(F.min("time"), F.max("time")).first()) or plain(raw))
    tables.append_days(stock(200, 201), table)  # a repeated row is one more row
    states.refresh_states(spark, table, root)
    hour = (BASE + timedelta(seconds=97 * 200)).replace(minute=0, second=0)
    assert len(read) == 1 and hour <= read[0][0] and read[0][1] < hour + timedelta(hours=1)
    equal(
        states.read_view(spark, root, "ticks_1day", "2024-01-01", "2024-01-03"),
        rollups.ticks_1day(tables.read_days(spark, table).drop("day")),
    )


def test_merging_in_any_steps_gives_the_same(spark, stock):
    fine = states.minute_states(stock())
    direct = states.bars(states.merged_states(fine, "1 day")).select("bucket", *states.KEYS, "avg_price", "price_volatility", "vwap")
    steps = fine
    for width in states.LEVELS[1:]:
        steps = states.merged_states(steps, width)
    equal(states.bars(steps).select(*direct.columns), direct)


def test_nothing_stored_and_empty_tables(spark, stock, tmp_path):
    root = str(tmp_path / "s")
    with pytest.raises(ValueError, match="no states"):
        states.read_view(spark, root, "ticks_1min", "2024-01-01", "2024-01-02")
    none = str(tmp_path / "none")
    stock(0, 1).limit(0).write.parquet(none)
    assert states.refresh_states(spark, none, root) == {}
    assert states.minute_states(stock().limit(0)).count() == 0
