"""Rollups, their refresh and reads of stored rollups."""

from pyspark.sql import functions as F

from registry.core import AS_OF, END, SQL, START, query
from tidemark.functions.buckets import whole_buckets
from tidemark.plans import incremental, rollups, states
from tidemark.session import scratch_path
from tidemark.sources import ledger, tables

_BARS = """arg_min_null(price, time) AS open, max(price) AS high, min(price) AS low,
    arg_max_null(price, time) AS close, sum(volume) AS volume, count(*) AS tick_count,
    avg(price) AS avg_price, stddev_samp(price) AS price_volatility"""
_BAR_NUMBERS = "open high low close volume avg_price price_volatility"
_VWAP = "sum(price * coalesce(volume, 1)) / sum(coalesce(volume, 1)) AS vwap"
_CHANGE = """arg_max(price, time) - arg_min(price, time) AS price_change,
    (arg_max(price, time) - arg_min(price, time)) / nullif(arg_min(price, time), 0) * 100
        AS price_change_percent"""
_CHANGE_NUMBERS = "vwap price_change price_change_percent"


def _ticks(interval: str, extra: str, where: str = "TRUE") -> str:
    return f"""SELECT time_bucket(INTERVAL '{interval}', time) AS bucket, symbol, exchange,
        data_source, {_BARS}{extra} FROM price_ticks WHERE {where}
        GROUP BY bucket, symbol, exchange, data_source"""


_SPREAD = ", avg(ask_price - bid_price) AS avg_spread"


@query("ticks_1min", _ticks("1 minute", _SPREAD), f"{_BAR_NUMBERS} avg_spread")
def _(t):
    return rollups.ticks_1min(t.price_ticks)


@query(
    "ticks_5min",
    _ticks("5 minutes", ", quantile_cont(price, 0.5) AS median_price"),
    f"{_BAR_NUMBERS} median_price",
)
def _(t):
    return rollups.ticks_5min(t.price_ticks)


@query("ticks_15min", _ticks("15 minutes", f", {_VWAP}"), f"{_BAR_NUMBERS} vwap")
def _(t):
    return rollups.ticks_15min(t.price_ticks)


_HOUR = _ticks("1 hour", f", {_VWAP}, {_CHANGE}")


@query("ticks_1hour", _HOUR, f"{_BAR_NUMBERS} {_CHANGE_NUMBERS}")
def _(t):
    return rollups.ticks_1hour(t.price_ticks)


@query(
    "ticks_4hour",
    _ticks("4 hours", f", {_VWAP}, {_CHANGE}, count(*) / 14400 AS ticks_per_second"),
    f"{_BAR_NUMBERS} {_CHANGE_NUMBERS} ticks_per_second",
)
def _(t):
    return rollups.ticks_4hour(t.price_ticks)


@query(
    "ticks_1day",
    _ticks(
        "1 day",
        f""", {_VWAP}, {_CHANGE},
        (max(price) - min(price)) / nullif(min(price), 0) * 100 AS daily_range_percent,
        count(*) / 86400 AS avg_ticks_per_second""",
    ),
    f"{_BAR_NUMBERS} {_CHANGE_NUMBERS} daily_range_percent avg_ticks_per_second",
)
def _(t):
    return rollups.ticks_1day(t.price_ticks)


def _summary(interval: str, order: str, where: str) -> str:
    return f"""SELECT time_bucket(INTERVAL '{interval}', time) AS bucket, symbol, data_source,
        arg_min(open, {order}) AS open, max(high) AS high, min(low) AS low,
        arg_max(close, {order}) AS close, sum(volume) AS volume, count(*) AS interval_count,
        avg(price_change_percent) AS avg_price_change_percent,
        stddev_samp(price_change_percent) AS volatility
    FROM ohlc_data WHERE {where} GROUP BY bucket, symbol, data_source"""


_SUMMARY_NUMBERS = "open high low close volume avg_price_change_percent volatility"
_RANK = """CASE interval_duration WHEN '1m' THEN 1 WHEN '5m' THEN 2 WHEN '15m' THEN 3
    WHEN '30m' THEN 4 {more} END"""
_MORE_RANKS = "WHEN '1h' THEN 5 WHEN '4h' THEN 6 ELSE 7"
_LENGTH = """CASE interval_duration WHEN '15m' THEN 1 WHEN '30m' THEN 2 WHEN '1h' THEN 3
    WHEN '4h' THEN 4 ELSE 5 END"""


def _since(years: int) -> str:
    return f"time >= CAST(TIMESTAMP '{AS_OF}' AS DATE) - INTERVAL {years} YEAR"


@query(
    "ohlc_summary_1hour",
    _summary("1 hour", f"({_RANK.format(more='ELSE 5')}, time, {_LENGTH})", _since(1)),
    _SUMMARY_NUMBERS,
)
def _(t):
    return rollups.rollup_all(rollups.ROLLUPS["ohlc_summary_1hour"], t.ohlc_data, AS_OF)


@query(
    "ohlc_summary_1day",
    _summary(
        "1 day",
        f"({_RANK.format(more=_MORE_RANKS)}, time, {_LENGTH})",
        _since(2),
    ),
    _SUMMARY_NUMBERS,
)
def _(t):
    return rollups.rollup_all(rollups.ROLLUPS["ohlc_summary_1day"], t.ohlc_data, AS_OF)


@query(
    "ohlc_summary_1week",
    _summary("7 days", f"(time, {_LENGTH})", "interval_duration IN ('1d', '4h', '1h')"),
    _SUMMARY_NUMBERS,
)
def _(t):
    return rollups.ohlc_summary_1week(t.ohlc_data)


@query(
    "symbol_daily_stats",
    """SELECT time_bucket(INTERVAL '1 day', time) AS bucket, symbol, count(*) AS total_ticks,
           avg(price) AS avg_price, stddev_samp(price) AS price_volatility,
           min(price) AS min_price, max(price) AS max_price,
           sum(coalesce(volume, 0)) AS total_volume,
           (max(price) - min(price)) / nullif(min(price), 0) * 100 AS daily_range_percent,
           arg_min(price, time) AS open_price, arg_max(price, time) AS close_price,
           (arg_max(price, time) - arg_min(price, time)) / nullif(arg_min(price, time), 0) * 100
               AS daily_return_percent,
           count(*) / 86400 AS avg_ticks_per_second,
           count(DISTINCT exchange) AS exchange_count,
           count(DISTINCT data_source) AS data_source_count
    FROM price_ticks GROUP BY bucket, symbol""",
    "avg_price price_volatility min_price max_price total_volume daily_range_percent open_price "
    "close_price daily_return_percent avg_ticks_per_second",
)
def _(t):
    return rollups.symbol_daily_stats(t.price_ticks)


@query(
    "market_volatility_hourly",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, symbol, exchange, data_source,
           stddev_samp(price) AS price_volatility, avg(price) AS avg_price, count(*) AS tick_count,
           avg(abs(price - before)) AS avg_price_movement,
           CASE WHEN sum(coalesce(volume, 0)) > 0
                THEN stddev_samp(price * coalesce(volume, 1)) / sum(coalesce(volume, 1)) END
               AS volume_weighted_volatility
    FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY time) AS before FROM price_ticks)
    GROUP BY 1, 2, 3, 4""",
    "price_volatility avg_price avg_price_movement volume_weighted_volatility",
)
def _(t):
    return rollups.market_volatility_hourly(t.price_ticks)


@query(
    "entity_rollup",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, entity_id, avg(value) AS avg_value,
           max(value) AS max_value, min(value) AS min_value, count(*) AS record_count,
           stddev_samp(value) AS stddev_value, avg(value2) AS avg_value2
    FROM records WHERE entity_id LIKE 'user_%' GROUP BY 1, 2""",
    "avg_value max_value min_value stddev_value avg_value2",
)
def _(t):
    return rollups.entity_rollup(t.records, "1 hour", "user_%")


@query(
    "ohlc_from_ticks",
    """SELECT time_bucket(INTERVAL '1 day', time) AS bucket, symbol, arg_min(price, time) AS open,
           max(price) AS high, min(price) AS low, arg_max(price, time) AS close,
           sum(volume) AS volume, count(*) AS tick_count, stddev_samp(price) AS volatility
    FROM price_ticks GROUP BY 1, 2""",
    "open high low close volume volatility",
)
def _(t):
    return rollups.ohlc_from_ticks(t.price_ticks, "1 day")


@query(
    "hourly_price_stats",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, symbol, avg(price) AS avg_price,
           max(price) AS max_price, min(price) AS min_price, sum(volume) AS total_volume
    FROM price_ticks GROUP BY 1, 2""",
    "avg_price max_price min_price total_volume",
)
def _(t):
    return rollups.hourly_price_stats(t.price_ticks)


_HOURLY_BARS = """SELECT time_bucket(INTERVAL '1 hour', time) AS time, symbol{keys},
    arg_min(price, time) AS open, max(price) AS high, min(price) AS low,
    arg_max(price, time) AS close, sum(volume) AS volume
    FROM price_ticks GROUP BY time_bucket(INTERVAL '1 hour', time), symbol{keys}"""


@query("hourly_from_minutes", _HOURLY_BARS.format(keys=""), "open high low close volume")
def _(t):
    return rollups.hourly_from_minutes(rollups.ohlc_from_ticks(t.price_ticks, "1 minute"))


_REFRESH_LOW, _REFRESH_HIGH = "2024-01-05 07:25:00", "2024-01-20 13:40:00"
_REFRESHED = "time >= TIMESTAMP '2024-01-05 08:00:00' AND time < TIMESTAMP '2024-01-20 13:00:00'"


@query(
    "refresh_rollup",
    _ticks("1 hour", f", {_VWAP}, {_CHANGE}", _REFRESHED),
    f"{_BAR_NUMBERS} {_CHANGE_NUMBERS}",
)
def _(t):
    path = scratch_path(t.spark, "rollup")
    rollup = rollups.ROLLUPS["ticks_1hour"]
    for start, end in (
        (_REFRESH_LOW, "2024-01-12 18:10:00"),
        ("2024-01-12 03:10:00", _REFRESH_HIGH),
    ):
        rollups.refresh_rollup(t.spark, rollup, t.price_ticks, path, start, end)
    return t.spark.read.parquet(path).drop("day")


@query(
    "refresh_due",
    """SELECT * FROM (
        SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, symbol, exchange, data_source,
               stddev_samp(price) AS price_volatility, avg(price) AS avg_price,
               count(*) AS tick_count, avg(abs(price - before)) AS avg_price_movement,
               CASE WHEN sum(coalesce(volume, 0)) > 0
                    THEN stddev_samp(price * coalesce(volume, 1)) / sum(coalesce(volume, 1)) END
                   AS volume_weighted_volatility
        FROM (SELECT *, lag(price) OVER (PARTITION BY symbol ORDER BY time) AS before
              FROM price_ticks)
        GROUP BY 1, 2, 3, 4)
    WHERE bucket >= TIMESTAMP '2024-01-28 12:00:00' AND bucket < TIMESTAMP '2024-01-29 11:00:00'""",
    "price_volatility avg_price avg_price_movement volume_weighted_volatility",
)
def _(t):
    root = scratch_path(t.spark, "rollups")
    name = "market_volatility_hourly"
    rollups.refresh_due(
        t.spark, "2024-01-29 12:00:00", {"price_ticks": t.price_ticks}, root, [name]
    )
    return t.spark.read.parquet(f"{root}/{name}").drop("day")


@query(
    "continuous_aggregate_read",
    f"SELECT * FROM ({_ticks('1 day', _SPREAD)}) "
    "WHERE bucket >= TIMESTAMP '2024-01-04' AND bucket < TIMESTAMP '2024-01-27'",
    f"{_BAR_NUMBERS} avg_spread",
)
def _(t):
    root = scratch_path(t.spark, "rollups")
    registry: dict = {}
    own = rollups.create_rollup(
        "daily_spread",
        "price_ticks",
        "1 day",
        lambda ticks: rollups.ohlcv_rollup(ticks, "1 day", [rollups.spread_column()]),
        "1 month",
        "1 hour",
        registry,
    )
    rollups.refresh_rollup(t.spark, own, t.price_ticks, f"{root}/{own.name}", START, END)
    return rollups.continuous_aggregate_read(t.spark, root, own.name, "2024-01-04", "2024-01-27")


@query(
    "create_rollup",
    """SELECT * FROM (
        SELECT time_bucket(INTERVAL '6 hours', time) AS bucket, entity_id, avg(value) AS avg_value,
               max(value) AS max_value, min(value) AS min_value, count(*) AS record_count,
               stddev_samp(value) AS stddev_value, avg(value2) AS avg_value2
        FROM records GROUP BY 1, 2)
    WHERE bucket >= TIMESTAMP '2024-01-01' AND bucket < TIMESTAMP '2024-01-30 18:00:00'""",
    "avg_value max_value min_value stddev_value avg_value2",
)
def _(t):
    root, registry = scratch_path(t.spark, "rollups"), {}
    rollups.create_rollup(
        "six_hourly",
        "time_series_data",
        "6 hours",
        lambda records: rollups.entity_rollup(records, "6 hours"),
        "1 month",
        "6 hours",
        registry,
    )
    sources = {"time_series_data": t.records}
    rollups.refresh_due(t.spark, "2024-01-31 00:00:00", sources, root, registry=registry)
    return t.spark.read.parquet(f"{root}/six_hourly").drop("day")


@query(
    "route_rollup",
    _HOURLY_BARS.format(keys=", exchange, data_source"),
    "open high low close volume",
)
def _(t):
    root = scratch_path(t.spark, "rollups")
    minutes = rollups.ROLLUPS["ticks_1min"]
    rollups.refresh_rollup(t.spark, minutes, t.price_ticks, f"{root}/ticks_1min", START, END)
    return rollups.route_rollup(t.spark, root, "1h", START, END)


_DUE_AS_OF = "2024-01-29 12:00:00"


def _register_due(name: str) -> None:
    """One refresh by policy per rollup, against the whole rollup cut to the policy's window."""
    rollup = rollups.ROLLUPS[name]
    low, high = whole_buckets(
        rollups.before(_DUE_AS_OF, rollup.start), rollups.before(_DUE_AS_OF, rollup.end), rollup.width
    )
    window = f"bucket >= TIMESTAMP '{low}' AND bucket < TIMESTAMP '{high}'"

    @query(f"refresh_due_{name}")
    def _(t):
        root = scratch_path(t.spark, "rollups")
        sources = {"price_ticks": t.price_ticks, "ohlc_data": t.ohlc_data}
        rollups.refresh_due(t.spark, _DUE_AS_OF, sources, root, [name])
        return t.spark.read.parquet(f"{root}/{name}").drop("day")

    SQL[f"refresh_due_{name}"] = f"SELECT * FROM ({SQL[name]}) WHERE {window}"


for _name in rollups.ROLLUPS:
    if _name != "market_volatility_hourly":  # registered above as refresh_due
        _register_due(_name)


@query("refresh_all", _ticks("1 hour", f", {_VWAP}, {_CHANGE}",
    "time >= TIMESTAMP '2024-01-09' AND time < TIMESTAMP '2024-01-11'"), f"{_BAR_NUMBERS} {_CHANGE_NUMBERS}")
def _(t):
    root = scratch_path(t.spark, "rollups")
    sources = {"price_ticks": t.price_ticks, "ohlc_data": t.ohlc_data}
    rollups.refresh_all(t.spark, sources, root, "2024-01-11", "2024-01-09")
    return t.spark.read.parquet(f"{root}/ticks_1hour").drop("day")


# Ticks of this stretch come late, those from the second moment on last.
_LATE = "time >= '2024-01-11 04:30:00' AND time < '2024-01-11 09:15:00'"
_TAIL = "time >= '2024-01-28 13:20:00'"


def _followed(t):
    """A table with a ledger, and a hook that stores a part of the ticks in it."""
    path = scratch_path(t.spark, "ticks")
    ledger.keep_ledger(t.spark, path)
    return path, lambda where: tables.append_days(t.price_ticks.where(where), path)


@query("continuous_aggregate_fresh", _HOUR, f"{_BAR_NUMBERS} {_CHANGE_NUMBERS}")
def _(t):
    """Stored buckets below the mark, raw rows for late ones and above it: right after the inserts."""
    table, store = _followed(t)
    path, rollup = scratch_path(t.spark, "rollup"), rollups.ROLLUPS["ticks_1hour"]
    store(f"NOT ({_LATE}) AND NOT ({_TAIL})")
    incremental.refresh_changed(t.spark, rollup, table, path)
    store(_LATE)
    store(_TAIL)
    return incremental.read_fresh(t.spark, rollup, table, path, "2000-01-01", "2100-01-01")


@query("refresh_changed", SQL["market_volatility_hourly"])
def _(t):
    """Three inserts, each followed by a refresh of what it changed."""
    table, store = _followed(t)
    path, rollup = scratch_path(t.spark, "rollup"), rollups.ROLLUPS["market_volatility_hourly"]
    for where in (f"NOT ({_LATE}) AND NOT ({_TAIL})", _LATE, _TAIL):
        store(where)
        incremental.refresh_changed(t.spark, rollup, table, path)
    return t.spark.read.parquet(path).drop("day")


def _register_view(name: str) -> None:
    """Every tick view from one set of merged states, brought up to date by two further inserts."""

    @query(f"states_{name}")
    def _(t):
        table, store = _followed(t)
        root = scratch_path(t.spark, "states")
        for where in (f"NOT ({_LATE}) AND NOT ({_TAIL})", _LATE, _TAIL):
            store(where)
            states.refresh_states(t.spark, table, root)
        found = states.read_view(t.spark, root, name, "2000-01-01", "2100-01-01")
        return found.withColumns({c: F.floor(F.col(c) * 100_000 + 0.31) / 100_000 for c in found.columns if c == "vwap"})

    # Sums of states differ from sums of rows in the last bits, and some vwap lie on the very
    # edge of a sixth place; both sides cut them at another point.
    plain = _VWAP.removesuffix(" AS vwap")
    SQL[f"states_{name}"] = SQL[name].replace(_VWAP, f"floor({plain} * 100000 + 0.31) / 100000 AS vwap")


for _name in states.VIEWS:
    _register_view(_name)
