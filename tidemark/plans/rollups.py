"""The rollups: what each computes, from which table, how wide, how far back.

A rollup is a function from source rows to bucket rows. Stored, it is a
day-partitioned table that :func:`refresh_rollup` recomputes a stretch of whole
buckets at a time.
"""

from __future__ import annotations

import calendar
import re
from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import Width, bucket, parse_width, whole_buckets
from tidemark.functions.instants import Instant, at, back, instant, within
from tidemark.functions.measures import (
    first_by,
    last_by,
    ordered,
    page,
    percent_change,
    pick,
    volume_weighted,
)
from tidemark.operators.percentiles import group_with_percentiles
from tidemark.operators.sequence import HOT_ROWS, with_previous
from tidemark.schemas import INTERVAL_CODES
from tidemark.sources.tables import (
    DAY,
    days_of,
    drop_days,
    exists,
    on_days,
    read_days,
    replace_days,
    with_day,
)

TICK_KEYS = ("bucket", "symbol", "exchange", "data_source")


def ohlcv_columns() -> list[Column]:
    """Open, high, low, close, volume, count, mean and deviation of ticks."""
    return [
        first_by("price").alias("open"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        last_by("price").alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("tick_count"),
        F.avg("price").alias("avg_price"),
        F.stddev("price").alias("price_volatility"),
    ]


def spread_column() -> Column:
    """Mean distance of bid and ask, where both are known."""
    return F.avg(F.col("ask_price") - F.col("bid_price")).alias("avg_spread")


def ohlcv_rollup(
    ticks: DataFrame,
    width: str | Width,
    extras: Sequence[Column] = (),
    keys: Sequence[str] = TICK_KEYS,
) -> DataFrame:
    """Ticks rolled up per bucket and key, with any further aggregates."""
    rows = ticks.withColumn("bucket", bucket("time", width))
    return rows.groupBy(*keys).agg(*ohlcv_columns(), *extras)


def _with_change(bars: DataFrame) -> DataFrame:
    return bars.withColumns(
        {
            "price_change": F.col("close") - F.col("open"),
            "price_change_percent": percent_change(F.col("open"), F.col("close")),
        }
    )


def _per_second(count: str, width: str) -> Column:
    return F.col(count) / parse_width(width).seconds


def ticks_1min(ticks: DataFrame) -> DataFrame:
    return ohlcv_rollup(ticks, "1 minute", [spread_column()])


def ticks_5min(ticks: DataFrame, **limits: int) -> DataFrame:
    rows = ticks.withColumn("bucket", bucket("time", "5 minutes"))
    return group_with_percentiles(
        rows, TICK_KEYS, "price", {"median_price": 0.5}, ohlcv_columns(), **limits
    )


def ticks_15min(ticks: DataFrame) -> DataFrame:
    return ohlcv_rollup(ticks, "15 minutes", [volume_weighted().alias("vwap")])


def ticks_1hour(ticks: DataFrame) -> DataFrame:
    return _with_change(ohlcv_rollup(ticks, "1 hour", [volume_weighted().alias("vwap")]))


def ticks_4hour(ticks: DataFrame) -> DataFrame:
    bars = _with_change(ohlcv_rollup(ticks, "4 hours", [volume_weighted().alias("vwap")]))
    return bars.withColumn("ticks_per_second", _per_second("tick_count", "4 hours"))


def ticks_1day(ticks: DataFrame) -> DataFrame:
    bars = _with_change(ohlcv_rollup(ticks, "1 day", [volume_weighted().alias("vwap")]))
    return bars.withColumns(
        {
            "daily_range_percent": percent_change(F.col("low"), F.col("high")),
            "avg_ticks_per_second": _per_second("tick_count", "1 day"),
        }
    )


# The order in which bar intervals are preferred by each summary.
_HOURLY_RANK = ("1m", "5m", "15m", "30m")
_DAILY_RANK = ("1m", "5m", "15m", "30m", "1h", "4h")


def _interval_rank(codes: Sequence[str]) -> Column:
    code = F.col("interval_duration")
    ranked = [F.when(code == name, F.lit(rank)) for rank, name in enumerate(codes, start=1)]
    return F.coalesce(*ranked, F.lit(len(codes) + 1))


def _ohlc_summary(bars: DataFrame, width: str, order: Column) -> DataFrame:
    rows = bars.withColumns({"bucket": bucket("time", width), "_order": order})
    return rows.groupBy("bucket", "symbol", "data_source").agg(
        F.min_by("open", "_order").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "_order").alias("close"),
        F.sum("volume").alias("volume"),
        F.count(F.lit(1)).alias("interval_count"),
        F.avg("price_change_percent").alias("avg_price_change_percent"),
        F.stddev("price_change_percent").alias("volatility"),
    )


def _bar_order(rank: Column) -> Column:
    """Rank, then time, then interval length, as one sortable number.

    A plain number keeps the aggregate hash-based; a struct would force a sort.
    Sixteen times the microseconds stay below 2^58 until the year 2540.
    """
    code = F.col("interval_duration")
    length = F.coalesce(
        *[F.when(code == name, F.lit(n)) for n, name in enumerate(INTERVAL_CODES)],
        F.lit(len(INTERVAL_CODES)),
    )
    return rank.cast("bigint") * F.lit(1 << 58) + F.unix_micros("time") * 16 + length


def ohlc_summary_1hour(bars: DataFrame) -> DataFrame:
    """Open from the finest interval there is, close from the coarsest."""
    return _ohlc_summary(bars, "1 hour", _bar_order(_interval_rank(_HOURLY_RANK)))


def ohlc_summary_1day(bars: DataFrame) -> DataFrame:
    """As the hourly summary, with hourly and four-hourly bars ranked too."""
    return _ohlc_summary(bars, "1 day", _bar_order(_interval_rank(_DAILY_RANK)))


def ohlc_summary_1week(bars: DataFrame) -> DataFrame:
    """Weekly summary of the coarser bars, in order of time."""
    coarse = bars.filter(F.col("interval_duration").isin("1d", "4h", "1h"))
    return _ohlc_summary(coarse, "1 week", _bar_order(F.lit(0)))


def symbol_daily_stats(ticks: DataFrame) -> DataFrame:
    """Everything about a symbol's day in one row."""
    rows = ticks.withColumn("bucket", bucket("time", "1 day"))
    stats = rows.groupBy("bucket", "symbol").agg(
        F.count(F.lit(1)).alias("total_ticks"),
        F.avg("price").alias("avg_price"),
        F.stddev("price").alias("price_volatility"),
        F.min("price").alias("min_price"),
        F.max("price").alias("max_price"),
        F.sum(F.coalesce("volume", F.lit(0.0))).alias("total_volume"),
        first_by("price").alias("open_price"),
        last_by("price").alias("close_price"),
        F.count_distinct("exchange").alias("exchange_count"),
        F.count_distinct("data_source").alias("data_source_count"),
    )
    return stats.withColumns(
        {
            "daily_range_percent": percent_change(F.col("min_price"), F.col("max_price")),
            "daily_return_percent": percent_change(F.col("open_price"), F.col("close_price")),
            "avg_ticks_per_second": _per_second("total_ticks", "1 day"),
        }
    )


def market_volatility_hourly(ticks: DataFrame, max_rows: int = HOT_ROWS) -> DataFrame:
    """Deviation and mean step of prices; the step looks back across the whole symbol."""
    moved = with_previous(
        ticks.select("time", "symbol", "price", "volume", "exchange", "data_source"),
        ["symbol"],
        ["price"],
        max_rows=max_rows,
    )
    weight = F.coalesce("volume", F.lit(1.0))
    rows = moved.withColumns(
        {
            "bucket": bucket("time", "1 hour"),
            "_step": F.abs(F.col("price") - F.col("previous.price")),
            "_weight": weight,
            "_weighted": F.col("price") * weight,
        }
    )
    traded = F.sum("volume") > 0
    return rows.groupBy(*TICK_KEYS).agg(
        F.stddev("price").alias("price_volatility"),
        F.avg("price").alias("avg_price"),
        F.count(F.lit(1)).alias("tick_count"),
        F.avg("_step").alias("avg_price_movement"),
        F.when(traded, F.stddev("_weighted") / F.sum("_weight")).alias(
            "volume_weighted_volatility"
        ),
    )


def entity_rollup(
    records: DataFrame, width: str | Width, pattern: str | None = None
) -> DataFrame:
    """Generic records per bucket and entity."""
    rows = pick(records, pattern=pattern).withColumn("bucket", bucket("time", width))
    return rows.groupBy("bucket", "entity_id").agg(
        F.avg("value").alias("avg_value"),
        F.max("value").alias("max_value"),
        F.min("value").alias("min_value"),
        F.count(F.lit(1)).alias("record_count"),
        F.stddev("value").alias("stddev_value"),
        F.avg("value2").alias("avg_value2"),
    )


def ohlc_from_ticks(ticks: DataFrame, width: str | Width) -> DataFrame:
    """Bars per symbol alone, over all exchanges and sources."""
    bars = ohlcv_rollup(ticks, width, keys=("bucket", "symbol"))
    columns = ["bucket", "symbol", "open", "high", "low", "close", "volume", "tick_count"]
    daily = parse_width(width) == parse_width("1 day")
    deviation = [F.col("price_volatility").alias("volatility")] if daily else []
    return bars.select(*columns, *deviation)


def hourly_price_stats(ticks: DataFrame) -> DataFrame:
    rows = ticks.withColumn("bucket", bucket("time", "1 hour"))
    return rows.groupBy("bucket", "symbol").agg(
        F.avg("price").alias("avg_price"),
        F.max("price").alias("max_price"),
        F.min("price").alias("min_price"),
        F.sum("volume").alias("total_volume"),
    )


def coarser_bars(
    bars: DataFrame, width: str | Width = "1 hour", keys: Sequence[str] = ("symbol",)
) -> DataFrame:
    """Bars of a wider bucket from finer ones."""
    rows = bars.withColumn("_bucket", bucket("bucket", width))
    return rows.groupBy(F.col("_bucket").alias("time"), *keys).agg(
        F.min_by("open", "bucket").alias("open"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        F.max_by("close", "bucket").alias("close"),
        F.sum("volume").alias("volume"),
    )


hourly_from_minutes = coarser_bars


@dataclass(frozen=True)
class Rollup:
    """A named rollup and its refresh policy.

    A refresh as of a moment covers ``[moment - start, moment - end)``, months and years
    counted by the calendar. ``look_back`` marks rollups whose first bucket needs the
    price before it, and says how far back that is usually found; ``keep`` limits the
    source to rows not older than that.
    """

    name: str
    source: str
    width: str
    build: Callable[[DataFrame], DataFrame]
    start: Width
    end: Width
    look_back: timedelta | None = None
    keep: Width | None = None


def before(moment: Instant, span: str | Width) -> datetime:
    """``moment`` less a span; months and years by the calendar, to the last day at most."""
    moment, span = instant(moment), parse_width(span)
    months = moment.year * 12 + moment.month - 1 - span.months
    year, month = divmod(months, 12)
    day = min(moment.day, calendar.monthrange(year, month + 1)[1])
    return moment.replace(year=year, month=month + 1, day=day) - timedelta(microseconds=span.micros)


def _define(
    name: str,
    source: str,
    width: str,
    build: Callable[[DataFrame], DataFrame],
    start: str,
    end: str,
    **more: object,
) -> tuple[str, Rollup]:
    return name, Rollup(name, source, width, build, parse_width(start), parse_width(end), **more)


# Source, width and refresh offsets of the shipped rollups.
ROLLUPS: dict[str, Rollup] = dict(
    [
        _define("ticks_1min", "price_ticks", "1m", ticks_1min, "1 hour", "1 minute"),
        _define("ticks_5min", "price_ticks", "5m", ticks_5min, "6 hours", "5 minutes"),
        _define("ticks_15min", "price_ticks", "15m", ticks_15min, "1 day", "15 minutes"),
        _define("ticks_1hour", "price_ticks", "1h", ticks_1hour, "1 day", "1 hour"),
        _define("ticks_4hour", "price_ticks", "4h", ticks_4hour, "1 week", "4 hours"),
        _define("ticks_1day", "price_ticks", "1d", ticks_1day, "1 month", "1 day"),
        _define(
            "ohlc_summary_1hour", "ohlc_data", "1h", ohlc_summary_1hour, "1 day", "1 hour",
            keep=parse_width("1 year"),
        ),
        _define(
            "ohlc_summary_1day", "ohlc_data", "1d", ohlc_summary_1day, "1 week", "1 day",
            keep=parse_width("2 years"),
        ),
        _define("ohlc_summary_1week", "ohlc_data", "1w", ohlc_summary_1week, "1 month", "1 week"),
        _define("symbol_daily_stats", "price_ticks", "1d", symbol_daily_stats, "1 week", "1 day"),
        _define(
            "market_volatility_hourly", "price_ticks", "1h", market_volatility_hourly,
            "1 day", "1 hour", look_back=timedelta(days=7),
        ),
    ]
)


def create_rollup(
    name: str,
    source: str,
    width: str,
    build: Callable[[DataFrame], DataFrame],
    start: str,
    end: str,
    registry: dict[str, Rollup] | None = None,
) -> Rollup:
    """Add a rollup of one's own, with its refresh policy."""
    _check_name(name)
    registry = ROLLUPS if registry is None else registry
    registry.update([_define(name, source, width, build, start, end)])
    return registry[name]


def compute_rollup(
    rollup: Rollup, source: DataFrame, start: Instant, end: Instant
) -> DataFrame:
    """The buckets of ``[start, end)``, both bucket boundaries.

    A rollup that looks back also gets, per symbol, the newest price before the
    range.
    """
    rows = within(source, start, end)
    if rollup.look_back is None:
        return rollup.build(rows)
    earlier = _newest_before(source, rows, start, rollup.look_back)
    known = rows.drop(DAY).unionByName(earlier, allowMissingColumns=True)
    return rollup.build(known).filter(F.col("bucket") >= at(start))


def _newest_before(
    source: DataFrame, rows: DataFrame, start: Instant, look_back: timedelta
) -> DataFrame:
    """Newest time and price before ``start`` of the symbols in ``rows``.

    The days just before the range answer for most symbols. Whether any is missing
    is asked first; only then is older history read, for the missing ones alone and
    going back four times as far each time, down to the oldest row.
    """

    def newest(ticks: DataFrame) -> DataFrame:
        return ticks.groupBy("symbol").agg(
            F.max("time").alias("time"), last_by("price").alias("price")
        )

    high, low = instant(start), instant(start) - look_back
    wanted = rows.select("symbol").filter(F.col("symbol").isNotNull()).distinct()
    found = newest(within(source, low, high))
    oldest = None
    while True:
        missing = wanted.join(found, "symbol", "left_anti")
        if not missing.head(1):
            return found
        if oldest is None:
            oldest = source.agg(F.unix_micros(F.min("time"))).first()[0]
        if oldest is None or low <= datetime(1970, 1, 1) + timedelta(microseconds=oldest):
            return found
        high, low = low, low - 4 * (instant(start) - low)
        part = within(source, low, high).join(missing, "symbol", "left_semi")
        found = found.unionByName(newest(part))


def rollup_all(rollup: Rollup, source: DataFrame, as_of: Instant) -> DataFrame:
    """The whole rollup, over the part of the source it is defined on."""
    return rollup.build(_kept(rollup, source, as_of))


def _kept(rollup: Rollup, source: DataFrame, as_of: Instant) -> DataFrame:
    """The part of the source that the rollup is defined on."""
    if rollup.keep is None:
        return source
    midnight = instant(as_of).replace(hour=0, minute=0, second=0, microsecond=0)
    return within(source, before(midnight, rollup.keep))


def refresh_rollup(
    spark: SparkSession,
    rollup: Rollup,
    source: DataFrame,
    path: str,
    start: Instant,
    end: Instant,
    as_of: Instant | None = None,
) -> tuple[datetime, datetime]:
    """Recompute the whole buckets inside ``[start, end)`` of a stored rollup.

    What the rollup is defined on is counted back from ``as_of``, by default ``end``. Only the days they lie in are rewritten; other buckets of those days are
    kept as stored. Returns the range that was refreshed.
    """
    low, high = whole_buckets(start, end, rollup.width)
    if low >= high:
        return low, low
    source = _kept(rollup, source, end if as_of is None else as_of)
    fresh = compute_rollup(rollup, source, low, high)
    stale_days = []
    if exists(spark, path):
        stored = read_days(spark, path, "bucket")
        days = days_of(within(stored, low, high, time="bucket"), "bucket")
        # Buckets of the touched days that lie outside the range stay as they are.
        touched = sorted({*days, low.date(), high.date()})
        outside = on_days(stored, touched).filter(
            (F.col("bucket") < at(low)) | (F.col("bucket") >= at(high))
        )
        if days:
            starts = within(source, low, high).select(bucket("time", rollup.width).alias("time"))
            filled = {*days_of(starts), *days_of(outside, "bucket")}
            stale_days = [d for d in days if d not in filled]
        fresh = with_day(fresh, "bucket").unionByName(outside, allowMissingColumns=True)
    replace_days(fresh, path, time="bucket")
    drop_days(spark, path, stale_days)
    return low, high


def refresh_due(
    spark: SparkSession,
    as_of: Instant,
    sources: dict[str, DataFrame],
    root: str,
    names: Sequence[str] | None = None,
    registry: dict[str, Rollup] | None = None,
) -> dict[str, tuple[datetime, datetime]]:
    """Refresh every rollup over the window its policy gives for ``as_of``."""
    registry = ROLLUPS if registry is None else registry
    return {
        name: refresh_rollup(
            spark,
            registry[name],
            sources[registry[name].source],
            f"{root.rstrip('/')}/{name}",
            before(as_of, registry[name].start),
            before(as_of, registry[name].end),
            as_of,
        )
        for name in (names or registry)
    }


def refresh_all(
    spark: SparkSession,
    sources: dict[str, DataFrame],
    root: str,
    end: Instant,
    start: Instant | None = None,
) -> dict[str, tuple[datetime, datetime]]:
    """Refresh every rollup over one window, by default the day before ``end``."""
    start = back(end, days=1) if start is None else start
    return {
        name: refresh_rollup(spark, r, sources[r.source], f"{root.rstrip('/')}/{name}", start, end)
        for name, r in ROLLUPS.items()
    }


_IDENTIFIER = re.compile(r"[a-zA-Z_][a-zA-Z0-9_]*")


def _check_name(name: str) -> None:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"not a rollup name: {name!r}")


def continuous_aggregate_read(
    spark: SparkSession,
    root: str,
    name: str,
    start: Instant,
    end: Instant,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Buckets of a stored rollup in ``[start, end)``."""
    _check_name(name)
    rows = within(read_days(spark, f"{root.rstrip('/')}/{name}", "bucket"), start, end, time="bucket")
    return page(rows.drop(DAY), ordered(order, "bucket"), limit, offset)


def route_rollup(
    spark: SparkSession,
    root: str,
    interval: str,
    start: Instant,
    end: Instant,
    symbol: str | None = None,
) -> DataFrame:
    """Bars of an interval from the cheapest stored rollup that has them."""
    if interval not in ("1m", "1h", "1d"):
        raise ValueError(f"no stored rollup serves interval {interval!r}")
    name = "ticks_1day" if interval == "1d" else "ticks_1min"
    stored = continuous_aggregate_read(spark, root, name, start, end)
    stored = pick(stored, symbol, key="symbol")
    keys = ("symbol", "exchange", "data_source")
    if interval == "1h":
        return coarser_bars(stored, "1 hour", keys)
    return stored.select(
        F.col("bucket").alias("time"), *keys, "open", "high", "low", "close", "volume"
    )
