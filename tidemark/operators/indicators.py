"""Technical indicators, one result per symbol (or per row for running ones).

"As of" indicators need only the newest n ticks of a symbol; those are cut out
before the shuffle, so their windows never see more than n rows.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, back, instant, within
from tidemark.functions.measures import ordered, page, pick, ratio
from tidemark.operators.sequence import HOT_ROWS, newest_rows, with_history, with_previous


def moving_averages(
    records: DataFrame,
    rows: int,
    start: Instant,
    end: Instant,
    ids: str | list[str] | DataFrame | None = None,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Mean of the last ``rows`` values and the two-term exponential average.

    The exponential column mixes the value with its predecessor only; the first
    row of an entity keeps its own value.
    """
    if rows <= 0:
        raise ValueError("window must have at least one row")
    source = pick(within(records, start, end), ids).select("entity_id", "time", "value")
    arranged, keys, by = with_history(source, ["entity_id"], max(rows - 1, 1), max_rows=max_rows)
    window = Window.partitionBy(*keys).orderBy(*by)
    weight = 2.0 / (rows + 1)
    smoothed = F.col("value") * weight + F.lag("value").over(window) * (1 - weight)
    result = (
        arranged.withColumns(
            {
                "sma": F.avg("value").over(window.rowsBetween(-(rows - 1), 0)),
                "ema": F.coalesce(smoothed, F.col("value")),
            }
        )
        .filter(~F.col("_carried"))
        .select("entity_id", "time", "value", "sma", "ema")
    )
    return page(result, ordered(order, "time", "entity_id"), limit, offset)


def _newest(
    ticks: DataFrame, count: int, as_of: Instant, symbol: str | None, since: Instant | None
) -> DataFrame:
    """Newest prices up to ``as_of``; ``since`` spares reading older history.

    For one symbol it is found out: the last week is asked first, then four times as far
    back each time, until there are ``count`` prices or no older ones. For all symbols
    at once only the caller can know which there are, so without ``since`` all history is read.
    """
    known = pick(within(ticks, end=as_of, closed=True), symbol, key="symbol")
    if since is None and isinstance(symbol, str):
        low, oldest = back(as_of, days=7), None
        while within(known, low).limit(count).count() < count:
            if oldest is None:
                oldest = known.agg(F.unix_micros(F.min("time"))).first()[0]
            if oldest is None or low <= datetime(1970, 1, 1) + timedelta(microseconds=oldest):
                break
            low = low - 4 * (instant(as_of) - low)
        else:
            since = low
    known = within(known, since)
    return newest_rows(known.select("symbol", "time", "price"), ["symbol"], count)


def sma(
    ticks: DataFrame,
    period: int,
    as_of: Instant,
    symbol: str | None = None,
    *,
    since: Instant | None = None,
) -> DataFrame:
    """Mean of the newest ``period`` prices."""
    newest = _newest(ticks, period, as_of, symbol, since)
    return newest.groupBy("symbol").agg(F.avg("price").alias("sma"))


def ema(
    ticks: DataFrame,
    period: int,
    as_of: Instant,
    symbol: str | None = None,
    *,
    oldest_first: bool = False,
    since: Instant | None = None,
) -> DataFrame:
    """Exponential average of the newest ``period`` prices, seeded with their mean.

    Folding a recursion over n prices leaves each with a power of the decay, so
    a weighted sum gives the same number. The default folds from newest to
    oldest, so the oldest price weighs most; ``oldest_first`` is the usual order.
    """
    weight = 2.0 / (period + 1)
    decay = F.lit(1.0 - weight)
    whole = Window.partitionBy("symbol")
    rows = _newest(ticks, period, as_of, symbol, since).withColumn("_n", F.count(F.lit(1)).over(whole))
    later = F.col("rank") - 1 if oldest_first else F.col("_n") - F.col("rank")
    return rows.groupBy("symbol").agg(
        (
            F.avg("price") * F.pow(decay, F.max("_n"))
            + F.sum(F.col("price") * weight * F.pow(decay, later))
        ).alias("ema")
    )


def rsi(
    ticks: DataFrame,
    as_of: Instant,
    period: int = 14,
    symbol: str | None = None,
    *,
    since: Instant | None = None,
) -> DataFrame:
    """Relative strength of gains against losses over the newest price changes.

    100 without losses, NULL without any change to look at.
    """
    newest_first = Window.partitionBy("symbol").orderBy(F.col("time").desc())
    change = F.col("price") - F.lead("price").over(newest_first)
    changes = (
        _newest(ticks, period + 2, as_of, symbol, since)
        .withColumn("_change", change)
        .filter(F.col("rank") <= period + 1)
    )
    gain = F.avg(F.when(F.col("_change").isNotNull(), F.greatest(F.col("_change"), F.lit(0.0))))
    loss = F.avg(F.when(F.col("_change").isNotNull(), F.greatest(-F.col("_change"), F.lit(0.0))))
    strength = F.col("_gain") / F.col("_loss")
    return (
        changes.groupBy("symbol")
        .agg(gain.alias("_gain"), loss.alias("_loss"))
        .select(
            "symbol",
            F.when(F.col("_loss") == 0, F.lit(100.0))
            .otherwise(100 - 100 / (1 + strength))
            .alias("rsi"),
        )
    )


def rsi_signal(
    ticks: DataFrame,
    as_of: Instant,
    period: int = 14,
    symbol: str | None = None,
    *,
    since: Instant | None = None,
) -> DataFrame:
    """:func:`rsi` with its usual reading."""
    reading = (
        F.when(F.col("rsi") >= 70, "overbought").when(F.col("rsi") <= 30, "oversold")
    )
    return rsi(ticks, as_of, period, symbol, since=since).withColumn(
        "signal", F.when(F.col("rsi").isNotNull(), F.coalesce(reading, F.lit("neutral")))
    )


def bollinger(
    ticks: DataFrame,
    as_of: Instant,
    period: int = 20,
    deviations: float = 2.0,
    symbol: str | None = None,
    *,
    since: Instant | None = None,
) -> DataFrame:
    """Mean, bands around it, bandwidth, and where the newest price lies between them."""
    summary = (
        _newest(ticks, period, as_of, symbol, since)
        .groupBy("symbol")
        .agg(
            F.avg("price").alias("middle_band"),
            F.stddev("price").alias("_deviation"),
            F.max_by("price", "time").alias("_current"),
        )
    )
    reach = F.col("_deviation") * deviations
    banded = summary.withColumns(
        {
            "upper_band": F.col("middle_band") + reach,
            "lower_band": F.col("middle_band") - reach,
        }
    )
    span = F.col("upper_band") - F.col("lower_band")
    return banded.select(
        "symbol",
        "middle_band",
        "upper_band",
        "lower_band",
        F.coalesce(ratio(F.col("_current") - F.col("lower_band"), span), F.lit(0.5)).alias(
            "price_position"
        ),
        ratio(span, F.col("middle_band")).alias("bandwidth"),
    )


def vwap(
    ticks: DataFrame, start: Instant, end: Instant, symbol: str | None = None
) -> DataFrame:
    """Volume-weighted price over the closed range, ticks with volume only."""
    return (
        pick(within(ticks, start, end, closed=True), symbol, key="symbol")
        .filter(F.col("volume") > 0)
        .groupBy("symbol")
        .agg((F.sum(F.col("price") * F.col("volume")) / F.sum("volume")).alias("vwap"))
    )


def obv(
    ticks: DataFrame,
    as_of: Instant,
    days: int = 30,
    symbol: str | None = None,
    *,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Volume added on rising ticks and taken off on falling ones."""
    rows = pick(within(ticks, back(as_of, days=days), as_of, closed=True), symbol, key="symbol")
    moved = with_previous(
        rows.select("symbol", "time", "price", "volume"), ["symbol"], ["price"], max_rows=max_rows
    )
    direction = F.signum(F.col("price") - F.col("previous.price"))
    flow = F.coalesce(direction * F.coalesce(F.col("volume"), F.lit(0.0)), F.lit(0.0))
    return moved.groupBy("symbol").agg(F.sum(flow).alias("obv"))


def support_resistance(
    ticks: DataFrame,
    as_of: Instant,
    days: int = 30,
    symbol: str | None = None,
    *,
    min_touches: int = 3,
    places: int = 2,
) -> DataFrame:
    """Price levels touched often, above or below the newest price.

    A symbol with levels has ticks in the window, so its newest price is there
    too, and both come from one aggregate per level.
    """
    known = pick(within(ticks, back(as_of, days=days), as_of, closed=True), symbol, key="symbol")
    touched = known.groupBy("symbol", F.round("price", places).alias("price_level")).agg(
        F.count(F.lit(1)).alias("touch_count"),
        F.max("time").alias("_time"),
        F.max_by("price", "time").alias("_price"),
    )
    current = touched.groupBy("symbol").agg(F.max_by("_price", "_time").alias("current_price"))
    levels = touched.filter(F.col("touch_count") >= min_touches)
    above = F.col("price_level") > F.col("current_price")
    return levels.join(current, "symbol").select(
        "symbol",
        "price_level",
        F.when(above, "resistance").otherwise("support").alias("level_type"),
        "touch_count",
        (F.col("touch_count") / 10.0).alias("strength"),
        F.abs(F.col("price_level") - F.col("current_price")).alias("distance"),
    )


def daily_ends(
    ticks: DataFrame, as_of: Instant, days: int, symbol: str | list[str] | None = None
) -> DataFrame:
    """Opening and closing price of each symbol and day of the trailing window."""
    rows = pick(within(ticks, back(as_of, days=days), as_of, closed=True), symbol, key="symbol")
    return rows.groupBy("symbol", F.to_date("time").alias("trade_date")).agg(
        F.min_by("price", "time").alias("open_price"),
        F.max_by("price", "time").alias("close_price"),
    )
