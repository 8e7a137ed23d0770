"""Tick bars of every width from one raw scan, by states that merge.

A state row sums up a bucket of one symbol, exchange and source so that two of them make one: the
number of rows and of prices, their sum and second moment about the mean, first and last price with
their times, extremes, volume, weights, spreads, and at minutes how often each price occurred.
States of a minute are made from raw rows; each wider one from the stored states below it. The
bars are plain columns over the states, so one hour that changed is read from the raw table once
and then only moves through a few stored rows, up to the day.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket, parse_width
from tidemark.functions.instants import Instant, within
from tidemark.functions.measures import percent_change, ratio
from tidemark.plans.incremental import (
    Mark,
    among,
    extent,
    read_mark,
    replace_buckets,
    write_mark,
)
from tidemark.plans.rollups import TICK_KEYS
from tidemark.sources.ledger import Span, changes, joined, widened
from tidemark.sources.tables import DAY, exists, read_days

LEVELS = ("1 minute", "5 minutes", "15 minutes", "1 hour", "4 hours", "1 day")
KEYS = TICK_KEYS[1:]
RANGES = 64


def minute_states(ticks: DataFrame) -> DataFrame:
    """States of a minute from raw ticks.

    Rows are first counted per price, which shrinks them before the shuffle where prices repeat;
    the second moment is then taken about the exact mean.
    """
    weight = F.coalesce("volume", F.lit(1.0))
    spread = F.col("ask_price") - F.col("bid_price")
    rows = ticks.withColumns({"bucket": bucket("time", LEVELS[0]), "_weight": weight, "_spread": spread})
    per_price = rows.groupBy(*TICK_KEYS, "price").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("time").alias("first_time"),
        F.max("time").alias("last_time"),
        F.sum("volume").alias("volume"),
        F.sum("_weight").alias("weight"),
        F.sum(F.col("price") * F.col("_weight")).alias("weighted"),
        F.sum("_spread").alias("spread"),
        F.count("_spread").alias("spreads"),
    )
    known = F.col("price").isNotNull()
    prices = F.collect_list(F.when(known, F.struct("price", "n")))
    states = per_price.groupBy(*TICK_KEYS).agg(
        F.sum("n").alias("n"),
        F.coalesce(F.sum(F.when(known, F.col("n"))), F.lit(0)).alias("priced"),
        F.sum(F.col("price") * F.col("n")).alias("total"),
        F.min_by("price", "first_time").alias("open"),
        F.min("first_time").alias("first_time"),
        F.max_by("price", "last_time").alias("close"),
        F.max("last_time").alias("last_time"),
        F.max("price").alias("high"),
        F.min("price").alias("low"),
        *[F.sum(c).alias(c) for c in ("volume", "weight", "weighted", "spread", "spreads")],
        F.sort_array(prices).alias("prices"),
    )
    mean = ratio(F.col("total"), F.col("priced"))
    moment = F.aggregate("prices", F.lit(0.0), lambda s, p: s + p["n"] * F.pow(p["price"] - mean, F.lit(2)))
    return states.withColumn("moment", moment)


def merged_states(states: DataFrame, width: str, keys: tuple[str, ...] = KEYS) -> DataFrame:
    """States of a wider bucket, or of fewer keys, from those of finer ones.

    Moments are merged pairwise in the order of time, without cancellation; a bucket
    has as many finer ones as its width holds.
    """
    rows = states.withColumn("bucket", bucket("bucket", width))
    parts = F.sort_array(F.collect_list(F.when(F.col("priced") > 0, F.struct("first_time", "priced", ratio(F.col("total"), F.col("priced")).alias("mean"), "moment"))))
    merged = rows.groupBy("bucket", *keys).agg(
        F.sum("n").alias("n"),
        F.min_by("open", "first_time").alias("open"),
        F.min("first_time").alias("first_time"),
        F.max_by("close", "last_time").alias("close"),
        F.max("last_time").alias("last_time"),
        F.max("high").alias("high"),
        F.min("low").alias("low"),
        *[F.sum(c).alias(c) for c in ("priced", "total", "volume", "weight", "weighted", "spread", "spreads")],
        parts.alias("_parts"),
    )
    start = F.struct(F.lit(0).cast("long").alias("priced"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("moment"))

    def add(a: Column, b: Column) -> Column:
        n = a["priced"] + b["priced"]
        step = b["mean"] - a["mean"]
        return F.struct(
            n.alias("priced"),
            (a["mean"] + step * b["priced"] / n).alias("mean"),
            (a["moment"] + b["moment"] + step * step * a["priced"] * b["priced"] / n).alias("moment"),
        )

    return merged.withColumn("moment", F.aggregate("_parts", start, add)["moment"]).drop("_parts")


def medians(states: DataFrame, width: str) -> DataFrame:
    """The exact median price per bucket, from how often each price occurred."""
    each = states.select(bucket("bucket", width).alias("bucket"), *KEYS, F.explode("prices").alias("p"))
    return each.groupBy("bucket", *KEYS).agg(F.percentile(F.col("p.price"), F.lit(0.5), F.col("p.n")).alias("median_price"))


def bars(states: DataFrame) -> DataFrame:
    """Open to deviation of the states, with every further column that a bar may have."""
    change = percent_change(F.col("open"), F.col("close"))
    deviation = F.when(F.col("priced") > 1, F.sqrt(F.col("moment") / (F.col("priced") - 1)))
    return states.select(
        *[c for c in ("bucket", *KEYS) if c in states.columns],
        "open", "high", "low", "close", "volume",
        F.col("n").alias("tick_count"),
        ratio(F.col("total"), F.col("priced")).alias("avg_price"),
        deviation.alias("price_volatility"),
        ratio(F.col("spread"), F.col("spreads")).alias("avg_spread"),
        ratio(F.col("weighted"), F.col("weight")).alias("vwap"),
        (F.col("close") - F.col("open")).alias("price_change"),
        change.alias("price_change_percent"),
        percent_change(F.col("low"), F.col("high")).alias("range_percent"),
        *[F.col(c) for c in ("median_price",) if c in states.columns],
    )


# The columns of a bar that every tick view has.
_BASE = [*TICK_KEYS, "open", "high", "low", "close", "volume", "tick_count", "avg_price", "price_volatility"]
_CHANGE = ["vwap", "price_change", "price_change_percent"]


def _per_second(width: str, name: str) -> Column:
    return (F.col("tick_count") / parse_width(width).seconds).alias(name)


def _daily(states: DataFrame) -> DataFrame:
    """A symbol's day over all exchanges and sources: the states are few, so no row is expanded."""
    counted = states.groupBy("bucket", "symbol").agg(
        F.size(F.collect_set("exchange")).cast("long").alias("exchange_count"),
        F.size(F.collect_set("data_source")).cast("long").alias("data_source_count"),
    )
    whole = bars(merged_states(states, "1 day", ("symbol",)))
    same = whole.symbol.eqNullSafe(counted.symbol) & whole.bucket.eqNullSafe(counted.bucket)
    return whole.join(counted, same).select(
        whole.bucket,
        whole.symbol,
        F.col("tick_count").alias("total_ticks"),
        "avg_price",
        "price_volatility",
        F.col("low").alias("min_price"),
        F.col("high").alias("max_price"),
        F.coalesce("volume", F.lit(0.0)).alias("total_volume"),
        F.col("open").alias("open_price"),
        F.col("close").alias("close_price"),
        "exchange_count",
        "data_source_count",
        F.col("range_percent").alias("daily_range_percent"),
        F.col("price_change_percent").alias("daily_return_percent"),
        _per_second("1 day", "avg_ticks_per_second"),
    )


#: Each view: the width of the states it is made of, and its columns over them.
VIEWS: dict[str, tuple[str, Callable[[DataFrame], DataFrame]]] = {
    "ticks_1min": ("1 minute", lambda s: bars(s).select(*_BASE, "avg_spread")),
    "ticks_5min": ("5 minutes", lambda s: bars(s).select(*_BASE, "median_price")),
    "ticks_15min": ("15 minutes", lambda s: bars(s).select(*_BASE, "vwap")),
    "ticks_1hour": ("1 hour", lambda s: bars(s).select(*_BASE, *_CHANGE)),
    "ticks_4hour": ("4 hours", lambda s: bars(s).select(*_BASE, *_CHANGE, _per_second("4 hours", "ticks_per_second"))),
    "ticks_1day": (
        "1 day",
        lambda s: bars(s).select(
            *_BASE, *_CHANGE, F.col("range_percent").alias("daily_range_percent"), _per_second("1 day", "avg_ticks_per_second")
        ),
    ),
    "symbol_daily_stats": ("1 day", _daily),
}


def state_path(root: str, width: str) -> str:
    return f"{root.rstrip('/')}/states_{width.replace(' ', '_')}"


def _level(spark: SparkSession, root: str, width: str, below: str, spans: list[Span]) -> DataFrame:
    """States of one level in some spans, from the stored ones of the level below."""
    finer = among(read_days(spark, state_path(root, below), "bucket"), spans, "bucket").drop(DAY)
    wider = merged_states(finer, width)
    if width != LEVELS[1]:
        return wider
    found = medians(finer, width)
    same = [wider[c].eqNullSafe(found[c]) for c in TICK_KEYS]
    return wider.join(found, same, "left").select(wider["*"], "median_price")


def refresh_states(spark: SparkSession, table: str, root: str) -> dict[str, list[Span]]:
    """Bring the states of every width up to date with the table; returns what was recomputed.

    The first refresh covers all rows, a later one the hours that the table's ledger names since;
    raw rows of these are read once, and nothing where nothing changed.
    """
    mark_path = state_path(root, "marks")
    held = read_mark(spark, mark_path)
    news = changes(spark, table, held.upto if held else 0)
    source = read_days(spark, table)
    spans = news.spans
    if held is None:
        whole = extent(source)
        spans = [whole] if whole else []
    spans = joined(widened(spans, LEVELS[0]), RANGES)
    done = {}
    if spans:
        replace_buckets(spark, minute_states(among(source, spans)), state_path(root, LEVELS[0]), spans)
        done[LEVELS[0]] = spans
        for below, width in zip(LEVELS, LEVELS[1:], strict=False):
            spans = widened(spans, width)
            replace_buckets(spark, _level(spark, root, width, below, spans), state_path(root, width), spans)
            done[width] = spans
    if spans or (held is not None and news.upto != held.upto):
        # Reads of states know no tail, so the mark's water only says how far they go.
        high = max([s[1] for s in spans], default=datetime.min)
        write_mark(spark, mark_path, Mark(news.upto, max(high, held.water) if held else high))
    return done


def read_view(spark: SparkSession, root: str, name: str, start: Instant, end: Instant) -> DataFrame:
    """Bars of a view that start in ``[start, end)``, from the states of its width."""
    width, shape = VIEWS[name]
    path = state_path(root, width)
    if not exists(spark, path):
        raise ValueError(f"no states of {width} are stored below {root}")
    return shape(within(read_days(spark, path, "bucket"), start, end, time="bucket").drop(DAY))
