"""Risk measures on daily returns.

The day aggregate runs first and combines on the map side; what follows has one
row per symbol and day.
"""

from __future__ import annotations

from math import sqrt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant
from tidemark.functions.measures import ratio
from tidemark.operators.indicators import daily_ends

# Fixed value: trading days a year, used to annualise.
TRADING_DAYS = 252


def volatility(
    ticks: DataFrame, as_of: Instant, days: int = 30, symbol: str | None = None
) -> DataFrame:
    """Annualised deviation of logarithmic close-to-close returns."""
    by_day = Window.partitionBy("symbol").orderBy("trade_date")
    change = ratio(F.col("close_price"), F.lag("close_price").over(by_day))
    return (
        daily_ends(ticks, as_of, days, symbol)
        .withColumn("_return", F.log(change))
        .groupBy("symbol")
        .agg((F.stddev("_return") * sqrt(TRADING_DAYS)).alias("volatility"))
    )


def value_at_risk(
    ticks: DataFrame,
    as_of: Instant,
    confidence: float = 0.95,
    days: int = 30,
    symbol: str | None = None,
) -> DataFrame:
    """The open-to-close return that is undercut on a share ``1 - confidence`` of days."""
    returns = (
        daily_ends(ticks, as_of, days, symbol)
        .filter(F.col("open_price") > 0)
        .withColumn("_return", (F.col("close_price") - F.col("open_price")) / F.col("open_price"))
    )
    return returns.groupBy("symbol").agg(
        F.percentile("_return", 1 - confidence).alias("value_at_risk")
    )


def correlate_symbols(
    ticks: DataFrame, first: str, second: str, as_of: Instant, days: int = 30
) -> DataFrame:
    """Correlation of two symbols' daily returns over the days both traded.

    The two series are laid side by side by one conditional aggregate per day,
    which spares the self-join.
    """
    returns = daily_ends(ticks, as_of, days, [first, second]).withColumn(
        "_return", ratio(F.col("close_price") - F.col("open_price"), F.col("open_price"))
    )

    def of(symbol: str):
        return F.max(F.when(F.col("symbol") == symbol, F.col("_return")))

    return (
        returns.groupBy("trade_date")
        .agg(of(first).alias("_first"), of(second).alias("_second"))
        .dropna()
        .agg(F.corr("_first", "_second").alias("correlation"), F.count(F.lit(1)).alias("days"))
        .select(F.lit(first).alias("symbol1"), F.lit(second).alias("symbol2"), "correlation", "days")
    )
