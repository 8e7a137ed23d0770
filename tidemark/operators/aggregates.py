"""Bucketed and whole-range aggregates.

All of them are hash aggregates with a partial phase before the shuffle, so one
heavy entity or bucket reaches its reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.buckets import Width, bucket
from tidemark.functions.instants import Instant, at, back, within
from tidemark.functions.measures import (
    VALUE_COLUMNS,
    aggregate_of,
    first_by,
    last_by,
    ordered,
    page,
    percent_change,
    pick,
    ratio,
)
from tidemark.operators.percentiles import group_with_percentiles

Ids = str | Sequence[str] | DataFrame | None


def _bucketed(
    records: DataFrame,
    width: str | Width,
    start: Instant | None,
    end: Instant | None,
    ids: Ids,
    pattern: str | None = None,
) -> DataFrame:
    rows = pick(within(records, start, end), ids, pattern)
    return rows.withColumn("bucket", bucket("time", width))


def _stats(column: str, *, ends: bool = True) -> list[Column]:
    basic = [
        F.avg(column).alias("avg"),
        F.min(column).alias("min"),
        F.max(column).alias("max"),
        F.sum(column).alias("sum"),
    ]
    return [*basic, first_by(column).alias("first"), last_by(column).alias("last")] if ends else basic


def time_bucket_agg(
    records: DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    ids: Ids = None,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Count, average, extremes, sum, first, last and sample deviation per bucket."""
    result = (
        _bucketed(records, width, start, end, ids)
        .groupBy("bucket", "entity_id")
        .agg(F.count(F.lit(1)).alias("count"), *_stats("value"), F.stddev("value").alias("stddev"))
    )
    return page(result, ordered(order, "bucket", "entity_id"), limit, offset)


def multi_entity_agg(
    records: DataFrame,
    ids: Sequence[str] | DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    **paging: object,
) -> DataFrame:
    """:func:`time_bucket_agg` for a list or frame of entities."""
    return time_bucket_agg(records, width, start, end, ids, **paging)


def aggregated_data(
    records: DataFrame,
    start: Instant,
    end: Instant,
    ids: Ids = None,
    width: str | Width = "1h",
    **paging: object,
) -> DataFrame:
    """The short form: count, average, extremes and sum per bucket."""
    return time_bucket_agg(records, width, start, end, ids, **paging).select(
        "bucket", "entity_id", "count", "avg", "min", "max", "sum"
    )


def multi_value_agg(
    records: DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    ids: Ids = None,
    *,
    ends: bool = True,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Statistics of all four values, one struct ``<column>_stats`` each."""
    flat: list[Column] = []
    names = ["avg", "min", "max", "sum", *(["first", "last"] if ends else [])]
    for column in VALUE_COLUMNS:
        stats = _stats(column, ends=ends)
        flat += [s.alias(f"{column}_{n}") for n, s in zip(names, stats, strict=True)]
    grouped = (
        _bucketed(records, width, start, end, ids)
        .groupBy("bucket", "entity_id")
        .agg(F.count(F.lit(1)).alias("count"), *flat)
    )
    nested = [
        F.struct(*[F.col(f"{column}_{n}").alias(n) for n in names]).alias(f"{column}_stats")
        for column in VALUE_COLUMNS
    ]
    result = grouped.select("bucket", "entity_id", "count", *nested)
    return page(result, ordered(order, "bucket", "entity_id"), limit, offset)


def weighted_average(
    records: DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    ids: Ids = None,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Average of ``value`` weighted by ``value2``; rows without a weight are left out."""
    result = (
        _bucketed(records, width, start, end, ids)
        .filter(F.col("value2").isNotNull())
        .groupBy("bucket", "entity_id")
        .agg(
            F.sum(F.col("value") * F.col("value2")).alias("_weighted"),
            F.sum("value2").alias("total_weight"),
            F.min("value").alias("_min"),
            F.max("value").alias("_max"),
        )
        .filter(F.col("total_weight") > 0)
        .select(
            "bucket",
            "entity_id",
            (F.col("_weighted") / F.col("total_weight")).alias("weighted_avg"),
            "total_weight",
            F.struct(F.col("_min").alias("min"), F.col("_max").alias("max")).alias("value_range"),
        )
    )
    return page(result, ordered(order, "bucket", "entity_id"), limit, offset)


def value_delta(
    records: DataFrame, start: Instant, end: Instant, ids: Ids = None
) -> DataFrame:
    """Change between the first and last value of the closed range ``[start, end]``.

    The percentage is 0 when the start value is 0; entities without rows in the
    range have no result.
    """
    ends = (
        pick(within(records, start, end, closed=True), ids)
        .groupBy("entity_id")
        .agg(first_by("value").alias("start_value"), last_by("value").alias("end_value"))
    )
    change = percent_change(F.col("start_value"), F.col("end_value"))
    return ends.select(
        "*",
        (F.col("end_value") - F.col("start_value")).alias("delta"),
        F.coalesce(change, F.lit(0.0)).alias("percent_change"),
        F.struct(at(start).alias("from"), at(end).alias("to")).alias("time_range"),
    )


def variability(
    records: DataFrame, hours: float, as_of: Instant, entities: DataFrame | None = None
) -> DataFrame:
    """Sample deviation over the trailing hours, 0 where it cannot be told.

    With ``entities`` every listed id gets a row, also without any data.
    """
    if hours <= 0:
        raise ValueError("hours must be positive")
    found = (
        within(records, back(as_of, hours=hours), as_of, closed=True)
        .groupBy("entity_id")
        .agg(F.stddev("value").alias("variability"), F.count(F.lit(1)).alias("sample_count"))
    )
    if entities is not None:
        found = entities.select("entity_id").distinct().join(found, "entity_id", "left")
    return found.fillna({"variability": 0.0, "sample_count": 0})


def aggregate(
    records: DataFrame,
    fn: str,
    column: str = "value",
    start: Instant | None = None,
    end: Instant | None = None,
    ids: Ids = None,
    *,
    closed: bool = True,
) -> DataFrame:
    """One named aggregate over one value column, per entity."""
    rows = pick(within(records, start, end, closed=closed), ids)
    return rows.groupBy("entity_id").agg(aggregate_of(fn, _value(column)).alias("result"))


def time_buckets(
    records: DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    fn: str = "avg",
    column: str = "value",
    ids: Ids = None,
    *,
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """One named aggregate over one value column and the row count, per bucket."""
    result = (
        _bucketed(records, width, start, end, ids)
        .groupBy("bucket", "entity_id")
        .agg(aggregate_of(fn, _value(column)).alias("value"), F.count(F.lit(1)).alias("count"))
    )
    return page(result, ordered(order, "bucket", "entity_id"), limit)


def pattern_aggregate(
    records: DataFrame,
    pattern: str,
    fn: str = "avg",
    column: str = "value",
    start: Instant | None = None,
    end: Instant | None = None,
    width: str | Width | None = None,
) -> DataFrame:
    """One aggregate over all entities that match a LIKE pattern, whole or per bucket."""
    rows = pick(within(records, start, end), pattern=pattern)
    keys = [] if width is None else [bucket("time", width).alias("bucket")]
    return rows.groupBy(*keys).agg(
        aggregate_of(fn, _value(column)).alias("result"), F.count(F.lit(1)).alias("count")
    )


def peak_and_average(
    records: DataFrame,
    pattern: str,
    column: str = "value",
    start: Instant | None = None,
    end: Instant | None = None,
) -> DataFrame:
    """Peak and mean of a column per matching entity, the highest peak first."""
    rows = pick(within(records, start, end), pattern=pattern)
    return (
        rows.groupBy("entity_id")
        .agg(F.max(_value(column)).alias("peak"), F.avg(column).alias("average"))
        .orderBy(F.col("peak").desc(), "entity_id")
    )


def statistics(
    records: DataFrame, start: Instant, end: Instant, ids: Ids = None
) -> DataFrame:
    """Summary of ``value`` over the closed range; what cannot be told is 0."""
    summary = (
        pick(within(records, start, end, closed=True), ids)
        .groupBy("entity_id")
        .agg(
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            F.avg("value").alias("avg"),
            F.sum("value").alias("sum"),
            F.count(F.lit(1)).alias("count"),
            F.stddev("value").alias("stddev"),
            F.variance("value").alias("variance"),
        )
    )
    return summary.fillna(0)


def value_distribution(
    records: DataFrame, start: Instant, end: Instant, bins: int, ids: Ids = None
) -> DataFrame:
    """Equal-width histogram per entity, with each bin's share in percent.

    Rows without a value are in no bin and count for no share.
    """
    if bins <= 0:
        raise ValueError("bins must be positive")
    rows = pick(within(records, start, end), ids).select("entity_id", "value").filter(F.col("value").isNotNull())
    limits = rows.groupBy("entity_id").agg(
        F.min("value").alias("_low"), F.max("value").alias("_high"), F.count(F.lit(1)).alias("_n")
    )
    step = (F.col("_high") - F.col("_low")) / bins
    slot = F.coalesce(F.floor(ratio(F.col("value") - F.col("_low"), step)), F.lit(0))
    return (
        rows.join(limits, "entity_id")
        .groupBy("entity_id", F.least(slot, F.lit(bins - 1)).alias("bin"), "_low", "_high", "_n")
        .agg(F.count(F.lit(1)).alias("count"))
        .select(
            "entity_id",
            "bin",
            (F.col("_low") + F.col("bin") * step).alias("range_low"),
            (F.col("_low") + (F.col("bin") + 1) * step).alias("range_high"),
            "count",
            (F.col("count") / F.col("_n") * 100).alias("percentage"),
        )
    )


def volume_profile(
    ticks: DataFrame, start: Instant | None = None, end: Instant | None = None, places: int = 2
) -> DataFrame:
    """Traded volume per symbol and price level."""
    return (
        within(ticks, start, end)
        .groupBy("symbol", F.round("price", places).alias("price_level"))
        .agg(F.sum("volume").alias("volume"), F.count(F.lit(1)).alias("tick_count"))
    )


def percentile_by_group(
    records: DataFrame, q: float, group: Column, column: str = "value", **limits: int
) -> DataFrame:
    """Exact interpolated percentile of a column per value of ``group``."""
    return group_with_percentiles(
        records.withColumn("group", group), ["group"], column, {"percentile": q}, **limits
    )


def having_filter(
    records: DataFrame,
    fn: str,
    column: str,
    threshold: float,
    start: Instant | None = None,
    end: Instant | None = None,
    pattern: str | None = None,
) -> DataFrame:
    """Entities whose aggregate exceeds a threshold, the highest first."""
    rows = pick(within(records, start, end), pattern=pattern)
    return (
        rows.groupBy("entity_id")
        .agg(aggregate_of(fn, _value(column)).alias("result"))
        .filter(F.col("result") > threshold)
        .orderBy(F.col("result").desc(), "entity_id")
    )


def daily_stats(
    records: DataFrame, start: Instant | None = None, end: Instant | None = None, **limits: int
) -> DataFrame:
    """Per day and entity: extremes, mean, count, deviation, median and 95th percentile."""
    rows = within(records, start, end).withColumn("bucket", bucket("time", "1 day"))
    return group_with_percentiles(
        rows,
        ["bucket", "entity_id"],
        "value",
        {"median_value": 0.5, "p95_value": 0.95},
        [
            F.min("value").alias("min_value"),
            F.max("value").alias("max_value"),
            F.avg("value").alias("avg_value"),
            F.count(F.lit(1)).alias("record_count"),
            F.stddev("value").alias("stddev_value"),
        ],
        **limits,
    )


def aggregate_from_records(
    records: DataFrame, minutes: int, start: Instant, end: Instant, ids: Ids = None
) -> DataFrame:
    """Extremes, mean and count per bucket of so many minutes, from raw rows."""
    return time_bucket_agg(records, f"{minutes} minutes", start, end, ids).select(
        F.col("bucket").alias("time"),
        "entity_id",
        F.col("min").alias("min_value"),
        F.col("max").alias("max_value"),
        F.col("avg").alias("avg_value"),
        "count",
    )


def get_aggregates(
    aggregates: DataFrame, interval: str, start: Instant, end: Instant, ids: Ids = None
) -> DataFrame:
    """Stored aggregate rows of one interval code."""
    rows = within(aggregates, start, end).filter(F.col("interval_duration") == interval)
    return pick(rows, ids)


def _value(column: str) -> str:
    if column not in VALUE_COLUMNS:
        raise ValueError(f"not a value column: {column!r}")
    return column
