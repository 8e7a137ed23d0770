"""Gap filling, gap finding and interpolation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import (
    Width,
    bucket_index,
    bucket_start,
    buckets_between,
    index_of,
    parse_width,
)
from tidemark.functions.instants import Instant, at, back, within
from tidemark.functions.measures import (
    VALUE_COLUMNS,
    first_by,
    last_by,
    ordered,
    page,
    pick,
    ratio,
)
from tidemark.operators.sequence import HOT_ROWS, repeat_rows, with_previous

_CARRIED = ("avg", "min", "max", "first", "last")


def gap_filled_agg(
    records: DataFrame,
    width: str | Width,
    start: Instant,
    end: Instant,
    fill_value: float | None = None,
    ids: str | Sequence[str] | DataFrame | None = None,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """One row per entity and bucket of the range; empty buckets repeat the last.

    Each filled bucket stands for itself and the empty ones up to the next, so
    the grid is made by repeating rows: no join with a calendar.
    """
    width = parse_width(width)
    low, count = index_of(start, width), buckets_between(start, end, width)
    filled = (
        pick(within(records, start, end), ids)
        .groupBy("entity_id", bucket_index("time", width).alias("_index"))
        .agg(
            F.count("value").alias("count"),
            F.avg("value").alias("avg"),
            F.min("value").alias("min"),
            F.max("value").alias("max"),
            first_by("value").alias("first"),
            last_by("value").alias("last"),
        )
    )
    values = ["count", *_CARRIED]
    if count <= max_rows:
        # An entity has at most `count` aggregated rows, so one task can order them.
        in_order = Window.partitionBy("entity_id").orderBy("_index")
        following = F.lead("_index").over(in_order)
        leading = F.lag("_index").over(in_order).isNull()
        spans = filled.withColumns({"_next": following, "_leads": leading})
    else:
        spans = _spans_of_long_series(filled, width, max_rows)
    until = F.coalesce(F.col("_next"), F.lit(low + count))
    before = F.when(F.col("_leads"), F.col("_index") - low).otherwise(F.lit(0))
    rows = repeat_rows(
        spans.withColumns({"_before": before, "_until": until}),
        F.col("_until") - F.col("_index") + F.col("_before"),
        "_step",
    )
    shift = F.col("_step") - F.col("_before")
    ahead, own = shift < 0, shift == 0
    result = rows.select(
        bucket_start(F.col("_index") + shift, width).alias("bucket"),
        "entity_id",
        F.when(own, F.col("count")).otherwise(F.lit(0)).alias("count"),
        *[
            F.when(ahead, F.lit(fill_value).cast("double")).otherwise(F.col(c)).alias(c)
            for c in _CARRIED
        ],
    )
    return page(result, ordered(order, "bucket", "entity_id"), limit, offset)


def _spans_of_long_series(filled: DataFrame, width: Width, max_rows: int) -> DataFrame:
    """``_next`` and ``_leads`` when one entity may have more buckets than a task holds.

    Counted backwards, the row before is the bucket that follows.
    """
    mirrored = filled.withColumn("_mirror", F.timestamp_micros(-F.col("_index") * 1_000_000))
    followed = with_previous(mirrored, ["entity_id"], ["_index"], "_mirror", max_rows=max_rows)
    firsts = filled.groupBy("entity_id").agg(F.min("_index").alias("_first"))
    return (
        followed.join(firsts, "entity_id")
        .withColumn("_next", F.col("previous._index"))
        .withColumn("_leads", F.col("_index") == F.col("_first"))
        .drop("previous", "_mirror", "_first")
    )


def value_gaps(
    records: DataFrame,
    minutes: float,
    start: Instant | None = None,
    end: Instant | None = None,
    *,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Pauses between neighbouring rows that exceed the expected interval."""
    rows = within(records, start, end).select("entity_id", "time")
    paired = with_previous(rows, ["entity_id"], ["time"], max_rows=max_rows)
    seconds = _seconds_between(F.col("previous.time"), F.col("time"))
    return paired.select(
        "entity_id",
        F.col("previous.time").alias("time"),
        F.col("time").alias("next_time"),
        seconds.alias("gap_seconds"),
    ).filter(F.col("gap_seconds") > minutes * 60)


def fill_interpolate(
    records: DataFrame,
    step_seconds: int,
    max_gap_seconds: int = 300,
    start: Instant | None = None,
    end: Instant | None = None,
    *,
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """All rows, plus points on the straight line across every over-long gap.

    Added points lie ``step_seconds`` apart from the earlier row on, strictly
    before the later one, and are marked ``interpolated``.
    """
    rows = within(records, start, end).select("entity_id", "time", *VALUE_COLUMNS)
    paired = with_previous(rows, ["entity_id"], ["time", *VALUE_COLUMNS], max_rows=max_rows)
    step = F.lit(step_seconds * 1_000_000)
    began = F.unix_micros("previous.time")
    span = F.unix_micros("time") - began
    inner = F.when(span > max_gap_seconds * 1_000_000, F.ceil(span / step) - 1)
    points = repeat_rows(paired, F.coalesce(inner, F.lit(0)) + 1, "_step")
    added = F.col("_step") > 0
    moment = began + F.col("_step") * step
    share = ratio(F.col("_step") * step, span)

    def value(name: str) -> Column:
        line = F.col(f"previous.{name}") + (F.col(name) - F.col(f"previous.{name}")) * share
        return F.when(added, line).otherwise(F.col(name)).alias(name)

    return points.select(
        "entity_id",
        F.when(added, F.timestamp_micros(moment)).otherwise(F.col("time")).alias("time"),
        *[value(name) for name in VALUE_COLUMNS],
        added.alias("interpolated"),
    )


def completeness(
    records: DataFrame,
    ids: DataFrame,
    start: Instant,
    end: Instant,
    expected: int,
    threshold: float = 0.9,
) -> DataFrame:
    """Row count per listed entity against the expected count."""
    counts = within(records, start, end).groupBy("entity_id").agg(F.count(F.lit(1)).alias("_n"))
    actual = F.coalesce(F.col("_n"), F.lit(0))
    return (
        ids.select("entity_id")
        .distinct()
        .join(counts, "entity_id", "left")
        .select(
            "entity_id",
            actual.alias("record_count"),
            F.lit(expected).alias("expected_count"),
            (actual < expected * threshold).alias("is_incomplete"),
        )
    )


def stale_entities(
    records: DataFrame, minutes: float, as_of: Instant, pattern: str | None = None
) -> DataFrame:
    """Entities with some row, but none in the last ``minutes``."""
    return (
        pick(records, pattern=pattern)
        .filter(F.col("time") <= at(as_of))
        .groupBy("entity_id")
        .agg(F.max("time").alias("last_seen"))
        .filter(F.col("last_seen") <= at(back(as_of, minutes=minutes)))
    )


def _seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / F.lit(1_000_000)
