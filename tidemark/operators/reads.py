"""Point, range and search reads.

Every read is a filter, a projection and, only when asked for, an order and a
cut. Time and value predicates reach the Parquet scan; day partitions are pruned.
"""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from datetime import datetime, timedelta
from itertools import islice

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket
from tidemark.functions.instants import Instant, at, back, instant, within
from tidemark.functions.measures import VALUE_COLUMNS, ordered, page, pick

Bounds = tuple[float | None, float | None]


def _shape(records: DataFrame, include_metadata: bool) -> DataFrame:
    columns = ["time", "entity_id", *VALUE_COLUMNS]
    return records.select(*columns, *(["metadata"] if include_metadata else []))


def _paged(
    rows: DataFrame, order: str | None, key: str, limit: int | None, offset: int = 0
) -> DataFrame:
    """A cut needs an order, newest first unless another is given; the whole needs none."""
    if order is None and (limit is not None or offset):
        order = "desc"
    return page(rows, ordered(order, "time", key), limit, offset)


def get_records(
    records: DataFrame,
    start: Instant,
    end: Instant,
    entity: str | None = None,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    include_metadata: bool = False,
) -> DataFrame:
    """Rows of one entity, or of all, in ``[start, end)``."""
    rows = _shape(within(pick(records, entity), start, end), include_metadata)
    return _paged(rows, order, "entity_id", limit, offset)


def get_multi_entity_records(
    records: DataFrame,
    ids: Sequence[str] | DataFrame,
    start: Instant,
    end: Instant,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    include_metadata: bool = False,
) -> DataFrame:
    """Rows of several entities; no ids, no rows."""
    rows = _shape(pick(within(records, start, end), ids), include_metadata)
    return _paged(rows, order, "entity_id", limit, offset)


def get_records_by_entity_type(
    records: DataFrame,
    entities: DataFrame,
    entity_type: str,
    start: Instant,
    end: Instant,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
    include_metadata: bool = False,
) -> DataFrame:
    """Rows of the active entities of a type."""
    wanted = entities.filter((F.col("entity_type") == entity_type) & F.col("is_active"))
    rows = _shape(pick(within(records, start, end), wanted), include_metadata)
    return _paged(rows, order, "entity_id", limit, offset)


get_multi_entity_data = get_multi_entity_records


@dataclass(frozen=True)
class Search:
    """Optional conditions of :func:`search_records`; all given ones must hold."""

    entity_pattern: str | None = None
    entity_types: Sequence[str] = ()
    value: Bounds = (None, None)
    value2: Bounds = (None, None)
    metadata: Mapping[str, object] = field(default_factory=dict)
    min_time: Instant | None = None
    max_time: Instant | None = None
    time_of_day: tuple[str, str] | None = None
    days_of_week: Sequence[int] = ()

    def conditions(self) -> list[Column]:
        found: list[Column] = []
        if self.entity_pattern is not None:
            found.append(F.col("entity_id").like(self.entity_pattern))
        for name, (low, high) in (("value", self.value), ("value2", self.value2)):
            if low is not None:
                found.append(F.col(name) >= low)
            if high is not None:
                found.append(F.col(name) <= high)
        for path, wanted in self.metadata.items():
            found.append(F.get_json_object("metadata", f"$.{path}") == _json_text(wanted))
        if self.min_time is not None:
            found.append(F.col("time") >= at(self.min_time))
        if self.max_time is not None:
            found.append(F.col("time") <= at(self.max_time))
        if self.time_of_day is not None:
            found.append(F.date_format("time", "HH:mm").between(*self.time_of_day))
        if self.days_of_week:
            found.append((F.dayofweek("time") - 1).isin(list(self.days_of_week)))
        return found


def search_records(
    records: DataFrame,
    entities: DataFrame,
    search: Search,
    start: Instant,
    end: Instant,
    *,
    order: str | None = None,
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Rows of active entities that meet every condition of ``search``."""
    rows = within(records, start, end)
    for condition in search.conditions():
        rows = rows.filter(condition)
    wanted = entities.filter("is_active")
    if search.entity_types:
        wanted = wanted.filter(F.col("entity_type").isin(list(search.entity_types)))
    rows = _shape(pick(rows, wanted), include_metadata=True)
    return _paged(rows, order, "entity_id", limit, offset)


def get_available_entities(
    entities: DataFrame, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Active entities by type and id."""
    return page(
        entities.filter("is_active"), [F.col("entity_type"), F.col("entity_id")], limit, offset
    )


def get_entities_by_type(
    entities: DataFrame, entity_type: str, limit: int | None = None, offset: int = 0
) -> DataFrame:
    """Active entities of one type by id."""
    rows = entities.filter((F.col("entity_type") == entity_type) & F.col("is_active"))
    return page(rows, [F.col("entity_id")], limit, offset)


def get_entities(entities: DataFrame, entity_type: str | None = None) -> DataFrame:
    """All entities, or those of one type, active or not."""
    return entities if entity_type is None else entities.filter(F.col("entity_type") == entity_type)


def high_value_records(
    records: DataFrame,
    min_value: float,
    start: Instant,
    end: Instant,
    entity: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Rows at or above a value, the highest first."""
    rows = within(pick(records, entity), start, end).filter(F.col("value") >= min_value)
    order = [F.col("value").desc(), F.col("time").desc(), F.col("entity_id").asc()]
    return page(_shape(rows, include_metadata=True), order, limit)


def multi_value_records(records: DataFrame) -> DataFrame:
    """Rows that carry all four values."""
    return records.dropna(subset=list(VALUE_COLUMNS[1:]))


def records_with_metadata(records: DataFrame) -> DataFrame:
    """Rows whose metadata is present and not the empty object."""
    return records.filter(F.col("metadata") != "{}")


def recent_records(records: DataFrame, as_of: Instant, days: int = 30) -> DataFrame:
    """Rows newer than ``days`` before ``as_of``."""
    cutoff = back(as_of, days=days)
    return within(records, cutoff).filter(F.col("time") > at(cutoff))


def get_ticks(
    ticks: DataFrame,
    start: Instant,
    end: Instant,
    symbol: str | None = None,
    *,
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Ticks of ``[start, end)``."""
    rows = within(pick(ticks, symbol, key="symbol"), start, end)
    return _paged(rows, order, "symbol", limit)


def get_ohlc(
    bars: DataFrame,
    interval: str,
    start: Instant,
    end: Instant,
    symbol: str | None = None,
    *,
    order: str | None = None,
    limit: int | None = None,
) -> DataFrame:
    """Bars of one interval code in ``[start, end)``."""
    rows = within(pick(bars, symbol, key="symbol"), start, end)
    rows = rows.filter(F.col("interval_duration") == interval)
    return _paged(rows, order, "symbol", limit)


def time_slices(rows: DataFrame, width: str = "1 minute") -> DataFrame:
    """``slice, n, before``: rows of each slice of time, and rows in newer ones.

    One small row per slice that has rows. Days are counted first, a number for each on the
    driver; the running sums over slices stay inside a day. Rows without a time have no slice.
    """
    counts = rows.filter(F.col("time").isNotNull()).groupBy(bucket("time", width).alias("slice")).agg(F.count(F.lit(1)).alias("n"))
    day = F.to_date("slice")
    newer_days, so_far = [], 0
    for row in sorted(counts.groupBy(day.alias("day")).agg(F.sum("n").alias("n")).collect(), reverse=True):
        newer_days.append((row["day"], so_far))
        so_far += row["n"]
    days = F.broadcast(rows.sparkSession.createDataFrame(newer_days, "day date, newer long"))
    newer = Window.partitionBy("day").orderBy(F.desc("slice")).rowsBetween(Window.unboundedPreceding, -1)
    inside = F.coalesce(F.sum("n").over(newer), F.lit(0))
    return counts.withColumn("day", day).withColumn("inside", inside).join(days, "day").select(
        "slice", "n", (F.col("newer") + F.col("inside")).alias("before")
    )


def numbered_records(
    records: DataFrame, start: Instant, end: Instant, entity: str | None = None, batch_size: int = 1000
) -> DataFrame:
    """The rows of ``[start, end)`` with the number of their ``batch``, newest first.

    Rows are ranked inside a minute, and counts of newer minutes added, so the numbers are exact
    and no task sees more than a minute. Equal times are ordered by entity and then by all values.
    """
    rows = get_records(records, start, end, entity, include_metadata=True).withColumn("slice", bucket("time", "1 minute"))
    order = [F.desc("time"), "entity_id", *VALUE_COLUMNS, "metadata"]
    inside = F.row_number().over(Window.partitionBy("slice").orderBy(*order)) - 1
    placed = rows.withColumn("_inside", inside).join(time_slices(rows).drop("n"), "slice")
    number = F.floor((F.col("before") + F.col("_inside")) / batch_size)
    return placed.withColumn("batch", number.cast("long")).drop("slice", "before", "_inside")


def records_page(
    records: DataFrame, start: Instant, end: Instant, offset: int, limit: int, entity: str | None = None
) -> DataFrame:
    """``limit`` rows of ``[start, end)`` after the newest ``offset`` ones.

    Counts per minute tell in which stretch of time the page lies; only rows of that stretch are
    read as a whole and sorted, however far back the page is.
    """
    if offset < 0 or limit < 0:
        raise ValueError("offset and limit must not be negative")
    rows = get_records(records, start, end, entity, include_metadata=True)
    reached = time_slices(rows.select("time")).filter(
        (F.col("before") < offset + limit) & (F.col("before") + F.col("n") > offset)
    )
    low, high, before = reached.agg(F.unix_micros(F.min("slice")), F.unix_micros(F.max("slice")), F.min("before")).first()
    if low is None:
        return rows.limit(0)
    epoch = datetime(1970, 1, 1)
    low, high = (epoch + timedelta(microseconds=m) for m in (low, high + 60_000_000))
    held = get_records(records, max(low, instant(start)), min(high, instant(end)), entity, include_metadata=True)
    order = [F.desc("time"), "entity_id", *VALUE_COLUMNS, "metadata"]
    return held.orderBy(*order).offset(offset - before).limit(limit)


def get_records_batches(
    records: DataFrame,
    start: Instant,
    end: Instant,
    entity: str | None = None,
    batch_size: int = 1000,
) -> Iterator[list[Row]]:
    """Hand a consumer the rows newest first, a batch at a time.

    One partition is fetched at a time, so the driver never holds the result. Consumers that run
    on Spark take :func:`numbered_records`, and single pages come from :func:`records_page`.
    """
    ordered_rows = get_records(records, start, end, entity, order="desc", include_metadata=True)
    rows = ordered_rows.toLocalIterator()
    while batch := list(islice(rows, batch_size)):
        yield batch


def allowed_rows(
    df: DataFrame,
    permissions: DataFrame,
    user: str,
    key: str = "symbol",
    allowed: str = "allowed_symbol",
) -> DataFrame:
    """Rows whose key the user may see."""
    granted = permissions.filter(F.col("user_id") == user).select(F.col(allowed).alias(key))
    return df.join(granted, key, "left_semi")


# The alert limits of the documented examples.
TEMPERATURE_LIMITS: dict[str, Bounds] = {"value": (-10.0, 35.0)}
CLIMATE_LIMITS: dict[str, Bounds] = {"value": (-20.0, 40.0), "value2": (5.0, 95.0)}
SENSOR_LIMITS: dict[str, Bounds] = {
    "value": (-10.0, 40.0),
    "value2": (10.0, 95.0),
    "value3": (980.0, 1050.0),
}


def threshold_alerts(df: DataFrame, limits: Mapping[str, Bounds]) -> DataFrame:
    """Rows outside any limit, with one ``<column>_alert`` flag per limit.

    Stateless, so the same call serves a streaming frame.
    """
    flags: dict[str, Column] = {}
    for name, (low, high) in limits.items():
        outside = F.lit(False)
        if low is not None:
            outside = outside | (F.col(name) < low)
        if high is not None:
            outside = outside | (F.col(name) > high)
        flags[f"{name}_alert"] = F.coalesce(outside, F.lit(False))
    flagged = df.withColumns(flags)
    return flagged.filter(" OR ".join(f"`{name}`" for name in flags)) if flags else flagged


def run_sql(tables: Mapping[str, DataFrame], text: str) -> DataFrame:
    """User SQL over the given frames, each visible under its name."""
    if not tables:
        raise ValueError("at least one table is needed")
    spark = next(iter(tables.values())).sparkSession
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text)


def _json_text(value: object) -> str:
    """A value as ``get_json_object`` renders it."""
    if isinstance(value, bool):
        return "true" if value else "false"
    return str(value)
