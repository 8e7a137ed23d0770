"""Points in time as Python values and as literals in a plan.

All trailing-window operators take an explicit ``as_of`` instead of reading the
clock, so a run can be repeated.
"""

from __future__ import annotations

from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Instant = str | date | datetime

#: Column metadata of a day partition: the name of the time column it was made from.
PARTITION_OF = "partition_of"


def instant(value: Instant) -> datetime:
    """Naive UTC datetime for an ISO string, a date or a datetime."""
    if isinstance(value, str):
        value = datetime.fromisoformat(value.replace("Z", "+00:00"))
    elif not isinstance(value, datetime):
        value = datetime(value.year, value.month, value.day)
    if value.tzinfo is not None:
        value = value.astimezone(timezone.utc).replace(tzinfo=None)
    return value


def at(value: Instant) -> Column:
    """Timestamp literal; folds to a constant, so it reaches the scan."""
    return F.lit(instant(value).isoformat(sep=" ")).cast("timestamp")


def back(value: Instant, **span: float) -> datetime:
    """``value`` moved back by a ``timedelta`` given as keywords."""
    return instant(value) - timedelta(**span)


def within(
    df: DataFrame,
    start: Instant | None = None,
    end: Instant | None = None,
    *,
    time: str = "time",
    closed: bool = False,
) -> DataFrame:
    """Rows of ``[start, end)``, or ``[start, end]`` when ``closed``.

    A stored fact table is partitioned by ``day``, which Catalyst does not
    derive from ``time``; the day bounds are added so whole partitions go. Only
    columns that the table readers have marked as such partitions are used so.
    """
    if start is not None and end is not None and instant(start) > instant(end):
        raise ValueError("time range must not end before it starts")
    days = [f.name for f in df.schema.fields if f.metadata.get(PARTITION_OF) == time]
    if start is not None:
        df = df.filter(F.col(time) >= at(start))
        for day in days:
            df = df.filter(F.col(day) >= F.lit(instant(start).date()))
    if end is not None:
        upper = F.col(time) <= at(end) if closed else F.col(time) < at(end)
        df = df.filter(upper)
        for day in days:
            df = df.filter(F.col(day) <= F.lit(instant(end).date()))
    return df


def check_span(start: Instant, end: Instant, max_days: int = 365) -> None:
    """Opt-in guard against over-long ranges."""
    if instant(end) - instant(start) > timedelta(days=max_days):
        raise ValueError(f"time range cannot exceed {max_days} days")
