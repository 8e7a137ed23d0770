"""Bucket widths and the bucket a row falls in.

Fixed-length buckets count from Monday 2000-01-03, calendar buckets (months,
years) from 2000-01-01. Everything is an ordinary column expression, so a
bucket can be a grouping key inside whole-stage code generation.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, instant

ORIGIN = datetime(2000, 1, 3)
CALENDAR_ORIGIN = datetime(2000, 1, 1)
_ORIGIN_MICROS = 946_857_600_000_000

_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400, "week": 604800}
_UNIT_MONTHS = {"month": 1, "year": 12}
_CODE_UNITS = {"s": "second", "m": "minute", "h": "hour", "d": "day", "w": "week", "M": "month", "y": "year"}

_SPELLED = re.compile(r"(\d+)\s+(second|minute|hour|day|week|month|year)s?", re.IGNORECASE)
_CODED = re.compile(r"(\d+)([smhdwMy])")


@dataclass(frozen=True)
class Width:
    """Length of a bucket: either whole microseconds or whole months."""

    micros: int = 0
    months: int = 0

    @property
    def seconds(self) -> float:
        if self.months:
            raise ValueError("a calendar width has no fixed length")
        return self.micros / 1_000_000


def parse_width(text: str | Width) -> Width:
    """Read ``'5 minutes'`` or the code form ``'5m'`` (``M`` means month)."""
    if isinstance(text, Width):
        return text
    found = _SPELLED.fullmatch(text)
    if found:
        amount, unit = int(found[1]), found[2].lower()
    else:
        found = _CODED.fullmatch(text)
        if not found:
            raise ValueError(f"not a bucket width: {text!r}")
        amount, unit = int(found[1]), _CODE_UNITS[found[2]]
    if amount <= 0:
        raise ValueError(f"bucket width must be positive: {text!r}")
    if unit in _UNIT_MONTHS:
        return Width(months=amount * _UNIT_MONTHS[unit])
    return Width(micros=amount * _UNIT_SECONDS[unit] * 1_000_000)


def bucket(time: Column | str, width: str | Width) -> Column:
    """Start of the bucket that holds ``time``."""
    width, time = parse_width(width), _col(time)
    if width.months:
        return bucket_start(bucket_index(time, width), width)
    micros = F.unix_micros(time)
    return F.timestamp_micros(micros - F.pmod(micros - F.lit(_ORIGIN_MICROS), F.lit(width.micros)))


def bucket_index(time: Column | str, width: str | Width) -> Column:
    """Number of the bucket, counted from the origin."""
    width, time = parse_width(width), _col(time)
    if width.months:
        months = (F.year(time) - 2000) * 12 + F.month(time) - 1
        return F.floor(months / F.lit(width.months))
    offset = F.unix_micros(time) - F.lit(_ORIGIN_MICROS)
    return ((offset - F.pmod(offset, F.lit(width.micros))) / F.lit(width.micros)).cast("bigint")


def bucket_start(index: Column | str, width: str | Width) -> Column:
    """Inverse of :func:`bucket_index`."""
    width, index = parse_width(width), _col(index)
    if width.months:
        step = F.make_ym_interval(F.lit(0), (index * width.months).cast("int"))
        return F.lit("2000-01-01 00:00:00").cast("timestamp") + step
    return F.timestamp_micros(F.lit(_ORIGIN_MICROS) + index * F.lit(width.micros))


def index_of(moment: Instant, width: str | Width) -> int:
    """:func:`bucket_index` of a single Python instant."""
    width, moment = parse_width(width), instant(moment)
    if width.months:
        return ((moment.year - 2000) * 12 + moment.month - 1) // width.months
    return (moment - ORIGIN) // timedelta(microseconds=width.micros)


def start_of(index: int, width: str | Width) -> datetime:
    """:func:`bucket_start` of a single Python index."""
    width = parse_width(width)
    if width.months:
        year, month = divmod(index * width.months, 12)
        return datetime(2000 + year, month + 1, 1)
    return ORIGIN + timedelta(microseconds=width.micros) * index


def whole_buckets(start: Instant, end: Instant, width: str | Width) -> tuple[datetime, datetime]:
    """The largest run of complete buckets inside ``[start, end)``."""
    low = index_of(start, width)
    if start_of(low, width) < instant(start):
        low += 1
    high = index_of(end, width)
    return start_of(low, width), start_of(max(low, high), width)


def buckets_between(start: Instant, end: Instant, width: str | Width) -> int:
    """How many buckets touch ``[start, end)``."""
    high = index_of(end, width)
    if start_of(high, width) < instant(end):
        high += 1
    return high - index_of(start, width)


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value
