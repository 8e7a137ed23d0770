"""Small column expressions used by many operators."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The identifier rules records, entities and symbols must meet.
ENTITY_ID = r"\A[A-Za-z0-9_.-]{1,100}\z"
ENTITY_TYPE = r"\A[a-z_]{1,50}\z"
SYMBOL = r"\A[A-Z0-9_]{1,20}\z"

VALUE_COLUMNS = ("value", "value2", "value3", "value4")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that yields NULL for a zero divisor."""
    return F.try_divide(numerator, denominator)


def percent_change(start: Column, end: Column) -> Column:
    return ratio(end - start, start) * 100


def is_finite(value: Column) -> Column:
    """True for an ordinary number; NaN and both infinities fail."""
    return ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def volume_weighted(price: str = "price", volume: str = "volume") -> Column:
    """Average price by volume, a missing volume counting as one."""
    weight = F.coalesce(F.col(volume), F.lit(1.0))
    return ratio(F.sum(F.col(price) * weight), F.sum(weight))


def first_by(value: str, time: str = "time") -> Column:
    return F.min_by(value, time)


def last_by(value: str, time: str = "time") -> Column:
    return F.max_by(value, time)


_AGGREGATES: dict[str, Callable[[str, str], Column]] = {
    "avg": lambda column, time: F.avg(column),
    "min": lambda column, time: F.min(column),
    "max": lambda column, time: F.max(column),
    "sum": lambda column, time: F.sum(column),
    "count": lambda column, time: F.count(column),
    "stddev": lambda column, time: F.stddev(column),
    "first": lambda column, time: first_by(column, time),
    "last": lambda column, time: last_by(column, time),
}


def aggregate_of(name: str, column: str, time: str = "time") -> Column:
    """One of the named aggregates over one value column."""
    if name not in _AGGREGATES:
        raise ValueError(f"unknown aggregate {name!r}; one of {sorted(_AGGREGATES)}")
    return _AGGREGATES[name](column, time)


def pick(
    df: DataFrame,
    ids: str | Sequence[str] | DataFrame | None = None,
    pattern: str | None = None,
    key: str = "entity_id",
) -> DataFrame:
    """Rows of the wanted keys: one id, a list, a frame of ids, or a LIKE pattern.

    A frame of ids is a semi join and may be of any size; a short list becomes
    an IN predicate that the scan can use.
    """
    if isinstance(ids, DataFrame):
        df = df.join(ids.select(key), key, "left_semi")
    elif isinstance(ids, str):
        df = df.filter(F.col(key) == ids)
    elif ids is not None:
        df = df.filter(F.col(key).isin(list(ids)) if ids else F.lit(False))
    return df.filter(F.col(key).like(pattern)) if pattern is not None else df


def page(
    df: DataFrame,
    order: Sequence[Column] = (),
    limit: int | None = None,
    offset: int = 0,
) -> DataFrame:
    """Order and cut a result; without an order or limit nothing is sorted."""
    if order:
        df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    return df if limit is None else df.limit(limit)


def ordered(direction: str | None, *columns: str) -> list[Column]:
    """Sort keys: the first column in the given direction, the rest ascending."""
    if direction is None:
        return []
    if direction not in ("asc", "desc"):
        raise ValueError("order must be 'asc', 'desc' or None")
    lead = F.col(columns[0])
    head = lead.desc() if direction == "desc" else lead.asc()
    return [head, *[F.col(c).asc() for c in columns[1:]]]
