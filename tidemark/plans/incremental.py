"""Rollups that follow their table by its ledger: refresh what changed, read what is newer raw.

Each stored rollup has a mark: the last ledger entry it has taken up, the spans it was told of but
has left for later, and the high-water mark below which its buckets are stored. A refresh reads
the changed spans, widened to whole buckets, and nothing else. A read takes stored buckets where
the table has not changed since, and works out the changed ones and those above the high-water
mark from raw rows, so it equals the rollup of all rows at any moment.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timedelta
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.instants import PARTITION_OF, Instant, at, instant, within
from tidemark.plans.rollups import Rollup, compute_rollup
from tidemark.sources.ledger import Log, Span, changes, clipped, days_in, joined, widened
from tidemark.sources.tables import (
    DAY,
    day_files,
    drop_days,
    exists,
    on_days,
    read_days,
    replace_days,
    stored_days,
    with_day,
)

RANGES = 64  # changed ranges that a plan names; the closest ones are joined beyond


@dataclass
class Mark:
    """How far a stored rollup has followed its table."""

    upto: int = 0
    water: datetime | None = None
    left: list[Span] = field(default_factory=list)


def _marks(spark: SparkSession, path: str) -> Log:
    return Log(spark, f"{path.rstrip('/')}-marks")


def read_mark(spark: SparkSession, path: str) -> Mark | None:
    held = _marks(spark, path).last()
    if held is None:
        return None
    left = [tuple(map(datetime.fromisoformat, span)) for span in held["left"]]
    return Mark(held["upto"], datetime.fromisoformat(held["water"]), left)


def write_mark(spark: SparkSession, path: str, mark: Mark) -> None:
    """Put a mark in place of the earlier ones."""
    log = _marks(spark, path)
    log.start()
    left = [[s.isoformat() for s in span] for span in mark.left]
    log.forget(log.append({"upto": mark.upto, "water": mark.water.isoformat(), "left": left}) - 1)


def among(df: DataFrame, spans: list[Span], time: str = "time") -> DataFrame:
    """Rows inside any of the spans, as constants that reach the scan; day folders are named."""
    if not spans:
        return df.filter(F.lit(False))
    inside = reduce(Column.__or__, [(F.col(time) >= at(low)) & (F.col(time) < at(high)) for low, high in spans])
    for day in (f.name for f in df.schema.fields if f.metadata.get(PARTITION_OF) == time):
        dates = [(low.date(), (high - timedelta(microseconds=1)).date()) for low, high in spans]
        df = df.filter(reduce(Column.__or__, [F.col(day).between(F.lit(a), F.lit(b)) for a, b in dates]))
    return df.filter(inside)


def extent(source: DataFrame, time: str = "time") -> Span | None:
    """The first and the last time of a table, the last one exclusive."""
    row = source.agg(F.unix_micros(F.min(time)), F.unix_micros(F.max(time))).first()
    if row[0] is None:
        return None
    epoch = datetime(1970, 1, 1)
    return epoch + timedelta(microseconds=row[0]), epoch + timedelta(microseconds=row[1] + 1)


def _felt(rollup: Rollup, source: DataFrame, spans: list[Span]) -> list[Span]:
    """The spans whose buckets a change in ``spans`` alters.

    Where a bucket needs the row before it, a change reaches to the next row of each symbol. Rows
    up to ``look_back`` after the change are asked first, and four times as many for symbols
    without one there, up to the newest row.
    """
    if rollup.look_back is None or not spans:
        return spans
    whole, out = extent(source), []
    for low, high in spans:
        names = within(source, low, high + rollup.look_back).select("symbol").distinct()
        reach, span = high, rollup.look_back
        while whole is not None and reach < whole[1]:
            later = within(source, high, high + span).groupBy("symbol").agg(F.min("time").alias("next"))
            missing = names.join(later, "symbol", "left_anti").head(1)
            if not missing or high + span >= whole[1]:
                following = extent(later, "next")
                reach = max(reach, following[1]) if following else reach
                break
            span *= 4
        out.append((low, reach))
    return joined(out)


def _stale(spark: SparkSession, rollup: Rollup, table: str, path: str) -> tuple[Mark, bool, DataFrame, list[Span]]:
    """The mark of a stored rollup and whether it has one yet, its table, and the buckets out of date.

    The ledger is read before the table: what is published in between is still noted next time.
    """
    held = read_mark(spark, path)
    mark = held or Mark()
    news = changes(spark, table, mark.upto)
    source = read_days(spark, table)
    if held is None:
        whole = extent(source)
        mark = Mark(news.upto, whole[0] if whole else datetime(1970, 1, 1))
        return mark, False, source, widened([whole], rollup.width) if whole else []
    spans = widened([*mark.left, *_felt(rollup, source, news.spans)], rollup.width)
    return Mark(news.upto, mark.water, mark.left), news.upto == held.upto, source, spans


def rolled(rollup: Rollup, source: DataFrame, spans: list[Span]) -> DataFrame:
    """The rollup's buckets of some spans of whole buckets, from raw rows of these alone."""
    if rollup.look_back is None or not spans:
        return rollup.build(among(source, spans))
    return reduce(DataFrame.unionByName, [compute_rollup(rollup, source, low, high) for low, high in spans])


def replace_buckets(spark: SparkSession, fresh: DataFrame, path: str, spans: list[Span], time: str = "bucket") -> None:
    """Put buckets in place of those that a stored table has in ``spans``; others stay.

    An overwrite leaves days alone that it has no rows for, so their files stay the same; the
    buckets of such days all lay in ``spans`` and are gone, and the days with them.
    """
    before: dict = {}
    if exists(spark, path):
        before = day_files(spark, path, [d for d in stored_days(spark, path) if d in {*days_in(spans)}])
        touched = on_days(read_days(spark, path, time), list(before))
        inside = reduce(Column.__or__, [(F.col(time) >= at(low)) & (F.col(time) < at(high)) for low, high in spans])
        fresh = with_day(fresh, time).unionByName(touched.filter(~inside), allowMissingColumns=True)
    replace_days(fresh, path, time=time)
    after = day_files(spark, path, list(before))
    drop_days(spark, path, [d for d in before if after[d] == before[d]])


def refresh_changed(
    spark: SparkSession, rollup: Rollup, table: str, path: str, end: Instant | None = None
) -> list[Span]:
    """Recompute the buckets of the rollup at ``path`` that its table's ledger names; returns them.

    The first refresh covers all rows. Buckets that are not over by ``end`` are left for later,
    and reads take them from raw rows until then. With nothing new, no row is read or written.
    """
    mark, same, source, spans = _stale(spark, rollup, table, path)
    limit = datetime.max if end is None else _floor(instant(end), rollup)
    due, left = joined(clipped(spans, datetime.min, limit), RANGES), clipped(spans, limit, datetime.max)
    if due:
        replace_buckets(spark, rolled(rollup, source, due), path, due)
        mark.water = max(mark.water, due[-1][1])
    if due or not same:
        write_mark(spark, path, Mark(mark.upto, mark.water, left))
    return due


def _floor(moment: datetime, rollup: Rollup) -> datetime:
    return widened([(moment, moment + timedelta(microseconds=1))], rollup.width)[0][0]


def read_fresh(
    spark: SparkSession, rollup: Rollup, table: str, path: str, start: Instant, end: Instant
) -> DataFrame:
    """Buckets that start in ``[start, end)``, equal to the rollup of all rows that there are now.

    Stored buckets are read where nothing has changed since the last refresh. The changed ones
    and those above the high-water mark come from raw rows, whose scan is cut to these spans.
    """
    start, end = instant(start), instant(end)
    mark, _, source, spans = _stale(spark, rollup, table, path)
    spans = [*spans, (mark.water, max(mark.water, end))]
    raw = clipped(widened(spans, rollup.width), _floor(start, rollup), _ceiling(end, rollup))
    raw = joined(raw, RANGES)
    wanted = (F.col("bucket") >= at(start)) & (F.col("bucket") < at(end))
    fresh = rolled(rollup, source, raw).filter(wanted)
    if not exists(spark, path):
        return fresh
    stored = within(read_days(spark, path, "bucket"), start, end, time="bucket").drop(DAY)
    for low, high in raw:
        stored = stored.filter((F.col("bucket") < at(low)) | (F.col("bucket") >= at(high)))
    return stored.unionByName(fresh, allowMissingColumns=True) if raw else stored


def _ceiling(moment: datetime, rollup: Rollup) -> datetime:
    low = _floor(moment, rollup)
    return moment if low == moment else widened([(low, moment)], rollup.width)[0][1]
