"""Retention, archiving, compaction and the reports that go with them."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, at, back, instant, within
from tidemark.operators.latest import keep_newest
from tidemark.operators.quality import CLEANED_MESSAGE, clean_ticks
from tidemark.sources.ledger import joined, noted
from tidemark.sources.tables import (
    DAY,
    day_bytes,
    drop_days,
    on_days,
    read_days,
    replace_days,
    stored_days,
)

# Days each table is kept, and days each bar interval is kept.
TABLE_KEEP_DAYS = {"price_ticks": 730, "ohlc_data": 1825, "time_series_data": 365}
OHLC_KEEP_DAYS = {
    "1m": 30,
    "5m": 90,
    "15m": 180,
    "30m": 365,
    "1h": 730,
    "4h": 1095,
    "1d": 1825,
    "1w": 3650,
    "1M": 3650,
}

# Sort key of a compacted table and its age in days.
COMPACTION = {
    "price_ticks": (("symbol",), 7),
    "ohlc_data": (("symbol", "interval_duration"), 3),
    "time_series_data": (("entity_id",), 7),
}
KEEP_LOG_ROWS = 20
FILE_BYTES = 256 * 1024 * 1024  # of a compacted file, at most about


def _first_kept_day(days: float, as_of: Instant) -> datetime:
    """Start of the earliest day that is not over for at least ``days``.

    A constant, so the cut reaches the scan and prunes day partitions.
    """
    return back(as_of, days=days).replace(hour=0, minute=0, second=0, microsecond=0)


def apply_retention(df: DataFrame, keep_days: float, as_of: Instant) -> DataFrame:
    """Rows whose day is not yet past the keeping time."""
    return within(df, _first_kept_day(keep_days, as_of))


def retention_by_symbol(
    ticks: DataFrame,
    as_of: Instant,
    pattern: str = "%",
    days: float = 730,
    *,
    chunk_semantics: bool = False,
) -> DataFrame:
    """Rows that stay when old rows of matching symbols go.

    With ``chunk_semantics`` an old day goes as a whole as soon as it holds one
    matching row; the table of such days has one row per day.
    """
    cutoff = _first_kept_day(days, as_of)
    matching = F.col("symbol").like(pattern)
    if not chunk_semantics:
        return ticks.filter((F.col("time") >= at(cutoff)) | ~matching)
    marked = within(ticks, end=cutoff).filter(matching).select(F.to_date("time").alias("_day")).distinct()
    return ticks.join(marked, F.to_date("time") == F.col("_day"), "left_anti")


def tiered_ohlc_retention(
    bars: DataFrame, as_of: Instant, *, chunk_semantics: bool = False
) -> DataFrame:
    """Bars that stay: finer intervals are kept for a shorter time.

    Intervals without a tier are kept. With ``chunk_semantics`` an expired bar
    takes its whole day along.
    """
    cutoff = F.coalesce(
        *[
            F.when(F.col("interval_duration") == code, at(_first_kept_day(days, as_of)))
            for code, days in OHLC_KEEP_DAYS.items()
        ]
    )
    expired = F.coalesce(F.col("time") < cutoff, F.lit(False))
    if not chunk_semantics:
        return bars.filter(~expired)
    marked = bars.filter(expired).select(F.to_date("time").alias("_day")).distinct()
    return bars.join(marked, F.to_date("time") == F.col("_day"), "left_anti")


def archive_inactive_sources(
    sources: DataFrame,
    ticks: DataFrame,
    bars: DataFrame,
    as_of: Instant,
    inactive_days: float = 365,
    recent_days: float = 30,
) -> DataFrame:
    """The sources table with long-silent sources switched off."""
    cutoff = back(as_of, days=recent_days)

    def active(df: DataFrame) -> DataFrame:
        return within(df, cutoff).filter(F.col("time") > at(cutoff)).select("data_source").distinct()

    names = active(ticks).union(active(bars)).distinct()
    known = names.select(F.col("data_source").alias("name"), F.lit(True).alias("_recent"))
    archive = (
        F.col("is_active")
        & (F.col("updated_at") < at(back(as_of, days=inactive_days)))
        & F.col("_recent").isNull()
    )
    return (
        sources.join(known, "name", "left")
        .withColumn("_archive", F.coalesce(archive, F.lit(False)))
        .withColumn("is_active", F.when(F.col("_archive"), False).otherwise(F.col("is_active")))
        .withColumn(
            "updated_at", F.when(F.col("_archive"), at(as_of)).otherwise(F.col("updated_at"))
        )
        .select(*sources.columns)
    )


def drop_expired_days(spark: SparkSession, path: str, keep_days: float, as_of: Instant) -> list[date]:
    """Drop expired day partitions of a stored table; no row is read."""
    expired = expired_days(spark, path, keep_days, as_of)
    drop_days(spark, path, expired)
    return expired


def expired_days(spark: SparkSession, path: str, keep_days: float, as_of: Instant) -> list[date]:
    cutoff = _first_kept_day(keep_days, as_of)
    return [d for d in stored_days(spark, path) if instant(d) < cutoff]


def rewrite_days(
    spark: SparkSession,
    path: str,
    days: Sequence[date],
    kept: DataFrame,
    source: DataFrame,
    note: bool = False,
) -> int:
    """Put ``kept`` in place of the rows of ``days`` in ``source``; returns rows removed.

    Days that keep no row are dropped, since an overwrite only replaces days it
    has rows for. With ``note``, a table that keeps a ledger notes the days that change.
    """
    if not days:
        return 0
    before = {r[DAY]: r["n"] for r in _rows_per_day(on_days(source, days))}
    after = {r[DAY]: r["n"] for r in _rows_per_day(on_days(kept, days))}
    changed = [d for d in before if after.get(d, 0) not in (0, before[d])]
    gone = [d for d in before if d not in after]
    spans = joined([(instant(d), instant(d) + timedelta(days=1)) for d in (*changed, *gone)])
    with noted(spark, path, spans if note else ()):
        if changed:
            replace_days(on_days(kept, changed), path)
        drop_days(spark, path, gone)
    return sum(before.values()) - sum(after.values())


def _rows_per_day(df: DataFrame) -> list:
    return df.groupBy(DAY).agg(F.count(F.lit(1)).alias("n")).collect()


def clean_ticks_table(
    spark: SparkSession, path: str, start: Instant, end: Instant, symbol: str | None = None
) -> str:
    """Remove invalid prices from a stored table, rewriting only days that hold some."""
    stored = read_days(spark, path)
    kept = clean_ticks(stored, start, end, symbol, dry_run=False)
    low, high = instant(start).date(), instant(end).date()
    days = [d for d in stored_days(spark, path) if low <= d <= high]
    return CLEANED_MESSAGE % rewrite_days(spark, path, days, kept, stored, note=True)


def run_retention(
    spark: SparkSession,
    as_of: Instant,
    *,
    ticks_path: str,
    bars_path: str,
    sources: DataFrame,
    log: DataFrame,
    symbol_pattern: str = "%",
    tick_days: float = TABLE_KEEP_DAYS["price_ticks"],
) -> tuple[DataFrame, DataFrame]:
    """Run every retention job; returns the new sources table and the new run log.

    Ticks of all symbols go by dropping day folders. Otherwise, and for bars,
    only days old enough for some tier are read and rewritten.
    """
    if symbol_pattern == "%":
        tick_note = f"{len(drop_expired_days(spark, ticks_path, tick_days, as_of))} tick days dropped"
    else:
        ticks = read_days(spark, ticks_path)
        kept = retention_by_symbol(ticks, as_of, symbol_pattern, tick_days)
        days = expired_days(spark, ticks_path, tick_days, as_of)
        tick_note = f"{rewrite_days(spark, ticks_path, days, kept, ticks)} ticks removed"
    bars = read_days(spark, bars_path)
    tiered = tiered_ohlc_retention(bars, as_of)
    due = expired_days(spark, bars_path, min(OHLC_KEEP_DAYS.values()), as_of)
    bar_note = f"{rewrite_days(spark, bars_path, due, tiered, bars)} bars removed"
    archived = archive_inactive_sources(
        sources, read_days(spark, ticks_path), read_days(spark, bars_path), as_of
    )
    kept_log, _ = keep_newest(log, KEEP_LOG_ROWS, "version")
    note = f"retention: {tick_note}; {bar_note}"
    return archived, kept_log.unionByName(run_log_row(spark, "retention_run_", note, as_of))


def _version(prefix: str, as_of: Instant) -> Column:
    stamp = F.date_format(at(as_of), "yyyy_MM_dd_HH_mm_ss")
    return F.concat(F.lit(prefix), stamp).alias("version")


def run_log_row(spark: SparkSession, prefix: str, note: str, as_of: Instant) -> DataFrame:
    """One row for the run log, versioned by its time."""
    return spark.range(1).select(
        _version(prefix, as_of),
        F.lit(note).alias("description"),
        at(as_of).alias("applied_at"),
        F.lit(None).cast("string").alias("applied_by"),
    )


def compact_partitions(
    spark: SparkSession,
    path: str,
    cluster: Sequence[str],
    older_than_days: float,
    as_of: Instant,
    target_bytes: int = FILE_BYTES,
) -> list[date]:
    """Rewrite old days as few files sorted by key and falling time.

    A day of ``b`` stored bytes becomes at most ``b / target_bytes`` files, rounded up,
    each sorted, so that row groups cover few keys and a read of one key skips the rest.
    A key goes to one file of its day, unless it alone holds more than a file's share;
    such a key is spread over all files of the day by time. Days that are already that
    few files are left alone; a day that shrinks in the rewrite may need fewer still and
    is then rewritten once more. Returns the days that were rewritten.
    """
    old = expired_days(spark, path, older_than_days, as_of)
    sizes = day_bytes(spark, path, old)
    files = {d: max(1, math.ceil(sizes[d] / target_bytes)) for d in old}
    stored = spark.read.parquet(path)
    held = {
        r[DAY]: r["n"]
        for r in on_days(stored, old)
        .groupBy(DAY)
        .agg(F.count_distinct(F.col("_metadata.file_path")).alias("n"))
        .collect()
    } if old else {}
    due = [d for d in old if held.get(d, 0) > files[d]]
    if not due:
        return due
    numbers, first = {}, 0
    for d in due:
        numbers[d] = first
        first += files[d]
    rows = on_days(stored, due)
    count = F.element_at(_by_day(files, due), F.col(DAY))
    if first > len(due):
        shares = rows.groupBy(DAY, *cluster).agg(F.count(F.lit(1)).alias("_n"))
        whole = Window.partitionBy(DAY)
        large = shares.filter(count > 1).withColumn("_all", F.sum("_n").over(whole))
        large = large.filter(F.col("_n") * count > F.col("_all")).select(
            DAY, *cluster, F.lit(True).alias("_large")
        )
        rows = rows.join(large, [DAY, *cluster], "left")
    else:
        rows = rows.withColumn("_large", F.lit(None).cast("boolean"))
    place = F.when(F.col("_large"), F.xxhash64("time")).otherwise(F.xxhash64(*cluster))
    file = F.element_at(_by_day(numbers, due), F.col(DAY)) + F.pmod(place, count)
    (
        rows.withColumn("_file", file)
        .repartitionByRange(first, "_file")
        .sortWithinPartitions(DAY, *cluster, F.col("time").desc())
        .select(*stored.columns)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(DAY)
        .parquet(path)
    )
    return due


def _by_day(values: Mapping[date, int], days: Sequence[date]) -> Column:
    return F.create_map(*[F.lit(x) for d in days for x in (d, values[d])])


def partition_report(
    stored: DataFrame, as_of: Instant, older_than_days: float = 7, target_bytes: int = FILE_BYTES
) -> DataFrame:
    """Rows, files and bytes per stored day, and whether the day should be compacted.

    An old day should be if it has more files than its bytes need at ``target_bytes``
    each, which is what :func:`compact_partitions` leaves.
    """
    per_file = stored.groupBy(
        DAY, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size")
    ).agg(F.count(F.lit(1)).alias("_n"))
    old = F.date_add(DAY, 1).cast("timestamp") <= at(back(as_of, days=older_than_days))
    return (
        per_file.groupBy(DAY)
        .agg(
            F.sum("_n").alias("row_count"),
            F.count(F.lit(1)).alias("file_count"),
            F.sum("_size").alias("total_bytes"),
        )
        .withColumn(
            "recommendation",
            F.when(
                old & (F.col("file_count") > F.ceil(F.col("total_bytes") / target_bytes)), "compact"
            ).otherwise("keep"),
        )
    )


def partition_findings(report: DataFrame, table: str) -> DataFrame:
    """The report's advice as one text, a line per day to compact, for the run log.

    The text has at most one line per stored day.
    """
    line = F.format_string(f"{table} %s: %s", F.col(DAY).cast("string"), F.col("recommendation"))
    lines = F.array_sort(F.collect_list(F.when(F.col("recommendation") == "compact", line)))
    return report.agg(F.concat_ws("\n", lines).alias("_text")).select(
        F.when(F.length("_text") > 0, F.col("_text"))
        .otherwise(F.lit("nothing to do"))
        .alias("description")
    )


def maintenance_entry(report: DataFrame, table: str, as_of: Instant) -> DataFrame:
    """A run-log row that records the findings of :func:`partition_report`."""
    return partition_findings(report, table).select(
        _version("maintenance_", as_of),
        "description",
        at(as_of).alias("applied_at"),
        F.lit(None).cast("string").alias("applied_by"),
    )
