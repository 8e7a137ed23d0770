"""Validated, idempotent ingest into the stored tables."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from datetime import date
from functools import reduce
from time import perf_counter

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.instants import Instant, at
from tidemark.operators.quality import (
    REASON,
    check_aggregates,
    check_ohlc,
    check_ticks,
    derive_ohlc_columns,
    split_valid,
    split_valid_entities,
    with_record_reason,
)
from tidemark.session import scratch_path
from tidemark.sources.ledger import days_in, has_ledger, hours_of
from tidemark.sources.tables import (
    append_days,
    days_of,
    drop_folder,
    exists,
    on_days,
    replace_days,
    with_day,
)

RECORD_KEY = ("entity_id", "time")
TICK_KEY = ("symbol", "time")
BAR_KEY = ("symbol", "interval_duration", "time")
AGGREGATE_KEY = ("entity_id", "interval_duration", "time")


@dataclass(frozen=True)
class BatchResult:
    """Outcome of a batch: rows stored, rows refused, wall time."""

    processed: int
    failed: int
    duration_ms: float


class BatchError(ValueError):
    """Some rows of a batch were refused; the valid ones are stored."""

    def __init__(self, result: BatchResult):
        super().__init__(f"{result.failed} of {result.processed + result.failed} rows refused")
        self.result = result


def merge_rows(
    existing: DataFrame, incoming: DataFrame, key: Sequence[str], sequence: Sequence[str] = ()
) -> DataFrame:
    """Existing rows with incoming ones put over them, one row per key.

    Among incoming rows of the same key the last by ``sequence`` wins, and of equal
    ones that with the largest values, so that a replay stores the same row. Columns
    that the stored table lacks are refused rather than lost. The rank limit also
    runs before the shuffle, so many copies of a key travel as few.
    """
    unknown = sorted({*incoming.columns} - {*existing.columns, *sequence})
    if unknown:
        raise ValueError(f"the stored table has no columns {', '.join(unknown)}")
    values = [c for c in existing.columns if c not in key and c in incoming.columns]
    latest = Window.partitionBy(*key).orderBy(
        F.col("_new").desc(), *[F.col(c).desc() for c in (*sequence, *values)]
    )
    both = incoming.withColumn("_new", F.lit(True)).unionByName(
        existing.withColumn("_new", F.lit(False)), allowMissingColumns=True
    )
    return (
        both.withColumn("_rank", F.row_number().over(latest))
        .filter(F.col("_rank") == 1)
        .select(*existing.columns)
    )


def upsert_days(
    incoming: DataFrame,
    path: str,
    key: Sequence[str],
    sequence: Sequence[str] = (),
    time: str = "time",
    days: Sequence[date] | None = None,
) -> None:
    """Merge rows into a stored table, rewriting only the days they touch.

    ``days`` spares finding those out, where the caller knows them or some more. A row without one of its key columns belongs to no key and fails the write.
    """
    spark = incoming.sparkSession
    lacking = reduce(Column.__or__, [F.col(c).isNull() for c in key])
    refused = F.raise_error(F.lit(f"a row lacks one of its key columns {', '.join(key)}"))
    incoming = with_day(incoming, time).filter(F.when(lacking, refused.cast("boolean")).otherwise(True))
    changed = hours_of(incoming, time) if has_ledger(spark, path) else ()
    if exists(spark, path):
        if changed:
            touched = days_in(changed)
        else:
            touched = days_of(incoming, time) if days is None else days
        existing = on_days(spark.read.parquet(path), touched)
    else:
        existing = incoming.drop(*sequence).limit(0)
    replace_days(merge_rows(existing, incoming, key, sequence), path, time, changed)


def insert_records(
    records: DataFrame, path: str, *, upsert: bool = False, sequence: Sequence[str] = ()
) -> None:
    """Store the valid ones of the records: plain append, or last write wins per key.

    Both judge each row by the same rules as :func:`insert_many`, which also counts
    and keeps what is refused.
    """
    good, _ = split_valid(records)
    if upsert and dict(records.dtypes)["time"] == "timestamp":
        # The days of all rows hold those of the good ones; no rule has to run for them.
        upsert_days(good, path, RECORD_KEY, sequence, days=days_of(records))
    else:
        _store(good, path, upsert, sequence)


def upsert_records(records: DataFrame, path: str, sequence: Sequence[str] = ()) -> None:
    insert_records(records, path, upsert=True, sequence=sequence)


def _store(good: DataFrame, path: str, upsert: bool, sequence: Sequence[str]) -> None:
    if upsert:
        upsert_days(good, path, RECORD_KEY, sequence)
    else:
        append_days(good, path)


def insert_many(
    raw: DataFrame,
    path: str,
    *,
    rejects_path: str | None = None,
    upsert: bool = True,
    sequence: Sequence[str] = (),
    strict: bool = False,
) -> BatchResult:
    """Validate a batch of any size, store what is valid and count both sides.

    The batch is typed and judged once and written to the shared folder, so the
    source is read once and all writes see the same verdict; the counts are observed
    on the way. The written batch goes when both sides are stored.
    """
    began = perf_counter()
    seen = Observation()
    judged = with_record_reason(raw).observe(
        seen,
        F.count_if(F.col(REASON).isNull()).alias("good"),
        F.count_if(F.col(REASON).isNotNull()).alias("bad"),
    )
    spark, staged = raw.sparkSession, scratch_path(raw.sparkSession, "batch")
    judged.write.parquet(staged)
    judged = spark.read.schema(judged.schema).parquet(staged)
    _store(judged.filter(F.col(REASON).isNull()).drop(REASON), path, upsert, sequence)
    if rejects_path is not None:
        judged.filter(F.col(REASON).isNotNull()).write.mode("append").parquet(rejects_path)
    drop_folder(spark, staged)
    counts = seen.get
    result = BatchResult(counts["good"], counts["bad"], (perf_counter() - began) * 1000)
    if strict and result.failed:
        raise BatchError(result)
    return result


def insert_ticks(ticks: DataFrame, path: str, sequence: Sequence[str] = ()) -> None:
    """Store ticks that meet the tick rules, last write wins per symbol and time."""
    upsert_days(check_ticks(ticks).filter("is_valid").drop("is_valid"), path, TICK_KEY, sequence)


def insert_ohlc(bars: DataFrame, path: str, sequence: Sequence[str] = ()) -> None:
    """Store bars that meet the bar rules, with their derived columns."""
    good = check_ohlc(bars).filter("is_valid").drop("is_valid")
    upsert_days(derive_ohlc_columns(good), path, BAR_KEY, sequence)


def insert_aggregates(aggregates: DataFrame, path: str, sequence: Sequence[str] = ()) -> None:
    """Store pre-computed aggregates whose numbers agree with each other."""
    good = check_aggregates(aggregates).filter("is_valid").drop("is_valid")
    spread = good.withColumn("value_range", F.col("max_value") - F.col("min_value"))
    upsert_days(spread, path, AGGREGATE_KEY, sequence)


def upsert_entities(
    existing: DataFrame, incoming: DataFrame, as_of: Instant, sequence: Sequence[str] = ()
) -> DataFrame:
    """The entity table with valid incoming entities put over it.

    ``created_at`` of a known entity is kept; ``updated_at`` becomes ``as_of``.
    """
    good, _ = split_valid_entities(incoming)
    known = existing.select("entity_id", F.col("created_at").alias("_created"))
    stamped = (
        good.join(known, "entity_id", "left")
        .withColumn("created_at", F.coalesce("_created", "created_at", at(as_of)))
        .withColumn("updated_at", at(as_of))
        .drop("_created")
    )
    return merge_rows(existing, stamped, ["entity_id"], sequence)


def insert_if_absent(existing: DataFrame, incoming: DataFrame, key: Sequence[str]) -> DataFrame:
    """The incoming rows whose key is not there yet, one per key, ready to append."""
    return incoming.join(existing.select(*key), list(key), "left_anti").dropDuplicates(list(key))


def copy_table(
    source: DataFrame, path: str, mapping: Callable[[DataFrame], DataFrame] | None = None
) -> None:
    """Move a whole source table into the record layout in one distributed job."""
    rows = source if mapping is None else mapping(source)
    append_days(rows.select(*[f.name for f in schemas.RECORDS.fields]), path)

