"""Streaming ingest, rollups, latest values, alerts and silence detection.

Each function either turns a streaming frame into another (rollups, alerts,
silence) or starts a query that keeps a stored table up to date (ingest,
latest). Everything runs on Spark's own stateful operators.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from tidemark.functions.buckets import ORIGIN, Width, bucket_index, bucket_start, parse_width
from tidemark.functions.measures import VALUE_COLUMNS, first_by, last_by
from tidemark.operators.quality import REASON, with_record_reason
from tidemark.operators.reads import Bounds, threshold_alerts
from tidemark.plans.rollups import ohlcv_columns
from tidemark.sources.ingest import RECORD_KEY, merge_rows, upsert_days
from tidemark.sources.ledger import Log
from tidemark.sources.tables import DAY, drop_folder, exists, folders, load_records


def read_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    *,
    files: str | None = None,
    max_files: int | None = None,
) -> DataFrame:
    """New Parquet files of a folder as a stream, a bounded number per trigger."""
    reader = spark.readStream.schema(schema)
    if files is not None:
        reader = reader.option("pathGlobFilter", files)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


MONTH = 31  # days of any month on the even calendar


def tumbling(width: str | Width, time: str = "time") -> Column:
    """Window column on the same grid as the batch buckets, for widths of a fixed length."""
    width = parse_width(width)
    if width.months:
        raise ValueError("a calendar width has no window of a fixed length; stream_bucket_agg and stream_rollup take it")
    shift = int((ORIGIN - datetime(1970, 1, 1)).total_seconds() % width.seconds)
    length = f"{int(width.seconds)} seconds"
    return F.window(time, length, length, f"{shift} seconds")


def even_calendar(width: str | Width, time: str = "time") -> Column:
    """A time on a calendar whose months all have 31 days: its bucket there has a fixed length.

    The distance from the start of the bucket stays what it is, so the order of times stays too,
    and a bucket there ends when the next one begins.
    """
    width, index = parse_width(width), bucket_index(time, width)
    inside = F.unix_micros(time) - F.unix_micros(bucket_start(index, width))
    return F.timestamp_micros(index * F.lit(_even_micros(width)) + inside)


def _even_micros(width: Width) -> int:
    return width.months * MONTH * 86_400_000_000


def even_delay(lateness: str | Width) -> str:
    """A watermark delay on the even calendar that closes no bucket before ``lateness`` has passed.

    Between two times there lie, beyond their distance, up to three days for every whole month.
    """
    given = parse_width(lateness)
    seconds = given.months * MONTH * 86_400 if given.months else int(given.seconds)
    return f"{seconds + 3 * 86_400 * (seconds // (28 * 86_400))} seconds"


def _bucketed(rows: DataFrame, width: str | Width, lateness: str, keys: Sequence[str], sums: Sequence[Column]) -> DataFrame:
    """Rows summed up by bucket and ``keys``; calendar buckets are windows of the even calendar."""
    width = parse_width(width)
    if width.months:
        place = rows.withColumn("_place", even_calendar(width)).withWatermark("_place", even_delay(lateness))
        window = F.window("_place", f"{width.months * MONTH} days")
        index = _whole(F.unix_micros("_window.start"), _even_micros(width))
        start = bucket_start(index, width)
    else:
        place, window, start = rows.withWatermark("time", lateness), tumbling(width), F.col("_window.start")
    summed = place.groupBy(window.alias("_window"), *keys).agg(*sums)
    return summed.withColumn("bucket", start).drop("_window")


def _whole(number: Column, unit: int) -> Column:
    return F.call_function("div", number, F.lit(unit))


def stream_bucket_agg(records: DataFrame, width: str | Width, lateness: str) -> DataFrame:
    """Bucket statistics per entity, each bucket sent once it can no longer change.

    Months and years close by the calendar, ``lateness`` after their last day.
    """
    sums = [
        F.count(F.lit(1)).alias("count"),
        F.avg("value").alias("avg"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
        F.sum("value").alias("sum"),
        first_by("value").alias("first"),
        last_by("value").alias("last"),
        F.stddev("value").alias("stddev"),
    ]
    return _bucketed(records, width, lateness, ["entity_id"], sums)


def stream_rollup(
    ticks: DataFrame,
    width: str | Width,
    lateness: str,
    extras: Sequence[Column] = (),
    keys: Sequence[str] = ("symbol", "exchange", "data_source"),
) -> DataFrame:
    """Bars from a tick stream, each sent once it can no longer change.

    The watermark delay plays the part of a refresh policy's end offset. Ticks
    that come later still are picked up by a batch refresh of the window. Months and
    years close by the calendar.
    """
    return _bucketed(ticks, width, lateness, keys, [*ohlcv_columns(), *extras])


def stream_alerts(df: DataFrame, limits: Mapping[str, Bounds]) -> DataFrame:
    """Out-of-range rows as they arrive; no state."""
    return threshold_alerts(df, limits)


def get_ohlc_stream(bars: DataFrame, interval: str, symbol: str | None = None) -> DataFrame:
    """Bars of one interval code as they arrive; no state."""
    wanted = bars.filter(F.col("interval_duration") == interval)
    return wanted if symbol is None else wanted.filter(F.col("symbol") == symbol)


def stream_stale(records: DataFrame, minutes: int, lateness: str) -> DataFrame:
    """One row each time an entity has been silent for ``minutes`` of event time.

    A session that closes is an entity that went silent, so the built-in session
    window does the work, with sessions merged before the shuffle.
    """
    gap = f"{minutes} minutes"
    return (
        records.withWatermark("time", lateness)
        .groupBy(F.session_window("time", gap).alias("_session"), "entity_id")
        .agg(F.max("time").alias("last_seen"))
        .select("entity_id", "last_seen", F.col("_session.end").alias("silent_at"))
    )


def stream_dedupe(records: DataFrame, lateness: str) -> DataFrame:
    """First row of each entity and time within the watermark."""
    return records.withWatermark("time", lateness).dropDuplicatesWithinWatermark(
        ["entity_id", "time"]
    )


def stream_ingest(
    raw: DataFrame,
    path: str,
    checkpoint: str,
    *,
    rejects_path: str | None = None,
) -> DataStreamWriter:
    """Validate a stream and add it to a stored table, batch by batch.

    A batch is written, by its number, beside the days of the table, so a trigger
    writes what arrived and nothing else, and a batch replayed after a failure takes
    its own place. :func:`merged_records` reads both; :func:`fold_pending` merges the
    pending batches into the days, as often as suits. Rejects go by batch number too.
    """

    def store(batch: DataFrame, number: int) -> None:
        judged = with_record_reason(batch).persist()
        good = judged.filter(F.col(REASON).isNull()).drop(REASON)
        good.write.mode("overwrite").parquet(f"{pending_path(path)}/{BATCH}={number}")
        if rejects_path is not None:
            refused = judged.filter(F.col(REASON).isNotNull())
            refused.write.mode("overwrite").parquet(f"{rejects_path}/{BATCH}={number}")
        judged.unpersist()

    return (
        raw.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


BATCH = "batch"


def pending_path(path: str) -> str:
    """Where batches of a table wait that are not yet merged into its days."""
    return f"{path.rstrip('/')}-pending"


def merged_records(spark: SparkSession, path: str, sequence: Sequence[str] = ()) -> DataFrame:
    """The table with its pending batches put over it, one row per entity and time.

    Of equal keys the row of the later batch wins, inside a batch the last by ``sequence``.
    """
    waiting = exists(spark, pending_path(path))
    if not waiting:
        return load_records(spark, path).drop(DAY)
    pending = spark.read.parquet(pending_path(path))
    if exists(spark, path):
        stored = load_records(spark, path).drop(DAY)
    else:
        stored = pending.drop(BATCH, *sequence).limit(0)
    return merge_rows(stored, pending, RECORD_KEY, [BATCH, *sequence])


def fold_pending(
    spark: SparkSession, path: str, sequence: Sequence[str] = (), checkpoint: str | None = None
) -> int:
    """Merge the waiting batches of finished triggers into the days they touch; returns how many.

    With ``checkpoint``, only batches that the stream has committed are folded. The one after
    them may still be replayed, and its replay must not meet rows that were put into the table
    after it. A fold that failed half way may be repeated, as the batches it has merged go only
    when all of them are in, and numbers below the last one folded are never merged again.
    """
    names = folders(spark, pending_path(path), f"{BATCH}=")
    numbers = sorted(int(n.removeprefix(f"{BATCH}=")) for n in names)
    log = Log(spark, f"{pending_path(path)}-folded")
    done = (log.last() or {"upto": -1})["upto"]
    if checkpoint is not None:
        last = last_committed(spark, checkpoint)
        numbers = [n for n in numbers if n <= last]
    due = [n for n in numbers if n > done]
    if due:
        pending = spark.read.parquet(pending_path(path)).filter(F.col(BATCH).isin(due))
        upsert_days(pending, path, RECORD_KEY, [BATCH, *sequence])
        if checkpoint is not None:
            log.start()
            log.forget(log.append({"upto": due[-1]}) - 1)
    for number in numbers:
        drop_folder(spark, f"{pending_path(path)}/{BATCH}={number}")
    return len(due)


def last_committed(spark: SparkSession, checkpoint: str) -> int:
    """The number of the last batch that a stream has committed, -1 if none; it is never replayed."""
    numbers = [int(n) for n in folders(spark, f"{checkpoint.rstrip('/')}/commits", "") if n.isdigit()]
    return max(numbers, default=-1)


def stream_latest(records: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Keep the newest row of every entity.

    Each batch is summed up to one row per entity and written by its number: a trigger
    writes as much as it brought news, and a replay takes its own place.
    :func:`load_latest` reads the newest of all batches; :func:`fold_latest` makes one
    of them, as often as suits.
    """

    def store(batch: DataFrame, number: int) -> None:
        newest = batch.groupBy("entity_id").agg(
            F.max("time").alias("time"), *[last_by(c).alias(c) for c in VALUE_COLUMNS]
        )
        newest.write.mode("overwrite").parquet(f"{path.rstrip('/')}/{BATCH}={number}")

    return (
        records.writeStream.foreachBatch(store)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


FOLDED = "folded"


def folded_path(path: str) -> str:
    """Where the fold of a table of latest rows is kept, apart from what batches write."""
    return f"{path.rstrip('/')}-{FOLDED}"


def _newest(rows: DataFrame) -> DataFrame:
    """The newest row of every entity; of equal times that of the later batch."""
    newest = Window.partitionBy("entity_id").orderBy(F.desc("time"), F.desc(BATCH))
    return rows.withColumn("_rank", F.row_number().over(newest)).filter(F.col("_rank") == 1).drop("_rank")


def _folds(spark: SparkSession, path: str) -> list[int]:
    return sorted(int(n.removeprefix(f"{FOLDED}=")) for n in folders(spark, folded_path(path), f"{FOLDED}="))


def _all_latest(spark: SparkSession, path: str) -> DataFrame:
    """What the newest whole fold and the batches hold, with the batch that each row is from."""
    parts = []
    folds = [n for n in _folds(spark, path) if exists(spark, f"{folded_path(path)}/{FOLDED}={n}/_SUCCESS")]
    if folds:
        parts.append(spark.read.parquet(f"{folded_path(path)}/{FOLDED}={folds[-1]}"))
    if folders(spark, path, f"{BATCH}=") or not parts:
        parts.append(spark.read.parquet(path).withColumn(BATCH, F.col(BATCH).cast("long")))
    return reduce(DataFrame.unionByName, parts)


def load_latest(spark: SparkSession, path: str) -> DataFrame:
    """The newest row of every entity over the fold and all batches; of equal times the later batch."""
    return _newest(_all_latest(spark, path)).drop(BATCH)


def fold_latest(spark: SparkSession, path: str) -> int:
    """Make one fold of the last one and the batches that are there now; returns how many these were.

    The fold lies in a folder of its own, which no batch writes, and a new one takes the place
    of the last only when it is whole. A batch that is replayed after it was folded is written
    again beside the fold and brings the same rows, so whatever happens no entity is lost.
    """
    numbers = [int(n.removeprefix(f"{BATCH}=")) for n in folders(spark, path, f"{BATCH}=")]
    earlier = _folds(spark, path)
    if numbers:
        target = (earlier[-1] if earlier else 0) + 1
        _newest(_all_latest(spark, path)).write.mode("overwrite").parquet(f"{folded_path(path)}/{FOLDED}={target}")
        for number in earlier:
            drop_folder(spark, f"{folded_path(path)}/{FOLDED}={number}")
        for number in numbers:
            drop_folder(spark, f"{path.rstrip('/')}/{BATCH}={number}")
    return len(numbers) + bool(earlier)


def write_stream(df: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """Append finished rows of a stream to a Parquet folder, exactly once."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
    )


def run_available(writer: DataStreamWriter) -> None:
    """Process everything that is there now, then stop."""
    writer.trigger(availableNow=True).start().awaitTermination()
