"""Day-partitioned Parquet tables: read, append, replace days, drop days.

A fact table is a folder of ``day=YYYY-MM-DD`` partitions. Writes ask Spark for
a rebalance by day, so adaptive execution splits an over-full day and merges
small ones instead of sending each day to a single task.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions.instants import PARTITION_OF
from tidemark.sources.ledger import Span, has_ledger, hours_of, noted

DAY = "day"


def _with_day(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField(DAY, T.DateType(), True)])


def _marked(df: DataFrame, time: str) -> DataFrame:
    """Say of the day column that it is a partition made from ``time``."""
    return df.withMetadata(DAY, {PARTITION_OF: time}) if DAY in df.columns else df


def read_days(spark: SparkSession, path: str, time: str = "time") -> DataFrame:
    """A day-partitioned table with the columns it was stored with."""
    return _marked(spark.read.parquet(path), time)


def read_table(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A table with a known schema: no inference pass over the files."""
    return spark.read.schema(schema).parquet(path)


def load_records(spark: SparkSession, path: str) -> DataFrame:
    return _marked(read_table(spark, path, _with_day(schemas.RECORDS)), "time")


def load_entities(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.ENTITIES)


def load_ticks(spark: SparkSession, path: str) -> DataFrame:
    return _marked(read_table(spark, path, _with_day(schemas.TICKS)), "time")


def load_ohlc(spark: SparkSession, path: str) -> DataFrame:
    return _marked(read_table(spark, path, _with_day(schemas.OHLC)), "time")


def load_aggregates(spark: SparkSession, path: str) -> DataFrame:
    return _marked(read_table(spark, path, _with_day(schemas.AGGREGATES)), "time")


def load_symbols(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.SYMBOLS)


def load_data_sources(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.DATA_SOURCES)


def load_run_log(spark: SparkSession, path: str) -> DataFrame:
    return read_table(spark, path, schemas.RUN_LOG)


def with_day(df: DataFrame, time: str = "time") -> DataFrame:
    return df.withColumn(DAY, F.to_date(time))


def append_days(df: DataFrame, path: str, time: str = "time") -> None:
    """Append rows below their days."""
    spark = df.sparkSession
    with noted(spark, path, hours_of(df, time) if has_ledger(spark, path) else ()):
        _rebalanced(with_day(df, time)).write.mode("append").partitionBy(DAY).parquet(path)


def replace_days(df: DataFrame, path: str, time: str = "time", changed: Sequence[Span] = ()) -> None:
    """Put the rows in place of what their days held; other days stay.

    Spark stages the new files and swaps them in when the job commits, so the
    rows may come from the table itself. ``changed`` is what the ledger notes, if
    the table keeps one.
    """
    with noted(df.sparkSession, path, changed):
        (
            _rebalanced(with_day(df, time))
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy(DAY)
            .parquet(path)
        )


def _rebalanced(df: DataFrame) -> DataFrame:
    return df.hint("rebalance", F.col(DAY))


def days_of(df: DataFrame, time: str = "time") -> list[date]:
    """The distinct days of a frame: as many values as there are days."""
    return sorted(r[0] for r in df.select(F.to_date(time)).distinct().collect() if r[0])


def on_days(df: DataFrame, days: Sequence[date]) -> DataFrame:
    """Rows of the given day partitions, named literally so that all others are pruned."""
    return df.filter(F.col(DAY).isin(list(days)) if days else F.lit(False))


def exists(spark: SparkSession, path: str) -> bool:
    root, system = _files(spark, path)
    return system.exists(root) and bool(system.listStatus(root))


def folders(spark: SparkSession, path: str, prefix: str) -> list[str]:
    """The names below a path that begin so; none where there is no such path."""
    root, system = _files(spark, path)
    if not system.exists(root):
        return []
    names = [status.getPath().getName() for status in system.listStatus(root)]
    return sorted(name for name in names if name.startswith(prefix))


def stored_days(spark: SparkSession, path: str) -> list[date]:
    """The day partitions of a table, read from its folder names."""
    prefix = f"{DAY}="
    return sorted(
        date.fromisoformat(name.removeprefix(prefix))
        for name in folders(spark, path, prefix)
        if name != f"{prefix}__HIVE_DEFAULT_PARTITION__"
    )


def day_bytes(spark: SparkSession, path: str, days: Sequence[date]) -> dict[date, int]:
    """Stored bytes of each day, from the file listing."""
    found = {}
    for day in days:
        folder, system = _files(spark, f"{path.rstrip('/')}/{DAY}={day.isoformat()}")
        found[day] = sum(f.getLen() for f in system.listStatus(folder) if f.getPath().getName()[0] not in "_.")
    return found


def day_files(spark: SparkSession, path: str, days: Sequence[date]) -> dict[date, frozenset[str]]:
    """The names of each day's files, from the file listing; none for a day that is not there."""
    found = {}
    for day in days:
        folder, system = _files(spark, f"{path.rstrip('/')}/{DAY}={day.isoformat()}")
        files = system.listStatus(folder) if system.exists(folder) else []
        found[day] = frozenset(f.getPath().getName() for f in files)
    return found


def drop_folder(spark: SparkSession, path: str) -> bool:
    """Remove a folder that the library itself wrote, wherever it is stored."""
    folder, system = _files(spark, path)
    return bool(system.delete(folder, True))


def drop_days(spark: SparkSession, path: str, days: Sequence[date]) -> int:
    """Remove whole day partitions without reading them; returns how many."""
    dropped = 0
    for day in days:
        folder, system = _files(spark, f"{path.rstrip('/')}/{DAY}={day.isoformat()}")
        dropped += bool(system.delete(folder, True))
    return dropped


def _files(spark: SparkSession, path: str):
    """A Hadoop path and its file system, whichever store it is on."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark._jsc.hadoopConfiguration())
