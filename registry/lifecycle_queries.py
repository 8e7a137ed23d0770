"""Retention, archiving, compaction, reports on stored tables."""

from pyspark.sql import functions as F

from registry.core import AS_OF, END, START, query
from tidemark.operators import lifecycle
from tidemark.session import scratch_path
from tidemark.sources import tables

_TICKS = "time, symbol, price, volume"


def _cutoff(days: int) -> str:
    return f"date_trunc('day', time) + INTERVAL 1 DAY <= TIMESTAMP '{AS_OF}' - INTERVAL {days} DAY"


@query(
    "apply_retention",
    f"SELECT {_TICKS} FROM price_ticks WHERE NOT ({_cutoff(14)})",
    "price volume",
)
def _(t):
    kept = lifecycle.apply_retention(t.price_ticks, 14, AS_OF)
    return kept.select("time", "symbol", "price", "volume")


@query(
    "retention_by_symbol",
    f"SELECT {_TICKS} FROM price_ticks WHERE NOT ({_cutoff(10)} AND symbol LIKE '%R%')",
    "price volume",
)
def _(t):
    kept = lifecycle.retention_by_symbol(t.price_ticks, AS_OF, "%R%", 10)
    return kept.select("time", "symbol", "price", "volume")


@query(
    "retention_by_symbol_days",
    f"""SELECT o_orderdate AS time, o_orderpriority AS symbol, o_totalprice AS price FROM orders
    WHERE CAST(o_orderdate AS DATE) NOT IN (
        SELECT CAST(o_orderdate AS DATE) FROM orders
        WHERE o_orderdate + INTERVAL 1 DAY <= TIMESTAMP '{AS_OF}' - INTERVAL 9000 DAY
          AND o_orderpriority LIKE '1-%')""",
    "price",
)
def _(t):
    ticks = t.orders.select(
        F.col("o_orderdate").alias("time"),
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_totalprice").alias("price"),
    )
    return lifecycle.retention_by_symbol(ticks, AS_OF, "1-%", 9000, chunk_semantics=True)


_OLD_AS_OF = "2001-06-01"
_RETAINED_AS_OF, _RETAINED_DAYS = "2024-08-01 00:00:00", 197
_RETAINED = (
    f"date_trunc('day', time) + INTERVAL 1 DAY <= TIMESTAMP '{_RETAINED_AS_OF}' - {{days}} * INTERVAL 1 DAY"
)


@query(
    "tiered_ohlc_retention",
    f"""SELECT * FROM old_bars
    WHERE NOT (date_trunc('day', time) + INTERVAL 1 DAY <= TIMESTAMP '{_OLD_AS_OF}' -
        (CASE interval_duration WHEN '1h' THEN 730 ELSE 1825 END) * INTERVAL 1 DAY)""",
    "close",
)
def _(t):
    return lifecycle.tiered_ohlc_retention(t.old_bars, _OLD_AS_OF)


@query(
    "archive_inactive_sources",
    f"""SELECT name, name <> 'S_idle' AS is_active,
           CASE WHEN name = 'S_idle' THEN TIMESTAMP '{AS_OF}' ELSE updated_at END AS updated_at
    FROM data_sources""",
)
def _(t):
    return lifecycle.archive_inactive_sources(t.data_sources, t.price_ticks, t.ohlc_data, AS_OF)


@query(
    "tiered_ohlc_retention_days",
    f"""SELECT * FROM old_bars WHERE CAST(time AS DATE) NOT IN (
        SELECT CAST(time AS DATE) FROM old_bars
        WHERE date_trunc('day', time) + INTERVAL 1 DAY <= TIMESTAMP '{_OLD_AS_OF}' -
            (CASE interval_duration WHEN '1h' THEN 730 ELSE 1825 END) * INTERVAL 1 DAY)""",
    "close",
)
def _(t):
    return lifecycle.tiered_ohlc_retention(t.old_bars, _OLD_AS_OF, chunk_semantics=True)


def _retained(t):
    """A whole retention run; paths of ticks and bars, the new sources and the new log."""
    ticks_path, bars_path = scratch_path(t.spark, "ticks"), scratch_path(t.spark, "bars")
    tables.append_days(t.price_ticks, ticks_path)
    tables.append_days(t.ohlc_data, bars_path)
    log = lifecycle.run_log_row(t.spark, "start_", "first run", START)
    sources, log = lifecycle.run_retention(
        t.spark,
        _RETAINED_AS_OF,
        ticks_path=ticks_path,
        bars_path=bars_path,
        sources=t.data_sources,
        log=log,
        tick_days=_RETAINED_DAYS,
    )
    return ticks_path, bars_path, sources, log


@query(
    "run_retention",
    f"SELECT {_TICKS} FROM price_ticks WHERE NOT ({_RETAINED.format(days=_RETAINED_DAYS)})",
    "price volume",
)
def _(t):
    return t.spark.read.parquet(_retained(t)[0]).select("time", "symbol", "price", "volume")


@query(
    "run_retention_bars",
    f"""SELECT time, symbol, data_source, interval_duration, close FROM ohlc_data
    WHERE NOT ({_RETAINED.format(days="(CASE interval_duration WHEN '15m' THEN 180 WHEN '30m' THEN 365 ELSE 730 END)")})""",
    "close",
)
def _(t):
    bars = t.spark.read.parquet(_retained(t)[1])
    return bars.select("time", "symbol", "data_source", "interval_duration", "close")


@query(
    "run_retention_sources",
    f"SELECT name, FALSE AS is_active, TIMESTAMP '{_RETAINED_AS_OF}' AS updated_at FROM data_sources",
)
def _(t):
    return _retained(t)[2]


@query(
    "run_retention_log",
    f"""SELECT 'start_2024_01_01_00_00_00' AS version, 'first run' AS description,
           TIMESTAMP '{START}' AS applied_at, CAST(NULL AS VARCHAR) AS applied_by
    UNION ALL
    SELECT 'retention_run_2024_08_01_00_00_00',
           'retention: ' || (SELECT count(DISTINCT CAST(time AS DATE)) FROM price_ticks
               WHERE {_RETAINED.format(days=_RETAINED_DAYS)}) || ' tick days dropped; '
           || (SELECT count(*) FROM ohlc_data WHERE {_RETAINED.format(days=180)}
               AND interval_duration = '15m') || ' bars removed',
           TIMESTAMP '{_RETAINED_AS_OF}', NULL""",
)
def _(t):
    return _retained(t)[3]


@query("compact_partitions", f"SELECT {_TICKS} FROM price_ticks", "price volume")
def _(t):
    path = scratch_path(t.spark, "ticks")
    tables.append_days(t.price_ticks, path)
    lifecycle.compact_partitions(t.spark, path, ["symbol"], 7, AS_OF)
    return t.spark.read.parquet(path).select("time", "symbol", "price", "volume")


@query(
    "partition_report",
    f"""SELECT date_trunc('day', time) AS day, count(*) AS row_count,
           CASE WHEN {_cutoff(7)} THEN 1 ELSE 3 END AS file_count, TRUE AS has_bytes,
           'keep' AS recommendation
    FROM (SELECT * FROM price_ticks) GROUP BY 1, {_cutoff(7)}
    UNION ALL SELECT date_trunc('day', time) - INTERVAL 10000 DAY, count(*), 3, TRUE, 'compact'
    FROM price_ticks GROUP BY 1""",
)
def _(t):
    """Three files per day; the days old enough are compacted, and then an older table is reported too."""
    path, old = scratch_path(t.spark, "ticks"), scratch_path(t.spark, "ticks")
    for part in (0, 1, 2):
        some = t.price_ticks.filter(F.pmod(F.xxhash64("time"), F.lit(3)) == part)
        some = some.withColumn("day", F.to_date("time")).repartition("day")
        some.write.mode("append").partitionBy("day").parquet(path)
        moved = some.withColumn("time", F.col("time") - F.expr("INTERVAL 10000 DAYS"))
        moved.withColumn("day", F.to_date("time")).repartition("day").write.mode("append").partitionBy("day").parquet(old)
    lifecycle.compact_partitions(t.spark, path, ["symbol"], 7, AS_OF)
    reports = [lifecycle.partition_report(t.spark.read.parquet(p), AS_OF) for p in (path, old)]
    return reports[0].unionByName(reports[1]).select(
        "day", "row_count", "file_count", (F.col("total_bytes") > 0).alias("has_bytes"), "recommendation"
    )


@query(
    "maintenance_entry",
    """SELECT 'maintenance_2024_01_31_00_00_00' AS version,
           string_agg('price_ticks ' || strftime(day, '%Y-%m-%d') || ': compact', chr(10) ORDER BY day) AS description,
           TIMESTAMP '2024-01-31' AS applied_at, CAST(NULL AS VARCHAR) AS applied_by
    FROM (SELECT DISTINCT CAST(time AS DATE) AS day FROM price_ticks)
    WHERE day + INTERVAL 1 DAY <= TIMESTAMP '2024-01-31' - INTERVAL 7 DAY""",
)
def _(t):
    path = scratch_path(t.spark, "ticks")
    for part in (0, 1):
        some = t.price_ticks.filter(F.pmod(F.xxhash64("time"), F.lit(2)) == part)
        some.withColumn("day", F.to_date("time")).repartition("day").write.mode("append").partitionBy("day").parquet(path)
    report = lifecycle.partition_report(t.spark.read.parquet(path), AS_OF)
    return lifecycle.maintenance_entry(report, "price_ticks", AS_OF)


@query(
    "clean_ticks_table",
    "SELECT time, symbol, price - 20 AS price, volume FROM price_ticks WHERE price - 20 > 0",
    "price volume",
)
def _(t):
    path = scratch_path(t.spark, "ticks")
    tables.append_days(t.price_ticks.withColumn("price", F.col("price") - 20), path)
    lifecycle.clean_ticks_table(t.spark, path, START, END)
    return t.spark.read.parquet(path).select("time", "symbol", "price", "volume")
