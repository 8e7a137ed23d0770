"""Bucketed and whole-range aggregates, gap filling, reports."""

from pyspark.sql import functions as F

from registry.core import AS_OF, END, START, query
from tidemark.functions.buckets import bucket
from tidemark.operators import aggregates as agg
from tidemark.operators import gaps, reports
from tidemark.session import scratch_path
from tidemark.sources.ingest import insert_aggregates
from tidemark.sources.tables import load_aggregates

_RANGE = f"time >= TIMESTAMP '{START}' AND time < TIMESTAMP '{END}'"
_CLOSED = f"time >= TIMESTAMP '{START}' AND time <= TIMESTAMP '{END}'"
_STATS = (
    "avg({c}) AS {p}avg, min({c}) AS {p}min, max({c}) AS {p}max, sum({c}) AS {p}sum, "
    "arg_min_null({c}, time) AS {p}first, arg_max_null({c}, time) AS {p}last"
)
_BUCKET_NUMBERS = "avg min max sum first last stddev"


def _bucket_sql(interval: str, table: str = "records", where: str = _RANGE) -> str:
    stats = _STATS.format(c="value", p="")
    return (
        f"SELECT time_bucket(INTERVAL '{interval}', time) AS bucket, entity_id, "
        f"count(*) AS count, {stats}, stddev_samp(value) AS stddev "
        f"FROM {table} WHERE {where} GROUP BY bucket, entity_id"
    )


_WIDTHS = {
    "minute": "1 minute",
    "five_minutes": "5 minutes",
    "hour": "1 hour",
    "seven_hours": "7 hours",
    "day": "1 day",
    "week": "7 days",
    "ten_days": "10 days",
    "month": "1 month",
    "quarter": "3 months",
    "year": "1 year",
}


@query(
    "bucket",
    "SELECT time, entity_id, order_key, "
    + ", ".join(f"time_bucket(INTERVAL '{w}', time) AS {n}" for n, w in _WIDTHS.items())
    + " FROM order_records",
)
def _(t):
    return t.order_records.select(
        "time",
        "entity_id",
        "order_key",
        *[bucket("time", width).alias(name) for name, width in _WIDTHS.items()],
    )


@query("time_bucket_agg", _bucket_sql("1 hour"), _BUCKET_NUMBERS)
def _(t):
    return agg.time_bucket_agg(t.records, "1 hour", START, END)


@query("time_bucket_agg_week", _bucket_sql("7 days"), _BUCKET_NUMBERS)
def _(t):
    return agg.time_bucket_agg(t.records, "1w", START, END)


_ORDER_BUCKETS = """
    SELECT time_bucket(INTERVAL '{width}', time) AS bucket, entity_id, count(*) AS count,
           avg(value) AS avg, min(value) AS min, max(value) AS max, sum(value) AS sum
    FROM order_records GROUP BY bucket, entity_id"""
_ORDER_RANGE = ("1990-01-01", "2010-01-01")


@query("aggregated_data_quarter", _ORDER_BUCKETS.format(width="3 months"), "avg min max sum")
def _(t):
    return agg.aggregated_data(t.order_records, *_ORDER_RANGE, width="3 months")


@query("aggregated_data_7h", _ORDER_BUCKETS.format(width="7 hours"), "avg min max sum")
def _(t):
    return agg.aggregated_data(t.order_records, *_ORDER_RANGE, width="7 hours")


@query(
    "time_bucket_page",
    _bucket_sql("1 day") + " ORDER BY bucket DESC, entity_id LIMIT 100 OFFSET 50",
    _BUCKET_NUMBERS,
)
def _(t):
    return agg.time_bucket_agg(t.records, "1 day", START, END, order="desc", limit=100, offset=50)


@query(
    "aggregated_data",
    f"SELECT bucket, entity_id, count, avg, min, max, sum FROM ({_bucket_sql('1 hour')})",
    "avg min max sum",
)
def _(t):
    return agg.aggregated_data(t.records, START, END)


_VALUES = ("value", "value2", "value3", "value4")
_STAT_NAMES = ("avg", "min", "max", "sum", "first", "last")


@query(
    "multi_value_agg",
    "SELECT time_bucket(INTERVAL '1 day', time) AS bucket, entity_id, count(*) AS count, "
    + ", ".join(_STATS.format(c=v, p=f"{v}_stats_") for v in _VALUES)
    + f" FROM records WHERE {_RANGE} GROUP BY bucket, entity_id",
    " ".join(f"{v}_stats_{s}" for v in _VALUES for s in _STAT_NAMES),
)
def _(t):
    return agg.multi_value_agg(t.records, "1 day", START, END)


@query(
    "multi_entity_agg",
    _bucket_sql(
        "4 hours", where=_RANGE + " AND entity_id IN (SELECT entity_id FROM entities WHERE is_active)"
    ),
    _BUCKET_NUMBERS,
)
def _(t):
    return agg.multi_entity_agg(t.records, t.entities.filter("is_active"), "4 hours", START, END)


@query(
    "weighted_average",
    f"""SELECT time_bucket(INTERVAL '1 day', time) AS bucket, entity_id,
           sum(value * value2) / sum(value2) AS weighted_avg, sum(value2) AS total_weight,
           min(value) AS value_range_min, max(value) AS value_range_max
    FROM records WHERE {_RANGE} AND value2 IS NOT NULL
    GROUP BY bucket, entity_id HAVING sum(value2) > 0""",
    "weighted_avg total_weight value_range_min value_range_max",
)
def _(t):
    return agg.weighted_average(t.records, "1 day", START, END)


@query(
    "value_delta",
    f"""WITH ends AS (
        SELECT entity_id, arg_min_null(value, time) AS start_value,
               arg_max_null(value, time) AS end_value
        FROM records WHERE {_CLOSED} GROUP BY entity_id)
    SELECT *, end_value - start_value AS delta,
           CASE WHEN start_value = 0 THEN 0 ELSE (end_value - start_value) / start_value * 100 END
               AS percent_change,
           TIMESTAMP '{START}' AS time_range_from, TIMESTAMP '{END}' AS time_range_to
    FROM ends""",
    "start_value end_value delta percent_change",
)
def _(t):
    return agg.value_delta(t.records, START, END)


@query(
    "variability",
    f"""SELECT entity_id, coalesce(variability, 0) AS variability,
           coalesce(sample_count, 0) AS sample_count
    FROM entities LEFT JOIN (
        SELECT entity_id, stddev_samp(value) AS variability, count(*) AS sample_count FROM records
        WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL 72 HOUR AND time <= TIMESTAMP '{AS_OF}'
        GROUP BY entity_id) USING (entity_id)""",
    "variability",
)
def _(t):
    return agg.variability(t.records, 72, AS_OF, t.entities)


def _gap_sql(interval: str, fill: str) -> str:
    carried = ", ".join(
        f"coalesce(last_value({c} IGNORE NULLS) OVER w, {fill}) AS {c}"
        for c in ("avg", "min", "max", "first", "last")
    )
    return f"""SELECT bucket, entity_id, coalesce(count, 0) AS count, {carried}
    FROM (SELECT * FROM (SELECT DISTINCT entity_id FROM records WHERE {_RANGE}),
         (SELECT unnest(generate_series(time_bucket(INTERVAL '{interval}', TIMESTAMP '{START}'),
                 TIMESTAMP '{END}' - INTERVAL 1 MICROSECOND, INTERVAL '{interval}')) AS bucket)) grid
    LEFT JOIN (
        SELECT time_bucket(INTERVAL '{interval}', time) AS bucket, entity_id, count(value) AS count,
               avg(value) AS avg, min(value) AS min, max(value) AS max,
               arg_min_null(value, time) AS first, arg_max_null(value, time) AS last
        FROM records WHERE {_RANGE} GROUP BY 1, 2) USING (bucket, entity_id)
    WINDOW w AS (PARTITION BY entity_id ORDER BY bucket)"""


@query("gap_filled_agg", _gap_sql("6 hours", "-1.0"), "avg min max first last")
def _(t):
    return gaps.gap_filled_agg(t.records, "6 hours", START, END, -1.0)


@query("gap_filled_agg_null", _gap_sql("1 hour", "NULL"), "avg min max first last")
def _(t):
    return gaps.gap_filled_agg(t.records, "1h", START, END)


@query(
    "aggregate",
    f"SELECT entity_id, sum(value2) AS result FROM records WHERE {_CLOSED} GROUP BY entity_id",
    "result",
)
def _(t):
    return agg.aggregate(t.records, "sum", "value2", START, END)


@query(
    "time_buckets",
    f"""SELECT time_bucket(INTERVAL '5 minutes', time) AS bucket, entity_id,
           arg_max_null(value2, time) AS value, count(*) AS count
    FROM records WHERE {_RANGE} GROUP BY bucket, entity_id""",
    "value",
)
def _(t):
    return agg.time_buckets(t.records, "5 minutes", START, END, "last", "value2")


@query(
    "pattern_aggregate",
    f"SELECT avg(value) AS result, count(*) AS count FROM records "
    f"WHERE {_RANGE} AND entity_id LIKE 'user_%'",
    "result",
)
def _(t):
    return agg.pattern_aggregate(t.records, "user_%", "avg", "value", START, END)


@query(
    "pattern_buckets",
    f"""SELECT time_bucket(INTERVAL '5 minutes', time) AS bucket, avg(value2) AS result,
           count(*) AS count
    FROM records WHERE {_RANGE} AND entity_id LIKE 'user_%' GROUP BY bucket""",
    "result",
)
def _(t):
    return agg.pattern_aggregate(t.records, "user_%", "avg", "value2", START, END, "5 minutes")


@query(
    "peak_and_average",
    "SELECT entity_id, max(value2) AS peak, avg(value2) AS average FROM records "
    "WHERE entity_id LIKE 'user_%' GROUP BY entity_id",
    "peak average",
)
def _(t):
    return agg.peak_and_average(t.records, "user_%", "value2")


@query(
    "statistics",
    f"""SELECT entity_id, min(value) AS min, max(value) AS max, avg(value) AS avg, sum(value) AS sum,
           count(*) AS count, coalesce(stddev_samp(value), 0) AS stddev,
           coalesce(var_samp(value), 0) AS variance
    FROM records WHERE {_CLOSED} GROUP BY entity_id""",
    "min max avg sum stddev variance",
)
def _(t):
    return agg.statistics(t.records, START, END)


@query(
    "value_distribution",
    f"""WITH r AS (SELECT entity_id, value FROM records WHERE {_RANGE}),
    e AS (SELECT entity_id, min(value) AS low, max(value) AS high, count(*) AS n FROM r GROUP BY 1),
    b AS (
        SELECT entity_id, low, high, n,
               CAST(least(coalesce(floor((value - low) / nullif((high - low) / 20, 0)), 0), 19)
                    AS BIGINT) AS bin
        FROM r JOIN e USING (entity_id))
    SELECT entity_id, bin, low + bin * ((high - low) / 20) AS range_low,
           low + (bin + 1) * ((high - low) / 20) AS range_high,
           count(*) AS count, count(*) / n * 100 AS percentage
    FROM b GROUP BY entity_id, bin, low, high, n""",
    "range_low range_high percentage",
)
def _(t):
    return agg.value_distribution(t.records, START, END, 20)


@query(
    "value_distribution_nulls",
    f"""WITH r AS (SELECT entity_id, value2 AS value FROM records WHERE {_RANGE} AND value2 <> 7),
    e AS (SELECT entity_id, min(value) AS low, max(value) AS high, count(*) AS n FROM r GROUP BY 1),
    b AS (
        SELECT entity_id, low, high, n,
               CAST(least(coalesce(floor((value - low) / nullif((high - low) / 4, 0)), 0), 3) AS BIGINT) AS bin
        FROM r JOIN e USING (entity_id))
    SELECT entity_id, bin, low + bin * ((high - low) / 4) AS range_low,
           low + (bin + 1) * ((high - low) / 4) AS range_high,
           count(*) AS count, count(*) / n * 100 AS percentage
    FROM b GROUP BY entity_id, bin, low, high, n""",
    "range_low range_high percentage",
)
def _(t):
    """Every seventh of the values is missing."""
    some = t.records.withColumn("value", F.nullif(F.col("value2"), F.lit(7.0)))
    return agg.value_distribution(some, START, END, 4)


@query(
    "volume_profile",
    """SELECT symbol, round(price, 2) AS price_level, sum(volume) AS volume, count(*) AS tick_count
    FROM price_ticks GROUP BY symbol, round(price, 2)""",
    "price_level volume",
)
def _(t):
    return agg.volume_profile(t.price_ticks)


@query(
    "percentile_by_group",
    """SELECT json_extract_string(metadata, '$.k') AS "group",
           quantile_cont(value, 0.95) AS percentile
    FROM records GROUP BY 1""",
    "percentile",
)
def _(t):
    return agg.percentile_by_group(t.records, 0.95, F.get_json_object("metadata", "$.k"))


@query(
    "having_filter",
    """SELECT entity_id, max(value) AS result FROM records WHERE entity_id LIKE 'user_%'
    GROUP BY entity_id HAVING max(value) > 300""",
    "result",
)
def _(t):
    return agg.having_filter(t.records, "max", "value", 300, pattern="user_%")


@query(
    "daily_stats",
    """SELECT time_bucket(INTERVAL '1 day', time) AS bucket, entity_id, min(value) AS min_value,
           max(value) AS max_value, avg(value) AS avg_value, count(*) AS record_count,
           stddev_samp(value) AS stddev_value, quantile_cont(value, 0.5) AS median_value,
           quantile_cont(value, 0.95) AS p95_value
    FROM records GROUP BY bucket, entity_id""",
    "min_value max_value avg_value stddev_value median_value p95_value",
)
def _(t):
    return agg.daily_stats(t.records)


@query(
    "aggregate_from_records",
    f"""SELECT time_bucket(INTERVAL '15 minutes', time) AS time, entity_id, min(value) AS min_value,
           max(value) AS max_value, avg(value) AS avg_value, count(*) AS count
    FROM records WHERE {_RANGE} GROUP BY 1, 2""",
    "min_value max_value avg_value",
)
def _(t):
    return agg.aggregate_from_records(t.records, 15, START, END)


@query(
    "get_aggregates",
    f"""SELECT time_bucket(INTERVAL '1 day', time) AS time, entity_id, '1d' AS interval_duration,
           min(value) AS min_value, max(value) AS max_value, avg(value) AS avg_value,
           count(*) AS count, max(value) - min(value) AS value_range
    FROM records WHERE {_RANGE} GROUP BY 1, 2
    HAVING avg(value) BETWEEN min(value) AND max(value)""",
    "min_value max_value avg_value value_range",
)
def _(t):
    path = scratch_path(t.spark, "aggregates")
    daily = agg.aggregate_from_records(t.records, 1440, START, END)
    insert_aggregates(daily.withColumn("interval_duration", F.lit("1d")), path)
    stored = load_aggregates(t.spark, path)
    return agg.get_aggregates(stored, "1d", START, END).select(
        "time", "entity_id", "interval_duration", "min_value", "max_value", "avg_value", "count",
        "value_range",
    )


@query(
    "domain_stats",
    """SELECT entity_type, count(*) AS total_records, min(time) AS earliest_record,
           max(time) AS latest_record, avg(value) AS avg_primary_value,
           count(value2) AS records_with_value2,
           count(CASE WHEN metadata <> '{}' THEN 1 END) AS records_with_metadata
    FROM records JOIN entities USING (entity_id) WHERE is_active GROUP BY entity_type""",
    "avg_primary_value",
)
def _(t):
    return reports.domain_stats(t.records, t.entities)


@query(
    "ingestion_pattern",
    f"""SELECT date_trunc('hour', time) AS hour, count(*) AS record_count,
           count(DISTINCT entity_id) AS entity_count,
           avg(8 + strlen(entity_id) + 8 + CASE WHEN value2 IS NULL THEN 0 ELSE 8 END + 8
               + strlen(metadata)) AS avg_row_size
    FROM records WHERE time > TIMESTAMP '{AS_OF}' - INTERVAL 7 DAY GROUP BY 1""",
    "avg_row_size",
)
def _(t):
    return reports.ingestion_pattern(t.records, AS_OF)


_SUMMARY = """SELECT '{name}' AS table_name, count(*) AS total_rows, min(time) AS oldest_data,
    max(time) AS newest_data,
    CAST(floor((epoch_us(max(time)) - epoch_us(min(time))) / 86400000000) AS BIGINT) AS data_span_days,
    count(DISTINCT symbol) AS unique_symbols FROM {name}"""


@query(
    "retention_summary",
    _SUMMARY.format(name="price_ticks") + " UNION ALL " + _SUMMARY.format(name="ohlc_data"),
)
def _(t):
    return reports.retention_summary({"price_ticks": t.price_ticks, "ohlc_data": t.ohlc_data})


@query(
    "table_profile",
    """SELECT 'row_count' AS metric_name, CAST(count(*) AS VARCHAR) AS metric_value,
           CASE WHEN count(*) > 100000000 THEN 'Very large table - ensure proper indexing'
                WHEN count(*) > 10000000 THEN 'Large table - monitor query performance'
                ELSE 'Normal table size' END AS recommendation
    FROM ticks_dup""",
)
def _(t):
    return reports.table_profile(t.ticks_dup)


@query(
    "server_health",
    f"""SELECT *, avg_cpu_usage < 80 AND avg_memory_usage < 85 AS is_healthy FROM (
        SELECT entity_id, avg(value) AS avg_cpu_usage,
               avg(coalesce(value2, 0)) AS avg_memory_usage
        FROM records WHERE {_RANGE} GROUP BY entity_id)""",
    "avg_cpu_usage avg_memory_usage",
)
def _(t):
    return reports.server_health(t.records, START, END)


@query(
    "success_rate",
    f"""SELECT entity_id, quantile_cont(value, 0.95) AS p95_response_time,
           avg(value) AS avg_response_time, avg(value3) * 100 AS success_rate
    FROM records WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL 720 HOUR
      AND time <= TIMESTAMP '{AS_OF}' GROUP BY entity_id""",
    "p95_response_time avg_response_time success_rate",
)
def _(t):
    return reports.success_rate(t.records, 720, AS_OF, flag="value3")
