"""Structured Streaming runs over the event file; each query reads back its sink."""

from pyspark.sql import functions as F

from registry.core import query
from registry.fixtures import raw_of, records_of, ticks_of
from tidemark.operators.reads import SENSOR_LIMITS
from tidemark.plans import rollups
from tidemark.session import scratch_path
from tidemark.sources import tables
from tidemark.streaming import flows


def _events(t):
    return flows.read_stream(t.spark, t.sf_dir, t.events_schema, files="events.parquet")


def _batches(t, files=4):
    """The events dealt to several files, one per micro-batch."""
    path = scratch_path(t.spark, "events")
    t.spark.read.schema(t.events_schema).parquet(f"{t.sf_dir}/events.parquet").repartition(
        files, "user_id"
    ).write.parquet(path)
    return flows.read_stream(t.spark, path, t.events_schema, max_files=1)


def _collected(t, stream):
    """Run a stream dry into a fresh Parquet folder and read that."""
    path = scratch_path(t.spark, "sink")
    flows.run_available(flows.write_stream(stream, path, scratch_path(t.spark, "state")))
    return t.spark.read.schema(stream.schema).parquet(path)


_SHAPE = "time, entity_id, value, value2, value3, value4"
_NUMBERS = "value value2 value3 value4"


@query("stream_ingest", f"SELECT {_SHAPE} FROM records", _NUMBERS)
def _(t):
    path = scratch_path(t.spark, "records")
    raw = records_of(_batches(t))
    flows.run_available(flows.stream_ingest(raw, path, scratch_path(t.spark, "state")))
    return flows.merged_records(t.spark, path).drop("metadata")


@query(
    "ingest_stream",
    """SELECT CAST(time AS TIMESTAMP) AS time, entity_id, CAST(value AS DOUBLE) AS value
    FROM raw_records WHERE entity_id NOT LIKE '% %' AND time <> 'unknown'
      AND value NOT IN ('n/a', 'NaN', 'Infinity') AND metadata <> '[]'""",
    "value",
)
def _(t):
    path, rejects = scratch_path(t.spark, "records"), scratch_path(t.spark, "rejects")
    state = scratch_path(t.spark, "state")
    flows.run_available(
        flows.stream_ingest(raw_of(_batches(t)), path, state, rejects_path=rejects)
    )
    flows.fold_pending(t.spark, path)
    return tables.load_records(t.spark, path).select("time", "entity_id", "value")


@query(
    "get_ohlc_stream",
    "SELECT time, symbol, data_source, open, high, low, close, volume FROM ohlc_data "
    "WHERE interval_duration = '4h'",
    "open high low close volume",
)
def _(t):
    path = scratch_path(t.spark, "bars")
    t.ohlc_data.write.parquet(path)
    bars = flows.read_stream(t.spark, path, t.ohlc_data.schema)
    return _collected(t, flows.get_ohlc_stream(bars, "4h")).select(
        "time", "symbol", "data_source", "open", "high", "low", "close", "volume"
    )


@query(
    "stream_rollup",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, symbol, exchange, data_source,
           arg_min(price, time) AS open, max(price) AS high, min(price) AS low,
           arg_max(price, time) AS close, sum(volume) AS volume, count(*) AS tick_count,
           avg(price) AS avg_price, stddev_samp(price) AS price_volatility
    FROM price_ticks GROUP BY 1, 2, 3, 4
    HAVING time_bucket(INTERVAL '1 hour', any_value(time)) + INTERVAL 1 HOUR
           <= (SELECT max(time) - INTERVAL 10 MINUTE FROM price_ticks)""",
    "open high low close volume avg_price price_volatility",
)
def _(t):
    return _collected(t, flows.stream_rollup(ticks_of(_events(t)), "1 hour", "10 minutes"))


@query(
    "stream_bucket_agg",
    """SELECT time_bucket(INTERVAL '7 days', time) AS bucket, entity_id, count(*) AS count,
           avg(value) AS avg, min(value) AS min, max(value) AS max, sum(value) AS sum,
           arg_min(value, time) AS first, arg_max(value, time) AS last,
           stddev_samp(value) AS stddev
    FROM records GROUP BY 1, 2
    HAVING time_bucket(INTERVAL '7 days', any_value(time)) + INTERVAL 7 DAY
           <= (SELECT max(time) - INTERVAL 1 HOUR FROM records)""",
    "avg min max sum first last stddev",
)
def _(t):
    return _collected(t, flows.stream_bucket_agg(records_of(_events(t)), "1 week", "1 hour"))


# The events reach over a month; read at a twelfth of their pace they reach over a year.
_SLOW = 12
_FIRST = 1_704_067_200_000_000  # 2024-01-01 in microseconds


def _slowed(df):
    return df.withColumn("time", F.timestamp_micros(F.lit(_FIRST) + _SLOW * (F.unix_micros("time") - F.lit(_FIRST))))


def _slowed_sql(table):
    return f"(SELECT * REPLACE (make_timestamp({_FIRST} + {_SLOW} * (epoch_us(time) - {_FIRST})) AS time) FROM {table})"


@query(
    "stream_rollup_monthly",
    f"""SELECT date_trunc('month', time)::TIMESTAMP AS bucket, symbol, exchange, data_source,
           arg_min(price, time) AS open, max(price) AS high, min(price) AS low,
           arg_max(price, time) AS close, sum(volume) AS volume, count(*) AS tick_count,
           avg(price) AS avg_price, stddev_samp(price) AS price_volatility
    FROM {_slowed_sql('price_ticks')} GROUP BY 1, 2, 3, 4
    HAVING date_trunc('month', any_value(time)) + INTERVAL 1 MONTH
           <= (SELECT max(time) - INTERVAL 10 MINUTE FROM {_slowed_sql('price_ticks')})""",
    "open high low close volume avg_price price_volatility",
)
def _(t):
    return _collected(t, flows.stream_rollup(_slowed(ticks_of(_events(t))), "1 month", "10 minutes"))


@query(
    "stream_bucket_agg_quarterly",
    f"""SELECT date_trunc('quarter', time)::TIMESTAMP AS bucket, entity_id, count(*) AS count,
           avg(value) AS avg, min(value) AS min, max(value) AS max, sum(value) AS sum,
           arg_min(value, time) AS first, arg_max(value, time) AS last,
           stddev_samp(value) AS stddev
    FROM {_slowed_sql('records')} GROUP BY 1, 2
    HAVING date_trunc('quarter', any_value(time)) + INTERVAL 3 MONTH
           <= (SELECT max(time) - INTERVAL 1 HOUR FROM {_slowed_sql('records')})""",
    "avg min max sum first last stddev",
)
def _(t):
    return _collected(t, flows.stream_bucket_agg(_slowed(records_of(_events(t))), "3 months", "1 hour"))


@query(
    "stream_latest",
    """SELECT entity_id, max(time) AS time, arg_max_null(value, time) AS value,
           arg_max_null(value2, time) AS value2, arg_max_null(value3, time) AS value3
    FROM records GROUP BY entity_id""",
    "value value2 value3",
)
def _(t):
    """A fold, then the last batch is replayed as after a crash before its commit, and a fold again."""
    path, state, records = scratch_path(t.spark, "latest"), scratch_path(t.spark, "state"), records_of(_batches(t))
    flows.run_available(flows.stream_latest(records, path, state))
    flows.fold_latest(t.spark, path)
    tables.drop_folder(t.spark, f"{state}/commits/{flows.last_committed(t.spark, state)}")
    flows.run_available(flows.stream_latest(records, path, state))
    flows.fold_latest(t.spark, path)
    return flows.load_latest(t.spark, path).select("entity_id", "time", "value", "value2", "value3")


@query(
    "stream_alerts",
    f"""SELECT * FROM (
        SELECT {_SHAPE}, value < -10 OR value > 40 AS value_alert,
               value2 < 10 OR value2 > 95 AS value2_alert, value3 < 980 OR value3 > 1050 AS value3_alert
        FROM records)
    WHERE value_alert OR value2_alert OR value3_alert""",
    _NUMBERS,
)
def _(t):
    return _collected(
        t, flows.stream_alerts(records_of(_events(t)).drop("metadata"), SENSOR_LIMITS)
    )


@query(
    "stream_stale",
    """SELECT entity_id, time AS last_seen, time + INTERVAL 720 MINUTE AS silent_at
    FROM (SELECT entity_id, time, lead(time) OVER (PARTITION BY entity_id ORDER BY time) AS following
          FROM records)
    WHERE (following IS NULL OR following > time + INTERVAL 720 MINUTE)
      AND time + INTERVAL 720 MINUTE <= (SELECT max(time) - INTERVAL 1 HOUR FROM records)""",
)
def _(t):
    return _collected(t, flows.stream_stale(records_of(_events(t)), 720, "1 hour"))


@query(
    "stream_dedupe",
    "SELECT DISTINCT entity_id, time FROM records",
)
def _(t):
    doubled = records_of(_events(t)).withColumn("copy", F.explode(F.array(F.lit(1), F.lit(2))))
    return _collected(t, flows.stream_dedupe(doubled, "1 hour")).select("entity_id", "time")


@query(
    "stream_rollup_late",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS bucket, symbol, exchange, data_source,
           arg_min(price, time) AS open, max(price) AS high, min(price) AS low,
           arg_max(price, time) AS close, sum(volume) AS volume, count(*) AS tick_count
    FROM price_ticks GROUP BY 1, 2, 3, 4""",
    "open high low close volume",
)
def _(t):
    """The stream leaves the newest buckets open; a batch refresh completes the table."""
    path = scratch_path(t.spark, "rollup")
    done = _collected(t, flows.stream_rollup(ticks_of(_events(t)), "1 hour", "2 days"))
    tables.append_days(done, path, time="bucket")
    hourly = rollups.Rollup(
        "hourly", "price_ticks", "1 hour",
        lambda ticks: rollups.ohlcv_rollup(ticks, "1 hour"),
        rollups.ROLLUPS["ticks_1hour"].start, rollups.ROLLUPS["ticks_1hour"].end,
    )
    rollups.refresh_rollup(t.spark, hourly, t.price_ticks, path, "2024-01-27", "2024-01-31")
    return t.spark.read.parquet(path).select(
        "bucket", "symbol", "exchange", "data_source", "open", "high", "low", "close", "volume",
        "tick_count",
    )
