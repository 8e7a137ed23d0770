"""Inserts, upserts, reference rows and mappings; writes go to fresh scratch tables."""

from pyspark.sql import functions as F

from registry.core import AS_OF, query
from tidemark.functions.buckets import bucket
from tidemark.plans.rollups import ohlc_from_ticks
from tidemark.session import scratch_path
from tidemark.sources import ingest, mappings, tables

_NUMBERS = "value value2 value3 value4"
_SHAPE = "time, entity_id, value, value2, value3, value4, metadata"


@query("insert_records", f"SELECT {_SHAPE} FROM records", _NUMBERS)
def _(t):
    path = scratch_path(t.spark, "records")
    ingest.insert_records(t.records, path)
    return tables.load_records(t.spark, path).drop("day")


@query(
    "upsert_records",
    """SELECT r.time, r.entity_id,
           CASE WHEN e.event_type = 'purchase' THEN r.value + 2000 ELSE r.value END AS value,
           r.value2, r.value3
    FROM records r JOIN events e ON e.ts = r.time AND 'user_' || e.user_id = r.entity_id""",
    "value value2 value3",
)
def _(t):
    path = scratch_path(t.spark, "records")
    ingest.insert_records(t.records, path)
    bought = t.records.join(
        t.events.filter("event_type = 'purchase'").select(
            F.col("ts").alias("time"), F.concat(F.lit("user_"), F.col("user_id")).alias("entity_id")
        ),
        ["time", "entity_id"],
        "left_semi",
    )
    changed = bought.withColumn("value", F.col("value") + 1000).withColumn("sequence", F.lit(1))
    again = bought.withColumn("value", F.col("value") + 2000).withColumn("sequence", F.lit(2))
    ingest.upsert_records(changed.unionByName(again), path, ["sequence"])
    return tables.load_records(t.spark, path).select("time", "entity_id", "value", "value2", "value3")


@query(
    "insert_many",
    """SELECT CAST(time AS TIMESTAMP) AS time, entity_id, CAST(value AS DOUBLE) AS value
    FROM raw_records WHERE entity_id NOT LIKE '% %' AND time <> 'unknown'
      AND value NOT IN ('n/a', 'NaN', 'Infinity') AND metadata <> '[]'""",
    "value",
)
def _(t):
    path = scratch_path(t.spark, "records")
    ingest.insert_many(t.raw_records, path, rejects_path=scratch_path(t.spark, "rejects"))
    return tables.load_records(t.spark, path).select("time", "entity_id", "value")


@query(
    "insert_many_result",
    """SELECT count(CASE WHEN ok THEN 1 END) AS processed, count(CASE WHEN NOT ok THEN 1 END) AS failed
    FROM (SELECT entity_id NOT LIKE '% %' AND time <> 'unknown'
                 AND value NOT IN ('n/a', 'NaN', 'Infinity') AND metadata <> '[]' AS ok
          FROM raw_records)""",
)
def _(t):
    result = ingest.insert_many(t.raw_records, scratch_path(t.spark, "records"), upsert=False)
    return t.spark.range(1).select(
        F.lit(result.processed).alias("processed"), F.lit(result.failed).alias("failed")
    )


@query(
    "insert_ticks",
    """SELECT time, symbol, price, volume, exchange, data_source FROM price_ticks
    WHERE price > 0 AND bid_price > 0 AND ask_price > 0""",
    "price volume",
)
def _(t):
    path = scratch_path(t.spark, "ticks")
    ingest.insert_ticks(t.price_ticks, path)
    return tables.load_ticks(t.spark, path).select(
        "time", "symbol", "price", "volume", "exchange", "data_source"
    )


_BAR_SQL = """SELECT time_bucket(INTERVAL '1 hour', time) AS time, symbol, '1h' AS interval_duration,
        arg_min(price, time) AS open, max(price) AS high, min(price) AS low,
        arg_max(price, time) AS close, sum(volume) AS volume
    FROM price_ticks GROUP BY 1, 2 HAVING min(price) > 0"""


@query(
    "insert_ohlc",
    f"""SELECT *, close - open AS price_change, (close - open) / open * 100 AS price_change_percent
    FROM ({_BAR_SQL})""",
    "open high low close volume price_change price_change_percent",
)
def _(t):
    path = scratch_path(t.spark, "bars")
    bars = ohlc_from_ticks(t.price_ticks, "1 hour").withColumnRenamed("bucket", "time")
    ingest.insert_ohlc(bars.withColumn("interval_duration", F.lit("1h")), path)
    return tables.load_ohlc(t.spark, path).select(
        "time", "symbol", "interval_duration", "open", "high", "low", "close", "volume",
        "price_change", "price_change_percent",
    )


@query(
    "insert_aggregates",
    """SELECT time_bucket(INTERVAL '1 hour', time) AS time, entity_id, '1h' AS interval_duration,
           min(value) AS min_value, max(value) AS max_value, avg(value2) AS avg_value,
           sum(value) AS sum_value, count(*) AS count, max(value) - min(value) AS value_range
    FROM records GROUP BY 1, 2 HAVING avg(value2) BETWEEN min(value) AND max(value)""",
    "min_value max_value avg_value sum_value value_range",
)
def _(t):
    """The mean is taken from the other value, so that many rows break the rule."""
    path = scratch_path(t.spark, "aggregates")
    hourly = t.records.groupBy(bucket("time", "1 hour").alias("time"), "entity_id").agg(
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.avg("value2").alias("avg_value"),
        F.sum("value").alias("sum_value"),
        F.count(F.lit(1)).alias("count"),
    )
    ingest.insert_aggregates(hourly.withColumn("interval_duration", F.lit("1h")), path)
    return tables.load_aggregates(t.spark, path).drop("day", "data_source", "created_at")


@query(
    "insert_if_absent",
    """SELECT DISTINCT upper(event_type) AS symbol FROM events
    WHERE upper(event_type) NOT IN (SELECT symbol FROM price_ticks WHERE price > 450)""",
)
def _(t):
    known = t.price_ticks.filter("price > 450").select("symbol")
    return ingest.insert_if_absent(known, t.price_ticks.select("symbol"), ["symbol"])


@query(
    "upsert_entities",
    f"""SELECT entity_id, CASE WHEN is_active THEN entity_type ELSE 'dormant' END AS entity_type,
           TIMESTAMP '2023-01-01' AS created_at,
           CASE WHEN is_active THEN TIMESTAMP '2023-01-01' ELSE TIMESTAMP '{AS_OF}' END AS updated_at
    FROM entities""",
)
def _(t):
    dormant = t.entities.filter("NOT is_active").withColumn("entity_type", F.lit("dormant"))
    merged = ingest.upsert_entities(t.entities, dormant, AS_OF)
    return merged.select("entity_id", "entity_type", "created_at", "updated_at")


_SENSOR = """SELECT ts AS time, 'sensor_' || user_id AS entity_id, value, k AS value2, value * 2 AS value3,
        CAST(NULL AS DOUBLE) AS value4, event_type AS location, 'T' || (user_id % 3) AS sensor_type
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)"""


def _metadata(df, *names):
    """Metadata fields as columns, so that JSON spelling does not matter."""
    return df.select(
        "time", "entity_id", "value", "value2", "value3", "value4",
        *[F.get_json_object("metadata", f"$.{n}").alias(n) for n in names],
    )


@query("map_sensor", _SENSOR, _NUMBERS)
def _(t):
    readings = t.events.select(
        F.concat(F.lit("sensor_"), F.col("user_id")).alias("sensor_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("temperature"),
        F.get_json_object("props", "$.k").cast("double").alias("humidity"),
        (F.col("value") * 2).alias("pressure"),
        F.lit(None).cast("double").alias("battery_level"),
        F.col("event_type").alias("location"),
        F.concat(F.lit("T"), F.col("user_id") % 3).alias("sensor_type"),
    )
    return _metadata(mappings.map_sensor(readings), "location", "sensor_type")


@query(
    "map_server",
    """SELECT ts AS time, 'server_' || user_id AS entity_id, value, value / 2 AS value2,
           value / 4 AS value3, value * 8 AS value4, 'host' || user_id AS hostname,
           event_type AS datacenter
    FROM events""",
    _NUMBERS,
)
def _(t):
    metrics = t.events.select(
        F.concat(F.lit("server_"), F.col("user_id")).alias("server_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("cpu_usage"),
        (F.col("value") / 2).alias("memory_usage"),
        (F.col("value") / 4).alias("disk_usage"),
        (F.col("value") * 8).alias("network_io"),
        F.concat(F.lit("host"), F.col("user_id")).alias("hostname"),
        F.col("event_type").alias("datacenter"),
    )
    return _metadata(mappings.map_server(metrics), "hostname", "datacenter")


@query(
    "map_api",
    """SELECT ts AS time, 'api_gateway' AS entity_id, value,
           CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS value2,
           k AS value3, k * 10 AS value4, '/' || event_type AS endpoint, 'GET' AS method,
           CASE WHEN event_type = 'error' THEN '500' ELSE '200' END AS status_code
    FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS DOUBLE) AS k FROM events)""",
    _NUMBERS,
)
def _(t):
    k = F.get_json_object("props", "$.k").cast("double")
    calls = t.events.select(
        F.concat(F.lit("/"), F.col("event_type")).alias("endpoint"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("response_time"),
        F.when(F.col("event_type") == "error", 500).otherwise(200).alias("status_code"),
        k.alias("request_size"),
        (k * 10).alias("response_size"),
        F.lit("GET").alias("method"),
        F.lit("agent").alias("user_agent"),
    )
    return _metadata(mappings.map_api(calls), "endpoint", "method", "status_code")


@query("copy_table", _SENSOR, _NUMBERS)
def _(t):
    path = scratch_path(t.spark, "copied")

    def as_sensor(events):
        return mappings.map_sensor(
            events.select(
                F.concat(F.lit("sensor_"), F.col("user_id")).alias("sensor_id"),
                F.col("ts").alias("timestamp"),
                F.col("value").alias("temperature"),
                F.get_json_object("props", "$.k").alias("humidity"),
                (F.col("value") * 2).alias("pressure"),
                F.lit(None).alias("battery_level"),
                F.col("event_type").alias("location"),
                F.concat(F.lit("T"), F.col("user_id") % 3).alias("sensor_type"),
            )
        )

    ingest.copy_table(t.events, path, as_sensor)
    return _metadata(tables.load_records(t.spark, path), "location", "sensor_type")
