"""Scans, range reads, searches, filters."""

from pyspark.sql import functions as F

from registry.core import AS_OF, END, START, query
from tidemark.operators import reads
from tidemark.session import scratch_path
from tidemark.sources import tables

_NUMBERS = "value value2 value3 value4"
_SHAPE = "time, entity_id, value, value2, value3, value4"
_RANGE = f"time >= TIMESTAMP '{START}' AND time < TIMESTAMP '{END}'"


@query("load_records", f"SELECT {_SHAPE}, metadata FROM records", _NUMBERS)
def _(t):
    path = scratch_path(t.spark, "records")
    tables.append_days(t.records, path)
    return tables.load_records(t.spark, path).drop("day")


@query("load_entities", "SELECT entity_id, entity_type, name, is_active FROM entities")
def _(t):
    path = scratch_path(t.spark, "entities")
    t.entities.write.parquet(path)
    return tables.load_entities(t.spark, path).select("entity_id", "entity_type", "name", "is_active")


@query(
    "load_ticks",
    "SELECT time, symbol, price, volume, exchange, data_source, bid_price, ask_price FROM price_ticks",
    "price volume bid_price ask_price",
)
def _(t):
    path = scratch_path(t.spark, "ticks")
    tables.append_days(t.price_ticks, path)
    return tables.load_ticks(t.spark, path).select(
        "time", "symbol", "price", "volume", "exchange", "data_source", "bid_price", "ask_price"
    )


@query(
    "load_ohlc",
    "SELECT * FROM ohlc_data",
    "open high low close volume price_change price_change_percent",
)
def _(t):
    path = scratch_path(t.spark, "bars")
    tables.append_days(t.ohlc_data, path)
    return tables.load_ohlc(t.spark, path).select(*t.ohlc_data.columns)


@query("get_records", f"SELECT {_SHAPE} FROM records WHERE {_RANGE}", _NUMBERS)
def _(t):
    return reads.get_records(t.records, START, END)


@query(
    "get_records_page",
    f"SELECT {_SHAPE}, metadata FROM records WHERE {_RANGE} "
    "ORDER BY time DESC, entity_id LIMIT 1000 OFFSET 200",
    _NUMBERS,
)
def _(t):
    return reads.get_records(t.records, START, END, limit=1000, offset=200, include_metadata=True)


@query(
    "get_multi_entity_records",
    f"SELECT {_SHAPE} FROM records WHERE {_RANGE} "
    "AND entity_id IN (SELECT entity_id FROM entities WHERE is_active)",
    _NUMBERS,
)
def _(t):
    return reads.get_multi_entity_records(t.records, t.entities.filter("is_active"), START, END)


@query(
    "get_multi_entity_data",
    f"SELECT {_SHAPE}, metadata FROM records WHERE {_RANGE} "
    "AND entity_id IN (SELECT entity_id FROM entities)",
    _NUMBERS,
)
def _(t):
    return reads.get_multi_entity_data(t.records, t.entities, START, END, include_metadata=True)


@query(
    "get_records_batches",
    f"""SELECT (row_number() OVER (ORDER BY time DESC, entity_id) - 1) // 700 AS batch,
        {_SHAPE}, metadata FROM records WHERE {_RANGE}""",
    _NUMBERS,
)
def _(t):
    return reads.numbered_records(t.records, START, END, batch_size=700)


@query(
    "records_page",
    f"""SELECT {_SHAPE}, metadata FROM records WHERE {_RANGE}
    ORDER BY time DESC, entity_id LIMIT 700 OFFSET 3500""",
    _NUMBERS,
)
def _(t):
    return reads.records_page(t.records, START, END, 3500, 700)


@query(
    "get_records_by_entity_type",
    f"SELECT {_SHAPE} FROM records JOIN entities USING (entity_id) WHERE {_RANGE} "
    "AND entity_type = 'machinery' AND is_active",
    _NUMBERS,
)
def _(t):
    return reads.get_records_by_entity_type(t.records, t.entities, "machinery", START, END)


@query(
    "search_records",
    f"""SELECT {_SHAPE}, metadata FROM records JOIN entities USING (entity_id)
    WHERE {_RANGE} AND is_active AND entity_id LIKE 'user\\_1%' ESCAPE '\\'
      AND entity_type IN ('machinery', 'furniture', 'building')
      AND value BETWEEN 10 AND 250 AND value2 BETWEEN 5 AND 90""",
    _NUMBERS,
)
def _(t):
    wanted = reads.Search(
        entity_pattern=r"user\_1%",
        entity_types=["machinery", "furniture", "building"],
        value=(10, 250),
        value2=(5, 90),
    )
    return reads.search_records(t.records, t.entities, wanted, START, END)


@query(
    "search_records_metadata",
    f"""SELECT {_SHAPE}, metadata FROM records JOIN entities USING (entity_id)
    WHERE {_RANGE} AND is_active AND json_extract_string(metadata, '$.k') = '42'""",
    _NUMBERS,
)
def _(t):
    return reads.search_records(t.records, t.entities, reads.Search(metadata={"k": 42}), START, END)


@query(
    "search_records_time",
    f"""SELECT {_SHAPE}, metadata FROM records JOIN entities USING (entity_id)
    WHERE {_RANGE} AND is_active AND time >= TIMESTAMP '2024-01-03 06:00:00'
      AND time <= TIMESTAMP '2024-01-28 18:00:00'
      AND strftime(time, '%H:%M') BETWEEN '08:30' AND '17:15' AND dayofweek(time) IN (0, 1, 3)""",
    _NUMBERS,
)
def _(t):
    wanted = reads.Search(
        min_time="2024-01-03T06:00:00Z",
        max_time="2024-01-28T18:00:00Z",
        time_of_day=("08:30", "17:15"),
        days_of_week=[0, 1, 3],
    )
    return reads.search_records(t.records, t.entities, wanted, START, END)


@query(
    "get_available_entities",
    "SELECT entity_id, entity_type, name, is_active FROM entities WHERE is_active",
)
def _(t):
    return reads.get_available_entities(t.entities).select(
        "entity_id", "entity_type", "name", "is_active"
    )


@query(
    "get_entities_by_type",
    "SELECT entity_id, entity_type, name FROM entities WHERE is_active AND entity_type = 'household'",
)
def _(t):
    return reads.get_entities_by_type(t.entities, "household").select(
        "entity_id", "entity_type", "name"
    )


@query("get_entities", "SELECT entity_id, entity_type, is_active FROM entities")
def _(t):
    return reads.get_entities(t.entities).select("entity_id", "entity_type", "is_active")


@query(
    "high_value_records",
    f"""SELECT {_SHAPE}, metadata FROM records WHERE {_RANGE} AND value >= 150
    ORDER BY value DESC, time DESC, entity_id LIMIT 500""",
    _NUMBERS,
)
def _(t):
    return reads.high_value_records(t.records, 150, START, END, limit=500)


@query(
    "multi_value_records",
    "SELECT time, symbol AS entity_id, open AS value, high AS value2, low AS value3, volume AS value4 "
    "FROM ohlc_data WHERE high IS NOT NULL AND low IS NOT NULL AND volume IS NOT NULL",
    _NUMBERS,
)
def _(t):
    return reads.multi_value_records(
        t.ohlc_data.select(
            "time",
            F.col("symbol").alias("entity_id"),
            F.col("open").alias("value"),
            F.col("high").alias("value2"),
            F.col("low").alias("value3"),
            F.col("volume").alias("value4"),
        )
    )


@query(
    "records_with_metadata", f"SELECT {_SHAPE}, metadata FROM records WHERE metadata <> '{{}}'", _NUMBERS
)
def _(t):
    return reads.records_with_metadata(t.records)


@query(
    "recent_records",
    f"SELECT {_SHAPE}, metadata FROM records WHERE time > TIMESTAMP '{AS_OF}' - INTERVAL 10 DAY",
    _NUMBERS,
)
def _(t):
    return reads.recent_records(t.records, AS_OF, 10)


@query(
    "get_ticks",
    f"SELECT time, symbol, price, volume, exchange, data_source, bid_price, ask_price "
    f"FROM price_ticks WHERE {_RANGE}",
    "price volume bid_price ask_price",
)
def _(t):
    return reads.get_ticks(t.price_ticks, START, END)


@query(
    "get_ohlc",
    f"SELECT * FROM ohlc_data WHERE interval_duration = '4h' AND {_RANGE}",
    "open high low close volume price_change price_change_percent",
)
def _(t):
    return reads.get_ohlc(t.ohlc_data, "4h", START, END)


@query(
    "allowed_rows",
    """SELECT time, symbol, price FROM price_ticks
    WHERE symbol IN (SELECT symbol FROM price_ticks GROUP BY symbol, data_source
                     HAVING data_source = 'S1' AND avg(price) > 50)""",
    "price",
)
def _(t):
    granted = (
        t.price_ticks.groupBy(F.col("data_source").alias("user_id"), F.col("symbol").alias("allowed_symbol"))
        .agg(F.avg("price").alias("_mean"))
        .filter("_mean > 50")
    )
    return reads.allowed_rows(t.price_ticks, granted, "S1").select("time", "symbol", "price")


@query(
    "threshold_alerts",
    f"""SELECT * FROM (
        SELECT {_SHAPE}, value < -10 OR value > 40 AS value_alert,
               coalesce(value2 < 10 OR value2 > 95, FALSE) AS value2_alert,
               value3 < 980 OR value3 > 1050 AS value3_alert
        FROM records)
    WHERE value_alert OR value2_alert OR value3_alert""",
    _NUMBERS,
)
def _(t):
    return reads.threshold_alerts(t.records.drop("metadata"), reads.SENSOR_LIMITS)


_USER_SQL = """
    SELECT entity_id, avg(value) AS mean_value, count(*) AS n
    FROM readings WHERE entity_id LIKE 'user_%' GROUP BY entity_id HAVING avg(value) > 45"""


@query("raw_sql", _USER_SQL.replace("readings", "records"), "mean_value")
def _(t):
    return reads.run_sql({"readings": t.records}, _USER_SQL)
