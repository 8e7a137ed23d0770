"""The reference table shapes as views over the test tables, in Spark and in SQL."""

from __future__ import annotations

import re
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.buckets import bucket
from tidemark.operators.quality import derive_ohlc_columns
from tidemark.sources.tables import read_table

# The files hold wall times without a zone; read as UTC instants they keep
# predicate pushdown, which a cast would lose.
_EVENTS = (
    "event_id BIGINT, ts TIMESTAMP, user_id BIGINT, event_type STRING, value DOUBLE, props STRING"
)
_LINEITEM = (
    "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, "
    "l_linestatus STRING, l_shipdate TIMESTAMP"
)
_ORDERS = (
    "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP, o_orderpriority STRING"
)
_CUSTOMER = (
    "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING"
)


def records_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").alias("time"),
        F.concat(F.lit("user_"), F.col("user_id")).alias("entity_id"),
        "value",
        F.get_json_object("props", "$.k").cast("double").alias("value2"),
        F.when(F.col("event_type") == "error", 1.0).otherwise(0.0).alias("value3"),
        F.lit(None).cast("double").alias("value4"),
        F.col("props").alias("metadata"),
    )


def ticks_of(events: DataFrame) -> DataFrame:
    return events.select(
        F.col("ts").alias("time"),
        F.upper("event_type").alias("symbol"),
        F.col("value").alias("price"),
        F.nullif(F.get_json_object("props", "$.k").cast("double"), F.lit(0.0)).alias("volume"),
        F.concat(F.lit("X"), F.col("user_id") % 3).alias("exchange"),
        F.concat(F.lit("S"), F.col("user_id") % 2).alias("data_source"),
        (F.col("value") * 0.999).alias("bid_price"),
        (F.col("value") * 1.001).alias("ask_price"),
    )


def raw_of(events: DataFrame) -> DataFrame:
    """Records as untyped text, some of them broken."""
    k = F.get_json_object("props", "$.k").cast("int")
    text = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    prefix = F.when(F.col("event_type") == "error", "User ").otherwise("User_")
    return events.select(
        F.when(k == 0, "unknown").otherwise(text).alias("time"),
        F.concat(prefix, F.col("user_id")).alias("entity_id"),
        F.when(k == 1, "n/a")
        .when(k == 2, "NaN")
        .when(k == 4, "Infinity")
        .otherwise(F.format_string("%.2f", "value"))
        .alias("value"),
        k.cast("string").alias("value2"),
        F.lit(None).cast("string").alias("value3"),
        F.lit(None).cast("string").alias("value4"),
        F.when(k == 3, "[]").otherwise(F.col("props")).alias("metadata"),
    )


class Tables:
    """Lazily built views over one test folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def _read(self, name: str, schema: str) -> DataFrame:
        return read_table(self.spark, f"{self.sf_dir}/{name}.parquet", schema)

    @cached_property
    def events(self) -> DataFrame:
        return self._read("events", _EVENTS)

    @property
    def events_schema(self) -> str:
        return _EVENTS

    @cached_property
    def orders(self) -> DataFrame:
        return self._read("orders", _ORDERS)

    @cached_property
    def customer(self) -> DataFrame:
        return self._read("customer", _CUSTOMER)

    @cached_property
    def records(self) -> DataFrame:
        return records_of(self.events)

    @cached_property
    def order_records(self) -> DataFrame:
        """Orders as records: years of data, with equal times."""
        return self.orders.select(
            F.col("o_orderdate").alias("time"),
            F.concat(F.lit("cust_"), F.col("o_custkey")).alias("entity_id"),
            F.col("o_totalprice").alias("value"),
            F.col("o_orderkey").alias("order_key"),
        )

    @cached_property
    def entities(self) -> DataFrame:
        return self.customer.select(
            F.concat(F.lit("user_"), F.col("c_custkey")).alias("entity_id"),
            F.lower("c_mktsegment").alias("entity_type"),
            F.col("c_name").alias("name"),
            F.lit(None).cast("string").alias("description"),
            F.lit(None).cast("string").alias("metadata"),
            F.lit("2023-01-01").cast("timestamp").alias("created_at"),
            F.lit("2023-01-01").cast("timestamp").alias("updated_at"),
            (F.col("c_acctbal") > 0).alias("is_active"),
        )

    @cached_property
    def price_ticks(self) -> DataFrame:
        return ticks_of(self.events)

    @cached_property
    def lineitem(self) -> DataFrame:
        return self._read("lineitem", _LINEITEM)

    @cached_property
    def old_bars(self) -> DataFrame:
        """Line items as bars of two intervals, years apart."""
        return self.lineitem.select(
            F.col("l_shipdate").alias("time"),
            F.concat(F.lit("P"), F.col("l_partkey")).alias("symbol"),
            F.when(F.col("l_linestatus") == "O", "1h").otherwise("1d").alias("interval_duration"),
            F.col("l_extendedprice").alias("close"),
        )

    @cached_property
    def ticks_dup(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_shipdate").alias("time"),
            F.concat(F.lit("P"), F.col("l_partkey")).alias("symbol"),
            (F.col("l_extendedprice") / F.col("l_quantity")).alias("price"),
            F.col("l_quantity").alias("volume"),
            F.lit("X0").alias("exchange"),
            F.lit("S0").alias("data_source"),
        )

    @cached_property
    def ohlc_data(self) -> DataFrame:
        def bars(code: str, width: str) -> DataFrame:
            rows = self.price_ticks.withColumn("_time", bucket("time", width))
            return rows.groupBy(F.col("_time"), "symbol", "data_source").agg(
                F.min_by("price", "time").alias("open"),
                F.max("price").alias("high"),
                F.min("price").alias("low"),
                F.max_by("price", "time").alias("close"),
                F.sum("volume").alias("volume"),
            ).select(
                F.col("_time").alias("time"),
                "symbol",
                F.lit(code).alias("interval_duration"),
                "open",
                "high",
                "low",
                "close",
                "volume",
                "data_source",
            )

        widths = {"30m": "30 minutes", "1h": "1 hour", "4h": "4 hours", "1d": "1 day"}
        whole = bars("15m", "15 minutes")
        for code, width in widths.items():
            whole = whole.unionByName(bars(code, width))
        return derive_ohlc_columns(whole)

    @cached_property
    def data_sources(self) -> DataFrame:
        names = self.price_ticks.select(F.col("data_source").alias("name")).distinct()
        idle = self.spark.range(1).select(F.lit("S_idle").alias("name"))
        return names.unionByName(idle).select(
            "name",
            F.lit(True).alias("is_active"),
            F.lit("2022-01-01").cast("timestamp").alias("updated_at"),
        )

    @cached_property
    def raw_records(self) -> DataFrame:
        return raw_of(self.events)


# The same views in SQL; a later one may use an earlier one.
VIEWS: dict[str, str] = {
    "records": """
        SELECT ts AS time, 'user_' || user_id AS entity_id, value,
               CAST(json_extract_string(props, '$.k') AS DOUBLE) AS value2,
               CASE WHEN event_type = 'error' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS value3,
               CAST(NULL AS DOUBLE) AS value4, props AS metadata
        FROM events""",
    "order_records": """
        SELECT o_orderdate AS time, 'cust_' || o_custkey AS entity_id, o_totalprice AS value,
               o_orderkey AS order_key
        FROM orders""",
    "entities": """
        SELECT 'user_' || c_custkey AS entity_id, lower(c_mktsegment) AS entity_type,
               c_name AS name, c_acctbal > 0 AS is_active
        FROM customer""",
    "price_ticks": """
        SELECT ts AS time, upper(event_type) AS symbol, value AS price,
               nullif(CAST(json_extract_string(props, '$.k') AS DOUBLE), 0) AS volume,
               'X' || (user_id % 3) AS exchange, 'S' || (user_id % 2) AS data_source,
               value * 0.999::DOUBLE AS bid_price, value * 1.001::DOUBLE AS ask_price
        FROM events""",
    "ticks_dup": """
        SELECT l_shipdate AS time, 'P' || l_partkey AS symbol,
               l_extendedprice / l_quantity AS price, l_quantity AS volume
        FROM lineitem""",
    "old_bars": """
        SELECT l_shipdate AS time, 'P' || l_partkey AS symbol,
               CASE l_linestatus WHEN 'O' THEN '1h' ELSE '1d' END AS interval_duration,
               l_extendedprice AS close
        FROM lineitem""",
    "ohlc_data": """
        SELECT *, close - open AS price_change,
               CASE WHEN open > 0 THEN (close - open) / open * 100 END AS price_change_percent
        FROM (
            SELECT time_bucket(w.width, t.time) AS time, symbol, w.code AS interval_duration,
                   arg_min(price, t.time) AS open, max(price) AS high, min(price) AS low,
                   arg_max(price, t.time) AS close, sum(volume) AS volume, data_source
            FROM price_ticks t,
                 (VALUES ('15m', INTERVAL 15 MINUTE), ('30m', INTERVAL 30 MINUTE),
                         ('1h', INTERVAL 1 HOUR), ('4h', INTERVAL 4 HOUR), ('1d', INTERVAL 1 DAY))
                 AS w(code, width)
            GROUP BY time_bucket(w.width, t.time), symbol, w.code, data_source
        )""",
    "data_sources": """
        SELECT name, TRUE AS is_active, TIMESTAMP '2022-01-01' AS updated_at
        FROM (SELECT DISTINCT data_source AS name FROM price_ticks UNION ALL SELECT 'S_idle')""",
    "raw_records": """
        SELECT CASE WHEN k = 0 THEN 'unknown' ELSE strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS time,
               CASE WHEN event_type = 'error' THEN 'User ' ELSE 'User_' END || user_id AS entity_id,
               CASE WHEN k = 1 THEN 'n/a' WHEN k = 2 THEN 'NaN' WHEN k = 4 THEN 'Infinity'
                    ELSE printf('%.2f', value) END AS value,
               CAST(k AS VARCHAR) AS value2,
               CASE WHEN k = 3 THEN '[]' ELSE props END AS metadata
        FROM (SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)""",
}


def with_views(sql: str) -> str:
    """The statement with the views it mentions as ``WITH`` clauses before its own."""
    needed: set[str] = set()

    def need(text: str) -> None:
        for name in VIEWS:
            if name not in needed and re.search(rf"\b{name}\b", text):
                needed.add(name)
                need(VIEWS[name])

    need(sql)
    clauses = ", ".join(f"{name} AS ({body})" for name, body in VIEWS.items() if name in needed)
    if not clauses:
        return sql
    own = re.match(r"\s*WITH (RECURSIVE )?", sql)
    return f"WITH RECURSIVE {clauses}" + (f", {sql[own.end():]}" if own else f" {sql}")
