"""Validation, repair, de-duplication, clean-up."""

from pyspark.sql import functions as F

from registry.core import AS_OF, END, START, query
from tidemark.operators import quality

_BARS = "open high low close volume price_change price_change_percent"
_JUDGED = """SELECT try_cast(time AS TIMESTAMP) AS time, entity_id,
        try_cast(value AS DOUBLE) AS value, CAST(value2 AS DOUBLE) AS value2,
        CASE WHEN NOT regexp_full_match(entity_id, '[A-Za-z0-9_.-]+')
                 THEN 'entity_id has illegal characters'
             WHEN try_cast(time AS TIMESTAMP) IS NULL THEN 'time is missing or unreadable'
             WHEN try_cast(value AS DOUBLE) IS NULL THEN 'value is not a number'
             WHEN NOT isfinite(try_cast(value AS DOUBLE)) THEN 'value is not finite'
             WHEN metadata NOT LIKE '{%' THEN 'metadata is not an object' END AS reject_reason
    FROM raw_records"""


@query(
    "split_valid",
    f"SELECT time, entity_id, value, value2 FROM ({_JUDGED}) WHERE reject_reason IS NULL",
    "value value2",
)
def _(t):
    return quality.split_valid(t.raw_records)[0].select("time", "entity_id", "value", "value2")


@query(
    "split_valid_rejects",
    f"""SELECT time, entity_id, reject_reason, count(*) AS n FROM ({_JUDGED})
    WHERE reject_reason IS NOT NULL GROUP BY 1, 2, 3""",
)
def _(t):
    rejects = quality.split_valid(t.raw_records)[1]
    return rejects.groupBy("time", "entity_id", "reject_reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "split_valid_entities",
    """SELECT c_name AS entity_id, c_mktsegment AS entity_type,
           CASE WHEN NOT regexp_full_match(c_name, '[A-Za-z0-9_.-]+')
                THEN 'entity_id has illegal characters' END AS reject_reason
    FROM (SELECT CASE WHEN c_acctbal > 0 THEN replace(c_name, '#', '_') ELSE c_name END AS c_name,
                 lower(c_mktsegment) AS c_mktsegment FROM customer)""",
)
def _(t):
    raw = t.customer.select(
        F.when(F.col("c_acctbal") > 0, F.replace("c_name", F.lit("#"), F.lit("_")))
        .otherwise(F.col("c_name"))
        .alias("entity_id"),
        F.lower("c_mktsegment").alias("entity_type"),
    )
    good, bad = quality.split_valid_entities(raw)
    return good.withColumn("reject_reason", F.lit(None).cast("string")).unionByName(bad)


@query(
    "check_ticks",
    """SELECT time, symbol, price, coalesce(price > 0 AND (volume IS NULL OR volume >= 0)
           AND bid_price > 0 AND ask_price > 0 AND bid_price <= ask_price, FALSE) AS is_valid
    FROM price_ticks""",
    "price",
)
def _(t):
    return quality.check_ticks(t.price_ticks).select("time", "symbol", "price", "is_valid")


@query(
    "check_ohlc",
    """SELECT time, symbol, interval_duration, data_source,
           high >= greatest(open, close) AND low <= least(open, close) AND open > 0 AND high > 0
           AND low > 0 AND close > 0 AND (volume IS NULL OR volume >= 0) AS is_valid
    FROM ohlc_data""",
)
def _(t):
    return quality.check_ohlc(t.ohlc_data).select(
        "time", "symbol", "interval_duration", "data_source", "is_valid"
    )


@query("derive_ohlc_columns", "SELECT * FROM ohlc_data", _BARS)
def _(t):
    return quality.derive_ohlc_columns(t.ohlc_data.drop("price_change", "price_change_percent"))


@query(
    "check_finite",
    """SELECT time, entity_id, value2, coalesce(isfinite(value2), TRUE) AS is_valid
    FROM (SELECT time, entity_id, CASE WHEN value2 = 7 THEN 'nan'::DOUBLE
                 WHEN value2 = 8 THEN 'inf'::DOUBLE ELSE value2 END AS value2 FROM records)
    WHERE value2 IS NULL OR value2 = value2""".replace(
        "value2, coalesce", "CASE WHEN isfinite(value2) THEN value2 END AS value2, coalesce"
    ),
    "value2",
)
def _(t):
    broken = t.records.withColumn(
        "value2",
        F.when(F.col("value2") == 7, F.lit(float("nan")))
        .when(F.col("value2") == 8, F.lit(float("inf")))
        .otherwise(F.col("value2")),
    )
    shown = F.when(F.col("is_valid"), F.col("value2")).alias("value2")
    return quality.check_finite(broken).select("time", "entity_id", shown, "is_valid")


@query(
    "fk_orphans",
    """SELECT time, entity_id, value FROM records
    WHERE entity_id NOT IN (SELECT entity_id FROM entities WHERE is_active)""",
    "value",
)
def _(t):
    orphans = quality.fk_orphans(t.records, t.entities.filter("is_active"))
    return orphans.select("time", "entity_id", "value")


@query(
    "dedupe_records",
    """SELECT entity_id, time, value, order_key FROM (
        SELECT *, row_number() OVER (PARTITION BY entity_id, time ORDER BY order_key) AS rn
        FROM order_records) WHERE rn = 1""",
    "value",
)
def _(t):
    return quality.dedupe_records(t.order_records, ["order_key"])


@query(
    "clean_records",
    """SELECT regexp_replace(lower(entity_id), '[^a-z0-9_]', '', 'g') AS entity_id,
           try_cast(time AS TIMESTAMP) AS time,
           CASE WHEN try_cast(value AS DOUBLE) IS NULL OR isnan(try_cast(value AS DOUBLE)) THEN 0
                WHEN isinf(try_cast(value AS DOUBLE)) THEN -1
                ELSE try_cast(value AS DOUBLE) END AS value,
           nullif(CAST(value2 AS DOUBLE), 0) AS value2, coalesce(metadata, '{}') AS metadata
    FROM raw_records""",
    "value value2",
)
def _(t):
    cleaned = quality.clean_records(t.raw_records)
    shown = F.when(F.col("value") == float("inf"), F.lit(-1.0)).otherwise(F.col("value"))
    return cleaned.select("entity_id", "time", shown.alias("value"), "value2", "metadata")


@query(
    "repair_ticks",
    f"""SELECT regexp_replace(upper(entity_id), '[^A-Z0-9_]', '', 'g') AS symbol,
           coalesce(try_cast(time AS TIMESTAMP), TIMESTAMP '{AS_OF}') AS time,
           CASE WHEN try_cast(value AS DOUBLE) IS NULL OR NOT isfinite(try_cast(value AS DOUBLE))
                THEN 0 ELSE abs(50 - try_cast(value AS DOUBLE)) END AS price
    FROM raw_records""",
    "price",
)
def _(t):
    number = F.col("value").try_cast("double")
    raw = t.raw_records.select(
        F.col("entity_id").alias("symbol"),
        "time",
        F.when(number < float("inf"), (50 - number).cast("string")).otherwise(F.lit("n/a")).alias("price"),
    )
    return quality.repair_ticks(raw, AS_OF)


_VALIDATED = """SELECT symbol, issue_type, issue_count,
           CASE issue_type
               WHEN 'duplicate_timestamps' THEN 'Multiple price entries for the same timestamp'
               WHEN 'large_price_gaps'
                   THEN 'Price changes greater than 10% between consecutive ticks'
               WHEN 'missing_volume' THEN 'Price ticks without volume information'
               ELSE 'Zero or negative price values' END AS description
    FROM (
        SELECT symbol, 'duplicate_timestamps' AS issue_type,
               count(CASE WHEN n > 1 THEN 1 END) AS issue_count
        FROM (SELECT symbol, time, count(*) AS n FROM {table} WHERE {range} GROUP BY 1, 2) GROUP BY 1
        UNION ALL
        SELECT symbol, 'large_price_gaps', count(CASE WHEN abs((price - before) / before) > 0.1 THEN 1 END)
        FROM (SELECT symbol, price, lag(price) OVER (PARTITION BY symbol ORDER BY time, price) AS before
              FROM {table} WHERE {range}) GROUP BY 1
        UNION ALL
        SELECT symbol, 'missing_volume', count(CASE WHEN volume IS NULL THEN 1 END)
        FROM {table} WHERE {range} GROUP BY 1
        UNION ALL
        SELECT symbol, 'invalid_prices', count(CASE WHEN price <= 0 THEN 1 END)
        FROM {table} WHERE {range} GROUP BY 1)"""


@query(
    "validate_ticks",
    _VALIDATED.format(
        table="price_ticks", range=f"time >= TIMESTAMP '{START}' AND time <= TIMESTAMP '{END}'"
    ),
)
def _(t):
    return quality.validate_ticks(t.price_ticks, START, END, tie=["price"])


@query(
    "validate_ticks_duplicates",
    _VALIDATED.format(
        table="ticks_dup",
        range="time >= TIMESTAMP '1990-01-01' AND time <= TIMESTAMP '2010-01-01'",
    ),
)
def _(t):
    return quality.validate_ticks(t.ticks_dup, "1990-01-01", "2010-01-01", tie=["price"])


_SHIFTED = "SELECT time, symbol, price - 20 AS price, volume FROM price_ticks"


@query(
    "clean_ticks_dry_run",
    f"""SELECT 'DRY RUN: Would clean ' || count(*) || ' rows with invalid prices' AS message,
           count(*) AS row_count
    FROM ({_SHIFTED}) WHERE price <= 0 AND time >= TIMESTAMP '{START}' AND time <= TIMESTAMP '{END}'""",
)
def _(t):
    shifted = t.price_ticks.withColumn("price", F.col("price") - 20)
    return quality.clean_ticks(shifted, START, END)


@query("clean_ticks", f"SELECT * FROM ({_SHIFTED}) WHERE price > 0", "price volume")
def _(t):
    shifted = t.price_ticks.withColumn("price", F.col("price") - 20)
    return quality.clean_ticks(shifted, START, END, dry_run=False).select(
        "time", "symbol", "price", "volume"
    )


_TYPES = ("stock", "crypto", "forex", "commodity", "index", "etf", "bond")


@query(
    "check_symbols",
    f"""SELECT CASE WHEN p_partkey % 5 = 0 THEN 'p ' ELSE 'P_' END || p_partkey AS symbol,
           list_extract({list(_TYPES)}, p_partkey % 7 + 1) AS asset_type,
           p_partkey % 5 <> 0 AND p_partkey % 7 <> 6 AS is_valid
    FROM part""",
)
def _(t):
    part = t.spark.read.parquet(f"{t.sf_dir}/part.parquet")
    key, kinds = F.col("p_partkey"), F.array(*[F.lit(k) for k in _TYPES])
    symbols = part.select(
        F.concat(F.when(key % 5 == 0, "p ").otherwise("P_"), key).alias("symbol"),
        F.get(kinds, (key % 7).cast("int")).alias("asset_type"),
    )
    return quality.check_symbols(symbols)


@query(
    "check_data_sources",
    """SELECT s_suppkey AS id, s_suppkey % 11 <> 0 AND s_suppkey % 13 <= 10
           AND coalesce(nullif(s_suppkey % 4, 3) > 0, TRUE) AND s_suppkey % 3 >= 1 AS is_valid
    FROM supplier""",
)
def _(t):
    key = F.col("s_suppkey")
    sources = t.spark.read.parquet(f"{t.sf_dir}/supplier.parquet").select(
        key.alias("id"),
        F.when(key % 11 == 0, " ").otherwise(F.col("s_name")).alias("name"),
        (key % 13 / 10).cast("decimal(3,2)").alias("reliability_score"),
        F.when(key % 4 != 3, key % 4).alias("rate_limit_per_minute"),
        (key % 3 - 1).alias("data_delay_seconds"),
    )
    return quality.check_data_sources(sources).select("id", "is_valid")
