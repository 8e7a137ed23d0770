"""Column layouts of the stored tables.

Two families share the operators: generic records of entities, and price ticks
or bars of symbols. Fact tables carry a ``day`` partition column when stored.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType, bool]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, null) for name, kind, null in fields])


_TS, _STR, _DBL, _BOOL = T.TimestampType(), T.StringType(), T.DoubleType(), T.BooleanType()

RECORDS = _struct(
    ("time", _TS, False),
    ("entity_id", _STR, False),
    ("value", _DBL, False),
    ("value2", _DBL, True),
    ("value3", _DBL, True),
    ("value4", _DBL, True),
    ("metadata", _STR, True),
)

ENTITIES = _struct(
    ("entity_id", _STR, False),
    ("entity_type", _STR, False),
    ("name", _STR, True),
    ("description", _STR, True),
    ("metadata", _STR, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
    ("is_active", _BOOL, True),
)

TICKS = _struct(
    ("time", _TS, False),
    ("symbol", _STR, False),
    ("price", _DBL, False),
    ("volume", _DBL, True),
    ("exchange", _STR, True),
    ("data_source", _STR, True),
    ("bid_price", _DBL, True),
    ("ask_price", _DBL, True),
    ("created_at", _TS, True),
)

OHLC = _struct(
    ("time", _TS, False),
    ("symbol", _STR, False),
    ("interval_duration", _STR, False),
    ("open", _DBL, False),
    ("high", _DBL, False),
    ("low", _DBL, False),
    ("close", _DBL, False),
    ("volume", _DBL, True),
    ("price_change", _DBL, True),
    ("price_change_percent", _DBL, True),
    ("data_source", _STR, True),
    ("created_at", _TS, True),
)

SYMBOLS = _struct(
    ("symbol", _STR, False),
    ("name", _STR, True),
    ("asset_type", _STR, False),
    ("exchange", _STR, True),
    ("currency", _STR, True),
    ("sector", _STR, True),
    ("market_cap", T.LongType(), True),
    ("is_active", _BOOL, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
)

DATA_SOURCES = _struct(
    ("id", T.IntegerType(), False),
    ("name", _STR, False),
    ("description", _STR, True),
    ("base_url", _STR, True),
    ("api_key_required", _BOOL, True),
    ("rate_limit_per_minute", T.IntegerType(), True),
    ("data_delay_seconds", T.IntegerType(), True),
    ("reliability_score", T.DecimalType(3, 2), True),
    ("is_active", _BOOL, True),
    ("created_at", _TS, True),
    ("updated_at", _TS, True),
)

AGGREGATES = _struct(
    ("time", _TS, False),
    ("entity_id", _STR, False),
    ("interval_duration", _STR, False),
    ("min_value", _DBL, False),
    ("max_value", _DBL, False),
    ("avg_value", _DBL, False),
    ("sum_value", _DBL, True),
    ("count", T.LongType(), False),
    ("value_range", _DBL, True),
    ("data_source", _STR, True),
    ("created_at", _TS, True),
)

RUN_LOG = _struct(
    ("version", _STR, False),
    ("description", _STR, True),
    ("applied_at", _TS, False),
    ("applied_by", _STR, True),
)

# The interval codes a bar or aggregate may carry.
INTERVAL_CODES = ("1m", "5m", "15m", "30m", "1h", "2h", "4h", "6h", "12h", "1d", "1w", "1M")

# The kinds of asset a symbol may be.
ASSET_TYPES = ("stock", "crypto", "forex", "commodity", "index", "etf")
