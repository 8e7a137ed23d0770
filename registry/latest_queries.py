"""Latest rows, coverage, movers, newest-N."""

from pyspark.sql import functions as F

from registry.core import AS_OF, query
from tidemark.operators import latest

_NUMBERS = "value value2 value3 value4"
_LATEST = """
    SELECT entity_id, arg_max_null(value, time) AS value, arg_max_null(value2, time) AS value2,
           arg_max_null(value3, time) AS value3, arg_max_null(value4, time) AS value4,
           {metadata} max(time) AS time
    FROM records GROUP BY entity_id"""


@query(
    "latest_record",
    _LATEST.format(metadata="arg_max_null(metadata, time) AS metadata,"),
    _NUMBERS,
)
def _(t):
    return latest.latest_record(t.records)


@query(
    "latest_value",
    "SELECT entity_id, arg_max_null(value, time) AS value FROM records GROUP BY entity_id",
    "value",
)
def _(t):
    return latest.latest_value(t.records)


@query("multi_entity_latest", _LATEST.format(metadata=""), _NUMBERS)
def _(t):
    return latest.multi_entity_latest(t.records, t.entities)


@query(
    "get_latest_values",
    f"SELECT * FROM ({_LATEST.format(metadata='')}) "
    "WHERE entity_id IN (SELECT entity_id FROM entities WHERE is_active)",
    _NUMBERS,
)
def _(t):
    return latest.get_latest_values(t.records, t.entities.filter("is_active"))


@query(
    "multi_entity_latest_map",
    f"SELECT entity_id, value, value2, value3, value4, time FROM entities "
    f"LEFT JOIN ({_LATEST.format(metadata='')}) USING (entity_id)",
    _NUMBERS,
)
def _(t):
    return latest.multi_entity_latest_map(t.records, t.entities)


@query(
    "latest_coverage",
    """SELECT count(*) AS requested, count(seen) AS found FROM entities
    LEFT JOIN (SELECT entity_id, max(time) AS seen FROM records GROUP BY 1) USING (entity_id)""",
)
def _(t):
    return latest.latest_coverage(t.records, t.entities)


@query(
    "top_changes",
    f"""SELECT *, (end_value - start_value) / nullif(start_value, 0) * 100 AS percent_change
    FROM (SELECT entity_id, arg_min_null(value, time) AS start_value,
                 arg_max_null(value, time) AS end_value
          FROM records WHERE time >= TIMESTAMP '{AS_OF}' - INTERVAL 240 HOUR
            AND time <= TIMESTAMP '{AS_OF}' GROUP BY entity_id)
    WHERE start_value <> 0 ORDER BY abs(percent_change) DESC, entity_id LIMIT 10""",
    "start_value end_value percent_change",
)
def _(t):
    return latest.top_changes(t.records, 10, 240, AS_OF)


@query(
    "keep_newest",
    """SELECT applied_at, entity_id FROM (
        SELECT time AS applied_at, entity_id,
               row_number() OVER (ORDER BY time DESC, entity_id DESC) AS rn FROM records)
    WHERE rn <= 20""",
)
def _(t):
    log = t.records.select(F.col("time").alias("applied_at"), "entity_id")
    return latest.keep_newest(log, 20, "entity_id")[0]


@query(
    "remove_old_versions",
    """SELECT version, applied_at FROM (
        SELECT o_orderkey AS version, o_orderdate AS applied_at,
               row_number() OVER (ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
    WHERE rn > 20""",
)
def _(t):
    log = t.orders.select(
        F.col("o_orderkey").alias("version"), F.col("o_orderdate").alias("applied_at")
    )
    return latest.keep_newest(log, 20, "version")[1]
