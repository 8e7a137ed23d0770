"""Projections of domain readings onto the record schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _record(
    df: DataFrame, entity: Column, time: str, values: Sequence[Column | str | None], extra: Sequence[Column]
) -> DataFrame:
    """Entity, time, up to four values, and the rest as a JSON object."""
    numbers = [F.lit(None) if v is None else F.col(v) if isinstance(v, str) else v for v in values]
    numbers += [F.lit(None)] * (4 - len(numbers))
    names = ("value", "value2", "value3", "value4")
    return df.select(
        F.col(time).cast("timestamp").alias("time"),
        entity.alias("entity_id"),
        *[n.cast("double").alias(name) for n, name in zip(numbers, names, strict=True)],
        F.to_json(F.struct(*extra)).alias("metadata"),
    )


def map_sensor(readings: DataFrame) -> DataFrame:
    """Temperature, humidity, pressure and battery of a sensor."""
    return _record(
        readings,
        F.col("sensor_id"),
        "timestamp",
        ["temperature", "humidity", "pressure", "battery_level"],
        [F.col("location"), F.col("sensor_type")],
    )


def map_server(metrics: DataFrame) -> DataFrame:
    """Processor, memory, disk and network use of a server."""
    return _record(
        metrics,
        F.col("server_id"),
        "timestamp",
        ["cpu_usage", "memory_usage", "disk_usage", "network_io"],
        [F.col("hostname"), F.col("datacenter")],
    )


def map_api(calls: DataFrame, entity: str = "api_gateway") -> DataFrame:
    """Response time, success flag and sizes of a service call."""
    success = F.when(F.col("status_code") == 200, 1.0).otherwise(0.0)
    return _record(
        calls,
        F.lit(entity),
        "timestamp",
        ["response_time", success, "request_size", "response_size"],
        [F.col("endpoint"), F.col("method"), F.col("status_code"), F.col("user_agent")],
    )
