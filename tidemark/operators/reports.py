"""Summaries of tables, entity types and services."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, at, back, within
from tidemark.functions.measures import pick
from tidemark.operators.percentiles import group_with_percentiles

# Row counts that change the verdict on a table, and the verdicts.
_SIZE_VERDICTS = (
    (100_000_000, "Very large table - ensure proper indexing"),
    (10_000_000, "Large table - monitor query performance"),
)
_NORMAL_SIZE = "Normal table size"


def domain_stats(records: DataFrame, entities: DataFrame) -> DataFrame:
    """Volume, span and mean per type of the active entities.

    Records are first summed up per entity, so the join with entities sees one
    row per entity and map-side combining takes care of heavy ones.
    """
    per_entity = records.groupBy("entity_id").agg(
        F.count(F.lit(1)).alias("_n"),
        F.min("time").alias("_from"),
        F.max("time").alias("_to"),
        F.sum("value").alias("_sum"),
        F.count("value").alias("_values"),
        F.count("value2").alias("_value2"),
        F.count_if(F.col("metadata") != "{}").alias("_metadata"),
    )
    active = entities.filter("is_active").select("entity_id", "entity_type")
    return (
        per_entity.join(active, "entity_id")
        .groupBy("entity_type")
        .agg(
            F.sum("_n").alias("total_records"),
            F.min("_from").alias("earliest_record"),
            F.max("_to").alias("latest_record"),
            (F.sum("_sum") / F.sum("_values")).alias("avg_primary_value"),
            F.sum("_value2").alias("records_with_value2"),
            F.sum("_metadata").alias("records_with_metadata"),
        )
        .orderBy(F.col("total_records").desc(), "entity_type")
    )


def row_bytes(df: DataFrame) -> Column:
    """Plain size of a row: eight bytes a number or time, the bytes of each text."""

    def size(name: str, kind: str) -> Column:
        width = F.octet_length(name) if kind == "string" else F.lit(8)
        return F.when(F.col(name).isNotNull(), width).otherwise(F.lit(0))

    total = F.lit(0)
    for name, kind in df.dtypes:
        total = total + size(name, kind)
    return total


def ingestion_pattern(records: DataFrame, as_of: Instant, days: int = 7) -> DataFrame:
    """Rows, entities and mean row size per hour of the trailing days.

    Counted per hour and entity first: the distinct count then needs no
    expansion of the rows and a full hour is spread over its entities.
    """
    cutoff = back(as_of, days=days)
    recent = within(records, cutoff).filter(F.col("time") > at(cutoff))
    per_entity = recent.groupBy(F.date_trunc("hour", "time").alias("hour"), "entity_id").agg(
        F.count(F.lit(1)).alias("_n"), F.sum(row_bytes(records)).alias("_bytes")
    )
    return per_entity.groupBy("hour").agg(
        F.sum("_n").alias("record_count"),
        F.count(F.lit(1)).alias("entity_count"),
        (F.sum("_bytes") / F.sum("_n")).alias("avg_row_size"),
    )


def retention_summary(tables: Mapping[str, DataFrame], key: str = "symbol") -> DataFrame:
    """Rows, span and distinct keys per table."""
    whole: DataFrame | None = None
    for name, df in tables.items():
        per_key = df.groupBy(key).agg(
            F.count(F.lit(1)).alias("_n"), F.min("time").alias("_from"), F.max("time").alias("_to")
        )
        span = F.unix_micros(F.max("_to")) - F.unix_micros(F.min("_from"))
        summary = per_key.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_rows"),
            F.min("_from").alias("oldest_data"),
            F.max("_to").alias("newest_data"),
            F.floor(span / F.lit(86_400_000_000)).alias("data_span_days"),
            F.count(key).alias("unique_symbols"),
        ).select(F.lit(name).alias("table_name"), "*")
        whole = summary if whole is None else whole.unionByName(summary)
    if whole is None:
        raise ValueError("no tables given")
    return whole


def table_profile(df: DataFrame) -> DataFrame:
    """Row count and a word on its size."""
    steps = [F.when(F.col("_n") > least, text) for least, text in _SIZE_VERDICTS]
    verdict = F.coalesce(*steps, F.lit(_NORMAL_SIZE))
    return df.agg(F.count(F.lit(1)).alias("_n")).select(
        F.lit("row_count").alias("metric_name"),
        F.col("_n").cast("string").alias("metric_value"),
        verdict.alias("recommendation"),
    )


def server_health(
    records: DataFrame,
    start: Instant,
    end: Instant,
    ids: str | list[str] | DataFrame | None = None,
    *,
    max_cpu: float = 80.0,
    max_memory: float = 85.0,
) -> DataFrame:
    """Mean load and memory per server, and whether both are below their limits."""
    healthy = (F.col("avg_cpu_usage") < max_cpu) & (F.col("avg_memory_usage") < max_memory)
    return (
        pick(within(records, start, end), ids)
        .groupBy("entity_id")
        .agg(
            F.avg("value").alias("avg_cpu_usage"),
            F.avg(F.coalesce("value2", F.lit(0.0))).alias("avg_memory_usage"),
        )
        .withColumn("is_healthy", healthy)
    )


def success_rate(
    records: DataFrame,
    hours: float,
    as_of: Instant,
    ids: str | list[str] | DataFrame | None = None,
    *,
    flag: str = "value2",
    **limits: int,
) -> DataFrame:
    """Mean and 95th percentile latency and the share of flagged successes, in percent."""
    rows = pick(within(records, back(as_of, hours=hours), as_of, closed=True), ids)
    return group_with_percentiles(
        rows,
        ["entity_id"],
        "value",
        {"p95_response_time": 0.95},
        [
            F.avg("value").alias("avg_response_time"),
            (F.avg(flag) * 100).alias("success_rate"),
        ],
        **limits,
    )
