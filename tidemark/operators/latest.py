"""Latest rows, largest changes, newest-N.

The newest value per key is a ``max_by`` aggregate: it combines on the map side,
so no sort and no per-key task is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, back, within
from tidemark.functions.measures import (
    VALUE_COLUMNS,
    first_by,
    last_by,
    percent_change,
    pick,
)
from tidemark.operators.sequence import newest_rows


def multi_entity_latest(
    records: DataFrame,
    ids: str | Sequence[str] | DataFrame | None = None,
    *,
    include_metadata: bool = False,
) -> DataFrame:
    """The newest row of each entity; entities without rows are absent."""
    chosen = pick(records, ids)
    if include_metadata:
        # Text would turn the aggregate into a sort of all rows; a rank is cut before the shuffle.
        columns = ["entity_id", *VALUE_COLUMNS, "metadata", "time"]
        return newest_rows(chosen.select(*columns), ["entity_id"], 1).select(*columns)
    return chosen.groupBy("entity_id").agg(
        *[last_by(c).alias(c) for c in VALUE_COLUMNS], F.max("time").alias("time")
    )


get_latest_values = multi_entity_latest


def latest_record(records: DataFrame, entity: str | None = None) -> DataFrame:
    """Newest row of one entity, or of each."""
    return multi_entity_latest(records, entity, include_metadata=True)


def latest_value(records: DataFrame, entity: str | None = None) -> DataFrame:
    """Newest primary value of one entity, or of each."""
    return pick(records, entity).groupBy("entity_id").agg(last_by("value").alias("value"))


def multi_entity_latest_map(records: DataFrame, ids: DataFrame) -> DataFrame:
    """One row per requested id; values are NULL where there is no data."""
    wanted = ids.select("entity_id").distinct()
    return wanted.join(multi_entity_latest(records, wanted), "entity_id", "left")


def latest_coverage(records: DataFrame, ids: DataFrame) -> DataFrame:
    """How many ids were asked for and how many have data."""
    return multi_entity_latest_map(records, ids).agg(
        F.count(F.lit(1)).alias("requested"), F.count("time").alias("found")
    )


def top_changes(
    df: DataFrame,
    limit: int,
    hours: float,
    as_of: Instant,
    *,
    key: str = "entity_id",
    value: str = "value",
) -> DataFrame:
    """Keys with the largest percent change over the trailing window."""
    recent = within(df, back(as_of, hours=hours), as_of, closed=True)
    ends = recent.groupBy(key).agg(
        first_by(value).alias("start_value"), last_by(value).alias("end_value")
    )
    return (
        ends.withColumn("percent_change", percent_change(F.col("start_value"), F.col("end_value")))
        .filter(F.col("percent_change").isNotNull())
        .orderBy(F.abs("percent_change").desc(), F.col(key))
        .limit(limit)
    )


def keep_newest(
    df: DataFrame, count: int, key: str, time: str = "applied_at"
) -> tuple[DataFrame, DataFrame]:
    """Split a log into its ``count`` newest rows and the rest."""
    kept = df.orderBy(F.col(time).desc(), F.col(key).desc()).limit(count)
    return kept, df.join(kept.select(key), key, "left_anti")
