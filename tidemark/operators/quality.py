"""Validation, repair and clean-up of rows."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.instants import Instant, at, within
from tidemark.functions.measures import (
    ENTITY_ID,
    ENTITY_TYPE,
    SYMBOL,
    VALUE_COLUMNS,
    is_finite,
    percent_change,
    pick,
    ratio,
)
from tidemark.operators.sequence import HOT_ROWS, with_previous
from tidemark.schemas import ASSET_TYPES, INTERVAL_CODES

REASON = "reject_reason"


def _first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first broken rule; a rule that is NULL counts as broken."""
    return F.coalesce(*[F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in rules])


def _optional(name: str, rule: Column) -> Column:
    return F.col(name).isNull() | rule


def with_record_reason(raw: DataFrame) -> DataFrame:
    """Type the columns of raw records and add ``reject_reason``, NULL when valid."""
    entity = F.col("entity_id")
    typed = {"time": _moment(raw, "time")}
    typed.update({c: F.col(c).try_cast("double") for c in VALUE_COLUMNS})
    lost = [
        (f"{c} is not a number", F.col(c).isNull() | F.col(c).try_cast("double").isNotNull())
        for c in VALUE_COLUMNS
    ]
    finite = [(f"{c} is not finite", _optional(c, is_finite(F.col(c).try_cast("double"))))
              for c in VALUE_COLUMNS]
    metadata = F.trim("metadata")
    is_object = F.coalesce(
        F.try_parse_json(metadata).isNotNull() & metadata.startswith("{"), F.lit(False)
    )
    rules = [
        ("entity_id is missing", F.length(F.trim(entity)) > 0),
        ("entity_id is too long", F.length(entity) <= 100),
        ("entity_id has illegal characters", entity.rlike(ENTITY_ID)),
        ("time is missing or unreadable", typed["time"].isNotNull()),
        ("value is missing", F.col("value").isNotNull()),
        *lost,
        *finite,
        ("metadata is not an object", _optional("metadata", is_object)),
    ]
    return raw.withColumn(REASON, _first_reason(rules)).withColumns(typed)


def split_valid(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records that may be stored, and the rest with the reason why not."""
    return _split(with_record_reason(raw))


def with_entity_reason(raw: DataFrame) -> DataFrame:
    rules = [
        ("entity_id is missing", F.length(F.trim("entity_id")) > 0),
        ("entity_id is too long", F.length("entity_id") <= 100),
        ("entity_id has illegal characters", F.col("entity_id").rlike(ENTITY_ID)),
        ("entity_type is missing", F.length(F.trim("entity_type")) > 0),
        ("entity_type is too long", F.length("entity_type") <= 50),
        ("entity_type has illegal characters", F.col("entity_type").rlike(ENTITY_TYPE)),
    ]
    return raw.withColumn(REASON, _first_reason(rules))


def split_valid_entities(raw: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Entities with a proper id and type, and the rest with the reason why not."""
    return _split(with_entity_reason(raw))


def _split(reasoned: DataFrame) -> tuple[DataFrame, DataFrame]:
    good = reasoned.filter(F.col(REASON).isNull()).drop(REASON)
    return good, reasoned.filter(F.col(REASON).isNotNull())


def _all(*rules: Column) -> Column:
    return F.coalesce(reduce(Column.__and__, rules), F.lit(False))


def _ordinary(*names: str) -> list[Column]:
    return [_optional(n, is_finite(F.col(n).cast("double"))) for n in names]


def _keys(df: DataFrame, *names: str) -> list[Column]:
    return [F.col(n).isNotNull() for n in names if n in df.columns]


def check_symbols(symbols: DataFrame) -> DataFrame:
    """Each symbol with ``is_valid``: its spelling, and one of the known kinds of asset."""
    return symbols.withColumn(
        "is_valid", _all(F.col("symbol").rlike(SYMBOL), F.col("asset_type").isin(*ASSET_TYPES))
    )


def check_data_sources(sources: DataFrame) -> DataFrame:
    """Each data source with ``is_valid``: a name, a score from 0 to 1, a positive rate, no
    negative delay."""
    return sources.withColumn(
        "is_valid",
        _all(
            F.length(F.trim("name")) > 0,
            _optional("reliability_score", F.col("reliability_score").between(0, 1)),
            _optional("rate_limit_per_minute", F.col("rate_limit_per_minute") > 0),
            _optional("data_delay_seconds", F.col("data_delay_seconds") >= 0),
        ),
    )


def check_ticks(ticks: DataFrame) -> DataFrame:
    """Each tick with ``is_valid``: symbol and time there, positive prices, bid not above
    ask, volume not negative, and every number an ordinary one."""
    bid, ask = F.col("bid_price"), F.col("ask_price")
    return ticks.withColumn(
        "is_valid",
        _all(
            *_keys(ticks, "symbol", "time"),
            *_ordinary("price", "volume", "bid_price", "ask_price"),
            F.col("price") > 0,
            _optional("volume", F.col("volume") >= 0),
            _optional("bid_price", bid > 0),
            _optional("ask_price", ask > 0),
            bid.isNull() | ask.isNull() | (bid <= ask),
        ),
    )


def check_ohlc(bars: DataFrame) -> DataFrame:
    """Each bar with ``is_valid``: symbol and time there, ordered positive prices, every
    number an ordinary one, and a known interval code."""
    prices = [F.col(c) for c in ("open", "high", "low", "close")]
    return bars.withColumn(
        "is_valid",
        _all(
            *_keys(bars, "symbol", "time"),
            *_ordinary("open", "high", "low", "close", "volume"),
            *[p > 0 for p in prices],
            F.col("high") >= F.greatest("open", "close"),
            F.col("low") <= F.least("open", "close"),
            _optional("volume", F.col("volume") >= 0),
            F.col("interval_duration").isin(*INTERVAL_CODES),
        ),
    )


def check_aggregates(aggregates: DataFrame) -> DataFrame:
    """Each aggregate row with ``is_valid``: entity and time there, mean between extremes,
    ordinary numbers, some rows, known code."""
    low, mean, high = F.col("min_value"), F.col("avg_value"), F.col("max_value")
    return aggregates.withColumn(
        "is_valid",
        _all(
            *_keys(aggregates, "entity_id", "time"),
            *_ordinary("min_value", "avg_value", "max_value"),
            high >= low,
            mean >= low,
            mean <= high,
            F.col("count") > 0,
            F.col("interval_duration").isin(*INTERVAL_CODES),
        ),
    )


def check_finite(records: DataFrame) -> DataFrame:
    """Each record with ``is_valid``: every present value is an ordinary number."""
    return records.withColumn(
        "is_valid",
        _all(is_finite(F.col("value")), *[_optional(c, is_finite(F.col(c))) for c in VALUE_COLUMNS[1:]]),
    )


def derive_ohlc_columns(bars: DataFrame) -> DataFrame:
    """Add ``price_change`` and ``price_change_percent``."""
    change = F.when(F.col("open") > 0, percent_change(F.col("open"), F.col("close")))
    return bars.withColumns(
        {"price_change": F.col("close") - F.col("open"), "price_change_percent": change}
    )


def fk_orphans(records: DataFrame, entities: DataFrame) -> DataFrame:
    """Records of unknown entities."""
    return records.join(entities.select("entity_id"), "entity_id", "left_anti")


def dedupe_records(
    records: DataFrame, order: Sequence[str], keys: Sequence[str] = ("entity_id", "time")
) -> DataFrame:
    """First row of each key in the given order.

    The rank limit is applied before the shuffle too, so a key with very many
    copies sends one row per map task.
    """
    first = Window.partitionBy(*keys).orderBy(*order)
    return (
        records.withColumn("_rank", F.row_number().over(first))
        .filter(F.col("_rank") == 1)
        .drop("_rank")
    )


def clean_records(raw: DataFrame) -> DataFrame:
    """Make raw records fit: plain ids, numbers or nothing, metadata or ``{}``."""

    def optional(name: str) -> Column:
        return F.nullif(F.col(name).try_cast("double"), F.lit(0.0)).alias(name)

    value = F.col("value").try_cast("double")
    usable = F.when(~F.isnan(value), value)
    return raw.select(
        F.regexp_replace(F.lower("entity_id"), "[^a-z0-9_]", "").alias("entity_id"),
        _moment(raw, "time").alias("time"),
        F.coalesce(usable, F.lit(0.0)).alias("value"),
        *[optional(c) for c in VALUE_COLUMNS[1:]],
        F.coalesce("metadata", F.lit("{}")).alias("metadata"),
    )


def repair_ticks(raw: DataFrame, as_of: Instant) -> DataFrame:
    """Mend invalid fields: sign of the price, spelling of the symbol, missing time."""
    price = F.abs(F.col("price").try_cast("double"))
    return raw.withColumns(
        {
            "price": F.coalesce(F.when(~F.isnan(price), price), F.lit(0.0)),
            "symbol": F.regexp_replace(F.upper("symbol"), "[^A-Z0-9_]", ""),
            "time": F.coalesce(_moment(raw, "time"), at(as_of)),
        }
    )


# The issue types and the descriptions reported with them.
_ISSUES = {
    "duplicate_timestamps": "Multiple price entries for the same timestamp",
    "large_price_gaps": "Price changes greater than 10% between consecutive ticks",
    "missing_volume": "Price ticks without volume information",
    "invalid_prices": "Zero or negative price values",
}


def validate_ticks(
    ticks: DataFrame,
    start: Instant,
    end: Instant,
    symbol: str | None = None,
    *,
    tie: Sequence[str] = (),
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Four issue counts per symbol over the closed range, zeros included.

    Ticks of equal time follow each other by price and volume unless ``tie`` says
    otherwise. A symbol that is asked for by name gets its counts without any tick.
    """
    rows = pick(within(ticks, start, end, closed=True), symbol, key="symbol").select(
        "symbol", "time", "price", "volume"
    )
    paired = with_previous(rows, ["symbol"], ["time", "price"], tie=tie, max_rows=max_rows)
    before = F.col("previous.price")
    # Any step away from zero is a large one.
    jumped = F.when(before == 0, F.col("price") != 0).otherwise(
        F.abs(ratio(F.col("price") - before, before)) > 0.1
    )
    repeated = F.when(F.col("time") == F.col("previous.time"), F.col("time"))
    counted = paired.groupBy("symbol").agg(
        F.count_distinct(repeated).alias("duplicate_timestamps"),
        F.count_if(jumped).alias("large_price_gaps"),
        F.count_if(F.col("volume").isNull()).alias("missing_volume"),
        F.count_if(F.col("price") <= 0).alias("invalid_prices"),
    )
    if isinstance(symbol, str):
        asked = ticks.sparkSession.range(1).select(F.lit(symbol).alias("symbol"))
        counted = asked.join(counted, "symbol", "left").na.fill(0, list(_ISSUES))
    long = counted.unpivot("symbol", list(_ISSUES), "issue_type", "issue_count")
    told = [F.when(F.col("issue_type") == name, text) for name, text in _ISSUES.items()]
    return long.withColumn("description", F.coalesce(*told))


# The messages a clean-up reports.
DRY_RUN_MESSAGE = "DRY RUN: Would clean %d rows with invalid prices"
CLEANED_MESSAGE = "Cleaned %d rows with invalid prices"


def _is_unclean(start: Instant, end: Instant, symbol: str | None) -> Column:
    bad = F.col("price").isNull() | (F.col("price") <= 0)
    inside = (F.col("time") >= at(start)) & (F.col("time") <= at(end))
    return bad & inside & (F.lit(True) if symbol is None else F.col("symbol") == symbol)


def clean_ticks(
    ticks: DataFrame, start: Instant, end: Instant, symbol: str | None = None, *, dry_run: bool = True
) -> DataFrame:
    """What a clean-up would remove (``dry_run``), or the ticks that remain."""
    bad = _is_unclean(start, end, symbol)
    if not dry_run:
        return ticks.filter(~bad)
    return (
        within(ticks, start, end, closed=True)
        .filter(bad)
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.format_string(DRY_RUN_MESSAGE, "row_count").alias("message"), "row_count"
        )
    )


def _moment(raw: DataFrame, name: str) -> Column:
    """A timestamp column as it is, text parsed, unreadable text NULL."""
    kind = dict(raw.dtypes)[name]
    return F.try_to_timestamp(F.col(name)) if kind == "string" else F.col(name).cast("timestamp")
