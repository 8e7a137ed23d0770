"""How a query and its SQL twin are registered, and how results are made comparable."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from registry.fixtures import Tables, with_views
from tidemark.session import prepare

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

START, END = "2024-01-01", "2024-01-31"
AS_OF = "2024-01-31 00:00:00"
PLACES = 6


def query(name: str, sql: str | None = None, doubles: str = ""):
    """Register a function of :class:`Tables` under a name.

    ``doubles`` names the floating-point columns, which both sides round.
    """

    def register(build: Callable[[Tables], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(build(Tables(prepare(spark), sf_dir)))

        QUERIES[name] = run
        if sql is not None:
            SQL[name] = _rounded(with_views(sql), doubles.split())
        return build

    return register


def _rounded(sql: str, doubles: list[str]) -> str:
    if not doubles:
        return sql
    columns = ", ".join(f"round({c}, {PLACES}) AS {c}" for c in doubles)
    return f"SELECT * REPLACE ({columns}) FROM ({sql})"


def comparable(df: DataFrame) -> DataFrame:
    """Flat columns of types both engines share: UTC wall times, rounded doubles, bigints."""
    columns: list[Column] = []

    def add(field: T.StructField, source: Column, name: str) -> None:
        kind = field.dataType
        if isinstance(kind, T.StructType):
            for inner in kind.fields:
                add(inner, source.getField(inner.name), f"{name}_{inner.name}")
            return
        if isinstance(kind, (T.TimestampType, T.DateType)):
            source = source.cast("timestamp_ntz")
        elif isinstance(kind, T.DoubleType):
            source = F.round(source, PLACES)
        elif isinstance(kind, (T.IntegerType, T.ShortType)):
            source = source.cast("bigint")
        columns.append(source.alias(name))

    for field in df.schema.fields:
        add(field, F.col(f"`{field.name}`"), field.name)
    return df.select(*columns)
