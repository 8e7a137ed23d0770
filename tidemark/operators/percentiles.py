"""Exact interpolated percentiles that survive a hot group.

Spark's ``percentile`` keeps every distinct value of a group in one buffer. That
is fine for ordinary groups; a group of more than ``max_rows`` rows instead gets
its answer by bracketing: a mergeable sketch gives two values that enclose the
wanted rank, one pass counts what lies below and groups what lies inside, and
only that thin slice is ranked. Should a sketch ever miss the rank, the group's
values are counted and ranked whole, so there is always an answer, and the same one.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.sequence import few_or_all

HOT_GROUP = 1_000_000
_ACCURACY = 10_000
_MARGIN = 2.0 / _ACCURACY


def group_with_percentiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    wanted: Mapping[str, float],
    others: Sequence[Column] = (),
    max_rows: int = HOT_GROUP,
) -> DataFrame:
    """``groupBy(keys).agg(others)`` plus one exact percentile per ``wanted`` name.

    The hot groups are counted first, by a job of their own; without any, Spark's
    ``percentile`` is all there is.
    """
    keys = list(keys)
    if not keys:
        df, keys = df.withColumn("_all", F.lit(1)), ["_all"]
    hot = (
        df.groupBy(*keys)
        .agg(F.count(value).alias("_n"))
        .filter(F.col("_n") > max_rows)
    )
    hot, any_hot = few_or_all(hot)
    if not any_hot:
        return df.groupBy(*keys).agg(
            *others, *[F.percentile(value, q).alias(name) for name, q in wanted.items()]
        ).drop("_all")
    marked = _join_nullsafe(df, hot, keys, "left")
    ordinary = F.when(F.col("_n").isNull(), F.col(value))
    result = marked.groupBy(*keys).agg(
        *others, *[F.percentile(ordinary, q).alias(name) for name, q in wanted.items()]
    )
    hot_rows = marked.filter(F.col("_n").isNotNull() & F.col(value).isNotNull())
    exact = _bracketed(hot_rows.select(*keys, value, "_n"), keys, value, wanted)
    joined = _join_nullsafe(result, exact, keys, "left")
    chosen = {name: F.coalesce(F.col(f"_exact_{name}"), F.col(name)) for name in wanted}
    return joined.withColumns(chosen).drop("_all", *[f"_exact_{name}" for name in wanted])


def _bracketed(
    rows: DataFrame, keys: list[str], value: str, wanted: Mapping[str, float]
) -> DataFrame:
    """Exact percentiles of large groups; ``_n`` holds each group's row count."""
    limits = [(max(0.0, q - _MARGIN), min(1.0, q + _MARGIN)) for q in wanted.values()]
    ends = rows.groupBy(*keys).agg(
        F.percentile_approx(value, [p for pair in limits for p in pair], _ACCURACY).alias("_ends"),
        F.min(value).alias("_min"),
        F.max(value).alias("_max"),
    )
    # At either end of the order the sketch is replaced by the true extreme.
    brackets = [
        F.struct(
            F.lit(name).alias("_name"),
            F.lit(q).alias("_q"),
            (F.col("_ends")[2 * i] if low > 0 else F.col("_min")).alias("_low"),
            (F.col("_ends")[2 * i + 1] if high < 1 else F.col("_max")).alias("_high"),
        )
        for i, ((name, q), (low, high)) in enumerate(zip(wanted.items(), limits, strict=True))
    ]
    bracket = ends.select(*keys, "_min", "_max", F.inline(F.array(*brackets)))
    picked = _picked(rows, bracket, keys, value)
    hit = picked.filter(~F.col("_missed"))
    missed = _join_nullsafe(bracket, hit.select(*keys, "_name"), [*keys, "_name"], "left_anti")
    whole = missed.withColumns({"_low": F.col("_min"), "_high": F.col("_max")})
    found = hit.unionByName(_picked(rows, whole, keys, value))
    return found.groupBy(*keys).agg(
        *[
            F.max(F.when(F.col("_name") == name, F.col("_exact"))).alias(f"_exact_{name}")
            for name in wanted
        ]
    )


def _picked(rows: DataFrame, bracket: DataFrame, keys: list[str], value: str) -> DataFrame:
    """``_exact`` per group and name, and whether the bracket ``_missed`` the rank."""
    placed = _join_nullsafe(rows, few_or_all(bracket.drop("_min", "_max"))[0], keys, "inner")
    per = [*keys, "_name"]
    below = placed.groupBy(*per).agg(F.count_if(F.col(value) < F.col("_low")).alias("_below"))
    counted = (
        placed.filter(F.col(value).between(F.col("_low"), F.col("_high")))
        .groupBy(*per, "_q", "_n", value)
        .agg(F.count(F.lit(1)).alias("_count"))
    )
    upto = Window.partitionBy(*per).orderBy(value).rowsBetween(Window.unboundedPreceding, 0)
    ranked = _join_nullsafe(counted, below, per, "inner").withColumn(
        "_upto", F.col("_below") + F.sum("_count").over(upto)
    )
    position = F.col("_q") * (F.col("_n") - 1)
    lower, upper = F.floor(position), F.ceil(position)
    picked = ranked.groupBy(*per, "_q", "_n", "_below").agg(
        F.min(F.when(F.col("_upto") > lower, F.col(value))).alias("_lower"),
        F.min(F.when(F.col("_upto") > upper, F.col(value))).alias("_upper"),
    )
    missed = (F.col("_below") > lower) | F.col("_lower").isNull() | F.col("_upper").isNull()
    between = F.col("_lower") + (F.col("_upper") - F.col("_lower")) * (position - lower)
    return picked.select(*keys, "_name", between.alias("_exact"), missed.alias("_missed"))


def _join_nullsafe(left: DataFrame, right: DataFrame, keys: list[str], how: str) -> DataFrame:
    """Equi-join on keys that may be NULL, keeping the left key columns."""
    renamed = right.select(
        *[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]
    )
    match = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    return left.join(renamed, match, how).drop(*[f"_r_{k}" for k in keys])
