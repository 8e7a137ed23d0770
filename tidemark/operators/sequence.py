"""Ordered work inside a key without putting a whole key into one task.

A window partitioned by entity sends every row of that entity to one task. One
entity may hold a third of all rows, so ordered operators here first cut *hot*
keys into time slices and sort each slice on its own. What a slice needs from
the slices before it (the last row, or the last n rows) is small: it comes from
a map-side aggregate, and enters the slice as extra rows ahead of its own. The
data itself is shuffled once, by (key, slice).

Keys with at most ``max_rows`` rows stay in one slice and need no carried rows.
The hot keys are counted first, by a job of their own. Up to ``FEW`` of them are
broadcast and more are joined by a shuffle; without any, nothing is joined at all.

Rows of equal time are put in order by ``tie``, by default by all other columns, so
that results do not depend on how rows lie in partitions or whether a key is hot.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

HOT_ROWS = 8_000_000
FEW = 10_000  # rows of a side table that may be broadcast
_MINUTE = 60_000_000
_GROUP_LIMIT = 1000
_SALTS = 256


def few_or_all(df: DataFrame, most: int | None = None) -> tuple[DataFrame, bool]:
    """A side table to join with, and whether it has rows.

    A table of at most ``most`` rows (``FEW``) is fetched, once, and marked for broadcast;
    a larger one is left as it is, for Spark to join by its size.
    """
    most = FEW if most is None else most
    rows = df.limit(most + 1).collect()
    if len(rows) > most:
        return df, True
    return F.broadcast(df.sparkSession.createDataFrame(rows, df.schema)), bool(rows)


def total_order(df: DataFrame, keys: Sequence[str], time: str, tie: Sequence[str] = ()) -> list[str]:
    """Time and what settles equal times: the given columns, or else all that can be ordered."""
    rest = [
        f.name
        for f in df.schema.fields
        if f.name not in (*keys, time) and not isinstance(f.dataType, (T.MapType, T.VariantType))
    ]
    return [time, *(tie or rest)]


def with_slices(
    df: DataFrame,
    keys: Sequence[str],
    time: str = "time",
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add ``_hot`` and, for hot keys, ``_slice``: an ascending number per time slice.

    A hot key is sliced into spans of so many minutes that, at its mean rate,
    each holds a sixteenth of ``max_rows``, small enough to spread evenly. A span
    that is over-full nonetheless is cut by minute, and its minutes into as many
    equal parts as the fullest asks for. All of this rests on exact counts, so a
    recomputed branch cuts the same slices. Where no key is hot, all that runs is
    one count per key.
    """
    keys = list(keys)
    micros = F.unix_micros(F.col(time))
    minute = F.floor(micros / F.lit(_MINUTE))
    span = F.floor(F.col("_minute") / F.col("_minutes"))
    # Joins infer these null filters anyway, each its own; stated here they make
    # every use of the hot keys the same plan, so that it is computed once.
    present = df.select(*keys, time).dropna().select(*keys, minute.alias("_minute"))
    length = F.max("_minute") - F.min("_minute") + 1
    hot_keys = (
        present.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows"), length.alias("_length"))
        .filter(F.col("_rows") > max_rows)
        .select(
            *keys,
            F.lit(True).alias("_hot"),
            F.greatest(
                F.floor(F.col("_length") * max_rows / (F.col("_rows") * 16)), F.lit(1)
            ).alias("_minutes"),
        )
    )
    hot_keys, any_hot = few_or_all(hot_keys)
    if not any_hot:
        return df.withColumns(
            {"_hot": F.lit(None).cast("boolean"), "_slice": F.lit(None).cast("bigint")}
        )
    full_spans = (
        present.join(hot_keys, keys)
        .groupBy(*keys, span.alias("_span"), "_minute")
        .agg(F.count(F.lit(1)).alias("_rows"))
        .groupBy(*keys, "_span")
        .agg(F.sum("_rows").alias("_rows"), F.max("_rows").alias("_most"))
        .filter(F.col("_rows") > max_rows)
        .select(
            *keys,
            "_span",
            F.least(F.ceil(F.col("_most") / max_rows), F.lit(_MINUTE)).alias("_parts"),
        )
    )
    full_spans, _ = few_or_all(full_spans)
    part = F.floor(F.pmod(micros, F.lit(_MINUTE)) * F.col("_parts") / F.lit(_MINUTE))
    of_part = F.col("_minute") * _MINUTE + part * F.floor(F.lit(_MINUTE) / F.col("_parts"))
    of_span = F.col("_span") * F.col("_minutes") * _MINUTE
    return (
        df.withColumn("_minute", minute)
        .join(hot_keys, keys, "left")
        .withColumn("_span", span)
        .join(full_spans, [*keys, "_span"], "left")
        .withColumn("_slice", F.coalesce(of_part, of_span))
        .drop("_minute", "_minutes", "_span", "_parts")
    )


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    columns: Sequence[str],
    time: str = "time",
    tie: Sequence[str] = (),
    max_rows: int = HOT_ROWS,
) -> DataFrame:
    """Add struct ``previous``: the given columns of the row before, per key.

    NULL for the first row of a key. ``tie`` names further sort columns for rows
    of equal time, by default all others.
    """
    keys, order = list(keys), total_order(df, keys, time, tie)
    sliced = with_slices(df, keys, time, max_rows)
    row = F.struct(*columns)
    newest = F.struct(*order)
    tails = (
        sliced.filter(F.col("_hot"))
        .groupBy(*keys, "_slice")
        .agg(*[F.max_by(c, newest).alias(f"_last_{c}") for c in columns])
        .select(
            *keys, "_slice", F.struct(*[F.col(f"_last_{c}").alias(c) for c in columns]).alias("_tail")
        )
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    carried = tails.select(*keys, "_slice", F.lag("_tail").over(by_slice).alias("_tail")).filter(
        F.col("_tail").isNotNull()
    )
    current = sliced.select("*", row.alias("_tail"), F.lit(False).alias("_carried"))
    entering = carried.withColumn("_carried", F.lit(True))
    inside = Window.partitionBy(*keys, "_slice").orderBy(F.col("_carried").desc(), *order)
    return (
        current.unionByName(entering, allowMissingColumns=True)
        .withColumn("previous", F.lag("_tail").over(inside))
        .filter(~F.col("_carried"))
        .drop("_slice", "_hot", "_tail", "_carried")
    )


def with_history(
    df: DataFrame,
    keys: Sequence[str],
    rows: int,
    time: str = "time",
    tie: Sequence[str] = (),
    max_rows: int = HOT_ROWS,
) -> tuple[DataFrame, list[str], list[Column]]:
    """Rows arranged so that every frame of ``rows`` earlier rows is local.

    Returns the frame, the window partition columns and the window order.
    Copied rows carry ``_carried = true``: compute, then drop them.

    A slice of a hot key is given the last ``rows`` rows of as many slices before it
    as together hold ``rows`` rows. Which ones follows from the counts per slice; the
    rows themselves never meet in a task of the key, only in that of the slice.
    """
    keys, order = list(keys), total_order(df, keys, time, tie)
    sliced = with_slices(df, keys, time, max_rows)
    columns = [c for c in sliced.columns if c not in ("_hot", "_slice")]
    newest_first = Window.partitionBy(*keys, "_slice").orderBy(*[F.col(c).desc() for c in order])
    tails = (
        sliced.filter(F.col("_hot"))
        .withColumn("_rank", F.row_number().over(newest_first))
        .filter(F.col("_rank") <= rows)
        .drop("_rank", "_hot")
    )
    held = sliced.filter(F.col("_hot")).groupBy(*keys, "_slice").agg(
        F.least(F.count(F.lit(1)), F.lit(rows)).alias("_held")
    )
    by_slice = Window.partitionBy(*keys).orderBy("_slice")
    numbered = held.select(
        *keys,
        "_slice",
        F.row_number().over(by_slice).alias("_number"),
        F.sum("_held").over(by_slice.rowsBetween(Window.unboundedPreceding, 0)).alias("_upto"),
    )
    reaching = Window.partitionBy(*keys).orderBy("_upto").rangeBetween(1 - rows, 0)
    needed = numbered.withColumns(
        {"_from": F.min("_number").over(reaching), "_reader": F.lead("_slice").over(by_slice)}
    ).select(*keys, "_reader", F.explode(F.sequence("_from", "_number")).alias("_number"))
    entering = (
        tails.join(numbered.select(*keys, "_slice", "_number"), [*keys, "_slice"])
        .join(needed.filter(F.col("_reader").isNotNull()), [*keys, "_number"])
        .select(*columns, F.col("_reader").alias("_slice"))
    )
    arranged = sliced.drop("_hot").withColumn("_carried", F.lit(False)).unionByName(
        entering.withColumn("_carried", F.lit(True))
    )
    return arranged, [*keys, "_slice"], [F.col(c).asc() for c in order]


def newest_rows(
    df: DataFrame,
    keys: Sequence[str],
    count: int,
    time: str = "time",
    tie: Sequence[str] = (),
) -> DataFrame:
    """The newest ``count`` rows of each key, numbered by ``rank`` from newest.

    Spark cuts each map task's rows to ``count`` per key before the shuffle, but
    only up to a threshold; beyond it a salted first cut does the same work.
    """
    names = total_order(df, keys, time, tie)
    order = [F.col(c).desc() for c in names]
    if count > _GROUP_LIMIT:
        salt = F.pmod(F.xxhash64(*names), F.lit(_SALTS))
        salted = Window.partitionBy(*keys, salt).orderBy(*order)
        df = df.withColumn("rank", F.row_number().over(salted)).filter(F.col("rank") <= count)
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(window)).filter(F.col("rank") <= count)


def repeat_rows(df: DataFrame, times: Column, index: str, chunk: int = 10_000) -> DataFrame:
    """Each row ``times`` times, numbered from 0 in ``index``; none when zero.

    The numbers come in two explodes, so no array is longer than ``chunk``.
    """
    return (
        df.withColumn("_times", times.cast("bigint"))
        .filter(F.col("_times") > 0)
        .withColumn("_chunk", F.explode(F.sequence(F.lit(0), F.floor((F.col("_times") - 1) / chunk))))
        .withColumn(
            index,
            F.explode(
                F.sequence(
                    F.col("_chunk") * chunk,
                    F.least(F.col("_chunk") * chunk + (chunk - 1), F.col("_times") - 1),
                )
            ),
        )
        .drop("_times", "_chunk")
    )
