"""Hot keys: sliced, bracketed and salted paths give what one task would."""

import random
import statistics
from datetime import datetime, timedelta

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tidemark.operators import gaps, indicators, percentiles, quality, sequence
from tidemark.operators.percentiles import group_with_percentiles
from tidemark.operators.sequence import (
    newest_rows,
    repeat_rows,
    with_history,
    with_previous,
    with_slices,
)
from tidemark.plans.rollups import market_volatility_hourly


@pytest.fixture(scope="module")
def skewed(spark):
    """One entity with most rows, many of them inside a single minute; others sparse."""
    chance = random.Random(7)
    base = datetime(2024, 1, 1)
    rows = []
    for i in range(600):
        rows.append((base + timedelta(seconds=i * 977), "hot", chance.random() * 100))
    for i in range(900):
        rows.append((base + timedelta(days=2, microseconds=i * 61_111), "hot", chance.random() * 100))
    for i in range(200):
        rows.append((base + timedelta(seconds=i * 3001), f"cold{i % 7}", chance.random() * 100))
    chance.shuffle(rows)
    df = spark.createDataFrame(
        [(t.isoformat(), e, v) for t, e, v in rows], "time string, entity_id string, value double"
    )
    return df.withColumn("time", F.col("time").cast("timestamp")).repartition(5).cache()


def _sorted(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())


def test_hot_key_is_cut_to_the_wanted_size(skewed):
    sliced = with_slices(skewed, ["entity_id"], max_rows=50)
    sizes = {
        (r["entity_id"], r["_slice"]): r["count"]
        for r in sliced.groupBy("entity_id", "_slice").count().collect()
    }
    hot = [n for (entity, _), n in sizes.items() if entity == "hot"]
    assert len(hot) > 30 and max(hot) <= 60 and sum(hot) == 1500
    assert all(part is None for entity, part in sizes if entity != "hot")


def test_previous_row_equals_plain_lag(skewed):
    window = Window.partitionBy("entity_id").orderBy("time")
    plain = skewed.select("entity_id", "time", F.lag("value").over(window).alias("before"))
    mine = with_previous(skewed, ["entity_id"], ["value"], max_rows=40)
    mine = mine.select("entity_id", "time", F.col("previous.value").alias("before"))
    key = lambda r: (r[0], r[1])
    assert sorted(map(tuple, mine.collect()), key=key) == sorted(map(tuple, plain.collect()), key=key)


@pytest.mark.parametrize("rows", [1, 2, 7, 130])
def test_moving_average_equals_plain_window(skewed, rows):
    window = Window.partitionBy("entity_id").orderBy("time")
    plain = skewed.select(
        "entity_id",
        "time",
        F.round(F.avg("value").over(window.rowsBetween(1 - rows, 0)), 9).alias("sma"),
        F.round(
            F.coalesce(
                F.col("value") * (2 / (rows + 1)) + F.lag("value").over(window) * (1 - 2 / (rows + 1)),
                F.col("value"),
            ),
            9,
        ).alias("ema"),
    )
    mine = indicators.moving_averages(skewed, rows, "2024-01-01", "2024-02-01", max_rows=40)
    mine = mine.withColumns({"sma": F.round("sma", 9), "ema": F.round("ema", 9)})
    columns = ("entity_id", "time", "sma", "ema")
    assert _sorted(mine, *columns) == _sorted(plain, *columns)


def test_sliced_operators_agree_with_unsliced(skewed):
    ticks = skewed.select(
        "time",
        F.col("entity_id").alias("symbol"),
        F.col("value").alias("price"),
        F.lit(2.0).alias("volume"),
        F.lit("X").alias("exchange"),
        F.lit("S").alias("data_source"),
    )
    span = ("2024-01-01", "2024-02-01")
    records = skewed.withColumns({c: F.lit(None).cast("double") for c in ("value2", "value3", "value4")})
    for few, many in (
        (gaps.value_gaps(records, 5, max_rows=30), gaps.value_gaps(records, 5)),
        (gaps.fill_interpolate(records, 600, 900, max_rows=30), gaps.fill_interpolate(records, 600, 900)),
        (
            gaps.gap_filled_agg(records, "30 minutes", *span, max_rows=30),
            gaps.gap_filled_agg(records, "30 minutes", *span),
        ),
        (
            quality.validate_ticks(ticks, *span, max_rows=30),
            quality.validate_ticks(ticks, *span),
        ),
        (
            indicators.obv(ticks, "2024-02-01", 40, max_rows=30),
            indicators.obv(ticks, "2024-02-01", 40),
        ),
        (market_volatility_hourly(ticks, max_rows=30), market_volatility_hourly(ticks)),
    ):
        names = few.columns
        show = lambda df: sorted(repr(tuple(r)) for r in rounded(df).select(*names).collect())
        assert show(few) == show(many)


def rounded(df):
    return df.select(
        *[F.round(n, 6).alias(n) if kind == "double" else F.col(n) for n, kind in df.dtypes]
    )


@pytest.mark.parametrize("q", [0.0, 0.05, 0.5, 0.95, 1.0])
def test_bracketed_percentile_is_exact(spark, q):
    chance = random.Random(3)
    values = [round(chance.lognormvariate(0, 3), 3) for _ in range(30_000)]
    rows = [("hot", v) for v in values] + [(None, 4.0), (None, 8.0), ("cold", 1.0), ("none", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(6)
    found = {
        r["g"]: (r["n"], r["p"])
        for r in group_with_percentiles(
            df, ["g"], "v", {"p": q}, [F.count(F.lit(1)).alias("n")], max_rows=10_000
        ).collect()
    }
    ordered = sorted(values)
    place = q * (len(values) - 1)
    low, high = ordered[int(place)], ordered[min(int(place) + 1, len(values) - 1)]
    assert found["hot"][0] == 30_000
    assert found["hot"][1] == pytest.approx(low + (high - low) * (place - int(place)), rel=1e-12)
    assert found[None] == (2, pytest.approx(4 + 4 * q))
    assert found["cold"] == (1, 1.0) and found["none"] == (1, None)


def test_percentile_answers_when_the_sketch_misses(spark, monkeypatch):
    """A bracket that is far too low is replaced by the whole range."""
    monkeypatch.setattr(percentiles, "_MARGIN", -0.2)
    df = spark.range(1, 102).select(F.lit("g").alias("g"), F.col("id").cast("double").alias("v"))
    found = group_with_percentiles(df, ["g"], "v", {"p": 0.5}, max_rows=10).first()
    assert found["p"] == 51.0


def test_many_hot_keys_are_joined_without_broadcast(skewed, monkeypatch):
    plain = with_previous(skewed, ["entity_id"], ["value"], max_rows=40)
    monkeypatch.setattr(sequence, "FEW", 0)
    shuffled = with_previous(skewed, ["entity_id"], ["value"], max_rows=40)
    assert _sorted(plain, "entity_id", "time", "previous") == _sorted(shuffled, "entity_id", "time", "previous")


def test_a_long_frame_reaches_over_many_sparse_slices(skewed):
    """Ten thousand rows of history, far more than a slice holds."""
    arranged, keys, _ = with_history(skewed, ["entity_id"], 10_000, max_rows=40)
    sizes = arranged.groupBy(*keys, "_carried").count().collect()
    assert max(r["count"] for r in sizes if not r["_carried"] and r["entity_id"] == "hot") <= 60
    arranged, keys, _ = with_history(skewed, ["entity_id"], 100, max_rows=40)
    carried = [r["count"] for r in arranged.filter("_carried").groupBy(*keys).count().collect()]
    assert carried and max(carried) <= 200


def test_equal_times_give_one_answer_however_rows_lie(spark):
    chance = random.Random(11)
    rows = [(f"2024-01-0{1 + i % 3}", "A", round(chance.random() * 100, 2), float(i % 7)) for i in range(200)]
    ticks = spark.createDataFrame(rows, "time string, symbol string, price double, volume double")
    ticks = ticks.withColumn("time", F.col("time").cast("timestamp"))
    answers = {
        tuple(sorted(tuple(r) for r in quality.validate_ticks(
            ticks.repartition(n), "2024-01-01", "2024-02-01", max_rows=limit).collect()))
        for n in (1, 3, 7, 11)
        for limit in (20, 1000)
    }
    assert len(answers) == 1


def test_percentile_without_keys(spark):
    df = spark.range(1, 102).select(F.col("id").cast("double").alias("v"))
    for limit in (10, 1000):
        assert group_with_percentiles(df, [], "v", {"p": 0.5}, max_rows=limit).first()["p"] == 51.0


def test_newest_rows_beyond_the_rank_threshold(skewed):
    window = Window.partitionBy("entity_id").orderBy(F.col("time").desc())
    plain = skewed.withColumn("rank", F.row_number().over(window)).filter("rank <= 1200")
    mine = newest_rows(skewed, ["entity_id"], 1200)
    assert _sorted(mine, "entity_id", "time", "rank") == _sorted(plain, "entity_id", "time", "rank")


def test_repeat_rows_in_chunks(spark):
    df = spark.createDataFrame([("a", 0), ("b", 1), ("c", 25), ("d", 20)], "k string, n int")
    found = repeat_rows(df, F.col("n"), "i", chunk=10).groupBy("k").agg(
        F.count("*").alias("n"), F.min("i"), F.max("i"), F.count_distinct("i")
    )
    assert {r[0]: tuple(r)[1:] for r in found.collect()} == {
        "b": (1, 0, 0, 1),
        "c": (25, 0, 24, 25),
        "d": (20, 0, 19, 20),
    }


def test_median_helper_agrees_with_python(spark):
    values = [5.0, 1.0, 9.0, 3.0]
    df = spark.createDataFrame([(v,) for v in values], "v double")
    found = group_with_percentiles(df, [], "v", {"m": 0.5}).first()["m"]
    assert found == statistics.median(values)
