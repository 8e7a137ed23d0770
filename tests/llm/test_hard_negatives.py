"""Operator 12 against scoring every pair."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import hard_negatives as module
from tidemark.llm.hard_negatives import Tree, hard_negatives, intervals, str_order, tile_cuts, tile_of

SCHEMA = "vec_id long, embedding array<double>, label int"


def plain(rows, every, positives=5, negatives=3, low=50, high=95):
    able = {}
    for i, v, label in rows:
        if i is not None and label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v):
            able.setdefault(i, (label, [math.floor(256 * x) for x in v]))
    out = []
    for a, (label, v) in able.items():
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w, strict=True)), i) for i, (_, w) in able.items() if i != a and len(w) == len(v))
        for s, p in [t for t in scored if able[t[1]][0] == label][:positives]:
            fits = [t for t in scored if able[t[1]][0] != label and low * -s <= 100 * -t[0] <= high * -s]
            out += [(a, p, rank, n, -s, -t) for rank, (t, n) in enumerate(fits[:negatives], 1)]
    return sorted(out)


def got(df):
    assert df.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in df.collect())


def clustered(draw, n, width, labels=4, spread=0.3):
    centres = draw.standard_normal((6, width))
    return [(i, (centres[i % 6] + spread * draw.standard_normal(width)).tolist(), int(draw.integers(labels))) for i in range(n)]


@pytest.fixture
def small_tiles(monkeypatch):
    monkeypatch.setattr(module, "TILE", 40)
    monkeypatch.setattr(module, "LEAF", 8)
    monkeypatch.setattr(module, "PACKS", 2)


def test_negatives_match_every_pair(spark, small_tiles):
    draw = np.random.default_rng(1)
    rows = clustered(draw, 400, 8)
    rows += [(1000 + k, rows[5][1], k % 3) for k in range(60)]  # one vector in a third of the anchors
    rows += [(1100 + k, (np.array(rows[7][1]) + 1e-3 * draw.standard_normal(8)).tolist(), 1) for k in range(60)]
    rows += [(2000, None, 1), (2010, rows[0][1], None), (2020, [float("nan")] * 8, 1), (2030, [None] * 8, 1), (2040, [float("inf")] * 8, 1)]
    rows += [(3000 + k, [1.0, 0.1 * k], k % 2) for k in range(0, 30)] + [(3100, [], 1), (3110, [], 2), (3120, [], 1)]
    rows += [(None, rows[0][1], 1), (4000, [0.0] * 8, 1), rows[20], rows[20]]
    df = spark.createDataFrame([(*r, "x", 7) for r in rows], SCHEMA + ", held string, tile int")
    assert got(hard_negatives(df.repartition(5), F.col("vec_id") % 10 == 0)) == plain(rows, 10)


def test_visits_are_not_sent_through_the_driver(spark, small_tiles, monkeypatch):
    # Anchors are repeated for each tile they visit, so that their compressed size says nothing.
    plans, visited = [], module._visited

    def watched(*args):
        found = visited(*args)
        plans.append(found._jdf.queryExecution().executedPlan().toString())
        return found

    monkeypatch.setattr(module, "_visited", watched)
    rows = clustered(np.random.default_rng(6), 300, 8)
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 10 == 0)) == plain(rows, 10)
    assert len(plans) == 4 and all("SortMergeJoin [shelf" in plan and "BroadcastHashJoin [shelf" not in plan for plan in plans)


def test_an_anchor_travels_once_to_a_shelf_of_tiles(spark, small_tiles, monkeypatch):
    monkeypatch.setattr(module, "TILE", 8)
    monkeypatch.setattr(module, "SHELVES", 1)  # of each of four cores
    sent, visited = [], module._visited

    def watched(tiles, visits, *args):
        sent.append((tiles.count(), visits.count()))
        return visited(tiles, visits, *args)

    monkeypatch.setattr(module, "_visited", watched)
    rows = [(i, v, label) for i, (_, v, label) in enumerate(clustered(np.random.default_rng(8), 300, 16, spread=2.0))]
    rows += [(400 + i, v[:3], label) for i, v, label in rows[:30]]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 10 == 0)) == plain(rows, 10)
    assert all(tiles > 20 and visits <= 4 * 33 for tiles, visits in sent)


def test_a_hot_anchor_vector_is_spread(spark, small_tiles, monkeypatch):
    monkeypatch.setattr(module, "HOT", 5)
    draw = np.random.default_rng(2)
    rows = clustered(draw, 60, 6)
    rows += [(500 + k, rows[3][1], 1) for k in range(40)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 2 == 0, 3, 2)) == plain(rows, 2, 3, 2)


def test_few_rows_and_none(spark):
    rows = [(0, [1.0, 0.0], 0), (1, [1.0, 0.1], 0), (2, [0.8, 0.0], 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 50 == 0)) == plain(rows, 50) == [(0, 1, 1, 2, 65536, 52224)]
    assert got(hard_negatives(df.limit(0), F.col("vec_id") % 50 == 0)) == []
    assert got(hard_negatives(df.where("label = 0"), F.col("vec_id") % 50 == 0)) == []


def test_large_numbers_are_exact(spark):
    draw = np.random.default_rng(3)
    rows = [(i, (draw.standard_normal(4) * 10.0**6).tolist(), i % 2) for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert got(hard_negatives(df, F.col("vec_id") % 5 == 0)) == plain(rows, 5)


def test_boxes_bound_the_scores_and_leaves_are_full():
    draw = np.random.default_rng(4)
    values = draw.integers(-300, 300, (1_000, 12))
    order = str_order(values)
    assert sorted(order.tolist()) == list(range(1_000))
    tree = Tree(values, draw.integers(0, 5, 1_000), [[i] for i in range(1_000)])
    anchors = draw.integers(-300, 300, (20, 12))
    least, most = intervals(anchors, tree.low, tree.high)
    scores = anchors @ tree.values.T
    leaf = np.arange(1_000) // module.LEAF
    assert (scores >= least[:, leaf]).all() and (scores <= most[:, leaf]).all()
    assert len(tree.low) == math.ceil(1_000 / module.LEAF)


def test_tiles_are_even():
    draw = np.random.default_rng(5)
    values = draw.integers(-300, 300, (4_000, 6))
    cuts, n = tile_cuts(values, 20)
    sizes = np.bincount(tile_of(values, cuts), minlength=n)
    assert 15 <= n <= 40 and sizes.max() <= 2 * 4_000 / 20
    cuts, n = tile_cuts(np.zeros((50, 3), dtype=np.int64), 8)
    assert (tile_of(np.zeros((5, 3), dtype=np.int64), cuts) < n).all()
