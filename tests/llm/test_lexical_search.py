"""Operator 13 against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import lexical_search
from tidemark.llm.common import mixed
from tidemark.llm.lexical_search import Sketches, ranked_documents, terms

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain(docs, items, k=10):
    """``(item_id, rank, doc_id, score)`` by scoring every document for every item."""

    def cut(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))

    held = [(i, Counter(cut(t))) for i, t in docs]
    held = [(i, c, sum(c.values())) for i, c in held if c]
    count, length = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c, n in held:
            m = 100 - 90 + (90 * n * count) // length
            score = sum(
                math.floor(1000 * math.log((2 * count + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(cut(text))
                if t in c
            )
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        for rank, (score, _, _, i) in enumerate(sorted(found, key=lambda f: f[:3])[:k], 1):
            out.append((item, rank, i, -score))
    return sorted(out, key=str)


def got(df):
    assert df.columns == ["item_id", "rank", "doc_id", "score"]
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture
def corpus(prose):
    draw = random.Random(5)
    docs = [(i, prose(draw.choice([1, 5, 40, 200]), i)) for i in range(150)]
    docs += [(500 + i, docs[i % 5][1]) for i in range(40)]  # ties
    docs += [(600, None), (601, ""), (602, " .,; "), (603, "Straße ÄÖ_x-ÄÖ"), (None, docs[3][1]), (500, docs[0][1])]
    docs.append((700, prose(20_000, 9)))
    items = [(i, " ".join(docs[7 * i][1].split(" ")[:25])) for i in range(15)]
    items += [(90, None), (91, "..."), (92, "nowhere_at_all"), (93, "STRASSE straße äö ÄÖ x"), (None, docs[2][1])]
    return docs, items + items[:3]


def test_the_best_documents_of_every_item(spark, corpus):
    docs, items = corpus
    table = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id long, text string, score int, term string")
    asked = spark.createDataFrame([(i, t, 5) for i, t in items], "item_id long, text string, rank int")
    assert got(ranked_documents(table.repartition(6), asked)) == plain(docs, items)
    assert got(ranked_documents(table.coalesce(1), asked, 3)) == plain(docs, items, 3)


def test_small_sketches_batches_and_parts_change_nothing(spark, corpus, monkeypatch):
    docs, items = corpus
    for name, value in (("WIDTH", 4), ("BATCH", 7), ("STEP", 2), ("TERMS", 400), ("QUERIES", 6)):
        monkeypatch.setattr(lexical_search, name, value)
    table, asked = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    assert got(ranked_documents(table.repartition(3), asked)) == plain(docs, items)


def test_bounds_are_never_below_scores():
    draw = np.random.default_rng(1)
    n, vocabulary = 200, 3_000
    lists = [draw.choice(vocabulary, draw.integers(0, 60), replace=False).tolist() for _ in range(n)]
    batch = pa.RecordBatch.from_arrays(
        [
            pa.array([max(1, 2 * len(t)) for t in lists], pa.int64()),
            pa.array(lists, pa.list_(pa.int32())),
            pa.array([[2] * len(t) for t in lists], pa.list_(pa.int64())),
        ],
        names=["n", "term", "tf"],
    )
    weights = draw.integers(1, 9_000, vocabulary)
    place = (mixed(np.arange(vocabulary, dtype=np.uint64)) % np.uint64(lexical_search.WIDTH)).astype(np.int64)
    sketch = Sketches(batch, weights, place, (n, sum(map(len, lists))))
    exact = 0
    for _ in range(50):
        query = draw.choice(vocabulary, 30, replace=False)
        wanted = np.zeros(vocabulary, dtype=bool)
        wanted[query] = True
        bounds, scores = sketch.bounds(place[query]), sketch.scores(np.arange(n), wanted)
        assert (bounds >= scores).all()
        exact += (bounds == scores).mean()
    assert exact > 10  # and often they are the score itself


def test_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a b")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert got(ranked_documents(docs.limit(0), items)) == [] and got(ranked_documents(docs, items.limit(0))) == []
    assert got(ranked_documents(docs, items)) == plain([(1, "a b")], [(1, "a")])


def test_terms_are_letters_digits_and_all_beyond_ascii():
    assert terms("Ab-9_ÄÖ\x7fẞx y") == ["ab", "9", "ÄÖ", "ẞx y"] and terms(None) == []
