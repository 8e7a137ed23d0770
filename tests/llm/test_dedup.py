"""Operators 8 and 1 against brute force, and the odd cases their docstrings define."""

import random

import brute
import numpy as np
import pytest

from tidemark.llm import minhash_dedup
from tidemark.llm.common import components, ranked, shingle_set, word_hashes
from tidemark.llm.embedding_dedup import near_duplicate_vectors
from tidemark.llm.minhash_dedup import keep_one_each, near_duplicates, similarity_sketches


def test_words_are_cut_at_ascii_white_space_only():
    a = word_hashes(np.frombuffer("Ein Wort  und\tÄ\x0bnoch\n".encode(), np.uint8))
    b = word_hashes(np.frombuffer("ein wort und Ä noch".encode(), np.uint8))
    assert len(a) == 4 and (a == b).all()
    assert word_hashes(np.frombuffer("ä".encode(), np.uint8)) != word_hashes(np.frombuffer("Ä".encode(), np.uint8))


def test_long_texts_and_long_words_hash_like_short_ones():
    text = " ".join(f"w{i}" for i in range(120_000)) + " " + "z" * 700_000 + " end"
    whole = word_hashes(np.frombuffer(text.encode(), np.uint8))
    assert len(whole) == 120_002
    each = [word_hashes(np.frombuffer(w.encode(), np.uint8))[0] for w in ("w0", "w77777", "w119999", "z" * 700_000, "end")]
    assert [whole[0], whole[77_777], whole[119_999], whole[-2], whole[-1]] == each


@pytest.mark.parametrize("size", [1, 3, 40, 2_000])
def test_sketches_fill_every_coordinate_and_estimate_similarity(size):
    draw = np.random.default_rng(size)
    pool = draw.integers(0, 2**63, 2 * size, dtype=np.uint64)
    one, two = pool[:size], pool[size // 4 : size + size // 4]
    sketch = similarity_sketches([one, two])
    assert (sketch != minhash_dedup._EMPTY).all()
    similar = len(np.intersect1d(one, two)) / len(np.union1d(one, two))
    assert abs((sketch[0] == sketch[1]).mean() - similar) < 0.15


def test_near_duplicates_match_brute_force(spark, prose, edited):
    texts = {i: prose(60 + i % 7, i) for i in range(40)}
    base = prose(150, 1000)
    for k in range(60):  # a group of near copies around the threshold
        texts[100 + k] = edited(base, 14 + k % 12, k)
    for k in range(30):  # exact copies, some in upper case
        texts[300 + k] = base.upper() if k % 2 else base
    passage = prose(45, 2000)
    for k in range(30):  # a shared passage
        texts[400 + k] = prose(25, 3000 + k) + " " + passage
    texts |= {500: None, 501: "", 502: " \n\t ", 503: "one", 504: "ONE", 505: "one two", 506: "one  two", 507: "two one"}
    docs = spark.createDataFrame([(i, t, "x") for i, t in texts.items()], "doc_id long, text string, component string")
    for width in (2, 5):
        expected = brute.near_duplicates(texts, width)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs.repartition(7), width).collect()}
        assert got == expected
    assert expected[504] == (1, 503) and expected[500] == (0, 500)


def test_blocks_of_a_bucket_find_all_links(spark, prose, edited, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "_BLOCK", 600)
    base = prose(120, 1)
    texts = {k: edited(base, 16 + k % 9, k) for k in range(50)}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 2).collect()}
    assert got == brute.near_duplicates(texts, 2)


def test_blocks_are_bounded_in_documents(spark, prose, edited, monkeypatch):
    monkeypatch.setattr(minhash_dedup, "_BLOCK_DOCS", 12)
    base = prose(120, 1)
    texts = {k: edited(base, 9 + k % 16, k) for k in range(60)}  # near copies, and copies that are too far off
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    taken = []
    pieces = minhash_dedup._pieces

    def seen(member, buckets):
        taken.append(pieces(member, buckets).groupBy("key", "i", "j").count().collect())
        return pieces(member, buckets)

    monkeypatch.setattr(minhash_dedup, "_pieces", seen)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, 2).collect()}
    assert got == brute.near_duplicates(texts, 2)
    assert taken[0] and max(r["count"] for r in taken[0]) <= 2 * 2 * 12


def test_comparing_a_block_takes_little_memory():
    import tracemalloc

    draw = np.random.default_rng(3)
    sets = [np.unique(draw.integers(0, 2**60, 4, dtype=np.uint64)) for _ in range(3_000)]
    sets[2_999], sets[300] = sets[17], sets[1_200]
    tracemalloc.start()
    found = minhash_dedup._spanning_links(sets, np.arange(3_000), 80)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert found == [(17, 2_999), (300, 1_200)]
    assert peak < 10 * 3_000**2  # bytes a pair; whole matrices took about 25


def test_rows_without_id_and_repeated_rows(spark):
    rows = [(1, "a b c d e f"), (1, "a b c d e f"), (None, "a b c d e f"), (2, "a b c d e f")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.component_id, r.kept) for r in near_duplicates(docs).collect())
    assert got == [(0, None, True), (1, 1, True), (1, 1, True), (2, 1, False)]
    kept = keep_one_each(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id or 0) for r in kept.collect()) == [0, 1, 1]
    empty = near_duplicates(docs.limit(0))
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0


def test_repeated_ids_with_other_texts_keep_their_links(spark, prose, edited):
    a, b = prose(80, 1), prose(120, 2)
    rows = [(1, a), (1, b), (2, edited(a, 30, 5)), (3, edited(b, 40, 6)), (4, prose(60, 9)), (5, b), (1, a)]
    rows += [(20 + k, edited(prose(90, 70 + k % 4), 18 + k, k)) for k in range(12)] + [(20, prose(90, 70 + k)) for k in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    sets = {}
    for i, text in rows:
        found = frozenset(brute.word_set(text, 2))
        sets[found] = min(i, sets.get(found, i))
    pairs = [(sets[s], sets[t]) for s in sets for t in sets if s != t and 100 * len(s & t) >= 80 * len(s | t)]
    component = brute.least_reachable(sorted(set(sets.values())), pairs)
    expected = sorted((i, component[sets[frozenset(brute.word_set(t, 2))]]) for i, t in rows)
    got = sorted((r.doc_id, r.component_id) for r in near_duplicates(docs, 2).collect())
    assert got == expected
    assert [c for i, c in got if i in (2, 3, 5)] == [1, 1, 1]


def test_components_of_paths_and_stars(spark):
    draw = random.Random(4)
    pairs = [(i, i + 1) for i in range(30)] + [(100, k) for k in range(101, 160)] + [(7, 7), (200, 201), (201, 200)]
    draw.shuffle(pairs)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long")).collect())
    expected = brute.least_reachable({i for p in pairs for i in p if p[0] != p[1]}, pairs)
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_ranks_run_over_chunks(spark):
    from pyspark.sql import functions as F

    df = spark.range(100).select(F.when(F.col("id") % 3 > 0, F.col("id") % 3).alias("k"), "id")
    got = ranked(df, ["k"], F.floor(F.col("id") / 10), [F.col("id")], "rank")
    for k in (None, 1, 2):
        ids = sorted((r.id, r["rank"]) for r in got.where(F.col("k").eqNullSafe(k)).collect())
        assert [rank for _, rank in ids] == list(range(len(ids)))


def test_near_duplicate_vectors_match_brute_force(spark):
    draw = np.random.default_rng(5)
    rows = {i: draw.standard_normal(16).tolist() for i in range(200)}
    centre = draw.standard_normal(16)
    for k in range(80):
        rows[300 + k] = (centre + draw.standard_normal(16) * (0.15 + 0.003 * k)).tolist()
    for k in range(40):
        rows[400 + k] = (centre * (1 + k % 3)).tolist()
    rows |= {
        900: None, 901: [0.0] * 16, 902: [float("nan")] + [1.0] * 15, 903: [None] + [1.0] * 15,
        904: [float("inf")] + [1.0] * 15, 905: [1.0, 2.0], 906: [],
    }
    rows |= {1000 + k: (draw.standard_normal(3) * 0.1 + [1, 2, 3]).tolist() for k in range(12)} | {1100: [2.0, 4.0], 1101: [1.0]}
    expected = {i: (0, i) for i in rows}
    for width in {len(v) for v in rows.values() if v}:
        expected |= brute.vector_links({i: v for i, v in rows.items() if v and len(v) == width}, 0.95)
    df = spark.createDataFrame([(i, v, 1) for i, v in rows.items()], "vec_id long, embedding array<double>, label int")
    got = {r.vec_id: (r.n_links, r.component_id) for r in near_duplicate_vectors(df.union(df).repartition(5)).collect()}
    assert got.keys() == expected.keys()
    found = sum(min(got[i][0], expected[i][0]) for i in got)
    assert found >= 0.99 * sum(n for n, _ in expected.values())
    assert all(got[i][0] <= expected[i][0] for i in got)
    assert sum(got[i][1] == expected[i][1] for i in got) >= 0.99 * len(got)
    assert all(got[i] == expected[i] for i in (*range(900, 907), *range(1000, 1012), 1100, 1101))
    assert got[1100] == (1, 905)


def test_hot_cells_are_cut_into_blocks(spark, monkeypatch):
    from tidemark.llm import embedding_dedup

    monkeypatch.setattr(embedding_dedup, "BLOCK", 16)
    draw = np.random.default_rng(6)
    centre = draw.standard_normal(8)
    rows = {i: (centre + 0.01 * draw.standard_normal(8)).tolist() for i in range(100)}
    df = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    assert {(r.n_links, r.component_id) for r in near_duplicate_vectors(df).collect()} == {(99, 0)}


@pytest.mark.parametrize("width", [8, 32, 64])
@pytest.mark.parametrize("spread", [0.001, 0.01, 0.05])
def test_every_vector_of_a_tight_cluster_meets_its_links(width, spread):
    from tidemark.llm.embedding_dedup import fitted

    draw = np.random.default_rng(width)
    vectors = draw.standard_normal((4, width))[draw.integers(0, 4, 1_500)] + spread * draw.standard_normal((1_500, width))
    units = vectors / np.linalg.norm(vectors, axis=1)[:, None]
    grid = fitted(units[:700], len(units), 0.95)
    own, near = grid.visits(units)
    seen = np.zeros((len(units), grid.size**2), dtype=bool)
    for i, cells in enumerate(near):
        seen[i, cells] = True
    seen[np.arange(len(units)), own] = True
    linked = units @ units.T >= 0.95
    met = seen[:, own] | seen[:, own].T
    assert ((linked & met).sum(1) >= 0.99 * linked.sum(1)).all()


def test_vectors_none_and_without_id(spark):
    schema = "vec_id long, embedding array<float>"
    assert near_duplicate_vectors(spark.createDataFrame([], schema)).count() == 0
    rows = [(None, [1.0, 0.0]), (None, [1.0, 0.0]), (3, [1.0, 0.0]), (4, [2.0, 0.0])]
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in near_duplicate_vectors(spark.createDataFrame(rows, schema)).collect())
    assert got == [(0, 0, None, True), (3, 1, 3, True), (4, 1, 3, False)]
