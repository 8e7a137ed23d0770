"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

A fast similarity sketch (Dahlgaard, Knudsen, Thorup 2017) throws every shingle into one
hashed bin per round, an earlier round winning over a later one. After ``bins`` rounds,
round ``bins + i`` throws all shingles into bin ``i``, so every coordinate is filled, and
the share of equal coordinates estimates the Jaccard similarity with concentration bounds.
Coordinates are banded; documents that agree on a band are candidates; links are decided
on the full shingle sets. With 42 bands of 6, a pair at similarity 0.8 misses every band
with probability 3e-6.

What keeps it linear: documents with equal sets stand for one another, so copies never
meet; in a bucket every member is compared with the least one; large buckets whose members
are then still in different components compare all with further heads, picked outside the
largest component, as long as that finds links. What is left is compared inside a task, on
blocks bounded in shingles and documents, pairs within the largest component left out, and
returns a spanning forest of the links rather than all of them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, mixed, shingle_set, texts_of, written

BANDS, ROWS = 42, 6
BINS = BANDS * ROWS
_EMPTY = np.uint64(0xFFFFFFFFFFFFFFFF)
_ELEMENTS = 1 << 18  # shingles sketched at a time
_BLOCK = 1 << 20  # shingles of one block of a bucket
_BLOCK_DOCS = 2_000  # documents of one block of a bucket
_TILE = 256  # rows of a block compared at a time
_HEADS = 6  # further heads of a large bucket


def similarity_sketches(sets: list[np.ndarray], bins: int = BINS) -> np.ndarray:
    """A row of ``bins`` coordinates for every non-empty set of 64-bit hashes."""
    sketch = np.full(len(sets) * bins, _EMPTY, dtype=np.uint64)
    element = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets), dtype=np.int64), [len(s) for s in sets])
    low = np.uint64(0xFFFFFFFF)
    for turn in range(2 * bins):
        thrown = mixed(element + np.uint64(turn * 0xD1342543DE82EF95 % (1 << 64)))
        value = (np.uint64(turn) << np.uint64(32)) | (thrown & low)
        if turn < bins:
            slot = owner * bins + (((thrown >> np.uint64(32)) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
        else:
            slot = owner * bins + (turn - bins)
        open_ = sketch[slot] == _EMPTY
        np.minimum.at(sketch, slot[open_], value[open_])
        waiting = np.unique(owner)
        rest = waiting[(sketch.reshape(-1, bins)[waiting] == _EMPTY).any(axis=1)]
        if not len(rest):
            break
        if len(rest) < len(waiting):
            kept = np.isin(owner, rest)
            element, owner = element[kept], owner[kept]
    return sketch.reshape(-1, bins)


def band_keys(sketch: np.ndarray, bands: int = BANDS) -> np.ndarray:
    """One 64-bit key per row and band."""
    parts = sketch.reshape(len(sketch), bands, -1)
    key = np.broadcast_to(mixed(np.arange(1, bands + 1, dtype=np.uint64)), parts.shape[:2]).copy()
    for k in range(parts.shape[2]):
        key = mixed(key + parts[:, :, k])
    return key.view(np.int64)


def _set_batches(batch: pa.RecordBatch, width: int) -> Iterator[tuple[list[int], list[np.ndarray]]]:
    """Row numbers and shingle sets, a bounded number of shingles at a time."""
    rows, sets, held = [], [], 0
    for i, data in enumerate(texts_of(batch.column("text"))):
        found = shingle_set(data, width)
        rows.append(i)
        sets.append(found)
        held += len(found)
        if held >= _ELEMENTS:
            yield rows, sets
            rows, sets, held = [], [], 0
    if rows:
        yield rows, sets


def _name(found: np.ndarray) -> tuple[int, int]:
    """The 128-bit name of a set, in halves."""
    if not len(found):
        return 0, 0
    return int(np.bitwise_xor.reduce(mixed(found))), int(mixed(found + np.uint64(7)).sum(dtype=np.uint64))


def sketched(docs: DataFrame, width: int) -> DataFrame:
    """``doc_id, n_shingles, set_a, set_b, keys``: a 128-bit name of the set and its band keys."""
    out = pa.schema(
        [("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set_a", pa.int64()), ("set_b", pa.int64()),
         ("keys", pa.list_(pa.int64()))]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for rows, sets in _set_batches(batch, width):
                full = [k for k, s in enumerate(sets) if len(s)]
                keys: list = [[] for _ in sets]
                if full:
                    for k, row in zip(full, band_keys(similarity_sketches([sets[k] for k in full])), strict=True):
                        keys[k] = row
                names = [_name(s) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array(rows)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array([a for a, _ in names], dtype=np.uint64).view(np.int64)),
                        pa.array(np.array([b for _, b in names], dtype=np.uint64).view(np.int64)),
                        pa.array(keys, pa.list_(pa.int64())),
                    ],
                    schema=out,
                )

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id long, n_shingles long, set_a long, set_b long, keys array<long>")


def shingle_sets(docs: DataFrame, width: int) -> DataFrame:
    """``id, tag, shingles``: the sorted distinct shingle hashes of every text, and the first half of the set's name."""
    out = pa.schema([("id", pa.int64()), ("tag", pa.int64()), ("shingles", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for rows, sets in _set_batches(batch, width):
                held = pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))
                tags = pa.array(np.array([_name(s)[0] for s in sets], dtype=np.uint64).view(np.int64))
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), tags, held], schema=out)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "id long, tag long, shingles array<long>")


def _spanning_links(sets: list[np.ndarray], labels: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Index pairs of different labels whose sets are similar enough: a spanning forest of them."""
    size = np.array([len(s) for s in sets], dtype=np.int64)
    root = {int(c): int(c) for c in labels}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = root[root[c]]
            c = root[c]
        return c

    value, number = np.unique(np.concatenate(sets), return_inverse=True)
    often = np.bincount(number, minlength=len(value)) > 1
    column = np.cumsum(often) - 1
    owner = np.repeat(np.arange(len(sets)), size)
    shared = often[number]
    owner, column = owner[shared], column[number[shared]]
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    common = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = max(256, (1 << 22) // len(sets))
    for first in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        low, high = np.searchsorted(column, [first, first + width])
        dense = np.zeros((len(sets), width), dtype=np.float32)
        dense[owner[low:high], column[low:high] - first] = 1
        for at in range(0, len(sets), _TILE):
            common[at : at + _TILE] += dense[at : at + _TILE] @ dense.T
    links = []
    for at in range(0, len(sets), _TILE):
        rows = common[at : at + _TILE]
        union = size[at : at + _TILE, None] + size[None, :] - rows
        for i, j in zip(*np.nonzero(np.triu(100 * rows >= percent * union, at + 1)), strict=True):
            i = i + at
            a, b = find(int(labels[i])), find(int(labels[j]))
            if a != b:
                root[max(a, b)] = min(a, b)
                links.append((int(i), int(j)))
    return links


def _finish(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches))
        ids, labels = held["id"].to_numpy(), held["component"].to_numpy()
        sets = [s.values.to_numpy().view(np.uint64) for s in held["shingles"]]
        links = _spanning_links(sets, labels, percent) if len(set(labels.tolist())) > 1 else []
        yield pa.RecordBatch.from_arrays(
            [pa.array([int(ids[i]) for i, _ in links], pa.int64()), pa.array([int(ids[j]) for _, j in links], pa.int64())],
            names=["a", "b"],
        )

    return run


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` for every row of ``docs(doc_id, text)``.

    A text is lowered (A-Z only) and cut at ASCII white space; its set holds the distinct
    runs of ``width`` words, or all its words as one run if they are fewer. Two documents
    are linked if ``100 * |intersection| >= percent * |union|``; ``component_id`` is the
    least ``doc_id`` reachable and ``kept`` says that it is the row's own.

    Null and empty texts have an empty set and stand alone. Rows that repeat a ``doc_id``
    with another text are each linked by their own text; where such a ``doc_id`` is the least of
    several sets, what any of them is linked with is reachable from all of them. A null ``doc_id`` stands alone:
    ``component_id`` is null and ``kept`` true. Other columns are ignored. Shingles are
    compared as 64-bit hashes.
    """
    found = written(sketched(docs, width), "sketches")
    full = found.where("n_shingles > 0 AND doc_id IS NOT NULL")
    reps = full.groupBy("set_a", "set_b", "n_shingles").agg(F.min("doc_id").alias("rep"))

    keyed = (
        full.join(reps, ["set_a", "set_b", "n_shingles"])
        .where("doc_id = rep")
        .dropDuplicates(["rep", "set_a", "set_b"])
        .select(
            F.col("rep").alias("id"), F.col("set_a").alias("tag"), F.col("n_shingles").alias("n"), F.explode("keys").alias("key")
        )
    )
    keyed = written(keyed, "keys")
    heads = keyed.groupBy("key").agg(F.min(F.struct("id", "tag", "n")).alias("head"), F.count("*").alias("members"))
    heads = heads.where("members > 1").select(
        "key",
        F.col("head.id").alias("head"),
        F.col("head.tag").alias("head_tag"),
        F.col("head.n").alias("head_n"),
        "members",
    )
    shared = written(keyed.join(heads, "key"), "buckets")
    spokes = (
        shared.where("id <> head")
        .where(100 * F.least("n", "head_n") >= percent * F.greatest("n", "head_n"))
        .select(F.col("id").alias("a"), F.col("tag").alias("a_tag"), F.col("head").alias("b"), F.col("head_tag").alias("b_tag"))
        .distinct()
    )
    # Sets are read for candidates only. A bucket of two is settled by its spoke.
    wanted = shared.select("id").distinct()
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    sets = shingle_sets(narrow.join(wanted, narrow.doc_id == wanted.id, "left_semi"), width)
    sets = written(sets.where(F.size("shingles") > 0).dropDuplicates(["id", "tag"]), "sets")
    links = written(_verified(spokes, sets, percent), "links")
    first = components(links)

    member, buckets = _unsettled(shared, first, 0)
    for turn in range(1, _HEADS + 1):
        large = buckets.where("main_blocks + rest_blocks > 2")
        if not large.head(1):
            break
        more = (
            member.join(large, "key")
            .where("component <> pick.component")
            .where(100 * F.least("n", "pick.n") >= percent * F.greatest("n", "pick.n"))
            .select(
                F.col("id").alias("a"),
                F.col("tag").alias("a_tag"),
                F.col("pick.id").alias("b"),
                F.col("pick.tag").alias("b_tag"),
            )
            .distinct()
        )
        more = written(_verified(more, sets, percent), "links")
        if not more.head(1):
            break
        links = links.unionByName(more)
        first = components(links)
        member, buckets = _unsettled(shared, first, turn)
    pieces = _pieces(member, buckets)
    late = (
        pieces.join(sets, ["id", "tag"])
        .groupBy("key", "i", "j")
        .applyInArrow(_finish(percent), "a long, b long")
    )
    found_late = written(late.distinct(), "links")
    merged = components(links.unionByName(found_late)) if found_late.head(1) else first

    return (
        found.join(reps, ["set_a", "set_b", "n_shingles"], "left")
        .withColumn("id", F.when(F.col("n_shingles") > 0, F.col("rep")))
        .join(merged, "id", "left")
        .withColumn("component_id", F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "id", "doc_id")))
        .select("doc_id", "n_shingles", "component_id", F.coalesce(F.expr("doc_id = component_id"), F.lit(True)).alias("kept"))
    )


def _unsettled(shared: DataFrame, found: DataFrame, turn: int) -> tuple[DataFrame, DataFrame]:
    """Members of buckets with their components, and the buckets that hold several components.

    ``main`` is the bucket's largest component, ``pick`` a member outside it, another one each
    ``turn``; the blocks of both sides are bounded in shingles and in documents.
    """
    member = shared.where("members > 2").join(found, "id", "left").withColumn("component", F.coalesce("component", "id"))
    sides = member.groupBy("key", "component").agg(
        F.count("*").alias("docs"),
        F.sum("n").alias("total"),
        F.min(F.struct(F.xxhash64("id", "tag", F.lit(turn)).alias("order"), "id", "tag", "n", "component")).alias("pick"),
    )
    main = sides.groupBy("key").agg(
        F.max_by(F.struct("component", "docs", "total"), F.struct("docs", -F.col("component"))).alias("main"),
        F.count("*").alias("several"),
    )
    main = main.where("several > 1").select("key", "main")

    def blocks(docs, total):
        return F.ceil(F.greatest(docs / _BLOCK_DOCS, total / _BLOCK)).cast("int")

    rest = sides.join(main, "key").where("component <> main.component").groupBy("key", "main")
    buckets = rest.agg(F.sum("docs").alias("docs"), F.sum("total").alias("total"), F.min("pick").alias("pick")).select(
        "key",
        F.col("main.component").alias("main"),
        "pick",
        blocks(F.col("main.docs"), F.col("main.total")).alias("main_blocks"),
        blocks(F.col("docs"), F.col("total")).alias("rest_blocks"),
    )
    return member, written(buckets, "unsettled")


def _pieces(member: DataFrame, buckets: DataFrame) -> DataFrame:
    """``key, id, tag, component, i, j``: a row for every pair of blocks a member is compared in.

    Pairs of two blocks of the largest component are left out, for they are linked already, and a
    block alone, for it is compared within itself along with any other.
    """
    spread = F.xxhash64("id", "tag")
    mine = F.when(F.col("component") == F.col("main"), F.pmod(spread, F.col("main_blocks"))).otherwise(
        F.col("main_blocks") + F.pmod(spread, F.col("rest_blocks"))
    )
    return (
        member.join(buckets, "key")
        .withColumn("mine", mine.cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, main_blocks + rest_blocks - 1)")))
        .where("greatest(mine, other) >= main_blocks AND mine <> other")
        .select("key", "id", "tag", "component", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))
    )


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    left = sets.select(F.col("id").alias("a"), F.col("tag").alias("a_tag"), F.col("shingles").alias("left"))
    right = sets.select(F.col("id").alias("b"), F.col("tag").alias("b_tag"), F.col("shingles").alias("right"))
    both = F.size(F.array_intersect("left", "right"))
    return (
        pairs.join(left, ["a", "a_tag"])
        .join(right, ["b", "b_tag"])
        .where(100 * both >= percent * (F.size("left") + F.size("right") - both))
        .select("a", "b")
    )


def keep_one_each(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """``docs`` with all its columns, one document of every group of near-duplicates left.

    The document with the least ``doc_id`` of a group stays. Rows without a ``doc_id`` stay.
    """
    gone = near_duplicates(docs, width, percent).where("NOT kept").select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, F.col("doc_id").cast("long") == F.col("__gone"), "left_anti")
