"""Near-duplicate embeddings by an inverted multi-index.

Vectors are brought to unit length and cut into halves; each half has a codebook of its own,
and the product of the two is a fine grid of cells (Babenko and Lempitsky 2012). From a
vector's own cell the nearest cells are visited in order of how far the vector would have
to move to lie in them, the two halves' distances to the separating hyperplanes squared and
added; since all cells up to a radius are visited, sorting both halves' distances gives the
multi-sequence traversal's cells directly. The radius is fitted to a target recall: sample
vectors are moved in random directions to exactly the threshold similarity, and the radius
is the quantile of what it takes to visit the cells they land in, or what the farthest of all
linked pairs within the sample takes, if that is more. Where it costs few cells more, the
radius is the threshold distance itself, with which no pair is missed. Pairs that meet in a
cell are verified by cosine in double precision. Every length of vectors has a grid of its own.

Equal vectors are collapsed first. A pair is looked for from one side only, that of the
smaller cell number. Large cells are cut into blocks, and each group of blocks returns
counts and a spanning forest, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import components, written

SAMPLE = 10_000  # vectors that the codebooks and the radius are fitted on
MEMBERS = 50  # vectors per cell that the grid is sized for
CODEWORDS = 512  # most per half
TARGET_RECALL = 0.999
BLOCK = 1_024  # vectors of one block of a cell
FEW_CELLS = 4  # cells a vector that may be added, over twice as many, for the exact radius


@dataclass
class Grid:
    """Two codebooks over the halves of unit vectors, and how far a traversal goes."""

    books: tuple[np.ndarray, np.ndarray]
    radius: float  # squared

    @property
    def size(self) -> int:
        return len(self.books[0])

    def distances(self, units: np.ndarray) -> list[np.ndarray]:
        """For either half: squared distance of every vector to every codeword's region."""
        cut = units.shape[1] - units.shape[1] // 2
        out = []
        for half, book in zip((units[:, :cut], units[:, cut:]), self.books, strict=True):
            d = (half**2).sum(1)[:, None] - 2 * half @ book.T + (book**2).sum(1)
            own = d.argmin(1)
            square = (book**2).sum(1)
            between = square[:, None] - 2 * book @ book.T + square[None, :]
            apart = np.sqrt(np.maximum(between, 1e-12))[own]
            h = np.maximum(d - d[np.arange(len(d)), own][:, None], 0) / (2 * apart)
            h[np.arange(len(d)), own] = -1.0  # even where two codewords coincide
            out.append(np.sign(h) * h**2)
        return out

    def cells(self, units: np.ndarray) -> np.ndarray:
        first, second = self.distances(units)
        return first.argmin(1) * self.size + second.argmin(1)

    def visits(self, units: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """The own cell of every vector, and the cells of larger number within the radius."""
        first, second = self.distances(units)
        own = first.argmin(1) * self.size + second.argmin(1)
        first, second = np.maximum(first, 0), np.maximum(second, 0)
        out = []
        for k in range(len(units)):
            order = np.argsort(second[k])
            reach = np.searchsorted(second[k][order], self.radius - first[k], side="right")
            rows = np.flatnonzero(reach)
            near = np.concatenate([i * self.size + order[: reach[i]] for i in rows])
            out.append(near[near > own[k]])
        return own, out


def codebook(points: np.ndarray, size: int, seed: int, rounds: int = 15) -> np.ndarray:
    """Lloyd's k-means from distinct random points; an empty codeword keeps its place."""
    draw = np.random.default_rng(seed)
    points = np.unique(points, axis=0)
    book = points[draw.choice(len(points), min(size, len(points)), replace=False)].copy()
    for _ in range(rounds):
        nearest = ((book**2).sum(1) - 2 * points @ book.T).argmin(1)
        for c in range(len(book)):
            mine = nearest == c
            if mine.any():
                book[c] = points[mine].mean(0)
    return book


def fitted(units: np.ndarray, total: int, cosine: float, recall: float = TARGET_RECALL) -> Grid:
    """A grid for ``total`` vectors from a sample of them."""
    size = max(1, min(CODEWORDS, math.ceil(math.sqrt(total / MEMBERS))))
    cut = units.shape[1] - units.shape[1] // 2
    books = [codebook(units[:, :cut], size, 1), codebook(units[:, cut:], size, 2)]
    size = min(map(len, books))
    grid = Grid((books[0][:size], books[1][:size]), 0.0)
    draw = np.random.default_rng(3)
    aside = draw.standard_normal(units.shape)
    aside -= (aside * units).sum(1)[:, None] * units
    length = np.linalg.norm(aside, axis=1)
    moved = cosine * units + math.sqrt(1 - cosine**2) * aside / np.where(length > 0, length, 1)[:, None]
    landed = grid.cells(moved)
    needed = []
    for at in range(0, len(units), 1_000):
        first, second = grid.distances(units[at : at + 1_000])
        row = np.arange(len(first))
        cell = landed[at : at + 1_000]
        needed.append(np.maximum(first[row, cell // size], 0) + np.maximum(second[row, cell % size], 0))
    radius = max(float(np.quantile(np.concatenate(needed), recall)), _farthest_link(grid, units, cosine))
    # No pair needs more than the squared distance of two unit vectors at the threshold.
    exact = 2 - 2 * cosine
    some = units[:500]
    grid.radius = exact + 1e-9
    at_most = np.mean([len(v) for v in grid.visits(some)[1]])
    grid.radius = min(radius, exact) + 1e-9
    if at_most <= 2 * np.mean([len(v) for v in grid.visits(some)[1]]) + FEW_CELLS:
        grid.radius = exact + 1e-9
    return grid


def _farthest_link(grid: Grid, units: np.ndarray, cosine: float) -> float:
    """The greatest radius that any linked pair of these vectors takes, seen from its smaller cell."""
    cell = np.concatenate([grid.cells(units[at : at + 1_000]) for at in range(0, len(units), 1_000)])
    farthest = 0.0
    for at in range(0, len(units), 250):
        part = units[at : at + 250]
        linked = (part @ units.T >= cosine) & (cell[at : at + 250, None] < cell[None, :])
        row, other = np.nonzero(linked)
        if len(row):
            first, second = (np.maximum(d, 0) for d in grid.distances(part))
            farthest = max(farthest, float((first[row, cell[other] // grid.size] + second[row, cell[other] % grid.size]).max()))
    return farthest


def _units(vectors: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows that can be linked, and their unit vectors in double precision."""
    rows, found = [], []
    for i, cell in enumerate(vectors):
        if not cell.is_valid or len(cell.values) != width or cell.values.null_count:
            continue
        vector = cell.values.to_numpy(zero_copy_only=False).astype(np.float64)
        top = np.abs(vector).max() if width else 0.0
        if np.isfinite(top) and top > 0:
            vector = vector / top
            rows.append(i)
            found.append(vector / np.linalg.norm(vector))
    return np.array(rows, dtype=np.int64), np.array(found).reshape(len(rows), width)


def near_duplicate_vectors(embeddings: DataFrame, cosine: float = 0.95, recall: float = TARGET_RECALL) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for every vector of ``embeddings(vec_id, embedding)``.

    ``n_links`` counts the other vectors at ``cosine`` or above, ``component_id`` is the
    least ``vec_id`` reachable over links, and ``kept`` says that it is the row's own.

    Vectors that are null, empty, zero, or hold null or non-finite components link with
    nothing; vectors of different lengths do not link with each other. Rows that repeat a
    ``vec_id`` count as one vector, the least of them; rows without one make one row with
    no links, no component, and ``kept`` true. Extra columns, such as labels, are ignored.
    """
    vectors = embeddings.groupBy(F.col("vec_id").cast("long").alias("vec_id")).agg(F.min("embedding").alias("embedding"))
    name = [F.xxhash64(F.lit(k), "embedding").alias(f"name{k}") for k in (1, 2)]
    vectors = written(vectors.select("vec_id", "embedding", *name), "vectors")
    usable = vectors.where((F.size("embedding") > 0) & F.col("vec_id").isNotNull())
    distinct = usable.groupBy("name1", "name2").agg(F.min("vec_id").alias("id"), F.count("*").alias("copies"))
    distinct = written(
        usable.join(distinct.select("id", "copies"), usable.vec_id == F.col("id")).select("id", "copies", "embedding"),
        "distinct",
    )
    total = distinct.count()
    sample = distinct.orderBy(F.xxhash64("id"), "id").limit(SAMPLE).select("embedding").toArrow()["embedding"].combine_chunks()
    grids: dict[int, Grid] = {}
    sizes = pc.list_value_length(sample).to_numpy()
    for width in np.unique(sizes).tolist():
        mine = sample.filter(pa.array(sizes == width))
        units = _units(mine, width)[1]
        if len(units):
            grids[width] = fitted(units, math.ceil(total * len(mine) / len(sample)), cosine, recall)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                yield from located(batch.slice(at, 512))

    def located(part: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        sizes = pc.list_value_length(part.column("embedding")).to_numpy()
        for width in np.unique(sizes).tolist():
            mine = part.filter(pa.array(sizes == width))
            rows, units = _units(mine.column("embedding"), width)
            if len(rows):
                # A length that the sample lacks is rare: all of its vectors share one cell.
                grid = grids.get(width) or Grid((np.zeros((1, width - width // 2)), np.zeros((1, width // 2))), 0.0)
                own, near = grid.visits(units)
                kept = mine.take(pa.array(rows))
                yield pa.RecordBatch.from_arrays(
                    [
                        kept.column("id"),
                        pa.array(np.full(len(rows), width), pa.int32()),
                        kept.column("copies"),
                        pa.array([u.tobytes() for u in units], pa.binary()),
                        pa.array(own, pa.int64()),
                        pa.array([[c, *n.tolist()] for c, n in zip(own, near, strict=True)], pa.list_(pa.int64())),
                    ],
                    names=["id", "width", "copies", "unit", "own", "cells"],
                )

    placed = written(distinct.mapInArrow(place, "id long, width int, copies long, unit binary, own long, cells array<long>"), "placed")
    visits = placed.select("id", "width", "copies", "unit", "own", F.explode("cells").alias("cell"))
    large = (
        placed.select("width", F.explode("cells").alias("cell"))
        .groupBy("width", "cell")
        .count()
        .where(F.col("count") > BLOCK)
        .select("width", "cell", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks"))
    )
    mine = F.pmod(F.xxhash64("id"), F.col("blocks")).cast("int")
    dealt = (
        visits.join(large, ["width", "cell"], "left")
        .withColumn("blocks", F.coalesce("blocks", F.lit(1)))
        .withColumn("mine", mine)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("i", F.least("mine", "other"))
        .withColumn("j", F.greatest("mine", "other"))
    )

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(list(batches))
        ids, copies, block = (held[c].to_numpy() for c in ("id", "copies", "mine"))
        member = held["own"].to_numpy() == held["cell"].to_numpy()
        split = held["i"][0].as_py() != held["j"][0].as_py()
        units = np.frombuffer(b"".join(held["unit"].to_pylist()), dtype=np.float64).reshape(len(ids), -1)
        linked = units @ units.T >= cosine
        linked &= member[:, None] | member[None, :]
        if split:
            linked &= block[:, None] != block[None, :]
        np.fill_diagonal(linked, False)
        rows = np.flatnonzero(linked.any(1))
        linked, ids, copies = linked[np.ix_(rows, rows)], ids[rows], copies[rows]
        n = linked @ copies if len(rows) else copies
        root = np.arange(len(rows))
        while len(rows):
            low = np.minimum(root, np.where(linked, root[None, :], len(rows)).min(1))
            low = low[low]
            if (low == root).all():
                break
            root = low
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array(ids[root] if len(rows) else ids, pa.int64()), pa.array(n, pa.int64())],
            names=["id", "root", "n"],
        )

    met = written(dealt.groupBy("width", "cell", "i", "j").applyInArrow(verify, "id long, root long, n long"), "met")
    counts = met.groupBy("id").agg(F.sum("n").alias("n"))
    reach = components(met.select(F.col("id").alias("a"), F.col("root").alias("b")))
    # Copies of a vector that can be linked at all are linked with each other.
    each = placed.select("id", "copies").join(counts, "id", "left").join(reach, "id", "left")
    reps = usable.groupBy("name1", "name2").agg(F.min("vec_id").alias("id")).join(each, "id")
    found = vectors.join(reps, ["name1", "name2"], "left")
    able = F.col("vec_id").isNotNull() & F.col("copies").isNotNull()
    return found.select(
        "vec_id",
        F.when(able, F.coalesce("n", F.lit(0)) + F.col("copies") - 1).otherwise(0).cast("long").alias("n_links"),
        F.when(able, F.coalesce("component", "id")).otherwise(F.col("vec_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.expr("vec_id = component_id"), F.lit(True)))
