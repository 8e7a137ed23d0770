"""Hard negatives by an R-tree that is packed by sort-tile-recursive (STR).

Vectors become whole numbers, equal ones of a label become one entry with its smallest ids, and
entries are cut into tiles: a bounded sample gives the cuts (coordinates in the order of their
spread, each slab cut again by the next), and every entry takes its tile by them. Inside a tile
the entries are packed into leaves by the same rule, with the label as the first coordinate. Each
box gives an interval of the inner products that its members can have with an anchor.

An anchor looks for what it needs, the best rows of its own label or the best ones of other
labels in a window of scores, in its own tile first. What it finds there is a lower bound of its
k-th best score, and it visits another tile only if that tile's interval reaches the window and
the bound. Tiles lie on shelves, and an anchor is sent once to a shelf for all that it visits there.
In a tile, a queue gives the leaves by the upper ends of their intervals, some at a
time; leaves outside the window or strictly below the k-th score are passed over, and the search
ends when the queue is below all that is needed. Anchors travel packed, and only rows that can still
be among the best ones return.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.llm.common import written

SAMPLE = 10_000  # entries that the cuts between tiles are taken from
TILE = 4_096  # entries that a tile is meant for; more where there would be over TILES of them
TILES = 1_024
LEAF = 32  # entries of a leaf
FIRST = 8  # leaves that are taken from the queue at first; then twice as many each time
PACKS = 16  # rows that the anchors visiting one shelf are packed into
SHELF = 1 << 17  # entries that the tiles of a shelf are meant for
SHELVES = 4  # shelves for every core at least, while there are as many tiles
RUN = 512  # anchors that are held against boxes at once
HOT = 4_096  # anchors with one vector and label above which these are spread
FAR = 1 << 62
EXACT = float(1 << 53)  # whole numbers below this are exact in doubles


@dataclass
class Cut:
    """How one level of tiles is told apart: by where a coordinate lies among ``bounds``."""

    at: int
    bounds: np.ndarray
    below: list


def _spread(values: np.ndarray) -> np.ndarray:
    return np.argsort(-values.astype(np.float64).var(0), kind="stable") if values.size else np.arange(values.shape[1])


def tile_cuts(values: np.ndarray, tiles: int) -> tuple[Cut | int, int]:
    """STR cuts that part the sample into about ``tiles`` tiles, and the number of tiles."""
    numbers = iter(range(1 << 30))

    def cut(values: np.ndarray, tiles: int, order: list[int]) -> Cut | int:
        if tiles < 2 or not order or len(values) < 2:
            return next(numbers)
        slabs = max(2, math.ceil(tiles ** (1 / len(order))))
        column = np.sort(values[:, order[0]])
        bounds = np.unique(column[[len(column) * k // slabs for k in range(1, slabs)]])
        slab = np.searchsorted(bounds, values[:, order[0]], side="right")
        each = [values[slab == k] for k in range(len(bounds) + 1)]
        return Cut(order[0], bounds, [cut(part, round(tiles * len(part) / len(values)), order[1:]) for part in each])

    order = _spread(values).tolist()[: max(1, (max(tiles, 2) - 1).bit_length())]
    root = cut(values, tiles, order)
    return root, next(numbers)


def tile_of(values: np.ndarray, node: Cut | int) -> np.ndarray:
    if isinstance(node, int):
        return np.full(len(values), node, dtype=np.int32)
    out = np.empty(len(values), dtype=np.int32)
    slab = np.searchsorted(node.bounds, values[:, node.at], side="right")
    for k, below in enumerate(node.below):
        out[slab == k] = tile_of(values[slab == k], below)
    return out


def str_order(values: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The order in which entries fill the leaves, by the coordinates as they are given."""

    def pack(rows: np.ndarray, order: list[int]) -> list[np.ndarray]:
        if len(rows) <= leaf or not order:
            return [rows]
        rows = rows[np.argsort(values[rows, order[0]], kind="stable")]
        slabs = max(1, round(math.ceil(len(rows) / leaf) ** (1 / len(order))))
        size = leaf * math.ceil(len(rows) / leaf / slabs)
        return [piece for at in range(0, len(rows), size) for piece in pack(rows[at : at + size], order[1:])]

    depth = max(1, math.ceil(len(values) / leaf).bit_length())
    return np.concatenate(pack(np.arange(len(values)), list(range(min(values.shape[1], depth)))))


@dataclass
class Tree:
    """The leaves of one tile. ``held`` names up to k ids of every entry, the smallest first."""

    values: np.ndarray
    labels: np.ndarray
    held: list[list[int]]
    low: np.ndarray = field(init=False)
    high: np.ndarray = field(init=False)

    def __post_init__(self):
        spread = _spread(self.values)
        order = str_order(np.column_stack([self.labels, self.values[:, spread]]))
        self.values, self.labels = self.values[order], self.labels[order]
        self.held = [self.held[i] for i in order]
        self.first = np.array([h[0] for h in self.held], dtype=np.int64)
        starts = np.arange(0, len(order), LEAF)
        self.low = np.minimum.reduceat(self.values, starts)
        self.high = np.maximum.reduceat(self.values, starts)
        self.labels_low = np.minimum.reduceat(self.labels, starts)
        self.labels_high = np.maximum.reduceat(self.labels, starts)
        corner = np.maximum(np.abs(self.low), np.abs(self.high)).astype(np.float64)
        self.length = math.sqrt((corner**2).sum(1).max())

    def numbers(self, anchors: np.ndarray) -> type:
        """Doubles where all products are exact in them, else Python's whole numbers."""
        return np.float64 if self.length * np.sqrt((anchors.astype(np.float64) ** 2).sum(1).max()) < EXACT / 2 else object

    def search(self, anchors: np.ndarray, labels: np.ndarray, needs: list[list[dict]], same: bool, k: int) -> Iterator[tuple]:
        """``(anchor, slot, score, id)``: the k best rows of every need that reach its bound."""
        kind = self.numbers(anchors)
        values, anchors = self.values.astype(kind), anchors.astype(kind)
        least, most = intervals(anchors, self.low.astype(kind), self.high.astype(kind))
        for i, wanted in enumerate(needs):
            if same:
                may = (self.labels_low <= labels[i]) & (self.labels_high >= labels[i])
            else:
                may = (self.labels_low != labels[i]) | (self.labels_high != labels[i])
            best: list[list[tuple[int, int]]] = [[] for _ in wanted]  # (-score, id), the best first
            floor = np.array([max(w["low"], w["bound"]) for w in wanted], dtype=kind)
            high = np.array([w["high"] for w in wanted], dtype=kind)
            may &= (most[i] >= floor.min()) & (least[i] <= high.max())
            queue = np.flatnonzero(may)
            queue = queue[np.argsort(-most[i, queue], kind="stable")]
            at, step = 0, FIRST
            while at < len(queue) and most[i, queue[at]] >= floor.min():
                leaves = queue[at : at + step]
                at, step = at + step, 2 * step
                reached = (most[i, leaves, None] >= floor) & (least[i, leaves, None] <= high)
                leaves = leaves[reached.any(1)]
                rows = (leaves[:, None] * LEAF + np.arange(LEAF)).ravel()
                rows = rows[rows < len(values)]
                rows = rows[(self.labels[rows] == labels[i]) == same]
                score = values[rows] @ anchors[i]
                some = np.flatnonzero(score >= floor.min())
                rows, score = rows[some], score[some]
                for n in range(len(wanted)):
                    fits = np.flatnonzero((score >= floor[n]) & (score <= high[n]))
                    if not len(fits):
                        continue
                    # Among entries of one score, the k best rows are in those with the k smallest first ids.
                    fits = fits[np.lexsort((self.first[rows[fits]], -score[fits]))[:k]]
                    best[n] += [(-int(score[f]), v) for f in fits for v in self.held[rows[f]][:k]]
                    best[n].sort()
                    del best[n][k:]
                    if len(best[n]) == k:
                        floor[n] = max(floor[n], -best[n][-1][0])
            for n, w in enumerate(wanted):
                for score, v in best[n]:
                    yield i, w["slot"], -score, v


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and the greatest inner product of every anchor with a vector of every box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return up @ low.T + down @ high.T, up @ high.T + down @ low.T


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = column.combine_chunks()
    return flat.flatten().to_numpy().reshape(len(flat), -1)


def _lists(offsets: np.ndarray, values: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), values)


def prepared(rows: DataFrame, anchors: Column, relabelled: Column | None = None) -> DataFrame:
    """``vec_id, label, vector, anchor, name1, name2`` of the rows that take part."""
    label = F.col("label") if relabelled is None else relabelled
    value = F.transform("embedding", lambda x: F.floor(x.cast("double") * 256))
    finite = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x.cast("double")) < float(1 << 54)))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double"))
    kept = rows.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.coalesce(finite, F.lit(False)))
    kept = kept.select(F.col("vec_id").cast("long").alias("vec_id"), label.cast("long").alias("label"), value.alias("vector"))
    kept = kept.where(square < 9e18).groupBy("vec_id").agg(F.min(F.struct("label", "vector")).alias("least"))
    kept = kept.select("vec_id", "least.*").withColumn("anchor", F.coalesce(anchors, F.lit(False)))
    return kept.withColumns({f"name{k}": F.xxhash64(F.lit(k), "vector") for k in (1, 2)})


def hard_negatives(
    embeddings: DataFrame,
    anchors: Column,
    positives: int = 5,
    negatives: int = 3,
    low: int = 50,
    high: int = 95,
    relabelled: Column | None = None,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``embeddings`` has ``vec_id, embedding, label``; ``anchors`` is a condition on ``vec_id`` and
    ``relabelled`` replaces the label. Scores are inner products of ``floor(256 * x)``, in whole
    numbers. A row's best rows have the highest scores, equal ones by smaller ``vec_id``. For the
    ``positives`` best other rows of an anchor's label, each, the ``negatives`` best rows of other
    labels with ``low`` to ``high`` hundredths of the positive's score are returned.

    Rows without id, label or vector, with a component that is null or not finite, or whose
    scores could leave 64 bits, take no part. Rows that repeat a ``vec_id`` count as one, the
    least of them. Vectors of different lengths are not compared; those without components all
    score 0. A positive without such negatives gives no rows, nor does one with a negative score,
    as its window is empty. Other columns are ignored; an empty table gives no rows.
    """
    spark = embeddings.sparkSession
    points = written(prepared(embeddings, anchors, relabelled), "points")
    name = ["name1", "name2", "label"]
    nothing = "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long"
    first = F.row_number().over(Window.partitionBy(*name).orderBy("vec_id"))
    entries = points.withColumn("place", first).where(F.col("place") <= positives + 1)
    entries = entries.groupBy(*name).agg(F.sort_array(F.collect_list("vec_id")).alias("held"), F.min("vector").alias("vector"))
    asks = points.where("anchor").groupBy(*name).count()
    entries = written(entries.join(asks, name, "left").withColumn("width", F.size("vector")), "entries")
    tiles = written(_tiled(entries), "tiles")
    boxes = _boxes(tiles)
    if not boxes:
        return spark.createDataFrame([], nothing)

    everything = F.array(F.struct(F.lit(0).alias("slot"), *[F.lit(v).cast("long").alias(n) for n, v in (("low", -FAR), ("high", FAR), ("bound", -FAR))]))
    wanted = _asking(tiles).withColumn("needs", everything)

    def ends(score: str) -> tuple[str, str]:
        wide = f"CAST({score} AS decimal(20,0))"
        return f"CAST(ceil({low} * {wide} / 100) AS long)", f"CAST(floor({high} * {wide} / 100) AS long)"

    near = _found(tiles, boxes, wanted, True, positives + 1, name)
    scores = near.groupBy(*name).agg(F.array_sort(F.collect_set("score")).alias("scores"))
    window = F.expr(
        f"transform(filter(scores, s -> s >= 0), (s, i) -> struct(i AS slot, "
        f"{ends('s')[0]} AS low, {ends('s')[1]} AS high, -{FAR}L AS bound))"
    )
    wanted = _asking(tiles).join(scores.select(*name, window.alias("needs")), name).where("size(needs) > 0")
    wanted = written(wanted, "windows")
    far = _found(tiles, boxes, wanted, False, negatives, name)
    slots = wanted.select(*name, F.explode("needs").alias("need")).select(*name, "need.slot", "need.low", "need.high")
    far = far.join(slots, [*name, "slot"])

    # One vector may belong to a third of the anchors: their rows are spread over salts.
    some = entries.where("count IS NOT NULL")
    total = points.where("anchor").count()
    hot = some.where(F.col("count") > max(HOT, total // 1_000)).select(*name, F.ceil(F.col("count") / HOT).cast("int").alias("salts"))
    salts = F.coalesce("salts", F.lit(1))
    each = points.where("anchor").select(*name, F.col("vec_id").alias("anchor_id")).join(F.broadcast(hot), name, "left")
    each = each.withColumn("salt", F.pmod(F.xxhash64("anchor_id"), salts).cast("int")).drop("salts")
    answer = near.groupBy(*name).agg(F.collect_list(F.struct("score", "id")).alias("near"))
    answer = answer.join(
        far.groupBy(*name).agg(F.collect_list(F.struct("low", "high", "score", "id")).alias("far")), name
    ).join(F.broadcast(hot), name, "left")
    answer = answer.withColumn("salt", F.explode(F.sequence(F.lit(0), salts - 1))).drop("salts")
    best = F.expr(
        "slice(array_sort(filter(near, p -> p.id <> anchor_id), (a, b) -> CASE WHEN a.score > b.score THEN -1 "
        f"WHEN a.score < b.score THEN 1 WHEN a.id < b.id THEN -1 ELSE 1 END), 1, {positives})"
    )
    rows = each.join(answer, [*name, "salt"]).select("anchor_id", F.explode(best).alias("p"), "far")
    fits = F.expr(f"filter(far, n -> n.low = {ends('p.score')[0]} AND n.high = {ends('p.score')[1]})")
    # Two positives with one window have it once in each slot.
    ranked = F.expr(
        "array_sort(array_distinct(transform(fits, n -> struct(n.score AS score, n.id AS id))), (a, b) -> "
        "CASE WHEN a.score > b.score THEN -1 WHEN a.score < b.score THEN 1 WHEN a.id < b.id THEN -1 ELSE 1 END)"
    )
    rows = rows.withColumn("fits", fits).select("anchor_id", "p", F.posexplode(ranked).alias("at", "n"))
    return rows.select(
        "anchor_id",
        F.col("p.id").alias("positive_id"),
        (F.col("at") + 1).cast("int").alias("rank"),
        F.col("n.id").alias("negative_id"),
        F.col("p.score").alias("positive_score"),
        F.col("n.score").alias("negative_score"),
    )


def _tiled(entries: DataFrame) -> DataFrame:
    """One row a tile: its entries, packed. Tiles that the sample's cuts leave too full are split."""
    widths = entries.groupBy("width").count().orderBy(F.desc("count"), F.desc("width")).head()
    width, total = (widths["width"], widths["count"]) if widths else (0, 0)
    some = entries.where(F.col("width") == width).orderBy("name1", "name2", "label").limit(SAMPLE).select("vector").toArrow()
    size = max(TILE, math.ceil(total / TILES))
    cuts, _ = tile_cuts(_matrix(some["vector"]), min(TILES, math.ceil(total / size))) if width and len(some) else (0, 1)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            usual = batch.column("width").to_numpy() == width
            tile = np.full(batch.num_rows, -1, dtype=np.int32)
            if usual.any() and width:
                tile[usual] = tile_of(_matrix(pa.chunked_array([batch.column("vector").filter(pa.array(usual))])), cuts)
            yield batch.append_column("tile", pa.array(tile))

    placed = written(entries.mapInArrow(place, StructType([*entries.schema, StructField("tile", IntegerType())])), "placed")
    counts = placed.groupBy("width", "tile").agg(F.ceil(F.count("*") / (2 * size)).cast("int").alias("parts"))
    placed = placed.join(F.broadcast(counts), ["width", "tile"])
    placed = placed.withColumn("part", F.pmod(F.xxhash64("name1", "name2", "label"), "parts").cast("int"))
    held = F.struct("label", "vector", "held", "name1", "name2", F.col("count").isNotNull().alias("asks"))
    packed = placed.groupBy("width", "tile", "part").agg(F.collect_list(held).alias("entries"))
    return packed.withColumn("number", F.xxhash64("width", "tile", "part"))


def _boxes(tiles: DataFrame) -> list[tuple[int, int, np.ndarray, np.ndarray]]:
    """Every tile's number, count of entries and corners; at most some thousand tiles."""

    def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                values = _matrix(pa.chunked_array([batch.column("entries")[row].values.field("vector")]))
                corners = [pa.array([c.tolist()], pa.list_(pa.int64())) for c in (values.min(0), values.max(0))]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("number").slice(row, 1), pa.array([len(values)], pa.int64()), *corners],
                    names=["number", "held", "low", "high"],
                )

    found = tiles.select("number", "entries").mapInArrow(bound, "number long, held long, low array<long>, high array<long>").toArrow()
    sides = [[np.array(c.values, dtype=np.int64) for c in found[side]] for side in ("low", "high")]
    return list(zip(found["number"].to_pylist(), found["held"].to_pylist(), *sides, strict=True))


def _asking(tiles: DataFrame) -> DataFrame:
    """The anchors' entries: ``number, name1, name2, label, vector``, the tile's number first."""
    asks = tiles.select("number", F.explode(F.filter("entries", lambda e: e["asks"])).alias("e"))
    return asks.select("number", "e.name1", "e.name2", "e.label", "e.vector")


def _found(tiles: DataFrame, boxes: list, wanted: DataFrame, same: bool, k: int, name: list[str]) -> DataFrame:
    """``name1, name2, label, slot, score, id``: the k best rows of every need, over all tiles."""
    alone = wanted.withColumns({"shelf": F.col("number"), "tiles": F.array("number")})
    own = written(_visited(tiles.withColumn("shelf", F.col("number")), alone, same, k), "own")
    kth = Window.partitionBy(*name, "slot").orderBy(F.desc("score"), "id")
    bounds = own.withColumn("place", F.row_number().over(kth)).where(F.col("place") == k)
    bounds = bounds.groupBy(*name).agg(F.map_from_entries(F.collect_list(F.struct("slot", "score"))).alias("kth"))
    bounded = F.transform(
        "needs",
        lambda n: F.struct(n["slot"].alias("slot"), n["low"].alias("low"), n["high"].alias("high"), F.coalesce(F.col("kth")[n["slot"]], n["bound"]).alias("bound")),
    )
    wanted = wanted.join(bounds, name, "left").withColumn("needs", bounded).drop("kth")
    context = tiles.sparkSession.sparkContext
    shelves = min(len(boxes), max(SHELVES * context.defaultParallelism, math.ceil(sum(b[1] for b in boxes) / SHELF)))
    sent = context.broadcast(boxes)

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sides: dict[int, list] = {}
        for at, (number, _, low, high) in enumerate(sent.value):
            sides.setdefault(len(low), []).append((number, at % shelves, low, high))
        shaped = {w: tuple(np.array(c) for c in zip(*sorted(side, key=lambda s: s[1]), strict=True)) for w, side in sides.items()}
        for batch in batches:
            widths = pc.list_value_length(batch.column("vector")).to_numpy()
            for width in np.unique(widths).tolist():
                every = np.flatnonzero(widths == width)
                numbers, shelf, low, high = shaped[width]
                for mine in (every[at : at + RUN] for at in range(0, len(every), RUN)):
                    part = batch.take(pa.array(mine))
                    vectors = _matrix(pa.chunked_array([part.column("vector")]))
                    largest = max(float(np.abs(x).max(initial=0)) for x in (vectors, low, high))
                    kind = np.float64 if largest**2 * max(1, width) < EXACT / 2 else object
                    least, most = intervals(vectors.astype(kind), low.astype(kind), high.astype(kind))
                    needs = part.column("needs")
                    owner = np.repeat(np.arange(len(mine)), pc.list_value_length(needs).to_numpy())
                    need = {c: needs.flatten().field(c).to_numpy()[:, None] for c in ("low", "high", "bound")}
                    hit = (most[owner] >= np.maximum(need["low"], need["bound"])) & (least[owner] <= need["high"])
                    hit = np.logical_or.reduceat(hit, np.searchsorted(owner, np.arange(len(mine))))
                    hit &= numbers[None, :] != part.column("number").to_numpy()[:, None]
                    row, tile = np.nonzero(hit)  # by row, and there by shelf
                    starts = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(shelf[tile], prepend=-1) != 0))
                    there = _lists(np.append(starts, len(row)), pa.array(numbers[tile]))
                    visits = pa.StructArray.from_arrays([pa.array(shelf[tile[starts]]), there], names=["shelf", "tiles"])
                    yield part.append_column("visits", _lists(np.searchsorted(row[starts], np.arange(len(mine) + 1)), visits))

    chosen = wanted.select("number", *name, "vector", "needs")
    visits = ArrayType(StructType([StructField("shelf", LongType()), StructField("tiles", ArrayType(LongType()))]))
    chosen = written(chosen.mapInArrow(choose, StructType([*chosen.schema, StructField("visits", visits)])), "chosen")
    chosen = chosen.withColumn("v", F.explode("visits")).select("number", *name, "vector", "needs", "v.*")
    numbers = [(box[0], at % shelves) for at, box in enumerate(boxes)]
    shelved = tiles.join(F.broadcast(tiles.sparkSession.createDataFrame(numbers, "number long, shelf long")), "number")
    further = _visited(shelved, chosen, same, k)
    best = own.unionByName(further).withColumn("place", F.row_number().over(kth)).where(F.col("place") <= k)
    return written(best.drop("place"), "best")


def _visited(tiles: DataFrame, visits: DataFrame, same: bool, k: int) -> DataFrame:
    """What the visits ``(shelf, anchor, needs, tiles)`` find in their tiles."""
    packs = visits.withColumn("pack", F.pmod(F.xxhash64("number"), F.lit(PACKS)).cast("int"))
    packs = packs.groupBy("shelf", "pack").agg(F.collect_list(F.struct("name1", "name2", "label", "vector", "needs", "tiles")).alias("anchors"))
    # Never broadcast: Spark would judge by the compressed files, before each anchor is repeated for its shelves.
    met = packs.hint("merge").join(tiles.select("shelf", "number", "entries"), "shelf").select("anchors", "number", "entries")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                entries, anchors = batch.column("entries")[row].values, batch.column("anchors")[row].values
                goals = anchors.field("tiles")
                owner = np.repeat(np.arange(len(anchors)), pc.list_value_length(goals).to_numpy())
                here = owner[goals.flatten().to_numpy() == batch.column("number")[row].as_py()]
                if not len(here):
                    continue
                tree = Tree(
                    _matrix(pa.chunked_array([entries.field("vector")])),
                    entries.field("label").to_numpy(),
                    entries.field("held").to_pylist(),
                )
                for at in range(0, len(here), RUN):
                    some = anchors.take(pa.array(here[at : at + RUN]))
                    found = list(
                        tree.search(
                            _matrix(pa.chunked_array([some.field("vector")])),
                            some.field("label").to_numpy(),
                            some.field("needs").to_pylist(),
                            same,
                            k,
                        )
                    )
                    taken = pa.array([f[0] for f in found], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [some.field(c).take(taken) for c in ("name1", "name2", "label")]
                        + [pa.array([f[c] for f in found], t) for c, t in ((1, pa.int32()), (2, pa.int64()), (3, pa.int64()))],
                        names=["name1", "name2", "label", "slot", "score", "id"],
                    )

    return met.mapInArrow(search, "name1 long, name2 long, label long, slot int, score long, id long")
