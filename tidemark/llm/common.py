"""What several operators share: tables, written steps, components, ranks and word hashes."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared folder and read it back, which cuts its lineage."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def components(edges: DataFrame, rounds: int = 40) -> DataFrame:
    """Connected components of ``edges(a, b)`` as rows ``(id, component)``, component the least id.

    Alternating large and small stars (Kiveris et al. 2014): every round hangs the
    neighbours of a vertex below the least of them, until each component is one star.
    Every round writes its edges to the shared folder. An empty input gives no rows;
    loops and repeated edges are ignored. More rounds than ``rounds`` are an error.
    """

    def starred(pairs: DataFrame, large: bool) -> DataFrame:
        sides = pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
        if large:
            sides = sides.unionByName(pairs.select(F.col("b").alias("u"), F.col("a").alias("v")))
        least = sides.groupBy("u").agg(F.min("v").alias("m"))
        least = least.select("u", F.least("u", "m").alias("m"))
        if large:
            hung = sides.where("v > u").join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
        else:
            hung = sides.join(least, "u").select(F.col("v").alias("a"), F.col("m").alias("b"))
            hung = hung.unionByName(least.select(F.col("u").alias("a"), F.col("m").alias("b")))
        return hung.where("a > b").distinct()

    def state(pairs: DataFrame) -> tuple:
        row = pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).head()
        return tuple(row)

    pairs = written(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    before = state(pairs)
    for _ in range(rounds):
        if not before[0]:
            break
        pairs = written(starred(starred(pairs, True), False), "edges")
        after = state(pairs)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return (
        pairs.select(F.col("a").alias("id"), F.col("b").alias("component"))
        .unionByName(pairs.select(F.col("b").alias("id"), F.col("b").alias("component")))
        .distinct()
    )


def ranked(df: DataFrame, keys: list[str], chunk: Column, order: list[Column], name: str) -> DataFrame:
    """Add the rank (from 0) of every row within ``keys``, without a task per key.

    ``chunk`` must not decrease along ``order`` within a key. Rows are ranked inside
    (key, chunk); counts per chunk, added up over the far smaller table of chunks, give
    the rest. Rows that are equal in all of ``order`` get distinct, arbitrary ranks.
    """
    df = df.withColumn("__chunk", chunk)
    counts = df.groupBy(*keys, "__chunk").agg(F.count("*").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        *[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)],
        F.col("__chunk").alias("__c"),
        F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"),
    )
    inside = F.row_number().over(Window.partitionBy(*keys, "__chunk").orderBy(*order)) - 1
    same = F.col("__chunk").eqNullSafe(F.col("__c"))
    for i, k in enumerate(keys):
        same = same & F.col(k).eqNullSafe(F.col(f"__k{i}"))
    joined = df.withColumn("__inside", inside).join(offsets, same)
    return joined.withColumn(name, F.col("__before") + F.col("__inside")).drop(
        "__chunk", "__c", "__before", "__inside", *[f"__k{i}" for i in range(len(keys))]
    )


# Words of UTF-8 text by numpy. A word is a run of bytes other than space and \t..\r; those
# separators are ASCII, so no character is ever cut.

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PIECE = 1 << 18


def mixed(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (the finaliser of SplitMix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n + 1, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def word_hashes(data: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word of one UTF-8 text, A-Z lowered, in order.

    The text is hashed in pieces of 256 KiB, cut between words.
    """
    found, at, n = [], 0, len(data)
    while at < n:
        end = min(n, at + _PIECE)
        if end < n:  # move the cut back to the last separator, or on to the next
            gaps = np.flatnonzero(_SPACE[data[at:end]])
            if len(gaps):
                end = at + int(gaps[-1]) + 1
            else:
                rest = np.flatnonzero(_SPACE[data[end:]])
                end = end + int(rest[0]) if len(rest) else n
        found.append(_piece_hashes(data[at:end]))
        at = end
    return np.concatenate(found) if found else np.empty(0, dtype=np.uint64)


def _piece_hashes(data: np.ndarray) -> np.ndarray:
    inside = np.empty(len(data) + 2, dtype=np.int8)
    inside[0] = inside[-1] = 0
    inside[1:-1] = ~_SPACE[data]
    steps = np.diff(inside)
    starts, ends = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
    up, down = _powers(_BASE, len(data)), _powers(_BASE_INVERSE, len(data))
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((_LOWER[data].astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] ^ (ends - starts).astype(np.uint64))


def texts_of(column: pa.Array | pa.ChunkedArray) -> Iterator[np.ndarray]:
    """The UTF-8 bytes of every text of a column; null counts as empty. Nothing is copied."""
    for array in column.chunks if isinstance(column, pa.ChunkedArray) else [column]:
        array = array.cast(pa.large_binary()) if not pa.types.is_large_binary(array.type) else array
        _, offsets, data = array.buffers()
        at = np.frombuffer(offsets, dtype=np.int64)[array.offset : array.offset + len(array) + 1]
        held = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
        nulls = array.is_null().to_numpy(zero_copy_only=False)
        for i in range(len(array)):
            yield held[:0] if nulls[i] else held[at[i] : at[i + 1]]


def shingle_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """Hashes of the runs of ``width`` words, with repeats; fewer words make one run of all of them."""
    if not len(words):
        return words
    span = min(width, len(words))
    out = np.zeros(len(words) - span + 1, dtype=np.uint64)
    for k in range(span):
        out = mixed(out + words[k : len(words) - span + 1 + k])
    return mixed(out + np.uint64(span))


def shingle_set(data: np.ndarray, width: int) -> np.ndarray:
    """The distinct shingles of one text as sorted 64-bit hashes."""
    return np.unique(shingle_hashes(word_hashes(data), width))
