"""Benchmark items inside documents: containment search over size-partitioned MinHash signatures.

Documents are partitioned by the size of their shingle set (powers of four), as in LSH
Ensemble (Zhu et al. 2016), for containment of a short item in a long document means a tiny
Jaccard similarity, and the number of hashes it takes depends on the document's size.
Here a partition of documents of up to 2^k shingles uses one-permutation MinHash with
2^(k+1) bins: a shingle's 64-bit hash names its bin by its top bits, and the least hash of a
bin is that bin's MinHash. An item is signed once for every partition that has documents,
with that partition's bins. A shared shingle is lost only behind another shingle of its
bin, so at a load of at most 5/8 it survives with probability above 0.74. A pair is a
candidate if it agrees in as many bins as that predicts, less five standard deviations and
at least one, and is decided by exact containment on the full shingle sets. An item of 11
shingles of which 9 are shared goes unseen with probability under 1e-5. Shorter items have too
few shingles for that, so theirs are not signed but met with every shingle of the documents.

All of it is DataFrame expressions. The items' signatures are broadcast only up to
``BROADCAST_ROWS`` rows, counted first, and joined by a shuffle beyond.
"""

from __future__ import annotations

from math import ceil, comb, floor, sqrt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

WIDTH = 5
CONTAINMENT = 0.8
BROADCAST_ROWS = 500_000  # of a long, an int and an item's id each
SURVIVES = 0.74  # least probability that a shared shingle is the least of its bin on both sides
MISSED = 1e-5  # greatest probability that a signed item at the threshold is no candidate
EVERY = -1  # the partition of items that are met with every shingle
LAST_PART = 24  # documents of more than 2^24 shingles use its bins


def shingle_array(text: Column, width: int = WIDTH) -> Column:
    """Sorted distinct hashes of the runs of ``width`` words; fewer words make one run.

    Words are runs of letters and digits, in lower case. Null and wordless texts give an
    empty array.
    """
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    return F.array_sort(F.array_distinct(_runs(F.transform(words, lambda w: F.xxhash64(w)), width)))


def _runs(hashes: Column, width: int) -> Column:
    """Hashes of every ``width`` neighbours, of all of them if they are fewer."""

    def of(h: Column) -> Column:
        run = F.transform(
            F.sequence(F.lit(1), F.size(h) - (width - 1)),
            lambda i: F.xxhash64(*[F.element_at(h, i + k) for k in range(width)]),
        )
        none = F.array().cast("array<bigint>")
        return (
            F.when(F.size(h) == 0, none)
            .when(F.size(h) < width, F.array(F.xxhash64(h)))
            .otherwise(run)
        )

    # A one-element array binds the word hashes once, so that they are not computed again
    # wherever they are used.
    return F.element_at(F.transform(F.array(hashes), of), 1)


def _part(n: Column) -> Column:
    """The least even k with ``n <= 2^k``."""
    k = (2 * F.ceil(F.log2(F.greatest(n, F.lit(1))) / 2)).cast("int")
    return F.least(k, F.lit(LAST_PART))


def _least_matches(n_item: Column, containment: float) -> Column:
    expected = n_item * (containment * SURVIVES)
    return F.greatest(F.lit(1), F.floor(expected - 5 * F.sqrt(expected * (1 - SURVIVES))))


def unsigned_up_to(containment: float) -> int:
    """The largest number of shingles of which an item at the threshold is missed too often."""

    def missed(n: int) -> float:
        shared, expected = max(1, ceil(containment * n)), n * containment * SURVIVES
        least = max(1, floor(expected - 5 * sqrt(expected * (1 - SURVIVES))))
        return sum(
            comb(shared, k) * SURVIVES**k * (1 - SURVIVES) ** (shared - k) for k in range(min(least, shared + 1))
        )

    n, run = 1, 0  # ``run`` sizes in a row are safe; the share missed falls, but for rounding
    while run < ceil(10 / containment):
        run = run + 1 if missed(n) < MISSED else 0
        n += 1
    return n - 1 - run


def _is_least(hashes: Column, part: Column, h: Column, i: Column) -> Column:
    """Whether ``h``, at ``i`` of the sorted ``hashes``, is the least of its bin, a run of them."""

    def bin_of(h: Column) -> Column:
        return F.call_function("shiftright", h, F.lit(63) - part)

    return (i == 0) | (bin_of(h) != bin_of(F.get(hashes, i - 1)))


def _signature(hashes: Column, part: Column) -> Column:
    """The least hash of every bin."""
    return F.filter(hashes, lambda h, i: _is_least(hashes, part, h, i))


def item_shingles(benchmark: DataFrame, width: int = WIDTH) -> DataFrame:
    """``item_id, shingles, n_item`` of the items that have words; equal items once."""
    return (
        benchmark.select(F.col("item_id"), shingle_array(F.col("text"), width).alias("shingles"))
        .where(F.col("item_id").isNotNull() & (F.size("shingles") > 0))
        .withColumn("n_item", F.size("shingles").cast("long"))
        .dropDuplicates()
    )


def contained_items(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT
) -> DataFrame:
    """Pairs ``doc_id, item_id, n_item, n_shared, containment`` that reach ``containment``.

    ``containment`` is the share of the item's distinct shingles that the whole document
    holds. Null and wordless texts on either side are in no pair, and neither are rows with
    a null id. Repeated rows give one pair; rows that share an id but not a text give the
    pair with the larger share. Other columns are ignored. An empty table on either side
    gives no rows.
    """
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where(
        "doc_id IS NOT NULL AND text IS NOT NULL"
    )
    items = written(item_shingles(benchmark, width), "items")
    short = unsigned_up_to(containment)
    # A document of fewer than containment * n_item shingles cannot hold the item.
    parts = F.explode(F.sequence(F.lit(0), F.lit(LAST_PART), F.lit(2)))
    wanted = (
        items.where(F.col("n_item") > short)
        .select("item_id", "n_item", "shingles", parts.alias("part"))
        .where((F.col("part") == LAST_PART) | (containment * F.col("n_item") <= F.pow(F.lit(2), "part")))
        .select("item_id", "part", F.explode(_signature(F.col("shingles"), F.col("part"))).alias("low"))
    )
    whole = items.where(F.col("n_item") <= short).select(
        "item_id", F.lit(EVERY).alias("part"), F.explode("shingles").alias("low")
    )
    wanted = written(wanted.unionByName(whole).distinct(), "signatures")
    counts = {r.whole: r.n for r in wanted.groupBy((F.col("part") == EVERY).alias("whole")).agg(F.count("*").alias("n")).collect()}
    sets = texts.select("doc_id", shingle_array(F.col("text"), width).alias("s")).withColumn("part", _part(F.size("s")))
    s, part = F.col("s"), F.col("part")
    if counts.get(True):
        every = F.transform(s, lambda h, i: F.struct(h.alias("low"), _is_least(s, part, h, i).alias("least")))
        signed = sets.select("doc_id", "part", F.inline(every))
    else:
        signed = sets.select("doc_id", "part", F.explode(_signature(s, part)).alias("low"), F.lit(True).alias("least"))
    if sum(counts.values()) <= BROADCAST_ROWS:
        by_hash = wanted.groupBy("low").agg(F.collect_set(F.struct("part", "item_id")).alias("held"))
        met = signed.join(F.broadcast(by_hash), "low").select(
            "doc_id", "part", "least", F.explode("held").alias("h")
        )
        met = met.where((F.col("h.part") == EVERY) | (F.col("least") & (F.col("part") == F.col("h.part"))))
        met = met.select("doc_id", F.col("h.item_id").alias("item_id"))
    else:
        held = wanted.withColumnRenamed("part", "held")
        met = signed.join(held, "low").where((F.col("held") == EVERY) | (F.col("least") & (F.col("part") == F.col("held"))))
        met = met.select("doc_id", "item_id")
    met = met.groupBy("doc_id", "item_id").agg(F.count("*").alias("matches"))
    met = met.join(items.select("item_id", "n_item"), "item_id")
    enough = F.when(F.col("n_item") <= short, containment * F.col("n_item")).otherwise(
        _least_matches(F.col("n_item"), containment)
    )
    met = met.where(F.col("matches") >= enough).select("doc_id", "item_id")
    met = written(met.distinct(), "candidates")

    candidate = met.select("doc_id").distinct()
    full = texts.join(candidate, "doc_id", "left_semi").select(
        "doc_id", shingle_array(F.col("text"), width).alias("held")
    )
    shared = F.size(F.array_intersect("shingles", "held")).cast("long")
    return (
        met.join(items, "item_id")
        .join(full, "doc_id")
        .select("doc_id", "item_id", "n_item", shared.alias("n_shared"))
        .where(F.col("n_shared") >= containment * F.col("n_item"))
        .groupBy("doc_id", "item_id")
        .agg(F.max(F.struct(F.col("n_shared") / F.col("n_item"), "n_shared", "n_item")).alias("best"))
        .select(
            "doc_id",
            "item_id",
            F.col("best.n_item").alias("n_item"),
            F.col("best.n_shared").alias("n_shared"),
            (F.col("best.n_shared") / F.col("best.n_item")).alias("containment"),
        )
    )


def decontaminated(
    docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, containment: float = CONTAINMENT
) -> DataFrame:
    """``docs`` with all its columns, without the documents that hold a benchmark item."""
    found = contained_items(docs, benchmark, width, containment).select(F.col("doc_id").alias("__found")).distinct()
    return docs.join(found, F.col("doc_id").cast("long") == F.col("__found"), "left_anti")
