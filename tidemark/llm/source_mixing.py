"""Mixing sources to target weights by Pfair scheduling.

The documents of a source are cut into blocks. With one slot per block, block ``k`` (from 0)
of a source of weight ``w`` is released at slot ``floor(k / w)`` and due by slot
``ceil((k + 1) / w)``. Giving every slot to the released block with the earliest deadline
meets all deadlines (weights add up to 1), so before any slot each source has had its share
within less than one block.

Weights are whole multiples of ``1 / WHOLE`` and never rounded to a cycle, so the schedule
need not repeat. It is cut into stretches of slots that are scheduled apart from each other, a
fold in a row each. What a stretch must know is how many blocks each source had before it. At
any slot that is the share rounded down or up, and two schedules that both meet their deadlines
agree as soon as the later blocks that one of them had left are due: the one whose open blocks
are due later keeps behind the other block by block, and has caught up when it has placed
them. So a stretch begins its fold as many slots early as the longest distance of two deadlines,
there with the earliest open deadlines rounded up, and arrives at the state of the whole
schedule. The place of a block follows from that state too, without a count over all blocks.

No document is dropped or repeated. When a source has run dry its later slots stay empty,
and the other sources keep their proportions to each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.llm.common import ranked, written

BLOCK = 16
CYCLE = 1_000  # the least weight is one slot in these
WHOLE = 10**12
CHUNK_BITS = 10  # a source is ranked in 2^10 pieces


def target_weights(docs: DataFrame, temperature: float = 0.5) -> DataFrame:
    """``source, weight`` proportional to the number of documents to the power ``temperature``.

    A null source counts as a source of its own.
    """
    counts = docs.groupBy("source").agg(F.count("*").alias("n"))
    return counts.select("source", F.pow("n", F.lit(temperature)).alias("weight"))


def whole_shares(weights: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """``source, share``: weights as whole numbers that add up to ``WHOLE``.

    Weights of less than one in ``cycle`` slots (one in ten per source, where there are more
    sources than a tenth of that) are raised to it, the others then scaled to what is left;
    without such weights all keep their proportions. Null, negative and non-finite weights
    count as 0; if all are 0 the sources share alike. What rounding leaves goes to the largest.
    """
    finite = F.when((F.col("weight") > 0) & (F.col("weight") < float("inf")), F.col("weight")).otherwise(0.0)
    summed = weights.groupBy("source").agg(F.sum(finite.cast("double")).alias("weight"))
    everything = Window.partitionBy(F.lit(0))  # over a row per source
    part = (
        summed.withColumn("total", F.sum("weight").over(everything))
        .withColumn("sources", F.count("*").over(everything))
        .withColumn("w", F.when(F.col("total") > 0, F.col("weight") / F.col("total")).otherwise(1 / F.col("sources")))
        .withColumn("least", 1 / F.greatest(F.lit(cycle), 10 * F.col("sources")))
        .withColumn("raised", F.col("w") < F.col("least"))
        .withColumn("up", F.sum(F.when(F.col("raised"), F.col("least")).otherwise(0.0)).over(everything))
        .withColumn("rest", F.sum(F.when(F.col("raised"), 0.0).otherwise(F.col("w"))).over(everything))
    )
    scaled = F.when(F.col("up") > 0, F.col("w") * (1 - F.col("up")) / F.col("rest")).otherwise(F.col("w"))
    part = part.withColumn("share", F.round(F.when(F.col("raised"), F.col("least")).otherwise(scaled) * WHOLE).cast("long"))
    largest = F.row_number().over(everything.orderBy(F.desc("share"), F.col("source").asc_nulls_first())) == 1
    left = F.lit(WHOLE) - F.sum("share").over(everything)
    return part.select("source", (F.col("share") + F.when(largest, left).otherwise(F.lit(0))).alias("share"))


def _div(a: Column, b: Column) -> Column:
    return F.call_function("div", a, b)


def _due(after: Column, share: Column) -> Column:
    """``ceil(after / share)``, by whole numbers."""
    return _div(after + share - 1, share)


def block_schedule(shares: DataFrame, cycle: int = CYCLE) -> DataFrame:
    """``source, b, mix_slot, mix_position`` of every block of ``shares(source, share, blocks)``.

    Slot by slot the earliest deadline among the released blocks wins, ties to the first
    source by name. A stretch is a row that carries a number per source. Stretches reach to
    the slot from which on only one source has blocks left; those are due one after the other.
    """
    spark = shares.sparkSession
    whole = F.lit(WHOLE).cast("long")
    ends = shares.where("blocks > 0").withColumn("end", F.ceil(F.col("blocks") * (WHOLE / F.col("share"))) + 1)
    ends = ends.orderBy(F.desc("end"), F.col("source").asc_nulls_first()).limit(2).collect()  # two rows
    if not ends:
        return spark.createDataFrame([], "source string, b long, mix_slot long, mix_position long")
    early = WHOLE // shares.agg(F.min("share")).head()[0] + 2
    length = max(cycle, early)
    stretches = -(-ends[1]["end"] // length) if len(ends) > 1 else 0

    one = shares.agg(F.sort_array(F.collect_list(F.struct("source", "share", "blocks"))).alias("s"))
    row = spark.range(stretches).withColumn("one", F.lit(0)).join(F.broadcast(one.withColumn("one", F.lit(0))), "one")
    row = row.withColumn("at", F.col("id") * length).withColumn("t", F.greatest(F.col("at") - early, F.lit(0)))

    def fluid(x: Column) -> Column:
        return F.col("t").cast("decimal(19,0)") * x["share"].cast("decimal(13,0)")

    row = row.withColumn(
        "p",
        F.transform(
            "s",
            lambda x, i: F.struct(
                i.alias("i"),
                x["share"].alias("share"),
                x["blocks"].alias("blocks"),
                _div(fluid(x), F.lit(WHOLE).cast("decimal(13,0)")).alias("base"),
                (fluid(x) % F.lit(WHOLE).cast("decimal(13,0)")).cast("long").alias("phase"),
            ),
        ),
    )
    total = F.aggregate("p", F.lit(0).cast("long"), lambda n, x: n + x["base"])
    open_ = F.transform(
        F.filter("p", lambda x: x["phase"] > 0),
        lambda x: F.struct(_due(whole - x["phase"], x["share"]).alias("deadline"), x["i"].alias("i")),
    )
    row = row.withColumn("up", F.slice(F.array_sort(open_), 1, (F.col("t") - total).cast("int"))["i"])
    row = row.withColumn(
        "begun", F.transform("p", lambda x: F.when(F.array_contains("up", x["i"]), 1).otherwise(0).cast("long"))
    )

    def due(had: Column, slot: Column) -> Column:
        """The source of a slot, by ``had``, the blocks of each source since the fold began."""
        return F.array_min(
            F.zip_with(
                F.col("p"),
                had,
                lambda x, j: F.when(
                    j * whole - x["phase"] < (slot + 1) * x["share"],
                    F.struct(
                        _due((j + 1) * whole - x["phase"], x["share"]).alias("deadline"),
                        x["i"].alias("i"),
                        (x["base"] + j).alias("b"),
                    ),
                ),
            )
        )

    def slots(first: Column, end: Column) -> Column:
        return F.when(end > first, F.sequence(first, end - 1)).otherwise(F.array().cast("array<bigint>"))

    def moved(had: Column, i: Column) -> Column:
        return F.transform(had, lambda j, at: F.when(at == i, j + 1).otherwise(j))

    none, warm = F.lit(0).cast("long"), F.col("at") - F.col("t")
    row = row.withColumn(
        "had", F.aggregate(slots(none, warm), F.col("begun"), lambda had, slot: moved(had, due(had, slot)["i"]))
    )

    def step(state: Column, slot: Column) -> Column:
        now = due(state["had"], slot)
        placed = F.struct(now["i"].alias("i"), now["b"].alias("b"), (F.col("t") + slot).alias("slot"))
        return F.struct(moved(state["had"], now["i"]).alias("had"), F.concat(state["out"], F.array(placed)).alias("out"))

    start = F.struct(F.col("had"), F.array().cast("array<struct<i:int,b:bigint,slot:bigint>>").alias("out"))
    before = F.aggregate(
        F.zip_with("p", "had", lambda x, j: F.least(x["blocks"], x["base"] + j)), none, lambda n, x: n + x
    )
    row = row.select("s", before.alias("before"), F.aggregate(slots(warm, warm + length), start, step)["out"].alias("out"))
    there = F.filter("out", lambda o: o["b"] < F.get(F.col("s"), o["i"])["blocks"])
    found = row.select("s", "before", F.posexplode(there).alias("pos", "o")).select(
        F.get("s", F.col("o.i"))["source"].alias("source"),
        F.col("o.b").alias("b"),
        F.col("o.slot").alias("mix_slot"),
        (F.col("before") + F.col("pos")).alias("mix_position"),
    )
    found = written(found, "schedule")

    last = ends[0]
    mine = F.col("source").eqNullSafe(F.lit(last["source"]))
    others = shares.where(~mine).agg(F.coalesce(F.sum("blocks"), F.lit(0))).head()[0]
    part = F.lit(last["share"]).cast("decimal(13,0)")
    fluid_end = (F.col("id") + 1).cast("decimal(19,0)") * F.lit(WHOLE).cast("decimal(13,0)")
    tail = spark.range(found.where(mine).count(), last["blocks"]).select(
        F.lit(last["source"]).cast(shares.schema["source"].dataType).alias("source"),
        F.col("id").alias("b"),
        (_div(fluid_end + part - 1, part) - 1).alias("mix_slot"),
        (F.col("id") + others).alias("mix_position"),
    )
    return found.unionByName(tail)


def mixed_sources(
    docs: DataFrame, weights: DataFrame | None = None, block: int = BLOCK, cycle: int = CYCLE
) -> DataFrame:
    """``docs`` with its columns and ``mix_block``, ``mix_slot`` and ``mix_position``.

    ``mix_block`` numbers the blocks of a source, ``mix_slot`` is the block's slot in the
    schedule, and ``mix_position`` numbers the blocks in order of slot, without the empty
    ones: reading by ``mix_position`` follows the weights. Within a source, documents are
    dealt to blocks in order of a hash of ``doc_id``.

    ``weights(source, weight)`` defaults to :func:`target_weights`. Sources that ``weights``
    lacks get the least weight, and sources without documents only leave empty slots. A null
    source is a source of its own. Rows of a source that repeat a ``doc_id`` share its
    place; rows without one are placed by all their columns. An empty table gives no rows.
    Columns of ``docs`` that bear the three names are replaced.

    A weight of less than one slot in ``cycle`` counts as that. Mixtures have up to thousands
    of sources: every slot up to where only one source has blocks left costs a step per source.
    """
    named = ["mix_block", "mix_slot", "mix_position"]
    docs = docs.drop(*named)
    if not {"doc_id", "source"} <= set(docs.columns):
        raise ValueError("doc_id and source are needed")
    names = docs.columns
    docs = docs.withColumn(
        "__key", F.when(F.col("doc_id").isNotNull(), F.xxhash64("doc_id")).otherwise(F.xxhash64(*docs.columns))
    )
    once = written(docs.select("source", "__key").distinct(), "mixed")
    there = once.groupBy("source").agg(F.count("*").alias("n"))
    given = target_weights(once) if weights is None else weights.select("source", F.col("weight").cast("double"))
    every = given.unionByName(there.select("source", F.lit(0.0).alias("weight")))
    placed = ranked(once, ["source"], F.shiftright("__key", 64 - CHUNK_BITS), [F.col("__key")], "__rank")
    placed = placed.select(
        F.col("source").alias("__source"), F.col("__key").alias("__k"), F.floor(F.col("__rank") / block).alias("mix_block")
    )

    # A source's blocks follow from its count alone.
    counted = there.select(F.col("source").alias("__s"), F.ceil(F.col("n") / block).alias("blocks"))
    shares = whole_shares(every, cycle)
    shares = shares.join(counted, shares.source.eqNullSafe(F.col("__s")), "left")
    shares = written(shares.select("source", "share", F.coalesce("blocks", F.lit(0)).alias("blocks")), "shares")
    blocks = block_schedule(shares, cycle).withColumnRenamed("source", "__s")
    placed = placed.join(
        blocks, F.col("__source").eqNullSafe(F.col("__s")) & (F.col("mix_block") == F.col("b"))
    ).select("__source", "__k", *named)
    return docs.join(
        placed, docs.source.eqNullSafe(F.col("__source")) & (F.col("__key") == F.col("__k"))
    ).select(*names, *named)
