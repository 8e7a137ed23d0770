"""Ranked lexical search by hashed max-sketches.

A document's weight for a term is its impact. The terms of a document are hashed into a row of
``WIDTH`` coordinates, each the largest impact of the terms that fall into it: a sketch that is
never below the document itself. For a batch of documents and of queries, adding up a query's
coordinates gives an upper bound of every score. Documents are then scored exactly, from their
own counts, in descending order of the bound, until the bound falls below the k-th best score
that the task has met; bounds equal to it are still scored, as the smaller id wins a tie.

Only terms of the queries are counted in the documents. They are sent to the tasks in parts of
at most ``TERMS`` terms and ``QUERIES`` queries, so what is broadcast is bounded; every part
reads the documents once. A task returns k documents a query, and Spark ranks these.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType
from pyspark.sql.window import Window

from tidemark.llm.common import mixed, written

WIDTH = 1_024  # coordinates of a sketch
TERMS = 200_000  # terms of the queries that are sent to the tasks at once
QUERIES = 10_000  # queries of one part
BATCH = 2_048  # documents whose sketches a task holds
STEP = 32  # documents that are scored exactly at once

# What a term is, and the small letters of A to Z.
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def terms(text: str | None) -> list[str]:
    """The terms of a text in order, with repeats."""
    text = text or ""
    return TERM.findall(text.lower() if text.isascii() else text.translate(LOWER))


def weight(held: int, total: int) -> int:
    """How much a term counts that ``held`` of ``total`` documents hold."""
    return math.floor(1000 * math.log((2 * total + 2) / (2 * held + 1)))


def impacts(weights: np.ndarray, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What a term adds to the score of a document that holds it ``tf`` times."""
    return weights * ((1_000_000_000 * tf) // (1000 * tf + 8 * m))


def counted(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """``doc_id, n, term, tf``: a document's number of terms, and its counts of the given ones."""
    place = {t: i for i, t in enumerate(vocabulary)}
    schema = StructType(
        [
            docs.schema["doc_id"],
            StructField("n", LongType()),
            StructField("term", ArrayType(IntegerType())),
            StructField("tf", ArrayType(LongType())),
        ]
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, held = [], []
            for text in batch.column(1):
                found = terms(text.as_py())
                sizes.append(len(found))
                held.append(Counter(filter(None.__ne__, map(place.get, found))))
            ends = pa.array(np.cumsum([0, *map(len, held)], dtype=np.int32))
            lists = [
                pa.ListArray.from_arrays(ends, pa.array([t for h in held for t in h], pa.int32())),
                pa.ListArray.from_arrays(ends, pa.array([c for h in held for c in h.values()], pa.int64())),
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int64()), *lists], names=schema.names)

    return docs.select("doc_id", "text").mapInArrow(count, schema)


class Sketches:
    """The documents of one batch: sparse impacts, and their hashed maxima."""

    def __init__(self, batch: pa.RecordBatch, weights: np.ndarray, place: np.ndarray, mean: tuple[int, int]):
        docs, total = mean
        lists = batch.column("term")
        self.ends = np.cumsum(np.append(0, pc.list_value_length(lists).to_numpy(zero_copy_only=False)))
        self.term = lists.flatten().to_numpy()
        row = np.repeat(np.arange(batch.num_rows), np.diff(self.ends))
        m = 10 + (90 * batch.column("n").to_numpy() * docs) // max(total, 1)
        self.impact = impacts(weights[self.term], batch.column("tf").flatten().to_numpy(), m[row])
        self.maxima = np.zeros((WIDTH, batch.num_rows), dtype=np.int64)
        np.maximum.at(self.maxima, (place[self.term], row), self.impact)

    def bounds(self, coordinates: np.ndarray) -> np.ndarray:
        """No document scores more than this for terms of these coordinates."""
        return self.maxima[coordinates].sum(0)

    def scores(self, rows: np.ndarray, wanted: np.ndarray) -> np.ndarray:
        """Exact scores of some documents for the terms that ``wanted`` marks."""
        lengths = self.ends[rows + 1] - self.ends[rows]
        first = np.repeat(self.ends[rows] - np.cumsum(lengths) + lengths, lengths)
        at = first + np.arange(len(first))
        owner = np.repeat(np.arange(len(rows)), lengths)
        out = np.zeros(len(rows), dtype=np.int64)
        np.add.at(out, owner, np.where(wanted[self.term[at]], self.impact[at], 0))
        return out


def best(score: np.ndarray, ids: np.ndarray, null: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores above 0; equal ones by ascending id, null last."""
    order = np.lexsort((ids, null, -score))[:k]
    return order[score[order] > 0]


def ranked_documents(docs: DataFrame, items: DataFrame, k: int = 10) -> DataFrame:
    """``item_id, rank, doc_id, score``: the k best of ``docs(doc_id, text)`` for ``items(item_id, text)``.

    Scores are whole numbers and exact. Null and empty texts hold no term: as a document such a
    text is not counted, as an item it finds nothing. Equal rows of ``items`` count once; an
    ``item_id`` with several texts is ranked once for each of them. Rows that repeat a ``doc_id``
    are documents of their own, and a null ``doc_id`` follows all others of its score. ``doc_id``
    is a whole number. Other columns are ignored; an empty table gives no rows.
    """
    spark = docs.sparkSession
    out = "item_id {0}, score long, doc_id long, query int".format(items.schema["item_id"].dataType.simpleString())
    found = spark.createDataFrame([], out.replace("query int", "rank int")).select("item_id", "rank", "doc_id", "score")
    asked = written(items.select("item_id", "text").distinct(), "items")
    # A part is bounded by the number of its queries and by the characters they may hold.
    size = asked.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars")).head()
    parts = max(1, math.ceil(size["n"] / QUERIES), math.ceil(size["chars"] / (2 * TERMS)))
    for part in range(parts):
        mine = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == part).collect()
        each = [(q.item_id, sorted(set(terms(q.text)))) for q in mine]
        vocabulary = sorted({t for _, words in each for t in words})
        if vocabulary:
            found = found.unionByName(_part(docs, each, vocabulary, k, items.schema["item_id"].dataType))
    return found


def _part(docs: DataFrame, each: list[tuple], vocabulary: list[str], k: int, kind) -> DataFrame:
    held = written(counted(docs, vocabulary), "counted")
    row = held.agg(F.count(F.when(F.col("n") > 0, 1)).alias("docs"), F.coalesce(F.sum("n"), F.lit(0)).alias("total")).head()
    mean = (row.docs, row.total)
    frequency = np.zeros(len(vocabulary), dtype=np.int64)
    for r in held.select(F.explode("term").alias("term")).groupBy("term").count().toLocalIterator():
        frequency[r["term"]] = r["count"]
    weights = np.array([weight(int(f), row.docs) for f in frequency], dtype=np.int64)
    place = (mixed(np.arange(len(vocabulary), dtype=np.uint64)) % np.uint64(WIDTH)).astype(np.int64)
    number = {t: i for i, t in enumerate(vocabulary)}
    queries = [(i, np.array([number[t] for t in words], dtype=np.int64)) for i, (_, words) in enumerate(each) if words]
    sent = held.sparkSession.sparkContext.broadcast((weights, place, queries))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, place, queries = sent.value
        marked = np.zeros(len(weights), dtype=bool)
        nothing = np.empty(0, dtype=np.int64)
        top = {i: (nothing, nothing, nothing.astype(bool)) for i, _ in queries}  # score, id, null
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH):
                batch = whole.slice(at, BATCH)
                ids = batch.column("doc_id")
                null = ids.is_null().to_numpy(zero_copy_only=False)
                ids = ids.fill_null(0).to_numpy()
                sketch = Sketches(batch, weights, place, mean)
                for i, numbers in queries:
                    bound = sketch.bounds(place[numbers])
                    threshold = top[i][0][-1] if len(top[i][0]) == k else 1
                    rows = np.flatnonzero(bound >= threshold)
                    rows = rows[np.argsort(-bound[rows], kind="stable")]
                    marked[numbers] = True
                    for step in range(0, len(rows), STEP):
                        threshold = top[i][0][-1] if len(top[i][0]) == k else 1
                        some = rows[step : step + STEP]
                        if bound[some[0]] < threshold:
                            break
                        score = np.append(top[i][0], sketch.scores(some, marked))
                        id_, none = np.append(top[i][1], ids[some]), np.append(top[i][2], null[some])
                        kept = best(score, id_, none, k)
                        top[i] = score[kept], id_[kept], none[kept]
                    marked[numbers] = False
        for i, (score, ids, null) in top.items():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), i), pa.int32()), pa.array(score, pa.int64()), pa.array(ids, pa.int64(), mask=null)],
                names=["query", "score", "doc_id"],
            )

    kept = held.where("n > 0").withColumn("doc_id", F.col("doc_id").cast("long"))
    kept = kept.mapInArrow(search, "query int, score long, doc_id long")
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    kept = kept.withColumn("rank", F.row_number().over(order).cast("int")).where(F.col("rank") <= k)
    schema = StructType([StructField("query", IntegerType()), StructField("item_id", kind)])
    names = held.sparkSession.createDataFrame([(i, item) for i, (item, _) in enumerate(each)], schema)
    return kept.join(names, "query").select("item_id", "rank", "doc_id", "score")
