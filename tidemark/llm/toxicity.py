"""Toxicity of documents and of their sentences, learnt from labels of documents alone.

Multiple-instance learning: a document is toxic if any of its sentences is. A sentence ``s``
of a document with ``S`` sentences is toxic with probability ``p = sigmoid(bias + slope *
ln S + sum of the weights of its words)``; the document's score is the noisy-or
``1 - prod(1 - p)``. Weights are fitted to the documents' labels through the noisy-or, so
that the same model then says which sentences are to blame. The weight of a word is the sum
over the word itself and its beginnings of four letters and more, which lets inflected and
compound forms share evidence.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Labelled documents that are expected in the training sample (all, if there are fewer).
SAMPLE = 8_000
#: Features that are kept of the sample.
FEATURES = 4_000
MIN_DOCS = 4  # toxic documents that a feature must occur in
MIN_RATIO = 2.5  # of its rate in toxic documents to that in others
OFFENDING = 0.5  # probability of a sentence that is pointed out

_SENTENCE = re.compile(r"[^.!?\n]+")
_WORD = re.compile(r"[^\W_]+")
_CACHE = 200_000


def sentences(text: str) -> Iterator[tuple[int, int, list[str]]]:
    """Start, end and lower-case words of every sentence that has a word."""
    for found in _SENTENCE.finditer(text):
        words = _WORD.findall(found[0].lower())
        if words:
            yield found.start(), found.end(), words


def features(word: str) -> list[str]:
    """The word, marked by ``$``, and its proper beginnings of 4 to 10 letters."""
    return [word + "$", *(word[:k] for k in range(4, min(len(word), 11)))]


@dataclass
class Model:
    """Weights of features, and the two terms that every sentence has."""

    bias: float = -20.0
    slope: float = 0.0
    weights: dict[str, float] = field(default_factory=dict)
    words: dict[str, float] = field(default_factory=dict)

    def word(self, word: str) -> float:
        known = self.words.get(word)
        if known is None:
            if len(self.words) >= _CACHE:
                self.words.clear()
            known = self.words[word] = sum(self.weights.get(f, 0.0) for f in features(word))
        return known

    def judge(self, text: str) -> tuple[float, list[tuple[int, int, float]]]:
        """The score of a text, and start, end and probability of its offending sentences."""
        found = [(start, end, sum(map(self.word, words))) for start, end, words in sentences(text)]
        every = self.bias + self.slope * math.log(max(1, len(found)))
        clean, offending = 0.0, []
        for start, end, z in found:
            z += every
            clean -= z + math.log1p(math.exp(-z)) if z > 0 else math.log1p(math.exp(z))
            if z > 0:
                p = 1 / (1 + math.exp(-z))
                if p >= OFFENDING:
                    offending.append((start, end, p))
        return -math.expm1(clean), offending


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``doc_id, text, toxic`` of documents with a text and a label; the highest of several labels."""
    marks = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return docs.select("doc_id", "text").where("text IS NOT NULL").join(marks, "doc_id").select("doc_id", "text", "toxic")


def trained(rows: DataFrame, sample: int = SAMPLE) -> Model:
    """A model from ``rows(doc_id, text, toxic)``.

    Of more than ``sample`` rows those with the least hashes of ``doc_id`` are taken, about
    ``sample`` of them. Features are counted by Spark; the encoded sample, bounded by
    ``sample`` and ``FEATURES``, is fitted on the driver. Without toxic rows every score is
    nearly 0.
    """
    part = F.pmod(F.xxhash64("doc_id", F.lit(10)), F.lit(1 << 20)) / (1 << 20)
    taken = rows.where(part < sample / max(1, rows.count())).select("text", F.col("toxic").cast("int").alias("toxic"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            docs, uses = (Counter(), Counter()), (Counter(), Counter())
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                words = Counter(w for _, _, ws in sentences(text) for w in ws)
                own = Counter()
                for w, n in words.items():
                    for f in features(w):
                        own[f] += n
                own[""] = sum(words.values())
                docs[toxic > 0].update(own.keys())
                uses[toxic > 0].update(own)
            names = list(docs[0].keys() | docs[1].keys())
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string())]
                + [pa.array([c[n] for n in names], pa.int64()) for c in (docs[1], docs[0], uses[1], uses[0])],
                names=["feature", "docs1", "docs0", "uses1", "uses0"],
            )

    counted = (
        taken.mapInArrow(count, "feature string, docs1 long, docs0 long, uses1 long, uses0 long")
        .groupBy("feature")
        .agg(*[F.sum(c).alias(c) for c in ("docs1", "docs0", "uses1", "uses0")])
        .where((F.col("docs1") >= MIN_DOCS) | (F.col("feature") == ""))
    )
    total = counted.where("feature = ''").head()
    if total is None or not total.docs1:
        return Model()
    rate1 = (F.col("uses1") + 0.5) / (total.uses1 + 1)
    rate0 = (F.col("uses0") + 0.5) / (total.uses0 + 1)
    vocabulary = {
        row.feature: i
        for i, row in enumerate(
            counted.where((F.col("feature") != "") & (rate1 >= MIN_RATIO * rate0))
            .orderBy(F.desc(F.col("uses1") * F.log(rate1 / rate0)), "feature")
            .limit(FEATURES)
            .select("feature")
            .collect()
        )
    }

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, toxic in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist(), strict=True):
                sizes, ids, n = [], [], 0
                for _, _, words in sentences(text):
                    n += 1
                    own = [vocabulary[f] for w in words for f in features(w) if f in vocabulary]
                    if own:
                        sizes.append(len(own))
                        ids += own
                out.append({"toxic": int(toxic > 0), "sentences": n, "sizes": sizes, "ids": ids})
            yield pa.RecordBatch.from_pylist(
                out,
                schema=pa.schema([("toxic", pa.int32()), ("sentences", pa.int32()), ("sizes", pa.list_(pa.int32())), ("ids", pa.list_(pa.int32()))]),
            )

    bags = taken.mapInArrow(encode, "toxic int, sentences int, sizes array<int>, ids array<int>").toArrow()
    return _fitted(bags, vocabulary)


def _fitted(bags: pa.Table, vocabulary: dict[str, int], steps: int = 400, shrink: float = 0.02) -> Model:
    """Weights by gradient ascent (Adam) on the likelihood of the documents' labels."""
    toxic = bags["toxic"].to_numpy().astype(np.float64)
    size = bags["sentences"].to_numpy().astype(np.float64)
    sizes = [np.asarray(s, dtype=np.int64) for s in bags["sizes"].to_pylist()]
    document = np.repeat(np.arange(len(toxic)), [len(s) for s in sizes])
    per = np.concatenate(sizes) if sizes else np.empty(0, np.int64)
    sentence = np.repeat(np.arange(len(per)), per)
    ids = np.concatenate([np.asarray(i, dtype=np.int64) for i in bags["ids"].to_pylist()])
    plain = size - np.bincount(document, minlength=len(toxic))  # sentences without a feature
    length = np.log(np.maximum(size, 1))
    theta = np.zeros(len(vocabulary) + 2)
    theta[:-2] = 0.1
    theta[-2:] = -5.0, -0.5
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for step in range(1, steps + 1):
        every = theta[-2] + theta[-1] * length
        z = np.bincount(sentence, theta[:-2][ids], minlength=len(per)) + every[document]
        p, p0 = 1 / (1 + np.exp(-np.clip(z, -30, 30))), 1 / (1 + np.exp(-np.clip(every, -30, 30)))
        clean = np.bincount(document, np.log1p(-np.minimum(p, 1 - 1e-12)), minlength=len(toxic)) + plain * np.log1p(-p0)
        q = np.exp(clean)
        pull = np.where(toxic > 0, q / np.maximum(1 - q, 1e-9), -1.0)  # d log-likelihood / d z is pull * p
        g, g0 = pull[document] * p, pull * plain * p0
        own = np.bincount(document, g, minlength=len(toxic)) + g0
        gradient = np.concatenate(
            [np.bincount(ids, g[sentence], minlength=len(vocabulary)) - shrink * theta[:-2], [own.sum(), (own * length).sum()]]
        )
        first += 0.1 * (gradient - first)
        second += 0.01 * (gradient**2 - second)
        theta += 0.05 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
    weights = {f: float(theta[i]) for f, i in vocabulary.items()}
    return Model(float(theta[-2]), float(theta[-1]), weights)


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``score``, ``predicted`` and ``offending``, from the whole ``text`` alone.

    ``predicted`` is 1 for scores of 0.5 and more. ``offending`` lists start, end and
    probability of the sentences to blame, in code points. Null and wordless texts score 0.
    Columns that bear the three names are replaced; an empty table gives no rows.
    """
    added = ["score", "predicted", "offending"]
    docs = docs.drop(*added)
    span = T.StructType(
        [T.StructField("start", T.IntegerType()), T.StructField("end", T.IntegerType()), T.StructField("score", T.DoubleType())]
    )
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("score", T.DoubleType()),
            T.StructField("predicted", T.IntegerType()),
            T.StructField("offending", T.ArrayType(span)),
        ]
    )
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            score, spans = [], []
            for text in batch.column("text"):
                value, found = model.judge(text.as_py() or "")
                score.append(min(1.0, max(0.0, value)))
                spans.append([{"start": s, "end": e, "score": p} for s, e, p in found])
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(score, pa.float64()), pa.array([int(s >= 0.5) for s in score], pa.int32()), pa.array(spans, kind)],
                names=[*batch.schema.names, *added],
            )

    return docs.mapInArrow(run, schema)
